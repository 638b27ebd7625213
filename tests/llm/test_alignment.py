"""Alignment of two tokenizers against loops over all tokens."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardsentry.llm import alignment, catalog
from cardsentry.llm.byte_level import byte_of_symbol

DOCS = "doc_id long, text string"


def brute(rows):
    """Rows of the query, and {(a, b): documents}."""
    a_side = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte = byte_of_symbol()

    def b_bytes(i):
        piece = b_side.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_side.is_byte(i) else piece.replace("▁", " ").encode()

    docs, pairs = [], Counter()
    for doc_id, text in rows:
        a = a_side.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_side.encode(text or "")
        a_raw = [bytes(byte[c] for c in a_side.id_to_token(i)) for i in a]
        b_raw = [b_bytes(i) for i in b]
        whole = b" " + (text or "").encode()
        if not text or b"".join(a_raw) != whole or b"".join(b_raw) != whole:
            docs.append((doc_id, [], [], [], ""))
            continue
        ends = lambda raw: np.cumsum([len(x) for x in raw]).tolist()
        a_ends, b_ends = ends(a_raw), ends(b_raw)
        links = []
        j = 0
        for i, end in enumerate(a_ends):  # every pair whose ranges overlap
            start = a_ends[i - 1] if i else 0
            while b_ends[j] <= start:
                j += 1
            k = j
            while k < len(b) and (b_ends[k - 1] if k else 0) < end:
                links.append((a[i], b[k]))
                k += 1
        common = sorted(set(a_ends) & set(b_ends))
        parts, i, j = [], 0, 0
        for end in common:
            own_a = [x for x, e in zip(a[i:], a_ends[i:], strict=True) if e <= end]
            own_b = [x for x, e in zip(b[j:], b_ends[j:], strict=True) if e <= end]
            i, j = i + len(own_a), j + len(own_b)
            parts.append(",".join(map(str, own_a)) + "|" + ",".join(map(str, own_b)))
        docs.append((doc_id, a, b, links, ";".join(parts)))
        pairs.update(set(links))
    best = defaultdict(int)
    for (a, _), n in pairs.items():
        best[a] = max(best[a], n)
    out = []
    for doc_id, a, b, links, text in docs:
        n_best = sum(pairs[x] == best[x[0]] for x in links)
        groups = text.count("|") if text else 0
        sha = hashlib.sha256(text.encode()).hexdigest() if text else ""
        out.append((doc_id, len(a), len(b), groups, len(links), n_best, sum(pairs[x] for x in links), sha))
    return sorted(out, key=str), pairs


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = catalog.QUERIES["op12_alignment"](spark, sf_dir)
    assert got.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert sorted(map(tuple, got.collect()), key=str) == brute([tuple(r) for r in rows])[0]


ODD = [
    (1, None), (2, ""), (3, " "), (4, "a b  c\r\n\td"), (5, "▁x holds the mark"), (6, "<|endoftext|> and </s><0x41>"), (7, "x" * 9000),
    (8, "é𝄞 naïve ﬁ 東京 Москва 👩‍👩‍👧"), (9, "the cat sat on the mat " * 800), (None, "no id"), (None, "no id"), (9, "the cat"), (10, " leading"),
    (11, "nul \x00 byte"),
]


@pytest.mark.parametrize("run_links, fan_in", [(3_000_000, 128), (400, 2), (1, 3)])
def test_odd_rows_in_many_runs(spark, run_links, fan_in):
    rows = ODD + [(100 + i, "a copy that many documents share") for i in range(40)]
    rows += [(200 + i, f"the {i} of words and {i * i} numbers, or the wor{i}ds") for i in range(40)]
    df = spark.createDataFrame(rows, DOCS).withColumn("run", F.lit("r")).withColumn("part", F.lit("p")).repartition(5)
    out, counts, folder = alignment.align(df, radix_bits=3, run_links=run_links, fan_in=fan_in)
    want, pairs = brute(rows)
    assert sorted(map(tuple, out.collect()), key=str) == want
    found = alignment.pair_counts(counts, folder).collect()
    assert {(r.a, r.b): r.n_docs for r in found} == dict(pairs)
    assert len(found) == len(pairs)


def test_empty_table(spark):
    df = spark.createDataFrame([], DOCS)
    assert alignment.align(df)[0].collect() == []
    assert [tuple(r)[1:] for r in alignment.align(spark.createDataFrame([(1, None)], DOCS))[0].collect()] == [(0, 0, 0, 0, 0, 0, "")]


def test_merge_and_maxima_in_small_blocks():
    rng = np.random.default_rng(3)
    whole, runs = Counter(), []
    for _ in range(9):
        pairs = np.unique(rng.integers(0, 40, 300) << alignment.PAIR_BITS | rng.integers(0, 30, 300))
        n = rng.integers(1, 5, len(pairs))
        whole.update(dict(zip(pairs.tolist(), n.tolist(), strict=True)))
        cut = sorted(rng.choice(np.arange(1, len(pairs)), 6, replace=False).tolist())
        runs.append(iter([*zip(np.split(pairs, cut), np.split(n, cut), strict=True)]))
    blocks = list(alignment.sized(alignment.with_maxima(alignment.merged(runs)), 17))
    assert all(len(b[0]) == 17 for b in blocks[:-1])
    pairs, counts, marks = (np.concatenate(c) for c in zip(*blocks, strict=True))
    assert (np.diff(pairs) > 0).all()
    assert dict(zip(pairs.tolist(), counts.tolist(), strict=True)) == whole
    top = defaultdict(int)
    for p, n in whole.items():
        top[p >> alignment.PAIR_BITS] = max(top[p >> alignment.PAIR_BITS], n)
    assert marks.tolist() == [int(n == top[p >> alignment.PAIR_BITS]) for p, n in zip(pairs.tolist(), counts.tolist(), strict=True)]
