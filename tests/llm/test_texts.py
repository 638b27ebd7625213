"""Licences, mixing, chat, subwords, personal data, fingerprints and quality."""

import hashlib
import math
import random
import re
import sys
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cardsentry.llm import catalog, chat_format, fingerprints, licenses, mixing, pii, quality, subword_sampling
from cardsentry.llm.common import read
from tools.compare import rows_of

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    return read(spark, SF, "documents")


# ---- licences


@pytest.mark.parametrize("name", list(catalog.SQL))
def test_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    df = catalog.QUERIES[name](spark, sf_dir)
    cur = con.execute(catalog.SQL[name])
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in cur.description], cur.fetchall())


def test_licences_of_odd_documents(spark):
    mit = next(t for i, t in licenses.TEMPLATES if i == "MIT" and len(t) > 500)
    rows = [
        (1, None),
        (2, ""),
        (3, "nothing here"),
        (4, "text\nReleased under the MIT License.\nmore text"),
        (4, "the same id\nLicensed under CC BY-NC 4.0."),
        (5, f"Copyright\n\n{mit.upper()}\n\nint main() {{}}"),
        (6, mit.replace("sublicense", "rent").replace(" ", "\n")),
        (7, "word " * 50_000 + "\nReleased under the MIT License."),
        (None, "Licensed under the Apache License, Version 2.0."),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("licences", F.lit("x"))
    got = {r.doc_id: (r.licences, r.best_licence) for r in licenses.scan(df).collect()}
    assert got == {
        1: ("", None),
        2: ("", None),
        3: ("", None),
        4: ("CC-BY-NC-4.0,MIT", "CC-BY-NC-4.0"),
        5: ("MIT", "MIT"),
        6: ("MIT", "MIT"),
        7: ("MIT", "MIT"),
        None: ("Apache-2.0", "Apache-2.0"),
    }
    assert licenses.scan(df.limit(0)).collect() == []


def best_windows(text, templates, dice):
    """{template: (dice, first word, words)} by all windows of all lengths."""
    own = licenses.pairs_of(text or "")
    out = {}
    for t, (_, wording) in enumerate(templates):
        bag = licenses.bigrams_of(wording)
        found = [(0.0, 0, 0)]
        for s in range(len(own)):
            for e in range(s + 1, min(len(own), s + licenses.bounds(wording, dice)[1]) + 1):
                seen = set(own[s:e])
                found.append((2 * len(seen & bag) / (len(seen) + len(bag)), -s, s - e))
        best = max(found)
        if best[0] >= dice:
            out[t] = (best[0], -best[1], 1 - best[2])
    return out


@pytest.mark.parametrize("part", [7, licenses.PART])
def test_licence_windows_by_brute_force(spark, part):
    """Notices in the middle of lines, over paragraphs, changed, cut short and repeated, at all places of a part."""
    wording = [
        ("A", "released under the terms of the plain licence"),
        ("B", "the work and the work and the work may be copied by all who ask for the work"),
        ("C", "copied by all"),
    ]
    vocabulary = sorted({w for _, t in wording for w in t.split()}) + ["x", "y"]
    rng = np.random.default_rng(5)
    texts = [None, "", "x", wording[1][1], " ".join([wording[0][1]] * 4), "the work " * 30]
    for i in range(60):
        words = wording[i % 3][1].split()
        for _ in range(rng.integers(0, 4)):
            at = rng.integers(0, len(words))
            words[at : at + rng.integers(0, 2)] = rng.choice(vocabulary, rng.integers(0, 2))
        front, back = rng.choice(vocabulary, i // 2), rng.choice(vocabulary, rng.integers(0, 20))
        texts.append(str(rng.choice([" ", ", ", "\n", "\n\n"])).join([*front, *words, *back]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got: dict = {}
    for r in licenses.spans(df, templates=wording, part=part).collect():
        got.setdefault(r.doc_id, {})[r.template] = (r.dice, r.first_word, r.n_words)
    want = {i: best_windows(text, wording, licenses.DICE) for i, text in enumerate(texts)}
    assert got == {i: w for i, w in want.items() if w}
    assert {t for w in want.values() for t in w} == {0, 1, 2}


def test_licences_inside_other_text(spark):
    mit = next(t for i, t in licenses.TEMPLATES if i == "MIT" and len(t) > 500)
    cut = mit.index("The above"), mit.index("THE SOFTWARE IS")
    three = "\n\n".join([mit[: cut[0]], mit[cut[0] : cut[1]], mit[cut[1] :]])
    rows = [
        (1, f"A long story. {'word ' * 1500}\n\n{three}\n\n{'other ' * 1500}"),
        (2, "It runs quickly. Released under the MIT License. It is small."),
        (3, "\n".join(f"# {line}" for line in three.split(". "))),
        (4, "He was released under the bridge, a permission that is hereby noted, free of doubt."),
    ]
    got = {r.doc_id: r for r in licenses.spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: (r.licence, r.dice) for i, r in got.items()} == {1: ("MIT", 1.0), 2: ("MIT", 1.0), 3: ("MIT", 1.0)}
    # the last two bigrams occur before: the shortest of the best windows ends without them
    assert (got[1].first_word, got[1].n_words) == (1503, len(licenses.pairs_of(mit)) + 1 - 2)
    assert (got[2].first_word, got[2].n_words) == (3, 5)


# ---- mixing


def test_mixing_reaches_margins_and_budget(spark):
    rows = read(spark, "/root/testdata/sf0.01", "documents")
    got = mixing.mix(rows, rounds=40).toPandas()
    assert len(got) == rows.count()
    for margin, power in mixing.MARGINS.items():
        tokens = got.groupby(margin)["tokens"].sum() ** power
        want = tokens / tokens.sum()
        have = (got["weight"] * got["tokens"]).groupby(got[margin]).sum() / got["tokens"].sum()
        assert np.allclose(have, want, atol=1e-6)
    expected = (got["probability"] * got["tokens"]).sum() / got["tokens"].sum()
    assert abs(expected - mixing.KEPT_TOKENS) < 1e-6
    assert abs(got.loc[got["kept"], "tokens"].sum() / got["tokens"].sum() - mixing.KEPT_TOKENS) < 0.1
    assert got["probability"].between(0, 1).all()


def test_raking_goes_on_until_the_margins_are_reached(spark):
    """A table on whose margins 12 rounds are not enough."""
    cells = [("a", "x", "p", 1000), ("b", "x", "p", 60), ("b", "y", "p", 1000), ("c", "y", "p", 60), ("c", "z", "p", 500)]
    df = spark.createDataFrame([*cells, ("a", "z", "p", 60)], "source string, lang string, topic string, tokens long")
    got = mixing.raked(df).toPandas()
    for margin, power in mixing.MARGINS.items():
        tokens = got.groupby(margin)["tokens"].sum() ** power
        have = (got["weight"] * got["tokens"]).groupby(got[margin]).sum() / got["tokens"].sum()
        assert np.allclose(have, tokens / tokens.sum(), rtol=1e-5)


def test_mixing_odd_rows(spark):
    rows = [
        (1, None, None, None, 0),
        (2, "", "en", "a", 0),
        (3, "a b c", None, "a", 5),
        (3, "a b c", None, "a", 5),
        (None, "x " * 30_000, "en", None, 1),
        (5, "y", "en", "a", 1),
    ]
    df = spark.createDataFrame(rows, DOCS).withColumns({"weight": F.lit(1), "row": F.lit(2)})
    got = mixing.mix(df).collect()
    assert len(got) == 6
    assert all(r.weight == 0 and not r.kept for r in got if r.doc_id in (1, 2))
    assert len({r.kept for r in got if r.doc_id == 3}) == 1
    left = mixing.sample(df)
    assert left.columns == df.columns
    assert left.count() == sum(r.kept for r in got)
    assert mixing.mix(df.limit(0)).collect() == []


# ---- chat


def digests(turns):
    """The contract's numbers, straight from the rows."""
    out = {}
    groups = defaultdict(list)
    for conv, turn, role, text in turns:
        groups[conv].append((turn, role or "", text or ""))
    for conv, rows in groups.items():
        rows.sort()
        loss = "".join(t for _, r, t in rows if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, r, t in rows)
        out[conv] = (len(rows), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    turns = [tuple(r) for r in read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    turns += [(-7, 0, "user", catalog.PROBE_TEXT), (-7, 1, "assistant", catalog.PROBE_TEXT)]
    got = catalog.QUERIES["op5_chat_format"](spark, sf_dir).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == digests(turns)
    assert len(got) == len({t[0] for t in turns})


def test_chat_odd_rows(spark):
    control = "### assistant: \\\\###</turn> </turn>\n\\</turn>\\: : \\"
    turns = [
        (1, 0, "user", None),
        (1, 1, "assistant", control),
        (1, 2, None, ""),
        (1, 3, "tool: x ###", "result"),
        (1, 4, "assistant", "é" * 120_000 + control),
        (None, 0, "assistant", "no conversation"),
        (None, 0, "assistant", "no conversation"),
        (3, 5, "system", "<|endoftext|>"),
        (2**60 + 1, 1, "assistant", "far"),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(0))
    encoded, back = chat_format.format_conversations(df)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in back.collect()}
    assert got == digests(turns)
    assert encoded.where("conv_id = 1").count() == 5
    assert chat_format.format_conversations(df.limit(0))[1].collect() == []


def test_escaping_is_reversible():
    rng = random.Random(1)
    for _ in range(5000):
        text = "".join(rng.choice(["\\", "#", "###", "</turn>", ": ", ":", " ", "a", "\n"]) for _ in range(rng.randrange(12)))
        assert chat_format.unescape(chat_format.escape(text)) == text


# ---- subwords


@pytest.fixture(scope="module")
def lattices():
    with open(subword_sampling.MODEL, "rb") as f:
        return subword_sampling.Lattices(subword_sampling.Vocabulary(f.read(), 1.0))


def all_paths(vocabulary, text):
    weights = {
        vocabulary.pieces[i].decode(): (i, w)
        for i, w in zip(vocabulary.node_id.tolist(), vocabulary.node_weight.tolist(), strict=True)
        if i >= 0
    }

    def paths(rest):
        if not rest:
            return [((), 0.0)]
        out = []
        for j in range(1, len(rest) + 1):
            hit = weights.get(rest[:j]) or (vocabulary.bytes_edge(ord(rest[0])) if j == 1 else None)
            if hit:
                out += [((hit[0], *p), math.log(hit[1]) + log) for p, log in paths(rest[j:])]
        return out

    found = paths(text)
    total = np.logaddexp.reduce([log for _, log in found])
    return {p: math.exp(log - total) for p, log in found}


def test_samples_follow_the_lattice(lattices):
    """First and second samples without replacement have the right frequencies, and scores weigh paths without bias."""
    text = lattices.vocabulary.prepared("on the ö")
    paths = all_paths(lattices.vocabulary, text)
    n = 12_000
    first, second, weight = Counter(), Counter(), Counter()
    for i in range(0, n, 500):
        for found in subword_sampling.segmentations([text] * 500, list(range(i, i + 500)), 3, lattices):
            assert len({tuple(f[0].tolist()) for f in found}) == 3
            assert found[0][2] > found[1][2] > found[2][2]
            first[tuple(found[0][0].tolist())] += 1
            second[tuple(found[1][0].tolist())] += 1
            for edges, log, _, score in found:
                assert abs(math.log(paths[tuple(edges.tolist())]) - log) < 1e-9
                weight[tuple(edges.tolist())] += math.exp(-score) / n
    for path, p in paths.items():
        assert abs(first[path] / n - p) < 0.02
        want = sum(q * p / (1 - q) for other, q in paths.items() if other != path)
        assert abs(second[path] / n - want) < 0.02
    common = sorted(paths, key=paths.get)[-3:]
    assert all(abs(weight[p] - 1) < 0.35 for p in common)


def test_all_paths_come_out_once(lattices):
    text = lattices.vocabulary.prepared("and\t7")
    paths = all_paths(lattices.vocabulary, text)
    (found,) = subword_sampling.segmentations([text], [9], 10_000, lattices)
    assert sorted(tuple(f[0].tolist()) for f in found) == sorted(paths)
    assert abs(sum(math.exp(f[1]) for f in found) - 1) < 1e-9
    assert all(f[3] == 0 for f in found)


def test_words_met_twice_stay(lattices, monkeypatch):
    monkeypatch.setattr(subword_sampling, "KNOWN_EDGES", 300)
    vocabulary, own = lattices.vocabulary, subword_sampling.Lattices(lattices.vocabulary)
    for n in range(12):
        text = vocabulary.prepared(f"the number{n} of the unseen€{n * 7} words ßx{n} and the rest" + f" once{n}{n}more" * (n % 2))
        (found,) = subword_sampling.segmentations([text], [n], 3, own)
        (fresh,) = subword_sampling.segmentations([text], [n], 3, subword_sampling.Lattices(vocabulary))
        for (edges, *numbers), (edges_fresh, *numbers_fresh) in zip(found, fresh, strict=True):
            assert edges.tolist() == edges_fresh.tolist()
            assert np.allclose(numbers, numbers_fresh)
    assert f"{subword_sampling.SPACE}the" in own.state_of
    assert f"{subword_sampling.SPACE}number0" not in own.state_of


def test_texts_are_cut_side_by_side(lattices, monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice("▁▁\n\tab€𝄞") for _ in range(rng.randrange(30))) for _ in range(500)] + ["", "▁" * 50, "\n▁a"]
    for _ in range(2):
        units, kind, length, text = subword_sampling.cut(texts)
        assert len(set(units)) == len(units)
        got = [[] for _ in texts]
        for k, n, t in zip(kind.tolist(), length.tolist(), text.tolist(), strict=True):
            got[t].append(units[k])
            assert n == len(units[k])
        assert got == [subword_sampling.UNITS.findall(t) for t in texts]
        monkeypatch.setattr(subword_sampling, "mix64", lambda x: x * 0)  # all sums are equal
    assert subword_sampling.cut(["", ""])[0] == []


def test_known_words_are_no_objects(lattices):
    """A worker keeps words in arrays: a text of new words leaves fewer objects than words."""
    rng = random.Random(8)
    text = lattices.vocabulary.prepared(" ".join("".join(rng.choices("abcdefgh", k=9)) for _ in range(20_000)))
    own = subword_sampling.Lattices(lattices.vocabulary)
    before = sys.getallocatedblocks()
    for _ in subword_sampling.segmentations([text], [3], 2, own):
        pass
    assert sys.getallocatedblocks() - before < 10_000
    assert len(own.state_of) > 19_900


def test_words_of_equal_sums_keep_their_lattices(lattices, monkeypatch):
    rng = random.Random(9)
    texts = [" ".join(rng.choice(("a", "the", "then", "het", "ö€", "on\n")) for _ in range(12)) for _ in range(30)] + ["", "the"]
    texts = [lattices.vocabulary.prepared(t) for t in texts]
    want = list(subword_sampling.segmentations(texts, range(len(texts)), 2, subword_sampling.Lattices(lattices.vocabulary)))
    monkeypatch.setattr(subword_sampling, "mix64", lambda x: x * 0)
    own = subword_sampling.Lattices(lattices.vocabulary)
    for _ in range(2):
        for a, b in zip(want, subword_sampling.segmentations(texts, range(len(texts)), 2, own), strict=True):
            assert [(p.tolist(), *numbers) for p, *numbers in a] == [(p.tolist(), *numbers) for p, *numbers in b]
    assert len(own.state_of) > 5


def test_table_finds_what_was_put():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 63, 60_000))
    table = subword_sampling.Table(4)
    for part in np.array_split(rng.permutation(len(keys)), 9):
        table.put(keys[part], part)
    assert (table.get(keys) == np.arange(len(keys))).all()
    other = rng.integers(0, 1 << 63, 1_000)
    assert (table.get(other[~np.isin(other, keys)]) == -1).all()


def test_sequences_that_do_not_spell_their_text(lattices):
    vocabulary = lattices.vocabulary
    texts = [vocabulary.prepared(t) for t in ("on the table", "", "of it", "ö €")]
    paths = [f[0][0] if f else np.zeros(0, np.int32) for f in subword_sampling.segmentations(texts, [1, 2, 3, 4], 1, lattices)]
    ids, begin = vocabulary.ids_of(np.concatenate(paths))
    lengths = np.diff(begin[np.cumsum([len(p) for p in paths])], prepend=0)
    coded = [t.encode() for t in texts]
    assert subword_sampling.spells(vocabulary, ids, lengths, coded).tolist() == [True] * 4
    for wrong in (b"longer" + coded[2], b"x" * len(coded[2])):
        assert subword_sampling.spells(vocabulary, ids, lengths, [*coded[:2], wrong, coded[3]]).tolist() == [True, True, False, True]


def test_samples_of_documents(spark, docs):
    got = subword_sampling.sample_segmentations(docs)
    assert got.count() == 2 * docs.count()
    assert got.where("NOT round_trip OR isnan(log_inclusion) OR log_inclusion > 0 OR log_inclusion < log_prob - 50 OR log_prob > 1e-9").count() == 0
    again = subword_sampling.sample_segmentations(docs.repartition(3))
    assert sorted(map(str, got.collect())) == sorted(map(str, again.collect()))
    back = subword_sampling.decode(got.where("sample = 2")).join(docs.select("doc_id", F.col("text").alias("own")), "doc_id")
    assert back.where("text != own").count() == 0
    both = subword_sampling.sample_segmentations(docs, decoded=True).withColumnRenamed("text", "spelled")
    assert subword_sampling.decode(both).where("NOT spelled <=> text").count() == 0


def test_samples_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "ab" * 30_000), (3, "ab" * 30_000), (None, "日本 \n\t x"), (5, "\x00퟿"), (6, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1))
    got = subword_sampling.sample_segmentations(df).collect()
    assert all(r.round_trip for r in got)
    count = Counter(r.doc_id for r in got)
    assert (count[1], count[2], count[3], count[None], count[5]) == (1, 1, 4, 2, 1) or count[5] >= 1
    assert len({str(r.ids) for r in got if r.doc_id == 3}) == 2
    assert subword_sampling.sample_segmentations(df.limit(0)).collect() == []


# ---- personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn_sum(digits):
    back = [int(c) for c in digits[::-1]]
    return sum(back[::2]) + sum(sum(divmod(2 * x, 10)) for x in back[1::2])


def plain_spans(text):
    only = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(only(m)) <= 19 and luhn_sum(only(m)) % 10 == 0]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(only(m)) <= 15]


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(1)
    for _ in range(30_000):
        text = "".join(rng.choice("0123456789" * 2 + ".-+ ()@ab.@Z%\n") for _ in range(rng.randrange(60)))
        assert pii.base_spans(text) == plain_spans(text)


def test_personal_data_of_documents(spark, docs):
    model = pii.fit(docs)
    got = {r.doc_id: r for r in pii.find(docs, model).collect()}
    for r in docs.collect():
        want = plain_spans(r.text)
        row = got[r.doc_id]
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in want) for k in pii.KINDS]
        assert set(joined.split(",")) <= set(row.spans.split(","))
    clean = pii.redact(docs, model)
    assert clean.columns == docs.columns
    assert all(not plain_spans(r.text) for r in clean.collect())


def test_trees_add_spelled_out_data(spark):
    """Candidates that words before them give away teach their format, which is then found without such words."""
    rng = random.Random(3)
    rows = []
    for i in range(400):
        n = f"({rng.randrange(200, 999)}) {rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}"
        code = "".join(rng.choice("0123456789") for _ in range(11))
        rows.append((i, f"please phone {n} today, lot {code} is on the shelf"))
    model = pii.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    found = [text[s:e] for text in ["at (415) 555-2671 now", "lot 48151623421 now"] for _, s, e in model.spans(text)[1]]
    assert found == ["(415) 555-2671"]


def test_spans_are_added_at_production_density(spark, tmp_path):
    """Few of many documents have personal data; the kind is added although no 4,000 documents hold enough examples."""
    rng = random.Random(5)
    rows = []
    for i in range(12_000):
        n = f"({rng.randrange(200, 999)}) {rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}"
        said = {0: f"please phone {n} today", 1: f"lot {rng.randrange(10**10, 10**11)} is here"}.get(i % 60, "nothing at all")
        rows.append((i, f"text {i} says {n} now" if i in (77, 7_777) else f"text {i} says {said}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.QUERIES["op8_pii"](spark, str(tmp_path)).where("n_added > 0 AND doc_id IN (77, 7777) OR n_added > 0 AND doc_id % 60 = 1").collect()
    assert {r.doc_id: r.spans for r in got} == {77: "phone:13:27", 7777: "phone:15:29"}
    model = pii.fit(docs, sample=20)  # bounded candidates, thresholds from all
    assert list(model.thresholds) == ["phone"]


def test_personal_data_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a" * 200_000 + "@x.y " + "1" * 100_000), (3, "a@b.c"), (None, "a@b.c")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("x"))
    model = pii.fit(df)
    got = pii.find(df, model)
    assert sorted((r.n_email for r in got.collect())) == [0, 0, 1, 1, 1]
    assert pii.find(df.limit(0), pii.fit(df.limit(0))).collect() == []
    assert sorted(str(r.text)[-10:] for r in pii.redact(df, model).where("doc_id IS NULL OR doc_id < 3").collect()) == ["", "None", "[EMAIL]"]


# ---- fingerprints


def simhash(text):
    words = [w for w in re.split("[ \t\n\x0b\f\r]+", (text or "").lower()) if w]
    terms = list(zip(words, words[1:], strict=False)) or [(w, None) for w in words]
    votes = np.zeros(64, int)
    for a, b in terms:
        h = xxhash.xxh64_intdigest(a.encode(), 42)
        h = h if b is None else xxhash.xxh64_intdigest(b.encode(), h)
        votes += np.array([(h >> i) & 1 for i in range(64)]) * 2 - 1
    return sum(1 << i for i in range(64) if votes[i] > 0)


def brute_fingerprints(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    prints = {i: simhash(t) for i, t in rows}
    out = {}
    for k, (i, text) in enumerate(rows):
        after_id, after = rows[(k + 1) % len(rows)]
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        like = lambda a, b: 1 - bin(a ^ b).count("1") / 64
        near = sum(bin(prints[i] ^ p).count("1") <= 3 for p in prints.values()) - 1
        out[i] = (
            len(text),
            hashlib.sha256(edited.encode()).hexdigest(),
            f"{prints[i]:016x}",
            f"{simhash(edited):016x}",
            like(prints[i], simhash(edited)),
            like(prints[i], prints[after_id]),
            near if i % 50 == 0 else None,
        )
    return out


def test_fingerprint_query(spark, docs):
    got = {r.doc_id: tuple(r)[1:] for r in catalog.QUERIES["op7_fingerprints"](spark, SF).collect()}
    assert got == brute_fingerprints([(r.doc_id, r.text) for r in docs.collect()])


def test_fingerprints_of_odd_rows(spark):
    rows = [(0, None), (50, ""), (3, "one"), (100, "One"), (7, "ü é\tß " * 3000), (8, "x y z"), (150, " \n ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.lit("x"))
    got = {r.doc_id: tuple(r)[1:] for r in fingerprints.with_edits(df).collect()}
    assert got == brute_fingerprints(rows)
    more = df.union(df.limit(1)).union(df.sparkSession.createDataFrame([(None, "x", "x")], df.schema))
    assert fingerprints.with_edits(more).count() == len(rows) + 1
    assert fingerprints.with_edits(df.limit(0)).collect() == []


@pytest.mark.parametrize("radius", [0, 2, 5])
def test_all_near_fingerprints_are_found(spark, radius):
    rng = random.Random(radius)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    base = [rng.getrandbits(64) for _ in range(20)]
    near = [b ^ sum(1 << i for i in rng.sample(range(64), rng.randrange(8))) for b in base for _ in range(15)]
    values = sorted({*base, *near})
    df = spark.createDataFrame([(signed(v),) for v in values], "fingerprint long")
    got = fingerprints.within(df.select(F.col("fingerprint").alias("query")), df, radius).collect()
    want = {(signed(a), signed(b)) for a in values for b in values if bin(a ^ b).count("1") <= radius}
    assert {(r.query, r.fingerprint) for r in got} == want
    assert len(got) == len(want)


# ---- quality


def test_quality_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    scored = catalog.QUERIES["op10_quality"](spark, sf_dir)
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality")
    got = scored.where("held_out").join(labels, "doc_id").toPandas()
    assert len(got) > 500
    assert (got["predicted"] == got["quality"]).mean() > 0.97
    ranks = got["score"].rank()
    good = got["quality"] == 1
    auc = (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.98


def test_quality_of_odd_rows(spark, docs):
    labels = read(spark, SF, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(docs, labels)
    rows = [(1, None), (2, ""), (3, " \n"), (3, "word " * 100_000), (None, "ü")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x"))
    got = quality.score(df, model)
    assert got.columns == [*df.columns, "predicted"]
    assert got.where("score < 0 OR score > 1 OR score IS NULL OR isnan(score)").count() == 0
    assert len({r.score for r in got.collect() if not (r.text or "").strip()}) == 1
    assert quality.score(df.limit(0), model).collect() == []
    none = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(df, none).collect()} == {0.5}
    odd = spark.createDataFrame([(None, 1), (0, None), (0, 7), (10**9, 1)], "doc_id long, label int")
    assert {r.score for r in quality.score(df, quality.fit(docs, odd)).collect()} == {0.5}


def planted_documents(n=1200):
    """(text, [(start, end) of personal data that the patterns don't find], [(start, end) of decoys])"""
    rng = random.Random(17)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randrange(3, 9)))
    out = []
    for i in range(n):
        kind = i % 6
        if kind == 0:
            item, cue = f"{word()}.{word()} [at] {word()} [dot] org", "mail"
        elif kind == 1:
            item, cue = f"(0{digits(2)}) {digits(3)} {digits(4)}", "phone"
        elif kind == 2:
            item, cue = f"{digits(4)}-{digits(4)}-{digits(4)}-{digits(3)}0", "card"
            while pii.base_spans(item):
                item = f"{digits(4)}-{digits(4)}-{digits(4)}-{digits(3)}0"
        elif kind == 3:
            item, cue = f"{rng.randrange(300, 999)}.{digits(2)}.{digits(2)}.{digits(2)}", "host"
        elif kind == 4:
            item, cue = digits(9), None  # an order number
        else:
            item, cue = f"{digits(2)}/{digits(2)}/{digits(4)}", None  # a date
        # a third of the items come without a word that tells what they are
        lead = f"{word()} {word()} {cue} " if cue and rng.random() < 0.67 else f"{word()} {word()} {word()} "
        text = f"{lead}{item} {word()} {word()} {i}"
        out.append((text, [(len(lead), len(lead) + len(item))] if cue else [], [] if cue else [(len(lead), len(lead) + len(item))]))
    return out


def test_trees_add_what_the_patterns_miss(spark):
    planted = planted_documents()
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(planted)], "doc_id long, text string")
    model = pii.fit(df, precision=0.6)  # a third of the planted items lack the word that the labels rest on
    assert set(model.thresholds) == set(pii.KINDS)
    hit = missed = wrong = 0
    for text, items, decoys in planted:
        base, spans = model.spans(text)
        added = {(s, e) for k, s, e in spans if (k, s, e) not in base}
        hit += sum(i in added for i in items)
        missed += sum(i not in added for i in items)
        wrong += sum(any(s < de and e > ds for s, e in added) for ds, de in decoys)
    assert hit / (hit + missed) >= 0.95 and hit / (hit + wrong) >= 0.97


def test_thresholds_and_scores_recomputed(spark):
    """Counts over all candidates that no pattern covers, by a loop; scores of one tree after the other."""
    planted = planted_documents(600)
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(planted)], "doc_id long, text string").repartition(3)
    model = pii.fit(df, precision=0.6)
    rows = {k: [] for k in pii.KINDS}
    for text, _, _ in planted:
        base = pii.base_spans(text)
        for p in pii.proposals(text):
            if all(p[2] <= s or p[1] >= e for _, s, e in base):
                x = np.array([pii.describe(text, p)], np.float64)
                score = math.floor(float(model.trees[pii.digest_of(text) % 2].raw(x)[0]) * pii.STEP)
                rows[p[0]].append((score, any(w in pii.CUES for w in pii.words_before(text, p[1]))))
    for kind, found in rows.items():
        steps = sorted({s for s, _ in found})
        good = [s for s in steps if (over := [y for t, y in found if t >= s]) and len(over) >= pii.LEAST_EXAMPLES and sum(over) / len(over) >= 0.6]
        assert model.thresholds.get(kind) == (min(good) / pii.STEP if good else None)


def test_pii_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    model = pii.fit(df)
    assert model.thresholds == {} and pii.find(df, model).collect() == [] and pii.redact(df, model).collect() == []


def test_margins_that_are_never_reached_end_with_a_warning(spark, monkeypatch):
    """The targets of a sparse table contradict each other, and the weights don't come to rest in the rounds there are."""
    monkeypatch.setattr(mixing, "MOST_ROUNDS", 12)
    monkeypatch.setattr(mixing, "RESTED", 0.0)
    rows = [("a", "x", "p", 1000), ("a", "y", "p", 1), ("b", "y", "q", 1000), ("c", "z", "q", 5)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    with pytest.warns(UserWarning, match="margins are off"):
        out = mixing.raked(cells, mixing.MARGINS, 12).collect()
    assert len(out) == 4 and all(r.weight > 0 and math.isfinite(r.weight) for r in out)
