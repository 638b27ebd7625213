"""Near-duplicate operators against brute force over all pairs."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardsentry.llm import catalog, embedding_dedup, minhash_dedup
from cardsentry.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


class Parts(dict):
    def top(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.top(a), self.top(b)
        self[max(a, b)] = min(a, b)


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_groups(rows):
    """{doc_id: (n_shingles, component)} of rows (doc_id, text) with distinct ids."""
    sets = {i: shingle_set(t) for i, t in rows}
    at = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            at[x].append(i)
    common = defaultdict(int)
    for ids in at.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                common[a, b] += 1
    parts = Parts()
    for (a, b), n in common.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            parts.join(a, b)
    return {i: (len(sets[i]), parts.top(i)) for i in sets}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_minhash_query(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    got = catalog.QUERIES["op4_minhash_near_dedup"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = brute_groups([(r.doc_id, r.text) for r in docs])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len(got) == len(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_minhash_chain_and_large_family(spark):
    """A family whose members reach each other only step by step, cut into many blocks."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(90):
        rows.append((i, " ".join(words)))
        if i % 2:
            words[(i * 7) % 120] = f"x{i}"
    rows += [(1000 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(60))) for i in range(30)]
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=8).collect()
    want = brute_groups(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) < 60


def test_minhash_odd_rows(spark):
    rows = [
        (1, None, "a"),
        (2, "", "a"),
        (3, " \t\n ", "a"),
        (4, "one two", "a"),
        (5, "ONE\ttwo ", "a"),
        (5, "ONE\ttwo ", "a"),
        (None, "one two", "a"),
        (None, "only without an id", "a"),
        (6, "ÄRGER two three four five six", "a"),
        (7, "ärger two three four five six", "a"),
        (8, "long " * 40_000, "a"),
        (9, "long " * 40_001, "a"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(df).collect()), key=str)
    want = [
        (1, 0, 1, True),
        (2, 0, 2, True),
        (3, 0, 3, True),
        (4, 1, 4, True),
        (5, 1, 4, False),
        (5, 1, 4, False),
        (None, 1, 4, False),
        (None, 1, None, True),
        (6, 2, 6, True),  # only A to Z are lower-cased
        (7, 2, 7, True),
        (8, 1, 8, True),
        (9, 1, 8, False),
    ]
    assert got == sorted(want, key=str)
    assert minhash_dedup.near_duplicates(df.limit(0)).collect() == []
    left = minhash_dedup.drop_near_duplicates(df.where("doc_id >= 4"))
    assert sorted(r.doc_id for r in left.collect()) == [4, 6, 7, 8]
    assert left.columns == df.columns


def test_minhash_repeated_rows_beside_a_near_copy(spark):
    """Repeated rows, copies without an id and many texts of one id don't add up in a block."""
    words = [f"w{i}" for i in range(100)]
    text, near = " ".join(words), " ".join([*words, "more"])
    other, beside = " ".join(words[::-1]), " ".join([*words[::-1], "more"])
    rows = [(7, text)] * 3000 + [(8, near)] + [(None, other)] * 3000 + [(9, beside)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(df).collect())
    assert got == {(7, 7, True): 3000, (8, 7, False): 1, (None, 9, False): 3000, (9, 9, True): 1}
    copies = [(1, 1, 403, text)] * 3000 + [(2, 1, 403, near), (5, 1, 403, None), (5, 1, 403, "")]
    copies += [(3, 1, 403, f"{text} {i}") for i in range(401)]
    members = spark.createDataFrame(copies, "node long, family long, n_family long, text string")
    groups = minhash_dedup.blocked(members, 64, minhash_dedup.WORDS).groupBy("family", "i", "j").count().collect()
    assert len(groups) == 7 * 8 / 2
    assert max(r["count"] for r in groups) < 3 * 64


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(50)] + [(7, 7), (2000, 2001), (2001, 2000)]
    got = components(spark.createDataFrame([*links, (None, 3)], "a long, b long")).collect()
    want = {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(50)}, 2000: 2000, 2001: 2000}
    assert {r.node: r.component for r in got} == want
    assert len(got) == len(want)


def brute_vectors(rows):
    good = {}
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64) / np.abs(v).max()
            good[i] = x / np.linalg.norm(x)
    parts, links = Parts(), defaultdict(int)
    keys = list(good)
    for n, i in enumerate(keys):
        for j in keys[n + 1 :]:
            if len(good[i]) == len(good[j]) and good[i] @ good[j] >= 0.95:
                links[i] += 1
                links[j] += 1
                parts.join(i, j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[parts.top(i)].append(i)
    least = {g: min((rows[i][0] for i in m if rows[i][0] is not None), default=None) for g, m in groups.items()}
    return [(rows[i][0], links[i], least[parts.top(i)]) for i in range(len(rows))]


def test_embedding_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = catalog.QUERIES["op1_embedding_near_dedup"](spark, sf_dir).collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == sorted(brute_vectors(rows))


@pytest.mark.parametrize("doubts", [0, 1000])
def test_embedding_clusters_in_blocks(spark, doubts):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((6, 16))
    rows = [(i, [float(x) for x in centres[i % 6] + 0.18 * rng.standard_normal(16)]) for i in range(240)]
    rows += [(500 + i, rows[i][1]) for i in range(20)]  # copies
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    # with no undecided pair allowed, blocks are done again by whole vectors
    got = embedding_dedup.near_duplicate_vectors(df, block=16, bucket=16, doubts=doubts).collect()
    want = brute_vectors(rows)
    assert sum(n for _, n, _ in want) > 2000
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == sorted(want)


def test_embedding_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, None),
        (2, []),
        (3, [0.0, 0.0]),
        (4, [1.0, None]),
        (5, [inf, 1.0]),
        (6, [nan, 1.0]),
        (7, [1.0, 0.0]),
        (7, [1.0, 0.0]),
        (8, [1e300, 1e290]),
        (9, [1e-300, 0.0]),
        (10, [1.0, 0.0, 0.0]),
        (None, [2.0, 0.0]),
        (None, [0.0, -1.0]),
        (11, [0.0, 1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n_links", F.lit("x"))
    got = embedding_dedup.near_duplicate_vectors(df).collect()
    key = lambda t: tuple(map(str, t))
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=key) == sorted(brute_vectors(rows), key=key)
    assert embedding_dedup.near_duplicate_vectors(df.limit(0)).collect() == []


def test_number_of_tables_follows_the_recall():
    for n in (10, 10_000, 10**9):
        tables, bits = embedding_dedup.tables_and_bits(n, 0.95)
        same = 1 - np.arccos(0.95) / np.pi
        assert (1 - same**bits) ** tables <= embedding_dedup.MISSED
