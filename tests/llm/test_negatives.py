"""Hard negatives against all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardsentry.llm import catalog, hard_negatives
from tools.compare import compare, connect

VECTORS = "vec_id long, label int, embedding array<float>"


def brute(rows, is_anchor, positives=5, negatives=5, window=(80, 100)):
    """Rows of (vec_id, label, embedding); numbers are Python's integers."""
    known = []
    for vec_id, label, e in rows:
        if label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            known.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in e]))
    out = []
    order = lambda t: (-t[0], t[1] is None, t[1] or 0)
    for i, (a, label, q) in enumerate(known):
        if a is None or not is_anchor(a):
            continue
        scored = [
            (sum(x * y for x, y in zip(q, v, strict=True)), b, other)
            for j, (b, other, v) in enumerate(known)
            if i != j and len(v) == len(q)
        ]
        near = sorted((s for s in scored if s[2] == label), key=order)[:positives]
        far = sorted((s for s in scored if s[2] != label), key=order)
        for p, b, _ in near:
            inside = [s for s in far if window[0] * p <= 100 * s[0] <= window[1] * p][:negatives]
            out += [(a, b, n + 1, c, p, s) for n, (s, c, _) in enumerate(inside)]
    return sorted(out, key=str)


def answer(df, **options):
    return sorted(map(tuple, hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, **options).collect()), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query_against_sql(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    ok, message, _ = compare(spark, connect(sf_dir), "op11_hard_negatives", sf_dir)
    assert ok, message
    assert catalog.QUERIES["op11_hard_negatives"](spark, sf_dir).count() > 0


@pytest.mark.parametrize("tree_rows", [4096, 40])
def test_odd_rows(spark, tree_rows):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        centre = rng.randrange(6)
        e = [math.cos(centre + k) + rng.gauss(0, 0.1) for k in range(6)]
        rows.append((i, rng.randrange(4), e))
    rows += [(1000 + i, i % 3, rows[0][2]) for i in range(60)]  # ties: copies of an anchor
    rows += [rows[10]] * 3  # repeated anchors
    rows += [(None, 1, rows[0][2]), (None, 2, rows[10][2]), (20, None, rows[0][2]), (30, 1, None), (40, 2, [1.0, None] * 3)]
    rows += [(50, 2, [1.0, float("nan")] * 3), (60, 2, [float("inf")] * 6), (70, 1, []), (71, 1, []), (72, 2, [])]
    rows += [(80, 1, [0.0] * 6), (81, 1, [0.0] * 6), (90, -3, [0.5, 0.5]), (91, -3, [0.5, 0.25]), (92, 7, [0.4, 0.4])]
    df = spark.createDataFrame(rows, VECTORS).withColumn("node", F.lit(1)).withColumn("rank", F.lit("x")).repartition(5)
    want = brute(rows, lambda a: a % 10 == 0)
    assert len(want) > 500
    assert answer(df, tree_rows=tree_rows, anchor_block=7) == want
    assert answer(df.limit(0)) == []


def test_scores_beyond_exact_doubles(spark):
    rng = random.Random(5)
    rows = [(i, i % 2, [float(np.float32(rng.gauss(0, 1) * 1e5)) for _ in range(4)]) for i in range(60)]
    df = spark.createDataFrame(rows, VECTORS)
    assert answer(df) == brute(rows, lambda a: a % 10 == 0)


def test_cover_tree_holds_every_row_within_its_radii():
    rng = np.random.default_rng(1)
    x = np.floor(256 * np.concatenate([rng.normal(size=(300, 8)), np.repeat(rng.normal(size=(1, 8)), 50, axis=0)]))
    order, centre, start, reach = hard_negatives.cover_tree(x)
    assert sorted(order.tolist()) == list(range(len(x)))
    tree = hard_negatives.Tree(x[order], centre, start, reach)
    m2 = tree.square.max()
    on_sphere = np.column_stack([tree.x, np.sqrt(m2 - tree.square)]) / np.sqrt(m2)
    angle = np.arccos(np.clip(on_sphere @ on_sphere.T, -1, 1))

    def below(s):
        rows = list(range(tree.start[s], tree.end[s]))
        for r in list(rows):
            if tree.first[r] >= 0:
                rows += below(tree.first[r])
        return rows + (below(tree.next[s]) if tree.next[s] >= 0 else [])

    for s in range(1, len(start)):
        assert angle[centre[s], below(s)].max() <= reach[s] + 1e-6
    assert len(below(tree.first[0])) == len(x) - 1


def test_search_leaves_far_nodes_alone():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16))
    x = np.floor(256 * (np.repeat(centres, 50, axis=0) + 0.02 * rng.normal(size=(1000, 16))))
    order, *rest = hard_negatives.cover_tree(x)
    tree = hard_negatives.Tree(x[order], *rest)
    seen = 0
    plain = tree.scores

    def counted(q, low, high):
        nonlocal seen
        seen += high - low
        return plain(q, low, high)

    tree.scores = counted
    rank = np.arange(len(x))
    for q in x[:20]:
        got = tree.best(q, rank, 5, -math.inf, math.inf)
        assert [s for s, _ in got] == sorted((tree.x @ q).tolist(), reverse=True)[:5]
    assert seen < 20 * len(x) / 3
