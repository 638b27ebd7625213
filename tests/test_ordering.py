import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardsentry.operators import ordering as O


def test_running_totals_match_a_loop(spark):
    rng = random.Random(1)
    # one group holds most of the rows, and its order values tie up to the id
    rows = [("big" if rng.random() < 0.8 else rng.choice("abc"), rng.randrange(40), i, rng.randrange(-5, 9)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, o int, id int, v int").repartition(5)
    got = O.running_totals(
        df, ["g"], [F.col("o"), F.col("id")], sums={"s": "v"}, prior_sums={"p": "v"}, prior_max={"hi": "v"}, prior_min={"lo": "v"}
    ).collect()
    assert len(got) == len(rows)
    seen: dict[str, list[int]] = {}
    want = {}
    for g, _, i, v in sorted(rows):
        past = seen.setdefault(g, [])
        want[i] = (sum(past) + v, sum(past), max(past, default=None), min(past, default=None))
        past.append(v)
    assert {r["id"]: (r["s"], r["p"], r["hi"], r["lo"]) for r in got} == want


def test_running_totals_without_groups_descending(spark):
    df = spark.range(1, 1001).withColumn("v", F.lit(1))
    got = O.running_totals(df, [], [F.col("id").desc()], sums={"s": "v"}).collect()
    assert {r["id"]: r["s"] for r in got} == {i: 1001 - i for i in range(1, 1001)}


@pytest.mark.parametrize("listed", [60_000, 50])
def test_ranks_and_quantiles_are_exact(spark, monkeypatch, listed):
    monkeypatch.setattr(O, "LISTED_ROWS", listed)
    rng = np.random.default_rng(2)
    heavy = np.round(np.exp(rng.normal(0, 4, 3000)), 2)  # a long tail and many repeats
    flat = np.full(3000, 7.0)
    signed = rng.normal(0, 1, 3000)
    holes = [None if i % 3 else float(v) for i, v in enumerate(signed)]
    rows = [(float(a), float(b), float(c), d, float("nan")) for a, b, c, d in zip(heavy, flat, signed, holes, strict=True)]
    df = spark.createDataFrame(rows, "heavy double, flat double, signed double, holes double, nothing double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    sizes, fetch = [], type(df).toPandas
    monkeypatch.setattr(type(df), "toPandas", lambda self: sizes.append(len(out := fetch(self))) or out)
    got = O.exact_quantiles(df, ["heavy", "flat", "signed", "holes", "nothing"], probs)
    assert got["nothing"] is None
    assert max(sizes) <= (10_000 if listed == 60_000 else 32 * 3 * 14)  # a pass returns buckets, not rows
    for name, values in (("heavy", heavy), ("flat", flat), ("signed", signed), ("holes", [v for v in holes if v is not None])):
        assert got[name] == pytest.approx(list(np.quantile(values, probs)), abs=1e-12)


@pytest.mark.parametrize("listed", [60_000, 40])
def test_ranks_among_numbers_of_any_size(spark, monkeypatch, listed):
    monkeypatch.setattr(O, "LISTED_ROWS", listed)
    rng = np.random.default_rng(4)
    columns = {
        "ends": [np.inf, -np.inf, *rng.normal(0, 1, 498)],
        "far": [1.7e308, -1.7e308, 1e300, *rng.normal(0, 1, 497)],
        "tiny": [5e-324, -5e-324, 0.0, *rng.normal(0, 1e-310, 497)],
        "spread": list(10.0 ** rng.uniform(-300, 300, 500)),
        "heavy": [7.5] * 450 + [float("inf")] * 50,
        "close": list(1e15 + np.arange(500) / 8),
    }
    rows = list(zip(*([float(x) for x in v] for v in columns.values()), strict=True))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))
    passes, fetch = [], type(df).toPandas
    monkeypatch.setattr(type(df), "toPandas", lambda self: passes.append(1) or fetch(self))
    ranks = [0, 1, 250, 498, 499]
    got = O.values_at_ranks(df, {c: ranks for c in columns})
    assert len(passes) <= 8
    for c, values in columns.items():
        want = sorted(values)
        assert [got[c][r] for r in ranks] == [want[r] for r in ranks], c


def test_rank_outside_the_column(spark):
    with pytest.raises(ValueError, match="rank 3"):
        O.values_at_ranks(spark.range(3), {"id": [3]})


@pytest.mark.parametrize("limit", [200_000, 0])
def test_lookup_broadcast_and_spread_agree(spark, monkeypatch, limit):
    monkeypatch.setattr(O, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(O, "HEAVY_KEYS", 2)
    rows = [(i, 1 if i < 500 else (2 if i < 700 else i % 50)) for i in range(1000)] + [(1000, None), (1001, 999)]
    df = spark.createDataFrame(rows, "id int, k int")
    table = df.where("k IS NOT NULL AND k <> 999").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("v"))
    got = {r["id"]: r["v"] for r in O.lookup(df, table, "k", "v", "n").collect()}
    first: dict[int, int] = {}
    for i, k in rows[:1000]:
        first.setdefault(k, i)
    assert got == {**{i: first[k] for i, k in rows[:1000]}, 1000: None, 1001: None}
