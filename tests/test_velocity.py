"""Velocity features against a plain per-card loop, on ties, sub-second ages, interleaved and hot cards."""

import math
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from cardsentry.operators.velocity import velocity_features

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def rows_from(card_us_amt):
    return [
        (f"t{i:05d}", c, T0 + timedelta(microseconds=us), a) for i, (c, us, a) in enumerate(card_us_amt)
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, "trans_num string, cc_num long, trans_date_trans_time timestamp, amt double")


def by_hand(rows, global_std):
    out = {}
    history = {}
    for rid, card, ts, amt in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        past = history.setdefault(card, [])
        us = (ts - T0) // timedelta(microseconds=1)
        seen = past + [(us, amt)]
        within = lambda s: [a for u, a in seen if (us - u) // 1_000_000 <= s]
        amounts = [a for _, a in past]
        mean = sum(amounts) / len(amounts) if amounts else amt
        std = global_std
        if len(amounts) >= 3 and max(amounts) > min(amounts):
            std = math.sqrt(sum((a - mean) ** 2 for a in amounts) / len(amounts))
        out[rid] = (
            (us - past[-1][0]) / 1e6 if past else None,
            int(len(within(600)) > 3),
            len(within(3600)),
            len(within(86400)),
            sum(within(86400)) / len(within(86400)),
            (amt - mean) / std,
        )
        past.append((us, amt))
    return out


def check(spark, rows, **kw):
    got = velocity_features(frame(spark, rows), 7.5, **kw).collect()
    want = by_hand(rows, 7.5)
    assert len(got) == len(rows)
    for r in got:
        w = want[r["trans_num"]]
        g = tuple(r)[-6:]
        assert (g[0] is None) == (w[0] is None)
        assert g[1:4] == w[1:4], r
        for a, b in zip((g[0] or 0, *g[4:]), (w[0] or 0, *w[4:]), strict=True):
            assert a == pytest.approx(b, abs=1e-6), r


def edge_rows():
    s = 1_000_000
    spec = [(1, 0, 5.0)] * 3  # ties
    spec += [(2, 0, 1.0), (2, 600 * s, 2.0), (3, 0, 1.0), (3, 600 * s + 900_000, 2.0), (4, 0, 1.0), (4, 601 * s, 2.0)]
    spec += [(5, i * 60 * s, 10.0 + i) for i in range(5)]  # five in ten minutes
    spec += [(6, i * 60 * s, 10.0) for i in range(3)]  # exactly three
    spec += [(7, i * 5000 * s, 0.1) for i in range(5)]  # constant history
    spec += [(8, 0, 42.0)]  # single row
    spec += [(9, 86400 * s * i + (i % 2), 3.0 * i) for i in range(6)]
    return rows_from(spec)


def random_rows(n, cards, seed):
    rng = random.Random(seed)
    spec = []
    for _ in range(n):
        us = rng.choice([rng.randrange(0, 3 * 86400) * 1_000_000, rng.randrange(0, 3 * 86400 * 1_000_000)])
        spec.append((rng.randrange(cards), us, round(rng.uniform(1, 500), 2)))
    spec += [(0, 1000, float(i)) for i in range(20)]  # twenty ties on one card
    return rows_from(spec)


@pytest.mark.parametrize("hot_card_rows", [10**9, 0, 60])
def test_edges_and_random_histories(spark, hot_card_rows):
    check(spark, edge_rows(), hot_card_rows=hot_card_rows)
    check(spark, random_rows(600, 8, 3), hot_card_rows=hot_card_rows)


def test_too_many_hot_cards_for_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr("cardsentry.operators.velocity.BROADCAST_ROWS", 1)
    check(spark, edge_rows() + [(f"r{r[0]}", r[1] + 100, *r[2:]) for r in random_rows(300, 5, 11)], hot_card_rows=20)


@pytest.mark.parametrize("scale", [1.0, 100_000.0, 1_000_000.0])
def test_both_paths_agree_on_a_small_spread_around_a_large_mean(spark, scale):
    rng = random.Random(4)
    spec = [(c, i * 40_000_000, (1.0 if c else scale) + rng.randrange(100) / 100) for c in (0, 1) for i in range(80)]
    df = frame(spark, rows_from(spec))
    plain = {r["trans_num"]: tuple(r)[-6:] for r in velocity_features(df, 7.5, hot_card_rows=10**9).collect()}
    hot = {r["trans_num"]: tuple(r)[-6:] for r in velocity_features(df, 7.5, hot_card_rows=0).collect()}
    assert plain.keys() == hot.keys()
    for k, row in plain.items():
        assert [x or 0 for x in hot[k]] == pytest.approx([x or 0 for x in row], rel=1e-9, abs=1e-7), k


@pytest.mark.parametrize("hot_card_rows", [10**9, 0])
def test_rows_without_card_or_time_stay(spark, hot_card_rows):
    df = frame(spark, edge_rows())
    holes = df.limit(2).withColumn("cc_num", F.lit(None).cast(df.schema["cc_num"].dataType)).unionByName(
        df.limit(3).withColumn("trans_date_trans_time", F.lit(None).cast("timestamp"))
    )
    got = velocity_features(df.unionByName(holes), 7.5, hot_card_rows=hot_card_rows)
    assert got.count() == df.count() + 5
    alone = got.where("cc_num IS NULL OR trans_date_trans_time IS NULL").collect()
    assert {(r["txn_count_24h"], r["amount_zscore"], r["rapid_fire_flag"]) for r in alone} == {(1, 0.0, 0)}


def test_missing_column_is_reported(spark):
    with pytest.raises(ValueError, match="cc_num"):
        velocity_features(frame(spark, edge_rows()).drop("cc_num"))
