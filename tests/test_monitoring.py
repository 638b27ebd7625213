"""Drift, log figures, alerts."""

import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardsentry.operators import alerts as A
from cardsentry.operators import drift as D
from cardsentry.operators import monitoring as M
from cardsentry.schema import PREDICTION_LOG_SCHEMA


def psi_by_hand(base, now):
    """A restatement with plain arrays."""
    edges = np.unique(np.percentile(base, np.linspace(0, 100, 11)))
    if len(edges) < 2:
        edges = np.array([edges[0] - 1e-9, edges[0] + 1e-9])

    def shares(values):
        top = edges[-1] * (1 + 1e-10)
        n = np.histogram(np.clip(values, edges[0], top), bins=edges)[0].astype(float)
        return norm(norm(n))

    def norm(n):
        p = n / n.sum() if n.sum() > 0 else np.ones(len(n)) / len(n)
        p = np.clip(p, 1e-6, 1.0)
        return p / p.sum()

    b, c = shares(base), shares(now)
    return max(0.0, float(np.sum((c - b) * np.log(c / b))))


def columns(spark, **values):
    n = len(next(iter(values.values())))
    rows = [tuple(None if v[i] is None else float(v[i]) for v in values.values()) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in values))


def test_psi_matches_arrays(spark):
    rng = np.random.default_rng(3)
    base = {"a": rng.normal(5, 2, 300), "b": -np.abs(rng.normal(5, 2, 300)), "c": np.full(300, 3.0), "s": rng.random(300)}
    now = {"a": rng.normal(6, 2, 200), "b": rng.normal(0, 3, 200), "c": np.full(200, 3.0), "s": rng.random(200) ** 2}
    baseline = D.DriftBaseline.fit(columns(spark, **base), ["a", "b", "c"], "s")
    got = {r["feature"]: r["psi"] for r in baseline.compare(columns(spark, **now), "s").collect()}
    assert got["a"] == pytest.approx(psi_by_hand(base["a"], now["a"]), abs=1e-9)
    assert got["b"] == pytest.approx(psi_by_hand(base["b"], now["b"]), abs=1e-9)
    assert got["c"] == pytest.approx(0.0, abs=1e-9)
    assert got[D.SCORE] == pytest.approx(psi_by_hand(base["s"], now["s"]), abs=1e-9)


def test_same_table_has_no_drift_and_empty_ones_are_uniform(spark):
    df = columns(spark, a=range(100), nothing=[None] * 100, s=np.linspace(0, 1, 100))
    baseline = D.DriftBaseline.fit(df, ["a", "nothing"], "s")
    compared = baseline.compare(df, "s")
    assert all(r["psi"] == pytest.approx(0, abs=1e-12) for r in compared.collect())
    assert D.overall_drift(compared).first()["overall_status"] == "OK"
    assert len(baseline.edges["nothing"]) == 11
    empty = {r["feature"]: r["psi"] for r in baseline.compare(df.limit(0), "s").collect()}
    assert empty["a"] == pytest.approx(0, abs=1e-6)


def test_values_outside_the_edges(spark):
    df = columns(spark, x=[-5.0, -0.0, 0.0, 1.0, 1.5, 3.0, 3.1, None, float("nan")])
    counts = lambda edges: [r["n"] for r in D.bin_counts(df, {"x": edges}).orderBy("bin").collect()]
    assert counts([0.0, 1.0, 3.0]) == [3, 3]  # above a positive last edge: dropped
    assert counts([-9.0, -5.0, 0.0]) == [0, 7]  # above any other last edge: last bin
    assert counts([-9.0, 0.0, 9.0]) == [1, 6]  # both zeros are the edge
    assert counts([0.0, 3.0]) == [6]


def test_status_limits(spark):
    df = spark.createDataFrame([(v,) for v in (0.0999, 0.1, 0.25, 0.2501)], "p double")
    got = df.select(D.psi_status(F.col("p")).alias("s"), D.overall_status(F.col("p")).alias("o")).collect()
    assert [r["s"] for r in got] == ["OK", "MODERATE", "MODERATE", "SIGNIFICANT"]
    assert [r["o"] for r in got] == ["OK", "WARNING", "WARNING", "CRITICAL"]


def test_drift_alert_only_on_trouble(spark):
    rows = [("WARNING", ["a"]), ("CRITICAL", ["a", "b"]), ("OK", [])]
    df = spark.createDataFrame(rows, "overall_status string, features_with_drift array<string>")
    assert {r["overall_status"] for r in A.drift_alert(df).collect()} == {"WARNING", "CRITICAL"}


def test_floor_percentile(spark):
    got = M.percentile_floor(spark.range(20), {"id": [0, 50, 95, 99, 100]})["id"]
    assert got == {0: 0, 50: 10, 95: 19, 99: 19, 100: 19}
    assert M.percentile_floor(spark.range(0), {"id": [95]}) == {"id": {95: 0.0}}


def test_log_times(spark):
    texts = ["2024-01-15T14:30:00Z", "2024-01-15T14:30:00.123456+00:00", "2024-01-15 14:30:00", "2024-01-15T14:30:00+00:00", "soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(F.date_format(M.parse_log_ts(F.col("t")), "yyyy-MM-dd HH:mm:ss")).collect()]
    assert got == ["2024-01-15 14:30:00"] * 3 + [None] * 3


def log_rows(spark, rows):
    return spark.createDataFrame([(str(i), *r, "1.0.0") for i, r in enumerate(rows)], PREDICTION_LOG_SCHEMA)


def test_report_of_an_empty_log(spark):
    r = M.metrics_report(log_rows(spark, [])).first()
    assert (r["total_transactions"], r["volume_per_minute"], r["avg_fraud_score"], r["fraud_rate_pct"]) == (0, 0.0, 0.0, 0.0)
    assert r["risk_tier_breakdown"]["HIGH"]["count"] == 0 and r["latency_ms"]["p95"] == 0.0
    assert M.risk_tier_breakdown(log_rows(spark, [])).count() == 3


def test_report_figures(spark):
    rows = [("2024-01-15T14:30:00Z", 0.2, "low", 5.0), ("2024-01-15T14:32:00Z", 0.8, "HIGH", 7.0), ("bad", 0.4, None, 9.0), ("bad", None, "ODD", None)]
    r = M.metrics_report(log_rows(spark, rows)).first()
    assert (r["total_transactions"], r["volume_per_minute"], r["fraud_rate_pct"], r["alert_rate_pct"]) == (4, 2.0, 25.0, 25.0)
    assert r["avg_fraud_score"] == pytest.approx(0.35)
    assert r["risk_tier_breakdown"]["LOW"]["count"] == 2 and r["risk_tier_breakdown"]["LOW"]["pct"] == 50.0
    assert r["score_percentiles"]["p50"] == 0.4 and r["latency_ms"]["p99"] == 9.0
    assert M.volume_per_minute(log_rows(spark, rows[2:])).first()[0] == 2.0


def limited_by_hand(rows, limit, window):
    sent: dict[str, list[int]] = {}
    out = set()
    for channel, us, rid in sorted(rows):
        past = sent.setdefault(channel, [])
        if sum(1 for t in past if t > us - window) < limit:
            past.append(us)
            out.add(rid)
    return out


@pytest.mark.parametrize("pace", [1, 5_000_000, 40_000_000])
def test_rate_limit_matches_a_loop(spark, pace):
    """From a dense stream without any pause to a sparse one, in two channels, over many chunks."""
    rng = random.Random(pace)
    rows, us = [], 0
    for i in range(3000):
        us += rng.randrange(0, 2 * pace + 1) * (50_000 if pace == 1 else 1)
        rows.append(("a" if rng.random() < 0.8 else "b", us, f"r{i:05d}"))
    df = spark.createDataFrame(rows, "channel string, us long, id string").repartition(6)
    got = A.rate_limited_alerts(df, F.col("us"), "id", channel=F.col("channel"), limit=10, seconds=60).collect()
    assert {r["id"] for r in got} == limited_by_hand(rows, 10, 60_000_000)


@pytest.mark.parametrize("gap", [100, 1_500, 9_000])
def test_one_segment_goes_over_many_tasks(spark, gap):
    """A channel without a pause: full all along, half full and seldom full."""
    rng, us, rows = random.Random(gap), 0, []
    for i in range(20_000):
        us += rng.randrange(0, 2 * gap)
        rows.append(("a", us, f"r{i:05d}"))
    df = spark.createDataFrame(rows, "channel string, us long, id string").repartition(5)
    got = A.rate_limited_alerts(df, F.col("us"), "id", channel=F.col("channel"), limit=5, seconds=0.02, tasks=16)
    assert {r["id"] for r in got.collect()} == limited_by_hand(rows, 5, 20_000)


def test_parts_are_even_in_one_long_segment(spark):
    df = spark.range(1_000_000).select(F.lit("a").alias("channel"), (F.col("id") * 50_000).alias("us"), F.col("id").cast("string").alias("id"))
    sent = A.rate_limited_alerts(df, F.col("us"), "id", channel=F.col("channel"), tasks=16)
    # twenty alerts a second and ten a minute: of every 1,200 the first ten
    assert [r["us"] // 50_000 for r in sent.select("us").orderBy("us").collect()] == [i for k in range(0, 1_000_000, 1_200) for i in range(k, min(k + 10, 1_000_000))]
    sizes = [r["n"] for r in sent.sparkSession.createDataFrame(sent.rdd.glom().map(len).collect(), "long").toDF("n").collect()]
    assert len(sizes) == 16 and max(sizes) <= sum(sizes) / 8


def test_few_alerts_of_a_full_channel_are_one_part(spark):
    """A part of a channel that is full all along is one more round, so parts go by rows, not by the session's setting."""
    df = spark.range(3_000).select((F.col("id") * 50_000).alias("us"), F.col("id").cast("string").alias("id"))
    sent = A.rate_limited_alerts(df, F.col("us"), "id")
    assert sent.rdd.getNumPartitions() == 1 and sent.count() == 30


def test_eleven_alerts_and_the_free_slot(spark):
    times = [i * 1_000_000 for i in range(11)] + [60_000_000]
    df = spark.createDataFrame([(t, f"{i:02d}") for i, t in enumerate(times)], "us long, id string")
    got = {r["id"] for r in A.rate_limited_alerts(df, F.col("us"), "id").collect()}
    assert got == {f"{i:02d}" for i in range(10)} | {"11"}


def test_alerts_without_channel_or_time_are_limited_too(spark):
    s = 1_000_000
    rows = [(None, i * s, f"n{i:02d}") for i in range(12)] + [("a", i * s, f"a{i:02d}") for i in range(12)]
    rows += [("b", None, f"b{i:02d}") for i in range(12)] + [("", 0, "e")]
    df = spark.createDataFrame(rows, "channel string, us long, id string")
    got = sorted(r["id"] for r in A.rate_limited_alerts(df, F.col("us"), "id", channel=F.col("channel")).collect())
    assert got == [f"{c}{i:02d}" for c in "ab" for i in range(10)] + ["e"] + [f"n{i:02d}" for i in range(10)]


def test_drift_alert_text_and_payload(spark):
    df = spark.createDataFrame([("warning", ["a", "b"], 0.31)], "overall_status string, features_with_drift array<string>, prediction_psi double")
    row = A.drift_alert(df).first()
    assert row["text"].endswith("features_with_drift: a, b\n  prediction_drift PSI: 0.3100")
    assert '"type":"drift"' in row["payload"] and '"psi":0.31' in row["payload"]


def test_no_alerts(spark):
    df = spark.createDataFrame([], "us long, id string")
    assert A.rate_limited_alerts(df, F.col("us"), "id").count() == 0


def test_exactly_the_limit_is_no_alert(spark):
    df = spark.createDataFrame([(0.7,), (0.7001,)], "fraud_score double")
    assert [r[0] for r in A.high_risk_alerts(df).collect()] == [0.7001]


def test_text_payload_and_history(spark):
    at = datetime(2024, 1, 15, tzinfo=timezone.utc)
    rows = [(f"x{i:03d}", 1200.5, 0.72, 0.7, 0.74, "HIGH", str(at + timedelta(minutes=i))) for i in range(120)]
    df = spark.createDataFrame(rows, "transaction_id string, amt double, fraud_score double, iso_score double, ae_score double, risk_tier string, timestamp string")
    row = A.alert_payload(A.alert_text(df)).orderBy("transaction_id").first()
    assert "amount: 1200.50" in row["text"] and "fraud_score: 0.7200" in row["text"]
    assert '"type":"high_risk_transaction"' in row["payload"] and '"amt":1200.5' in row["payload"]
    kept = A.alert_history(df, "timestamp", "transaction_id").collect()
    assert len(kept) == 100 and kept[0]["transaction_id"] == "x119"
