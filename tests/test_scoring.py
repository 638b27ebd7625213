import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardsentry.operators import evaluate as E
from cardsentry.operators import scoring as SC


def one(spark, iso, ae, xgb):
    df = spark.createDataFrame([(iso, ae, xgb)], "iso_score double, ae_score double, xgb_score double")
    return SC.Ensemble().score(df).first()


@pytest.mark.parametrize(
    ("scores", "tier", "alert"),
    [
        ((0.0, 0.0, 0.0), "LOW", False), ((0.1, 0.1, 0.1), "LOW", False), ((0.4, 0.4, 0.4), "MEDIUM", False),
        ((0.5, 0.5, 0.5), "MEDIUM", True), ((0.9, 0.9, 0.9), "HIGH", True), ((1.0, 0.8, 0.8), "HIGH", True), ((1.0, 1.0, 1.0), "HIGH", True),
    ],
)
def test_tiers_and_alerts(spark, scores, tier, alert):
    row = one(spark, *scores)
    assert 0 <= row["fraud_score"] <= 1
    assert (row["risk_tier"], row["should_alert"]) == (tier, alert)


def test_missing_score_counts_as_zero(spark):
    df = spark.createDataFrame([(0.9, 0.9)], "iso_score double, ae_score double")
    row = SC.Ensemble().score(df).first()
    assert (row["fraud_score"], row["xgb_score"]) == (0.6, 0.0)


def test_weights_are_normalised():
    assert sum(SC.normalised((0.4, 0.6, 1 / 3))) == pytest.approx(1.0)
    grid = SC.weight_grid()
    assert len(grid) == 66 and grid[0][1:] == (0.0, 0.0, 1.0)
    assert all(sum(w[1:]) == pytest.approx(1.0) for w in grid)


def rows_and_truth(n=400, levels=37, seed=4):
    rng = random.Random(seed)
    return [(rng.randrange(levels) / levels, int(rng.random() < 0.2)) for _ in range(n)]


def long(spark, rows):
    return spark.createDataFrame([("m", s, y) for s, y in rows], "model string, score double, label int")


def test_areas_and_best_f1_match_brute_force(spark):
    rows = rows_and_truth()
    pos = sum(y for _, y in rows)
    ap, last, auc, fpr0, tpr0, best = 0.0, 0.0, 0.0, 0.0, 0.0, (-1.0, 0.0)
    for t in sorted({s for s, _ in rows}, reverse=True):
        tp = sum(y for s, y in rows if s >= t)
        k = sum(1 for s, _ in rows if s >= t)
        p, r = tp / k, tp / pos
        ap, last = ap + (r - last) * p, r
        fpr = (k - tp) / (len(rows) - pos)
        auc, fpr0, tpr0 = auc + (fpr - fpr0) * (r + tpr0) / 2, fpr, r
        f1 = 2 * p * r / (p + r + 1e-12)
        best = (f1, t) if f1 >= best[0] else best
    m = E.model_metrics(long(spark, rows)).first()
    assert m["pr_auc"] == pytest.approx(ap) and m["roc_auc"] == pytest.approx(auc)
    assert m["optimal_threshold"] == best[1] and m["f1"] == pytest.approx(best[0])
    assert m["tp"] + m["fn"] == pos and m["tn"] + m["fp"] == len(rows) - pos


def test_single_class_has_no_areas(spark):
    m = E.model_metrics(long(spark, [(0.2, 0), (0.4, 0)])).first()
    assert (m["pr_auc"], m["roc_auc"], m["precision"], m["recall"]) == (0.0, 0.0, 0.0, 0.0)


def test_recall_grows_along_the_curve(spark):
    points = E.pr_curve(E.curve(long(spark, rows_and_truth()), ["model"])).orderBy(F.desc("score")).collect()
    recalls = [r["recall"] for r in points]
    assert recalls == sorted(recalls) and recalls[-1] == 1.0


def test_costs_at_scores_on_and_beside_the_thresholds(spark):
    grid = np.arange(0.05, 0.96, 0.01)
    assert len(grid) == E.THRESHOLDS
    scores = [*grid, *np.nextafter(grid, 0), *np.nextafter(grid, 1), 0.0, 0.5, 1.0]
    rows = [(float(s), i % 3 == 0) for i, s in enumerate(scores)]
    got = {r["idx"]: r for r in E.cost_curve(long(spark, [(s, int(y)) for s, y in rows])).collect()}
    assert len(got) == len(grid)
    for i, t in enumerate(grid):
        fp = sum(1 for s, y in rows if s >= t and not y)
        fn = sum(1 for s, y in rows if s < t and y)
        assert (got[i]["threshold"], got[i]["fp"], got[i]["fn"]) == (t, fp, fn)
        assert got[i]["cost"] == 50 * fp + 500 * fn


def test_fitted_ensemble_prefers_the_informative_score(spark):
    rng = random.Random(5)
    rows = [(rng.random(), rng.random(), 0.9 if y else rng.random() * 0.5, int(y)) for y in (rng.random() < 0.2 for _ in range(300))]
    df = spark.createDataFrame(rows, "iso_score double, ae_score double, xgb_score double, is_fraud int")
    e = SC.Ensemble().fit(df)
    assert e.weights[2] > 0.5
    by_f1 = SC.Ensemble().fit(df, method="f1")
    assert 0 < by_f1.threshold <= 1


def test_both_ways_of_the_weight_search_agree(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(rng.randrange(9) / 9, rng.random(), rng.randrange(5) / 5, int(rng.random() < 0.1)) for _ in range(500)]
    df = spark.createDataFrame(rows, "iso_score double, ae_score double, xgb_score double, is_fraud int").repartition(4)
    counted = {r["idx"]: r["average_precision"] for r in SC.weight_search(df).collect()}
    monkeypatch.setattr(SC, "FEW_POSITIVES", 3)
    curves = {r["idx"]: r["average_precision"] for r in SC.weight_search(df).collect()}
    assert len(counted) == 66 and curves == pytest.approx(counted, abs=1e-12)


def test_weight_search_in_parts_equals_curves(spark):
    """Many positives: every cell is cut into parts, and no row is expanded to its 66 scores."""
    rng = np.random.default_rng(3)
    x = np.round(rng.random((4_000, 3)), 2)
    y = (x.sum(axis=1) + rng.normal(0, 0.5, 4_000) > 2).astype(int)
    rows = [(*map(float, r), int(v)) for r, v in zip(x, y, strict=True)] + [(None, 0.5, float("nan"), None)]
    df = spark.createDataFrame(rows, "iso_score double, ae_score double, xgb_score double, is_fraud int").repartition(5)
    filled = df.na.fill(0.0, SC.SCORES)
    found = {r["idx"]: r["average_precision"] for r in SC._precision_by_parts(filled, "is_fraud", part_rows=300).collect()}
    for k, a, b, c in SC.weight_grid():
        if k % 13 == 0:
            score = F.lit(a) * F.col("iso_score") + F.lit(b) * F.col("ae_score") + F.lit(c) * F.col("xgb_score")
            long = filled.select(F.lit(k).alias("idx"), score.alias("score"), F.col("is_fraud").alias("label"))
            want = E.average_precision(E.curve(long, ["idx"]), ["idx"]).first()["average_precision"]
            assert found[k] == pytest.approx(want, abs=1e-12)
    assert sorted(found) == list(range(66))
