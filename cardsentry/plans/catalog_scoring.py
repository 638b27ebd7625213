"""Queries: blending, tiers, weight and threshold search, curves, metrics, costs."""

from pyspark.sql import functions as F

from cardsentry.operators import evaluate as E
from cardsentry.operators import scoring as SC
from cardsentry.plans.catalog import query, r6, s6, with_txn
from cardsentry.sources.tables import transactions

THIRDS = (1 / 3, 1 / 3, 1 / 3)
BLEND = "((1/3::DOUBLE) * iso_score + (1/3::DOUBLE) * ae_score + (1/3::DOUBLE) * xgb_score)"
BLENDED = f"blended AS (SELECT *, {BLEND} blend FROM txn)"
MODELS = {"Isolation Forest": "iso_score", "Autoencoder": "ae_score", "XGBoost": "xgb_score", "Ensemble": "blend"}
LONG = "long AS (" + " UNION ALL ".join(f"SELECT '{m}' model, {c} score, is_fraud label FROM blended" for m, c in MODELS.items()) + ")"
POINTS = """counts AS (SELECT model, score, count(*) n, sum(label) pos FROM long GROUP BY model, score),
points AS (SELECT *, sum(n) OVER d k, sum(pos) OVER d tp, sum(n) OVER (PARTITION BY model) total, sum(pos) OVER (PARTITION BY model) positives
 FROM counts WINDOW d AS (PARTITION BY model ORDER BY score DESC))"""
F1 = "(2 * (tp / k::DOUBLE) * (tp / positives::DOUBLE) / (tp / k::DOUBLE + tp / positives::DOUBLE + 1e-12::DOUBLE))"
AP = "sum(pos * tp / k::DOUBLE) / max(positives)"
AUC = "sum((n - pos) * (tp - pos / 2.0::DOUBLE)) / (max(positives) * (max(total) - max(positives)))"
BEST_F1 = f"best AS (SELECT model, score AS threshold, f1 FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY f1 DESC, score) r FROM (SELECT *, {F1} f1 FROM points)) WHERE r = 1)"
GRID = "grid AS (SELECT i AS idx, 0.05::DOUBLE + i * ((0.05::DOUBLE + 0.01::DOUBLE) - 0.05::DOUBLE) AS threshold FROM range(91) r(i))"
COSTS = """costs AS (SELECT model, idx, threshold, count_if(score >= threshold AND label = 0)::BIGINT fp, count_if(score < threshold AND label = 1)::BIGINT fn,
 count_if(score >= threshold AND label = 0) * 50::DOUBLE + count_if(score < threshold AND label = 1) * 500::DOUBLE AS cost
 FROM long, grid GROUP BY model, idx, threshold)"""
BEST_COST = "cheapest AS (SELECT model, threshold, cost FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY cost, idx) r FROM costs) WHERE r = 1)"


def _blended(spark, sf_dir):
    return transactions(spark, sf_dir).withColumn("blend", SC.combine_scores(THIRDS))


def _long(spark, sf_dir):
    return E.long_scores(_blended(spark, sf_dir), MODELS)


@query(
    "zip_scores",
    with_txn("SELECT trans_num, is_fraud, iso_score, ae_score, xgb_score FROM txn"),
)
def _zip_scores(spark, sf_dir):
    """Scores of different models meet by transaction id, not by position."""
    df = transactions(spark, sf_dir)
    one, two = df.select("trans_num", "is_fraud", "iso_score"), df.select("trans_num", "ae_score", "xgb_score")
    return one.join(two, "trans_num")


@query("combine_scores", with_txn(f"SELECT trans_num, {s6('(2 * iso_score + 1 * ae_score + 1 * xgb_score) / 4')} AS blend FROM txn"))
def _combine(spark, sf_dir):
    return transactions(spark, sf_dir).select("trans_num", r6(SC.combine_scores((2, 1, 1))).alias("blend"))


TIER = "CASE WHEN blend < 0.3::DOUBLE THEN 'LOW' WHEN blend < 0.7::DOUBLE THEN 'MEDIUM' ELSE 'HIGH' END"


@query("risk_tier", with_txn(f"SELECT trans_num, {TIER} AS risk_tier FROM blended", BLENDED))
def _tier(spark, sf_dir):
    return _blended(spark, sf_dir).select("trans_num", SC.risk_tier(F.col("blend")).alias("risk_tier"))


def _r4(x: str) -> str:
    return f"round({x}, 4)"


@query(
    "score_transaction",
    with_txn(
        f"""SELECT trans_num AS transaction_id, strftime(trans_date_trans_time, '%Y-%m-%d %H:%M:%S') AS timestamp, amt AS amount,
 {_r4('blend')} AS fraud_score, {TIER} AS risk_tier, {_r4('iso_score')} AS iso_score, {_r4('ae_score')} AS ae_score,
 {_r4('xgb_score')} AS xgb_score, blend >= 0.5::DOUBLE AS should_alert, round(processing_time_ms, 2) AS processing_time_ms FROM blended""",
        BLENDED,
    ),
)
def _score_transaction(spark, sf_dir):
    return SC.scored_record(SC.Ensemble().score(transactions(spark, sf_dir)))


# the label of the validation part; it keeps the 66-fold expansion of the SQL twin within reason, as in training
WEIGHTS = """cells AS (SELECT i, j, i * 0.1::DOUBLE w_iso, j * 0.1::DOUBLE w_ae, 1 - i * 0.1::DOUBLE - j * 0.1::DOUBLE w_xgb,
 row_number() OVER (ORDER BY i, j) - 1 idx FROM range(11) a(i), range(11) b(j) WHERE j <= 10 - i),
mixed AS (SELECT idx, w_iso * iso_score + w_ae * ae_score + w_xgb * xgb_score score, is_fraud label FROM txn, cells),
counts AS (SELECT idx, score, count(*) n, sum(label) pos FROM mixed GROUP BY idx, score),
points AS (SELECT *, sum(n) OVER d k, sum(pos) OVER d tp, sum(pos) OVER (PARTITION BY idx) positives
 FROM counts WINDOW d AS (PARTITION BY idx ORDER BY score DESC)),
found AS (SELECT idx, sum(pos * tp / k::DOUBLE) / max(positives) ap FROM points GROUP BY idx)"""


@query(
    "weight_search",
    with_txn(f"SELECT idx::INT AS idx, {s6('w_iso')} AS w_iso, {s6('w_ae')} AS w_ae, {s6('w_xgb')} AS w_xgb, {s6('ap')} AS average_precision FROM found JOIN cells USING (idx)", WEIGHTS),
)
def _weight_search(spark, sf_dir):
    out = SC.weight_search(transactions(spark, sf_dir))
    return out.select("idx", *[r6(c).alias(c) for c in ("w_iso", "w_ae", "w_xgb", "average_precision")])


@query(
    "optimize_weights",
    with_txn(
        f"SELECT idx::INT AS idx, {s6('w_iso')} AS w_iso, {s6('w_ae')} AS w_ae, {s6('w_xgb')} AS w_xgb, {s6('ap')} AS average_precision FROM found JOIN cells USING (idx) ORDER BY round(ap, 12) DESC, idx LIMIT 1",
        WEIGHTS,
    ),
)
def _optimize_weights(spark, sf_dir):
    out = SC.optimize_weights(transactions(spark, sf_dir))
    return out.select("idx", *[r6(c).alias(c) for c in ("w_iso", "w_ae", "w_xgb", "average_precision")])


@query("threshold_f1", with_txn(f"SELECT model, {s6('threshold')} AS threshold, {s6('f1')} AS f1 FROM best", BLENDED, LONG, POINTS, BEST_F1))
def _threshold_f1(spark, sf_dir):
    best = E.best_f1(E.curve(_long(spark, sf_dir), ["model"]), ["model"])
    return best.select("model", r6("threshold").alias("threshold"), r6("f1").alias("f1"))


@query("threshold_cost", with_txn(f"SELECT model, {s6('threshold')} AS threshold, cost FROM cheapest", BLENDED, LONG, GRID, COSTS, BEST_COST))
def _threshold_cost(spark, sf_dir):
    best = E.best_cost(E.cost_curve(_long(spark, sf_dir)))
    return best.select("model", r6("threshold").alias("threshold"), "cost")


@query(
    "optimize_threshold",
    with_txn(
        f"SELECT 'f1' AS method, {s6('threshold')} AS threshold, count_if(blend >= threshold)::BIGINT AS alerts FROM best, blended WHERE model = 'Ensemble' GROUP BY threshold "
        f"UNION ALL SELECT 'cost', {s6('threshold')}, count_if(blend >= threshold)::BIGINT FROM cheapest, blended WHERE model = 'Ensemble' GROUP BY threshold",
        BLENDED, LONG, POINTS, BEST_F1, GRID, COSTS, BEST_COST,
    ),
)
def _optimize_threshold(spark, sf_dir):
    df = _blended(spark, sf_dir)
    rows = []
    for method in ("f1", "cost"):
        t = SC.optimize_threshold(df, "blend", method)
        alerts = F.count_if(F.col("blend") >= F.lit(t)).alias("alerts")
        rows.append(df.agg(alerts).select(F.lit(method).alias("method"), r6(F.lit(t)).alias("threshold"), "alerts"))
    return rows[0].unionByName(rows[1])


def _points(extra: str) -> str:
    return with_txn(f"SELECT model, {s6('score')} AS score, {extra} FROM points", BLENDED, LONG, POINTS)


@query("pr_curve", _points(f"{s6('tp / k::DOUBLE')} AS precision, {s6('tp / positives::DOUBLE')} AS recall, tp::BIGINT AS tp"))
def _pr_curve(spark, sf_dir):
    points = E.pr_curve(E.curve(_long(spark, sf_dir), ["model"]))
    return points.select("model", *[r6(c).alias(c) for c in ("score", "precision", "recall")], "tp")


@query("roc_curve", _points(f"{s6('(k - tp) / (total - positives)::DOUBLE')} AS fpr, {s6('tp / positives::DOUBLE')} AS tpr"))
def _roc_curve(spark, sf_dir):
    points = E.roc_curve(E.curve(_long(spark, sf_dir), ["model"]))
    return points.select("model", *[r6(c).alias(c) for c in ("score", "fpr", "tpr")])


@query("average_precision", with_txn(f"SELECT model, {s6(AP)} AS average_precision FROM points GROUP BY model", BLENDED, LONG, POINTS))
def _average_precision(spark, sf_dir):
    out = E.average_precision(E.curve(_long(spark, sf_dir), ["model"]), ["model"])
    return out.withColumn("average_precision", r6("average_precision"))


@query("roc_auc", with_txn(f"SELECT model, {s6(AUC)} AS roc_auc FROM points GROUP BY model", BLENDED, LONG, POINTS))
def _roc_auc(spark, sf_dir):
    return E.roc_auc(E.curve(_long(spark, sf_dir), ["model"]), ["model"]).withColumn("roc_auc", r6("roc_auc"))


def _cells(t: str) -> str:
    return f"""count_if(score < {t} AND label = 0)::BIGINT AS tn, count_if(score >= {t} AND label = 0)::BIGINT AS fp,
 count_if(score < {t} AND label = 1)::BIGINT AS fn, count_if(score >= {t} AND label = 1)::BIGINT AS tp"""


@query("confusion_at_threshold", with_txn(f"SELECT model, {_cells('0.5::DOUBLE')} FROM long GROUP BY model", BLENDED, LONG))
def _confusion(spark, sf_dir):
    return E.confusion_at_threshold(_long(spark, sf_dir), 0.5)


PRF = f"""{s6('coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0)')} AS precision, {s6('coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0)')} AS recall,
 {s6('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0)')} AS f1"""


def _prf(df):
    return df.withColumns({c: r6(c) for c in ("precision", "recall", "f1")})


@query(
    "precision_recall_f1",
    with_txn(f"SELECT *, {PRF} FROM (SELECT model, {_cells('0.999::DOUBLE')} FROM long GROUP BY model)", BLENDED, LONG),
)
def _precision_recall_f1(spark, sf_dir):
    """A threshold so high that some models predict nothing, whose rates are then 0."""
    return _prf(E.precision_recall_f1(E.confusion_at_threshold(_long(spark, sf_dir), 0.999)))


METRICS = f"""areas AS (SELECT model, {AP} pr_auc, {AUC} roc_auc FROM points GROUP BY model),
confused AS (SELECT model, pr_auc, roc_auc, threshold AS optimal_threshold, {_cells('threshold')} FROM long JOIN best USING (model) JOIN areas USING (model) GROUP BY ALL),
metrics AS (SELECT model, {s6('pr_auc')} AS pr_auc, {s6('roc_auc')} AS roc_auc, {s6('optimal_threshold')} AS optimal_threshold, tn, fp, fn, tp, {PRF} FROM confused)"""


def _metrics(df):
    return _prf(df).withColumns({c: r6(c) for c in ("pr_auc", "roc_auc", "optimal_threshold")})


@query("model_metrics", with_txn("SELECT * FROM metrics WHERE model = 'Ensemble'", BLENDED, LONG, POINTS, BEST_F1, METRICS))
def _model_metrics(spark, sf_dir):
    return _metrics(E.model_metrics(E.long_scores(_blended(spark, sf_dir), {"Ensemble": "blend"})))


@query("compare_models", with_txn("SELECT * FROM metrics", BLENDED, LONG, POINTS, BEST_F1, METRICS))
def _compare_models(spark, sf_dir):
    return _metrics(E.model_metrics(_long(spark, sf_dir)))


@query("cost_curve", with_txn(f"SELECT model, idx::INT AS idx, {s6('threshold')} AS threshold, fp, fn, cost FROM costs", BLENDED, LONG, GRID, COSTS))
def _cost_curve(spark, sf_dir):
    return E.cost_curve(_long(spark, sf_dir)).withColumn("threshold", r6("threshold"))


COST_TABLE = """at_default AS (SELECT model, count_if(score >= 0.5::DOUBLE AND label = 0) * 50::DOUBLE + count_if(score < 0.5::DOUBLE AND label = 1) * 500::DOUBLE cost_at_default FROM long GROUP BY model),
analysis AS (SELECT model, round(threshold, 6) cost_optimal_threshold, cost cost_at_optimal, cost_at_default, 50::DOUBLE cost_fp, 500::DOUBLE cost_fn FROM cheapest JOIN at_default USING (model))"""


@query("cost_analysis", with_txn("SELECT * FROM analysis", BLENDED, LONG, GRID, COSTS, BEST_COST, COST_TABLE))
def _cost_analysis(spark, sf_dir):
    return E.cost_analysis(_long(spark, sf_dir)).withColumn("cost_optimal_threshold", r6("cost_optimal_threshold"))


@query("random_baseline", with_txn(f"SELECT {s6('avg(is_fraud)')} AS baseline FROM txn"))
def _random_baseline(spark, sf_dir):
    return E.random_baseline(transactions(spark, sf_dir)).withColumn("baseline", r6("baseline"))


EVALUATION = """evaluation AS (SELECT 'metrics' AS section, model, metric, value FROM (UNPIVOT (SELECT model, pr_auc, roc_auc, optimal_threshold, tn::DOUBLE tn, fp::DOUBLE fp, fn::DOUBLE fn, tp::DOUBLE tp, precision, recall, f1 FROM metrics) ON COLUMNS(* EXCLUDE model) INTO NAME metric VALUE value)
 UNION ALL SELECT 'costs', model, metric, value FROM (UNPIVOT analysis ON COLUMNS(* EXCLUDE model) INTO NAME metric VALUE value))"""


@query(
    "full_evaluation",
    with_txn("SELECT * FROM evaluation", BLENDED, LONG, POINTS, BEST_F1, METRICS, GRID, COSTS, BEST_COST, COST_TABLE, EVALUATION),
)
def _full_evaluation(spark, sf_dir):
    return E.full_evaluation(_blended(spark, sf_dir), MODELS).withColumn("value", r6("value"))


@query(
    "score_stats_by_class",
    with_txn(f"SELECT model, label, {s6('avg(score)')} AS mean_score, {s6('min(score)')} AS min_score, {s6('max(score)')} AS max_score FROM long GROUP BY model, label", BLENDED, LONG),
)
def _score_stats(spark, sf_dir):
    out = E.score_stats_by_class(_long(spark, sf_dir))
    return out.select("model", "label", *[r6(c).alias(c) for c in ("mean_score", "min_score", "max_score")])


@query("class_weight", with_txn(f"SELECT {s6('(count(*) - sum(is_fraud)) / sum(is_fraud)')} AS class_weight FROM txn"))
def _class_weight(spark, sf_dir):
    from cardsentry.models.boosted import class_weight

    return class_weight(transactions(spark, sf_dir)).withColumn("class_weight", r6("class_weight"))
