"""Queries: drift, prediction-log metrics, alerts, report tables."""

from pyspark.sql import functions as F

from cardsentry.functions.scalar import age_years, haversine_km, micros
from cardsentry.operators import alerts as A
from cardsentry.operators import drift as D
from cardsentry.operators import evaluate as E
from cardsentry.operators import monitoring as M
from cardsentry.operators import scoring as SC
from cardsentry.operators.split import TimeSplit
from cardsentry.plans.catalog import PARTS, query, r6, s6, with_txn
from cardsentry.plans.catalog_features import AGE, DISTANCE
from cardsentry.plans.catalog_scoring import (
    BEST_COST, BEST_F1, BLEND, BLENDED, COST_TABLE, COSTS, EVALUATION, GRID, LONG, METRICS, MODELS, POINTS, THIRDS, TIER,
)
from cardsentry.schema import TIME
from cardsentry.session import materialise, scratch_path, small_table
from cardsentry.sources import files
from cardsentry.sources.tables import transactions

# --- drift: the first 70 % of the rows are the baseline; in the rest the amounts are raised by half -------------------

FEATURES = ["amt", "distance_km", "age", "hour", "flat", "negative", "nothing"]
SIDES = f"""sides AS (SELECT *, CASE WHEN split <> 'train' THEN amt * 1.5::DOUBLE ELSE amt END AS shifted, {DISTANCE} distance_km, {AGE} age,
 hour(trans_date_trans_time) AS hour, 7 flat, -1 - amt AS negative, NULL::DOUBLE AS nothing, {BLEND} blend FROM parts)"""
_CELLS = {"amt": "shifted", "__score__": "blend"} | {c: c for c in FEATURES if c != "amt"}
DRIFT = f"""long AS ({" UNION ALL ".join(f"SELECT split = 'train' AS base, '{f}' feature, round(({c})::DOUBLE, 9) x FROM sides" for f, c in _CELLS.items())}),
quantiles AS (SELECT feature, list_sort(list_distinct(quantile_cont(x, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) q FROM long WHERE base AND x IS NOT NULL GROUP BY feature
 UNION ALL SELECT 'nothing', [0::DOUBLE, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]),
edges AS (SELECT feature, CASE WHEN len(q) < 2 THEN [q[1] - 1e-9, q[1] + 1e-9] ELSE q END e FROM quantiles),
binned AS (SELECT base, feature, CASE WHEN x > e[-1] AND e[-1] > 0 THEN NULL ELSE greatest(0, least(len(e) - 2, len(list_filter(e, lambda v: v <= x)) - 1)) END bin
 FROM long JOIN edges USING (feature) WHERE x IS NOT NULL),
slots AS (SELECT base, feature, unnest(range(len(e) - 1)) bin FROM edges, (SELECT unnest([true, false]) base)),
counts AS (SELECT base, feature, bin, count(b.bin) n FROM slots LEFT JOIN binned b USING (base, feature, bin) GROUP BY ALL),
raw AS (SELECT base, feature, bin, n, greatest(1e-6, CASE WHEN sum(n) OVER f > 0 THEN n / sum(n) OVER f ELSE 1 / count(*) OVER f END::DOUBLE) p
 FROM counts WINDOW f AS (PARTITION BY base, feature)),
once AS (SELECT *, p / sum(p) OVER (PARTITION BY base, feature) s FROM raw),
again AS (SELECT *, greatest(1e-6, s / sum(s) OVER (PARTITION BY base, feature)) t FROM once),
twice AS (SELECT *, t / sum(t) OVER (PARTITION BY base, feature) u FROM again),
psis AS (SELECT feature, greatest(0, sum((c.u - b.u) * ln(c.u / b.u))) psi FROM (SELECT * FROM twice WHERE base) b JOIN (SELECT * FROM twice WHERE NOT base) c USING (feature, bin) GROUP BY feature)"""
STATUS = "CASE WHEN psi < 0.1 THEN 'OK' WHEN psi <= 0.25 THEN 'MODERATE' ELSE 'SIGNIFICANT' END"
OVERALL = "CASE WHEN worst > 0.25 THEN 'CRITICAL' WHEN worst >= 0.1 THEN 'WARNING' ELSE 'OK' END"


def _drift(final: str) -> str:
    return with_txn(final, PARTS, SIDES, DRIFT)


def _sides(spark, sf_dir):
    df = transactions(spark, sf_dir).withColumn("blend", SC.combine_scores(THIRDS))
    labelled = TimeSplit.fit(df).label(df)
    train = labelled.where("split = 'train'")
    test = labelled.where("split <> 'train'").withColumn("amt_shifted", F.col("amt") * 1.5)

    def enrich(part, amt):
        wide = part.withColumns(
            {
                "distance_km": haversine_km(*map(F.col, ["lat", "long", "merch_lat", "merch_long"])),
                "age": age_years(F.col(TIME), F.col("dob")),
                "hour": F.hour(TIME),
                "flat": F.lit(7),
                "negative": -1 - F.col("amt"),
                "nothing": F.lit(None).cast("double"),
                "amt": F.col(amt),
            }
        )
        return wide.select(*[F.round(F.col(c).cast("double"), 9).alias(c) for c in [*FEATURES, "blend"]])

    return enrich(train, "amt"), enrich(test, "amt_shifted")


def _fitted(spark, sf_dir):
    train, test = _sides(spark, sf_dir)
    # joined and derived columns that several passes read
    return D.DriftBaseline.fit(materialise(train), FEATURES, "blend"), materialise(test)


def _edge_rows(spark, edges):
    rows = [(f, i, float(v)) for f, e in edges.items() for i, v in enumerate(e)]
    return small_table(spark, rows, "feature string, i int, edge double").withColumn("edge", r6("edge"))


@query("quantile_edges", _drift(f"SELECT feature, (i - 1)::INT AS i, {s6('e[i]')} AS edge FROM (SELECT feature, e, unnest(range(1, len(e) + 1)) i FROM edges) WHERE feature <> '__score__'"))
def _quantile_edges(spark, sf_dir):
    train, _ = _sides(spark, sf_dir)
    return _edge_rows(spark, D.quantile_edges(train, FEATURES))


@query("bin_counts", _drift("SELECT feature, bin::INT AS bin, n FROM counts WHERE NOT base AND feature <> '__score__'"))
def _bin_counts(spark, sf_dir):
    train, test = _sides(spark, sf_dir)
    return D.bin_counts(test, D.quantile_edges(train, FEATURES))


@query("bin_proportions", _drift(f"SELECT feature, bin::INT AS bin, {s6('s')} AS p FROM once WHERE NOT base AND feature <> '__score__'"))
def _bin_proportions(spark, sf_dir):
    train, test = _sides(spark, sf_dir)
    shares = D.proportions(D.bin_counts(test, D.quantile_edges(train, FEATURES)))
    return shares.withColumn("p", r6("p"))


@query("psi", _drift(f"SELECT feature, {s6('psi')} AS psi FROM psis"))
def _psi(spark, sf_dir):
    baseline, test = _fitted(spark, sf_dir)
    return baseline.compare(test, "blend").withColumn("psi", r6("psi"))


@query("psi_status", _drift(f"SELECT feature, {STATUS} AS status FROM psis"))
def _psi_status(spark, sf_dir):
    baseline, test = _fitted(spark, sf_dir)
    return baseline.compare(test, "blend").select("feature", D.psi_status(F.col("psi")).alias("status"))


@query("drift_fit", _drift(f"SELECT feature, bin::INT AS bin, {s6('s')} AS p, {s6('(SELECT avg(x) FROM long WHERE base AND feature = $$__score__$$)')} AS mean_score FROM once WHERE base"))
def _drift_fit(spark, sf_dir):
    baseline, _ = _fitted(spark, sf_dir)
    path = scratch_path(spark, "drift")
    baseline.save(spark, path)
    loaded = D.DriftBaseline.load(spark, path)
    return loaded.table(spark).select("feature", "bin", r6("p").alias("p"), r6(F.lit(loaded.mean_score)).alias("mean_score"))


@query("feature_drift", _drift(f"SELECT feature, round(psi, 4) AS psi, {STATUS} AS status FROM psis WHERE feature <> '__score__'"))
def _feature_drift(spark, sf_dir):
    baseline, test = _fitted(spark, sf_dir)
    return D.feature_drift(baseline.compare(test, "blend"))


@query("align_baseline", _drift("SELECT feature, bin::INT AS bin, count(*) AS sides FROM twice WHERE feature IN ('amt', 'age', '__score__') GROUP BY feature, bin"))
def _align_baseline(spark, sf_dir):
    """Only the columns that the current table shares with the baseline are compared."""
    baseline, test = _fitted(spark, sf_dir)
    lean = test.select("amt", "age", F.lit(1.0).alias("unknown"), F.col("blend").alias(D.SCORE))
    shared = {c: e for c, e in baseline.edges.items() if c in lean.columns}
    here = D.proportions(D.bin_counts(lean, shared)).select("feature", "bin")
    there = baseline.table(spark).select("feature", "bin").join(here.select("feature").distinct(), "feature", "left_semi")
    both = there.unionByName(here)
    return both.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("sides"))


@query(
    "prediction_drift",
    _drift(
        f"""SELECT round(psi, 4) AS psi, {STATUS} AS status, round((SELECT avg(x) FROM long WHERE base AND feature = '__score__'), 4) AS baseline_avg_score,
 round((SELECT avg(x) FROM long WHERE NOT base AND feature = '__score__'), 4) AS current_avg_score FROM psis WHERE feature = '__score__'"""
    ),
)
def _prediction_drift(spark, sf_dir):
    baseline, test = _fitted(spark, sf_dir)
    return D.prediction_drift(baseline, test, "blend", baseline.compare(test, "blend"))


WORST = f"""SELECT worst AS max_psi, {OVERALL} AS overall_status, drifted AS features_with_drift FROM (SELECT max(round(psi, 4)) worst,
 coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (feature <> '__score__' AND psi >= 0.1), '') drifted FROM psis)"""


@query("overall_drift_status", _drift(WORST))
def _overall(spark, sf_dir):
    baseline, test = _fitted(spark, sf_dir)
    out = D.overall_drift(baseline.compare(test, "blend"))
    return out.withColumn("features_with_drift", F.concat_ws(",", "features_with_drift"))


REPORT = f"""drift_rows AS (SELECT 0 AS section, 'overall' AS name, max_psi AS psi, overall_status AS status FROM ({WORST})
 UNION ALL SELECT 1, 'prediction', round(psi, 4), {STATUS} FROM psis WHERE feature = '__score__'
 UNION ALL SELECT 2, feature, round(psi, 4), {STATUS} FROM psis WHERE feature <> '__score__')"""


@query("drift_report", with_txn("SELECT * FROM drift_rows ORDER BY section, name", PARTS, SIDES, DRIFT, REPORT))
def _drift_report(spark, sf_dir):
    baseline, test = _fitted(spark, sf_dir)
    return D.drift_report(baseline, test, "blend")


@query("drift_alert", _drift(f"SELECT overall_status, '--- DRIFT ALERT ---' || chr(10) || '  overall_status: ' || overall_status || chr(10) || '  features_with_drift: ' || replace(features_with_drift, ',', ', ') AS text FROM ({WORST}) WHERE overall_status IN ('WARNING', 'CRITICAL')"))
def _drift_alert(spark, sf_dir):
    baseline, test = _fitted(spark, sf_dir)
    return A.drift_alert(D.overall_drift(baseline.compare(test, "blend"))).select("overall_status", "text")


# --- prediction log -------------------------------------------------------------------------------------------------

LOG = f"""log AS (SELECT trans_num transaction_id, strftime(trans_date_trans_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp", round(blend, 4) fraud_score,
 {TIER} risk_tier, round(processing_time_ms, 2) processing_time_ms, '1.0.0' model_version, date_trunc('second', trans_date_trans_time) AS logged FROM blended)"""


def _scored(spark, sf_dir):
    return SC.Ensemble().score(transactions(spark, sf_dir))


def _log(spark, sf_dir):
    at = F.date_format(TIME, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    scored = _scored(spark, sf_dir).select(
        F.col("trans_num").alias("transaction_id"), "fraud_score", "risk_tier",
        F.round("processing_time_ms", 2).alias("processing_time_ms"), at.alias("at"),
    )
    return files.prediction_records(scored, at="at")


def _from_log(final: str) -> str:
    return with_txn(final, BLENDED, LOG)


LOG_COLUMNS = ["transaction_id", "timestamp", "fraud_score", "risk_tier", "processing_time_ms", "model_version"]


@query("sink_prediction_log", _from_log("SELECT transaction_id, \"timestamp\", fraud_score, risk_tier, processing_time_ms, model_version FROM log"))
def _sink_prediction_log(spark, sf_dir):
    """Two batches of the same records, one of them delivered twice, leave one record a transaction."""
    path = scratch_path(spark, "log")
    for batch in (0, 1, 1):
        files.append_prediction_log(_log(spark, sf_dir), path, batch)
    return files.read_prediction_log(spark, path).select(*LOG_COLUMNS)


@query("scan_prediction_log", _from_log("SELECT transaction_id, fraud_score, risk_tier FROM log"))
def _scan_prediction_log(spark, sf_dir):
    """Broken and blank lines in the log are passed over; a log that does not exist is empty."""
    path = scratch_path(spark, "log")
    missing = files.read_prediction_log(spark, path)
    texts = files.to_json_text(_log(spark, sf_dir))
    texts.unionByName(texts.select(F.substring("value", 1, 30).alias("value"))).write.text(path)
    return files.read_prediction_log(spark, path).unionByName(missing).select("transaction_id", "fraud_score", "risk_tier")


@query(
    "parse_log_ts",
    _from_log(
        "SELECT transaction_id, CASE WHEN transaction_id::BIGINT % 3 = 2 THEN NULL ELSE epoch_us(logged) END AS us FROM log"
    ),
)
def _parse_log_ts(spark, sf_dir):
    """Thirds: ISO with fraction and Z; blank-separated; ISO with an offset but no fraction, which stays unparsed."""
    third = F.col("transaction_id").cast("long") % 3
    to_second = F.substring("timestamp", 1, 19)
    text = F.when(third == 0, F.col("timestamp")).when(third == 1, F.translate(to_second, "T", " ")).otherwise(F.concat(to_second, F.lit("+00:00")))
    return _log(spark, sf_dir).select("transaction_id", micros(M.parse_log_ts(text)).alias("us"))


def _floor_at(column: str, p: int) -> str:
    return f"list_sort(list({column}))[least(floor({p} / 100::DOUBLE * count(*)), count(*) - 1)::BIGINT + 1]"


@query(
    "percentile_floor",
    _from_log("SELECT " + ", ".join(f"{_floor_at('fraud_score', p)} AS p{p}" for p in (50, 90, 95, 99)) + " FROM log"),
)
def _percentile_floor(spark, sf_dir):
    p = M.percentile_floor(_log(spark, sf_dir), {"fraud_score": [50, 90, 95, 99]})["fraud_score"]
    return small_table(spark, [tuple(float(v) for v in p.values())], ", ".join(f"p{k} double" for k in p))


HIGH = "round(100 * count_if(risk_tier = 'HIGH') / count(*)::DOUBLE, 2)"
SUMMARY = f"count(*) AS total_transactions, {HIGH} AS fraud_rate_pct, round(avg(fraud_score), 4) AS avg_fraud_score, {HIGH} AS alert_rate_pct"
VOLUME = "round(count(*) / greatest((epoch_us(max(logged)) - epoch_us(min(logged))) / 1e6 / 60, 1 / 60::DOUBLE), 2)"
LATENCY = "round(avg(processing_time_ms), 2) AS avg, " + ", ".join(f"round({_floor_at('processing_time_ms', p)}, 2) AS p{p}" for p in (50, 95, 99))


@query("score_summary", _from_log(f"SELECT {SUMMARY} FROM log"))
def _score_summary(spark, sf_dir):
    return M.score_summary(_log(spark, sf_dir))


@query("volume_per_minute", _from_log(f"SELECT {VOLUME} AS volume_per_minute FROM log"))
def _volume(spark, sf_dir):
    return M.volume_per_minute(_log(spark, sf_dir))


@query("latency_stats", _from_log(f"SELECT {LATENCY} FROM log"))
def _latency(spark, sf_dir):
    return M.latency_stats(_log(spark, sf_dir))


@query(
    "risk_tier_breakdown",
    _from_log(
        "SELECT t AS risk_tier, count(l.risk_tier) AS count, round(100 * count(l.risk_tier) / (SELECT count(*) FROM log)::DOUBLE, 2) AS pct "
        "FROM (SELECT unnest(['LOW', 'MEDIUM', 'HIGH']) t) LEFT JOIN log l ON l.risk_tier = t GROUP BY t"
    ),
)
def _breakdown(spark, sf_dir):
    return M.risk_tier_breakdown(_log(spark, sf_dir))


@query(
    "metrics_report",
    _from_log(
        f"SELECT {SUMMARY}, {VOLUME} AS volume_per_minute, "
        + ", ".join(f"{_floor_at('fraud_score', p)} AS score_p{p}" for p in (50, 90, 95, 99))
        + ", round(avg(processing_time_ms), 2) AS latency_avg, "
        + ", ".join(f"round({_floor_at('processing_time_ms', p)}, 2) AS latency_p{p}" for p in (50, 95, 99))
        + ", count_if(risk_tier = 'LOW')::BIGINT AS low, count_if(risk_tier = 'MEDIUM')::BIGINT AS medium, count_if(risk_tier = 'HIGH')::BIGINT AS high FROM log"
    ),
)
def _metrics_report(spark, sf_dir):
    r = M.metrics_report(_log(spark, sf_dir))
    return r.select(
        "total_transactions", "fraud_rate_pct", "avg_fraud_score", "alert_rate_pct", "volume_per_minute",
        *[F.col(f"score_percentiles.p{p}").alias(f"score_p{p}") for p in (50, 90, 95, 99)],
        F.col("latency_ms.avg").alias("latency_avg"),
        *[F.col(f"latency_ms.p{p}").alias(f"latency_p{p}") for p in (50, 95, 99)],
        *[F.col(f"risk_tier_breakdown.{t}.count").alias(t.lower()) for t in M.TIERS],
    )


# --- alerts ---------------------------------------------------------------------------------------------------------

RECORDS = f"""records AS (SELECT trans_num transaction_id, strftime(trans_date_trans_time, '%Y-%m-%d %H:%M:%S') AS "timestamp", amt amount, round(blend, 4) fraud_score,
 {TIER} risk_tier, round(iso_score, 4) iso_score, round(ae_score, 4) ae_score, epoch_us(trans_date_trans_time) us FROM blended),
alerts AS (SELECT * FROM records WHERE fraud_score > 0.7)"""


def _alerts(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    records = SC.scored_record(scored.withColumn("processing_time_ms", F.lit(None)))
    us = scored.select(F.col("trans_num").alias("transaction_id"), micros(F.col(TIME)).alias("us"))
    return A.high_risk_alerts(records).join(us, "transaction_id")


@query("high_risk_alerts", with_txn("SELECT transaction_id, fraud_score FROM alerts", BLENDED, RECORDS))
def _high_risk(spark, sf_dir):
    return _alerts(spark, sf_dir).select("transaction_id", "fraud_score")


def _limited_sql(limit: int, seconds: int) -> str:
    window = seconds * 10**6
    return f"""lined AS (SELECT *, row_number() OVER (ORDER BY us, transaction_id) i FROM alerts),
walk AS (SELECT i, transaction_id, us, true AS sent, [us] AS w FROM lined WHERE i = 1
 UNION ALL SELECT l.i, l.transaction_id, l.us, len(list_filter(k.w, lambda z: z > l.us - {window}::BIGINT)) < {limit},
 CASE WHEN len(list_filter(k.w, lambda z: z > l.us - {window}::BIGINT)) < {limit} THEN list_append(list_filter(k.w, lambda z: z > l.us - {window}::BIGINT), l.us)
 ELSE list_filter(k.w, lambda z: z > l.us - {window}::BIGINT) END FROM walk k JOIN lined l ON l.i = k.i + 1)"""


# the test data has too few alerts for ten per minute to matter, so three per six hours are allowed
@query(
    "rate_limited_alerts",
    with_txn("SELECT transaction_id, us FROM walk WHERE sent", BLENDED, RECORDS, _limited_sql(3, 6 * 3600)).replace("WITH ", "WITH RECURSIVE ", 1),
)
def _rate_limited(spark, sf_dir):
    sent = A.rate_limited_alerts(_alerts(spark, sf_dir), F.col("us"), "transaction_id", limit=3, seconds=6 * 3600)
    return sent.select("transaction_id", "us")


TEXT = """'--- HIGH-RISK TRANSACTION ALERT ---' || chr(10) || '  transaction_id: ' || transaction_id || chr(10) || printf('  amount: %.2f', amount) || chr(10)
 || printf('  fraud_score: %.4f', fraud_score) || chr(10) || printf('  iso_score: %.4f  ae_score: %.4f', iso_score, ae_score) || chr(10)
 || '  risk_tier: ' || risk_tier || chr(10) || '  timestamp: ' || "timestamp" """


@query("alert_text", with_txn(f"SELECT transaction_id, {TEXT} AS text FROM alerts", BLENDED, RECORDS))
def _alert_text(spark, sf_dir):
    return A.alert_text(_alerts(spark, sf_dir)).select("transaction_id", "text")


@query(
    "alert_payload",
    with_txn(
        "SELECT transaction_id, 'high_risk_transaction' AS type, fraud_score, amount, \"timestamp\", 7 AS fields FROM alerts", BLENDED, RECORDS
    ),
)
def _alert_payload(spark, sf_dir):
    """The JSON message, parsed again."""
    out = A.alert_payload(_alerts(spark, sf_dir))
    get = lambda path: F.get_json_object("payload", path)
    return out.select(
        get("$.transaction.transaction_id").alias("transaction_id"), get("$.type").alias("type"),
        get("$.fraud_score").cast("double").alias("fraud_score"), get("$.transaction.amount").cast("double").alias("amount"),
        get("$.transaction.timestamp").alias("timestamp"),
        F.size(F.json_object_keys(get("$.transaction"))).alias("fields"),
    )


@query(
    "alert_history",
    with_txn(
        f"""SELECT * FROM (SELECT 'high_risk_transaction' AS type, transaction_id AS id, us FROM walk WHERE sent
 UNION ALL SELECT 'drift', overall_status, (SELECT max(epoch_us(trans_date_trans_time)) FROM txn) FROM ({WORST}) WHERE overall_status IN ('WARNING', 'CRITICAL'))
 ORDER BY us DESC, type DESC, id DESC LIMIT 100""",
        BLENDED, RECORDS, _limited_sql(3, 6 * 3600), PARTS.replace("numbered", "numbered0"), SIDES, DRIFT,
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def _alert_history(spark, sf_dir):
    """Of the transaction alerts that were sent and of the drift alert, the newest hundred."""
    sent = A.rate_limited_alerts(_alerts(spark, sf_dir), F.col("us"), "transaction_id", limit=3, seconds=6 * 3600)
    baseline, test = _fitted(spark, sf_dir)
    drift = A.drift_alert(D.overall_drift(baseline.compare(test, "blend")))
    last = transactions(spark, sf_dir).agg(F.max(micros(F.col(TIME))).alias("us"))
    drift = drift.crossJoin(F.broadcast(last))  # one row each
    rows = A.alert_history(
        sent.select(F.lit("high_risk_transaction").alias("type"), F.col("transaction_id").alias("id"), "us"),
        "us", "id", drift=drift.select(F.lit("drift").alias("type"), F.upper("overall_status").alias("id"), "us"),
    )
    return rows


@query(
    "report_tables",
    with_txn(
        f"SELECT section, model AS name, metric, {s6('value')} AS value FROM evaluation UNION ALL SELECT 'drift', name, status, {s6('psi')} FROM drift_rows",
        BLENDED, LONG.replace("long AS", "long0 AS"), POINTS.replace("FROM long", "FROM long0").replace("counts", "counts0"), BEST_F1,
        METRICS.replace("FROM long", "FROM long0"), GRID, COSTS.replace("FROM long", "FROM long0"), BEST_COST,
        COST_TABLE.replace("FROM long", "FROM long0"), EVALUATION, PARTS, SIDES, DRIFT, REPORT,
    ),
)
def _report_tables(spark, sf_dir):
    """Evaluation and drift rows in one long table, written and read back."""
    scored = transactions(spark, sf_dir).withColumn("blend", SC.combine_scores(THIRDS))
    baseline, test = _fitted(spark, sf_dir)
    evaluation = E.full_evaluation(scored, MODELS).select("section", F.col("model").alias("name"), "metric", "value")
    drift = D.drift_report(baseline, test, "blend").select(F.lit("drift").alias("section"), "name", F.col("status").alias("metric"), F.col("psi").alias("value"))
    path = scratch_path(spark, "report")
    evaluation.unionByName(drift).write.parquet(path)
    return spark.read.parquet(path).withColumn("value", r6("value"))


@query(
    "stream_summary",
    _from_log(
        "SELECT count(*) AS total_processed, round(avg(processing_time_ms), 2) AS avg_processing_time_ms, count_if(risk_tier = 'LOW')::BIGINT AS count_low, "
        "count_if(risk_tier = 'MEDIUM')::BIGINT AS count_medium, count_if(risk_tier = 'HIGH')::BIGINT AS count_high, "
        "(SELECT count_if(blend >= 0.5::DOUBLE)::BIGINT FROM blended) AS alerts_triggered FROM log"
    ),
)
def _stream_summary(spark, sf_dir):
    return M.stream_summary(SC.scored_record(_scored(spark, sf_dir)))


@query(
    "processor_metrics",
    _from_log(
        f"SELECT count(*) AS total_processed, round(avg(processing_time_ms), 2) AS avg_latency_ms, round({_floor_at('processing_time_ms', 95)}, 2) AS p95_latency_ms, "
        "count_if(risk_tier = 'LOW')::BIGINT AS count_low, count_if(risk_tier = 'MEDIUM')::BIGINT AS count_medium, count_if(risk_tier = 'HIGH')::BIGINT AS count_high, "
        "(SELECT count_if(blend >= 0.5::DOUBLE)::BIGINT FROM blended) AS alert_count FROM log"
    ),
)
def _processor_metrics(spark, sf_dir):
    return M.processor_metrics(SC.scored_record(_scored(spark, sf_dir)))
