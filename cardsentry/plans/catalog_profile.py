"""Queries: descriptive tables."""

from pyspark.sql import functions as F

from cardsentry.functions import scalar as S
from cardsentry.operators import profile as PR
from cardsentry.plans.catalog import query, r6, s6, with_txn
from cardsentry.plans.catalog_features import AGE, DISTANCE
from cardsentry.schema import TIME
from cardsentry.sources.tables import transactions


def _by(expression: str, name: str, extra: str = "", source: str = "txn") -> str:
    return (
        f"SELECT {expression} AS {name}, count(is_fraud) AS total, sum(is_fraud)::BIGINT AS fraud, "
        f"{s6('100 * avg(is_fraud)')} AS fraud_rate{extra} FROM {source} GROUP BY {expression}"
    )


def _rounded(df):
    return df.withColumn("fraud_rate", r6("fraud_rate"))


@query("daily_fraud_rate", with_txn(_by("trans_date_trans_time::DATE::VARCHAR", "day")))
def _daily(spark, sf_dir):
    out = PR.daily_fraud_rate(transactions(spark, sf_dir))
    return _rounded(out).withColumn("day", F.col("day").cast("string"))


@query("fraud_by_hour", with_txn(_by("hour(trans_date_trans_time)", "hour")))
def _hour(spark, sf_dir):
    return _rounded(PR.fraud_by_hour(transactions(spark, sf_dir))).withColumn("hour", F.col("hour").cast("long"))


@query(
    "fraud_by_dow",
    with_txn(
        "SELECT *, ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][day_of_week + 1] AS day_name FROM ("
        + _by("(isodow(trans_date_trans_time) - 1)", "day_of_week") + ")"
    ),
)
def _dow(spark, sf_dir):
    return _rounded(PR.fraud_by_dow(transactions(spark, sf_dir))).withColumn("day_of_week", F.col("day_of_week").cast("long"))


@query("fraud_by_category", with_txn(_by("category", "category")))
def _category(spark, sf_dir):
    return _rounded(PR.fraud_by_category(transactions(spark, sf_dir)))


@query("fraud_by_gender", with_txn(_by("gender", "gender")))
def _gender(spark, sf_dir):
    return _rounded(PR.fraud_by(transactions(spark, sf_dir), "gender", "gender"))


def _top(key: str, at_least: int) -> str:
    rates = f"SELECT {key}, count(*) total, sum(is_fraud)::BIGINT fraud, 100 * sum(is_fraud) / count(*)::DOUBLE fraud_rate FROM txn GROUP BY {key}"
    return with_txn(
        f"SELECT * REPLACE ({s6('fraud_rate')} AS fraud_rate) FROM (SELECT * FROM ({rates}) WHERE total >= {at_least} ORDER BY fraud_rate DESC, {key} LIMIT 10)"
    )


@query("top_merchants", _top("merchant", 5))
def _merchants(spark, sf_dir):
    return _rounded(PR.top_rates(transactions(spark, sf_dir), "merchant", 10, at_least=5))


@query("top_states", _top("state", 0))
def _states(spark, sf_dir):
    return _rounded(PR.top_rates(transactions(spark, sf_dir), "state", 10))


EDA_GROUP = f"""CASE WHEN {AGE} > 17 AND {AGE} <= 30 THEN '18-30' WHEN {AGE} > 30 AND {AGE} <= 45 THEN '31-45'
 WHEN {AGE} > 45 AND {AGE} <= 60 THEN '46-60' WHEN {AGE} > 60 AND {AGE} <= 150 THEN '60+' END"""


@query(
    "fraud_by_age_group",
    with_txn(
        f"""SELECT g AS age_group, count(is_fraud) AS total, coalesce(sum(is_fraud), 0)::BIGINT AS fraud, {s6('100 * avg(is_fraud)')} AS fraud_rate
 FROM (SELECT unnest(['18-30','31-45','46-60','60+']) g) LEFT JOIN (SELECT {EDA_GROUP} ag, is_fraud FROM txn) ON ag = g GROUP BY g"""
    ),
)
def _age_group(spark, sf_dir):
    return _rounded(PR.fraud_by_age_group(transactions(spark, sf_dir)))


@query("class_counts", with_txn(f"SELECT is_fraud, count(*) AS n, {s6('100 * count(*) / (SELECT count(*) FROM txn)::DOUBLE')} AS pct FROM txn GROUP BY is_fraud"))
def _class_counts(spark, sf_dir):
    return PR.class_counts(transactions(spark, sf_dir)).withColumn("pct", r6("pct"))


@query("mean_age_by_class", with_txn(f"SELECT is_fraud, {s6(f'avg({AGE})')} AS mean_age FROM txn GROUP BY is_fraud"))
def _mean_age(spark, sf_dir):
    return PR.mean_age_by_class(transactions(spark, sf_dir)).withColumn("mean_age", r6("mean_age"))


DESCRIBED = ["amt", "lat", "long", "city_pop", "merch_lat", "merch_long", "is_fraud", "cc_num"]


def _describe_one(c: str) -> str:
    q = lambda p: s6(f"quantile_cont({c}::DOUBLE, {p})")
    x = f"{c}::DOUBLE"
    return (
        f"SELECT '{c}' AS \"column\", count({c}) AS count, {s6(f'avg({x})')} AS mean, {s6(f'stddev_samp({x})')} AS std, "
        f"{s6(f'min({c})')} AS min, {q(0.25)} AS q25, {q(0.5)} AS q50, {q(0.75)} AS q75, {s6(f'max({c})')} AS max FROM txn"
    )


@query("describe_numeric", with_txn(" UNION ALL ".join(_describe_one(c) for c in DESCRIBED)))
def _describe(spark, sf_dir):
    out = PR.describe_numeric(transactions(spark, sf_dir), DESCRIBED)
    return out.select("column", "count", *[r6(c).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


@query(
    "boxplot_stats",
    with_txn(
        f"""SELECT category, {s6('q25')} AS q25, {s6('q50')} AS q50, {s6('q75')} AS q75,
 {s6('min(CASE WHEN inside THEN amt END)')} AS whisker_low, {s6('max(CASE WHEN inside THEN amt END)')} AS whisker_high,
 count_if(NOT inside)::BIGINT AS outliers
 FROM (SELECT *, amt BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) inside FROM txn JOIN q USING (category))
 GROUP BY category, q25, q50, q75""",
        "q AS (SELECT category, quantile_cont(amt, 0.25) q25, quantile_cont(amt, 0.5) q50, quantile_cont(amt, 0.75) q75 FROM txn GROUP BY category)",
    ),
)
def _boxplot(spark, sf_dir):
    out = PR.boxplot_stats(transactions(spark, sf_dir))
    cells = [r6(c).alias(c) for c in ("q25", "q50", "q75", "whisker_low", "whisker_high")]
    return out.select("category", *cells, "outliers")


BINS = {"amt": 50, "distance_km": 50, "age": 30, "city_pop": 50, "iso_score": 40}
ENRICHED = f"enriched AS (SELECT *, {DISTANCE} distance_km, {AGE} age, hour(trans_date_trans_time) AS hour, isodow(trans_date_trans_time) - 1 AS day_of_week FROM txn)"


def _enriched(spark, sf_dir):
    df = transactions(spark, sf_dir)
    return df.withColumns(
        {
            "distance_km": S.haversine_km(*map(F.col, ["lat", "long", "merch_lat", "merch_long"])),
            "age": S.age_years(F.col(TIME), F.col("dob")),
            "hour": F.hour(TIME),
            "day_of_week": F.weekday(TIME),
        }
    )


@query(
    "histogram_by_class",
    with_txn(
        f"""SELECT "column", label, least(floor((x - lo) / ((hi - lo) / bins)), bins - 1)::INT AS bin, count(*) AS n,
 {s6('count(*) / (total * ((hi - lo) / bins))')} AS density
 FROM long JOIN ends USING ("column", label) GROUP BY "column", label, bin, total, hi, lo, bins""",
        ENRICHED,
        "long AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", is_fraud AS label, {k} AS bins, round({c}::DOUBLE, 9) AS x FROM enriched" for c, k in BINS.items()) + ")",
        'ends AS (SELECT "column", label, min(x) lo, max(x) hi, count(*) total FROM long GROUP BY "column", label)',
    ),
)
def _histogram(spark, sf_dir):
    df = _enriched(spark, sf_dir)
    df = df.withColumns({c: F.round(F.col(c).cast("double"), 9) for c in BINS})  # the same numbers in both engines
    return PR.histogram_by_class(df, BINS).withColumn("density", r6("density"))


CORRELATED = ["cc_num", "amt", "lat", "long", "city_pop", "merch_lat", "merch_long", "is_fraud", "hour", "day_of_week", "distance_km", "age"]


def _corr_sql(pairs) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}::DOUBLE, {b}::DOUBLE) AS corr FROM enriched" for a, b in pairs
    )


@query(
    "correlation_matrix",
    with_txn(f"SELECT a, b, {s6('corr')} AS corr FROM (" + _corr_sql([(a, b) for a in CORRELATED for b in CORRELATED]) + ")", ENRICHED),
)
def _correlation(spark, sf_dir):
    return PR.correlation_matrix(_enriched(spark, sf_dir), CORRELATED).withColumn("corr", r6("corr"))


@query(
    "top_correlated",
    with_txn(
        f"SELECT b AS \"column\", {s6('corr')} AS corr FROM (SELECT * FROM ("
        + _corr_sql([("is_fraud", b) for b in CORRELATED if b != "is_fraud"])
        + ") ORDER BY abs(corr) DESC, b LIMIT 10)",
        ENRICHED,
    ),
)
def _top_correlated(spark, sf_dir):
    matrix = PR.correlation_matrix(_enriched(spark, sf_dir), CORRELATED)
    return PR.top_correlated(matrix).withColumn("corr", r6("corr"))
