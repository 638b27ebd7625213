"""Figures over the prediction log: volume, score and latency percentiles, tier shares."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardsentry.functions.scalar import ratio_or_zero
from cardsentry.operators.ordering import values_at_ranks
from cardsentry.session import materialise

TIERS = ["LOW", "MEDIUM", "HIGH"]


def parse_log_ts(text: Column) -> Column:
    """ISO or blank-separated time to the second: a Z is removed and the text is cut at the first dot. What then still
    holds an offset is not a time (null)."""
    bare = F.split_part(F.replace(text, F.lit("Z"), F.lit("")), F.lit("."), F.lit(1))
    return F.coalesce(
        F.try_to_timestamp(bare, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(bare, F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    )


def cleaned(log: DataFrame) -> DataFrame:
    """Missing numbers count as 0, a missing tier as LOW; tiers are compared in capitals."""
    return log.select(
        F.coalesce(F.col("fraud_score").cast("double"), F.lit(0.0)).alias("fraud_score"),
        F.coalesce(F.col("processing_time_ms").cast("double"), F.lit(0.0)).alias("processing_time_ms"),
        F.upper(F.coalesce(F.col("risk_tier"), F.lit("LOW"))).alias("risk_tier"),
        parse_log_ts(F.col("timestamp")).alias("at"),
    )


def percentile_floor(df: DataFrame, percents: dict[str, list[int]], rows: int | None = None) -> dict[str, dict[int, float]]:
    """Per column and percent p the value at 0-based position ``min(int(p / 100 * n), n - 1)`` of the sorted column;
    0 for an empty table. The columns must have no nulls."""
    n = df.count() if rows is None else rows
    if n == 0:
        return {c: dict.fromkeys(ps, 0.0) for c, ps in percents.items()}
    at = {c: {p: min(int(p / 100.0 * n), n - 1) for p in ps} for c, ps in percents.items()}
    values = values_at_ranks(df, {c: list(r.values()) for c, r in at.items()})
    return {c: {p: values[c][r] for p, r in ranks.items()} for c, ranks in at.items()}


def score_summary(log: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1))
    high = 100.0 * ratio_or_zero(F.count_if(F.col("risk_tier") == "HIGH"), rows)
    return cleaned(log).agg(
        rows.alias("total_transactions"),
        F.round(high, 2).alias("fraud_rate_pct"),
        F.round(F.coalesce(F.avg("fraud_score"), F.lit(0.0)), 4).alias("avg_fraud_score"),
        F.round(high, 2).alias("alert_rate_pct"),
    )


def volume_per_minute(log: DataFrame) -> DataFrame:
    """Rows per minute of the logged span (at least a second); with fewer than two readable times just the rows."""
    rows, known = F.count(F.lit(1)), F.count("at")
    seconds = F.unix_seconds(F.max("at")) - F.unix_seconds(F.min("at"))
    minutes = F.greatest(seconds / 60.0, F.lit(1.0 / 60.0))
    volume = F.when(known >= 2, rows / minutes).otherwise(rows.cast("double"))
    return cleaned(log).agg(F.round(volume, 2).alias("volume_per_minute"))


def latency_stats(log: DataFrame) -> DataFrame:
    clean = cleaned(log).select("processing_time_ms")
    p = percentile_floor(clean, {"processing_time_ms": [50, 95, 99]})["processing_time_ms"]
    return clean.agg(
        F.round(F.coalesce(F.avg("processing_time_ms"), F.lit(0.0)), 2).alias("avg"),
        *[F.round(F.lit(float(v)), 2).alias(f"p{k}") for k, v in p.items()],
    )


def risk_tier_breakdown(log: DataFrame) -> DataFrame:
    """(risk_tier, count, pct): always three rows; rows of other tiers count for the total only."""
    tiers = F.col("risk_tier")
    wide = cleaned(log).agg(F.count(F.lit(1)).alias("total"), *[F.count_if(tiers == t).alias(t) for t in TIERS])
    rows = F.array(
        *[
            F.struct(
                F.lit(t).alias("risk_tier"),
                F.col(t).alias("count"),
                F.round(100.0 * ratio_or_zero(F.col(t), F.col("total")), 2).alias("pct"),
            )
            for t in TIERS
        ]
    )
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def metrics_report(log: DataFrame) -> DataFrame:
    """The whole report as one nested row: one aggregate plus one search for the six percentiles. The log's texts are
    parsed once."""
    clean = materialise(cleaned(log))
    n = clean.count()
    p = percentile_floor(clean, {"fraud_score": [50, 90, 95, 99], "processing_time_ms": [50, 95, 99]}, n)
    rows, known, tiers = F.count(F.lit(1)), F.count("at"), F.col("risk_tier")
    seconds = F.unix_seconds(F.max("at")) - F.unix_seconds(F.min("at"))
    volume = F.when(known >= 2, rows / F.greatest(seconds / 60.0, F.lit(1.0 / 60.0))).otherwise(rows.cast("double"))

    def share(tier: str) -> Column:
        return F.round(100.0 * ratio_or_zero(F.count_if(tiers == tier), rows), 2)

    def avg(c: str, digits: int) -> Column:
        return F.round(F.coalesce(F.avg(c), F.lit(0.0)), digits)

    def points(c: str, digits: int) -> list[Column]:
        return [F.round(F.lit(float(v)), digits).alias(f"p{k}") for k, v in p[c].items()]

    breakdown = [F.struct(F.count_if(tiers == t).alias("count"), share(t).alias("pct")).alias(t) for t in TIERS]
    return clean.agg(
        rows.alias("total_transactions"),
        share("HIGH").alias("fraud_rate_pct"),
        avg("fraud_score", 4).alias("avg_fraud_score"),
        F.struct(*points("fraud_score", 4)).alias("score_percentiles"),
        F.round(volume, 2).alias("volume_per_minute"),
        F.struct(avg("processing_time_ms", 2).alias("avg"), *points("processing_time_ms", 2)).alias("latency_ms"),
        share("HIGH").alias("alert_rate_pct"),
        F.struct(*breakdown).alias("risk_tier_breakdown"),
    )


def stream_summary(scored: DataFrame) -> DataFrame:
    tier = F.col("risk_tier")
    return scored.agg(
        F.count(F.lit(1)).alias("total_processed"),
        F.round(F.coalesce(F.avg("processing_time_ms"), F.lit(0.0)), 2).alias("avg_processing_time_ms"),
        *[F.count_if(tier == t).alias(f"count_{t.lower()}") for t in TIERS],
        F.count_if(F.col("should_alert")).alias("alerts_triggered"),
    )


def processor_metrics(scored: DataFrame) -> DataFrame:
    clean = scored.withColumn("processing_time_ms", F.coalesce("processing_time_ms", F.lit(0.0)))
    p95 = percentile_floor(clean, {"processing_time_ms": [95]})["processing_time_ms"][95]
    return stream_summary(clean).select(
        "total_processed",
        F.col("avg_processing_time_ms").alias("avg_latency_ms"),
        F.round(F.lit(float(p95)), 2).alias("p95_latency_ms"),
        *[f"count_{t.lower()}" for t in TIERS],
        F.col("alerts_triggered").alias("alert_count"),
    )
