"""Descriptive tables of a transaction table: rates by key, distributions, correlations."""

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsentry.functions.scalar import AGE_GROUPS, age_group, age_years
from cardsentry.operators.ordering import exact_quantiles, lookup, running_totals
from cardsentry.schema import LABEL, TIME
from cardsentry.session import materialise, small_table

DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def fraud_by(df: DataFrame, key: Column | str, name: str) -> DataFrame:
    """(key, total, fraud, fraud_rate in percent) per value of ``key``; rows without a key are left out."""
    key = F.col(key) if isinstance(key, str) else key
    grouped = df.select(key.alias(name), F.col(LABEL).alias("_y")).where(F.col(name).isNotNull()).groupBy(name)
    return grouped.agg(F.count("_y").alias("total"), F.sum("_y").alias("fraud")).withColumn(
        "fraud_rate", F.try_divide(100.0 * F.col("fraud"), F.col("total"))
    )


def daily_fraud_rate(df: DataFrame) -> DataFrame:
    return fraud_by(df, F.to_date(TIME), "day")


def fraud_by_hour(df: DataFrame) -> DataFrame:
    return fraud_by(df, F.hour(TIME), "hour")


def fraud_by_dow(df: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(d) for d in DAY_NAMES])
    return fraud_by(df, F.weekday(TIME), "day_of_week").withColumn(
        "day_name", F.element_at(names, F.col("day_of_week") + 1)
    )


def fraud_by_category(df: DataFrame) -> DataFrame:
    return fraud_by(df, "category", "category").orderBy("fraud_rate", "category")


def top_rates(df: DataFrame, key: str, k: int = 10, at_least: int = 0) -> DataFrame:
    """The ``k`` keys of highest rate among those with at least ``at_least`` rows; equal rates in key order."""
    rates = fraud_by(df, key, key).where(F.col("total") >= at_least)
    return rates.orderBy(F.desc("fraud_rate"), F.asc(key)).limit(k)


def fraud_by_age_group(df: DataFrame) -> DataFrame:
    """All four groups, also empty ones; exactly 17 years belong to none here."""
    found = fraud_by(df, age_group(age_years(F.col(TIME), F.col("dob")), include_lowest=False), "age_group")
    groups = small_table(df.sparkSession, [(name,) for _, name in AGE_GROUPS], "age_group string")
    return groups.join(found, "age_group", "left").na.fill(0, ["total", "fraud"])


def class_counts(df: DataFrame) -> DataFrame:
    counts = df.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"))
    share = 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy())  # over one row per class
    return counts.select(LABEL, "n", share.alias("pct"))


def mean_age_by_class(df: DataFrame) -> DataFrame:
    return df.groupBy(LABEL).agg(F.avg(age_years(F.col(TIME), F.col("dob"))).alias("mean_age"))


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max); quartiles are exact."""
    names = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    wide = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in names.items()])
    cells = []
    for i, c in enumerate(columns):
        q = quartiles[c] or [None] * 3
        cells.append(
            F.struct(
                F.lit(c).alias("column"),
                *[F.col(f"{n}_{i}").alias(n) for n in names],
                *[F.lit(v).cast("double").alias(n) for n, v in zip(("q25", "q50", "q75"), q, strict=True)],
            )
        )
    return wide.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def quantiles_by(df: DataFrame, key: str, value: str, probs: list[float]) -> tuple[DataFrame, DataFrame]:
    """(per key: total and exact quantiles q0, q1, ...; the rows counted per key and value).

    The counted values are range-partitioned, so a key with most of the rows still spreads over all tasks.
    """
    counts = (
        df.select(F.col(key), F.col(value).cast("double").alias("value"))
        .where(F.col(key).isNotNull() & F.col("value").isNotNull())
        .groupBy(key, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    points = running_totals(counts, [key], [F.col("value")], sums={"upto": "n"}, group_sums={"total": "n"})
    ends = []
    for i, p in enumerate(probs):
        at = (F.col("total") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            ends.append(F.min(F.when(F.col("upto") > rank, F.col("value"))).alias(f"{side}{i}"))
    wide = points.groupBy(key, "total").agg(*ends)
    out = []
    for i, p in enumerate(probs):
        at = (F.col("total") - 1) * F.lit(float(p))
        out.append((F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * (at - F.floor(at))).alias(f"q{i}"))
    return wide.select(key, "total", *out), points.drop("total")


def boxplot_stats(df: DataFrame, key: str = "category", value: str = "amt") -> DataFrame:
    """Quartiles, and whiskers at the last values within 1.5 interquartile ranges."""
    quartiles, points = quantiles_by(df, key, value, [0.25, 0.5, 0.75])
    table = materialise(quartiles.select(key, F.struct("q0", "q1", "q2").alias("q"), "total"))
    low, mid, high = (F.col(f"q.q{i}") for i in range(3))
    inside = F.col("value").between(low - 1.5 * (high - low), high + 1.5 * (high - low))
    return (
        lookup(points, table, key, "q", "total")
        .groupBy(key, low.alias("q25"), mid.alias("q50"), high.alias("q75"))
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(~inside, F.col("n")).otherwise(0)).alias("outliers"),
        )
    )


def histogram_by_class(df: DataFrame, bins: dict[str, int]) -> DataFrame:
    """(column, label, bin, n, density): equal-width bins between the class's own extremes, the last one closed."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.lit(k).alias("bins"), F.col(c).cast("double").alias("x"))
            for c, k in bins.items()
        ]
    )
    long = (
        df.select(F.col(LABEL).cast("int").alias("label"), F.explode(cells).alias("c"))
        .select("label", "c.*")
        .where(F.col("label").isin(0, 1) & F.col("x").isNotNull())
    )
    flat = F.min("x") == F.max("x")
    ends = long.groupBy("column", "label").agg(
        (F.min("x") - F.when(flat, F.lit(0.5)).otherwise(F.lit(0.0))).alias("lo"),
        (F.max("x") + F.when(flat, F.lit(0.5)).otherwise(F.lit(0.0))).alias("hi"),
        F.count(F.lit(1)).alias("total"),
    )
    # two rows per column at most
    placed = long.join(F.broadcast(ends), ["column", "label"])
    width = (F.col("hi") - F.col("lo")) / F.col("bins")
    index = F.least(F.floor((F.col("x") - F.col("lo")) / width), F.col("bins") - 1)
    return (
        placed.withColumn("bin", index.cast("int"))
        .groupBy("column", "label", "bin", "total", width.alias("width"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("column", "label", "bin", "n", (F.col("n") / (F.col("total") * F.col("width"))).alias("density"))
    )


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, corr) for every pair of columns, over the rows in which both are known; null for a constant column."""
    number = {c: F.col(c).cast("double") for c in columns}
    pairs = list(combinations(columns, 2))
    holes = df.agg(*[F.count_if(x.isNull()).alias(c) for c, x in number.items()]).first()
    aggs = []
    for i, (a, b) in enumerate(pairs):
        x, y = number[a], number[b]
        if holes[a] or holes[b]:
            x, y = (F.when(x.isNotNull() & y.isNotNull(), v) for v in (x, y))
        aggs.append(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)).alias(f"r{i}"))
    for i, c in enumerate(columns):
        aggs.append(F.when(F.stddev_pop(number[c]) > 0, F.lit(1.0)).alias(f"s{i}"))
    wide = df.agg(*aggs)
    cells = [(a, b, f"r{i}") for i, (a, b) in enumerate(pairs)]
    cells += [(b, a, r) for a, b, r in cells] + [(c, c, f"s{i}") for i, c in enumerate(columns)]
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(r).alias("corr")) for a, b, r in cells])
    return wide.select(F.explode(rows).alias("p")).select("p.*")


def top_correlated(matrix: DataFrame, target: str = LABEL, k: int = 10) -> DataFrame:
    """The ``k`` columns most correlated with ``target`` by absolute value, weakest first."""
    others = matrix.where((F.col("a") == target) & (F.col("b") != target) & F.col("corr").isNotNull())
    strongest = others.select(F.col("b").alias("column"), "corr").orderBy(F.abs("corr").desc(), "column").limit(k)
    return strongest.orderBy(F.abs("corr"), F.desc("column"))
