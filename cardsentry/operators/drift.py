"""Drift of feature and score distributions against a fitted baseline (population stability index).

The baseline is small by construction: at most ten bins per column. Tables are read once per step and reduced to counts
per column and bin before anything is shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardsentry.operators.ordering import exact_quantiles, slots
from cardsentry.session import small_table
from cardsentry.sources.state import load_scalars, save_scalars

SCORE = "__score__"
# Number of bins, smallest share of a bin, half width around a constant, limits of the statuses.
N_BINS = 10
SMALLEST_SHARE = 1e-6
CONSTANT_HALF_WIDTH = 1e-9
MODERATE_FROM, SIGNIFICANT_ABOVE = 0.1, 0.25


def psi_status(psi: Column) -> Column:
    return F.when(psi < MODERATE_FROM, "OK").when(psi <= SIGNIFICANT_ABOVE, "MODERATE").otherwise("SIGNIFICANT")


def overall_status(worst: Column) -> Column:
    return F.when(worst > SIGNIFICANT_ABOVE, "CRITICAL").when(worst >= MODERATE_FROM, "WARNING").otherwise("OK")


def quantile_edges(df: DataFrame, columns: list[str], n_bins: int = N_BINS) -> dict[str, list[float]]:
    """Distinct quantiles as bin edges; around a constant two edges; for a column without values the unit interval."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    out = {}
    for c, q in exact_quantiles(df, columns, probs).items():
        edges = sorted(set(q)) if q else probs
        if len(edges) < 2:
            edges = [edges[0] - CONSTANT_HALF_WIDTH, edges[0] + CONSTANT_HALF_WIDTH]
        out[c] = edges
    return out


def bin_counts(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """(feature, bin, n) for every bin of every column, empty ones included.

    Bins are closed below, the last one on both sides. Values below the first edge fall into the first bin. Values above
    the last edge are dropped if that edge is positive, and fall into the last bin otherwise.
    """
    tops = [e[-1] if e[-1] > 0 else math.inf for e in edges.values()]
    found = (
        slots(df, {c: e[1:-1] for c, e in edges.items()})
        .where(F.col("x") <= F.element_at(F.lit(tops), F.col("i") + 1))
        .groupBy("i", F.col("slot").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = [(i, c, b) for i, (c, e) in enumerate(edges.items()) for b in range(len(e) - 1)]
    every = small_table(df.sparkSession, grid, "i int, feature string, bin int")
    return every.join(found, ["i", "bin"], "left").select("feature", "bin", F.coalesce("n", F.lit(0)).alias("n"))


def _shares(value: Column) -> Column:
    """Shares per feature, none below the smallest share; without any value all bins are alike. Not yet adding up to 1."""
    per_feature = Window.partitionBy("feature")
    total = F.sum(value).over(per_feature)
    share = F.when(total > 0, F.try_divide(value, total)).otherwise(1.0 / F.count(F.lit(1)).over(per_feature))
    return F.least(F.lit(1.0), F.greatest(F.lit(SMALLEST_SHARE), share))


def _to_one(column: str) -> Column:
    return F.col(column) / F.sum(column).over(Window.partitionBy("feature"))


def proportions(counts: DataFrame) -> DataFrame:
    """(feature, bin, p): the share of every bin."""
    return counts.select("feature", "bin", _shares(F.col("n")).alias("p")).withColumn("p", _to_one("p"))


def psi(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """(feature, psi) from two share tables. Bins known to both sides are brought to shares once more, then compared."""
    both = current.withColumnRenamed("p", "c").join(baseline.withColumnRenamed("p", "b"), ["feature", "bin"])
    again = both.withColumns({"b": _shares(F.col("b")), "c": _shares(F.col("c"))})
    again = again.withColumns({"b": _to_one("b"), "c": _to_one("c")})
    total = F.sum((F.col("c") - F.col("b")) * F.ln(F.col("c") / F.col("b")))
    return again.groupBy("feature").agg(F.greatest(F.lit(0.0), total).alias("psi"))


@dataclass
class DriftBaseline:
    edges: dict[str, list[float]]
    shares: dict[str, list[float]]
    mean_score: float

    @staticmethod
    def fit(df: DataFrame, features: list[str], score: str, n_bins: int = N_BINS) -> DriftBaseline:
        named = df.select(*features, F.col(score).alias(SCORE))
        edges = quantile_edges(named, [*features, SCORE], n_bins)
        shares: dict[str, list[float]] = {c: [] for c in edges}
        for r in sorted(proportions(bin_counts(named, edges)).collect(), key=lambda r: r["bin"]):
            shares[r["feature"]].append(r["p"])
        mean = named.agg(F.avg(SCORE).alias("m")).first()["m"]
        return DriftBaseline(edges, shares, mean or 0.0)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(f, i, p) for f, ps in self.shares.items() for i, p in enumerate(ps)]
        return small_table(spark, rows, "feature string, bin int, p double")

    def compare(self, df: DataFrame, score: str) -> DataFrame:
        """(feature, psi) of the columns known to the baseline, and of the score under its reserved name."""
        known = [c for c in self.edges if c != SCORE and c in df.columns]
        named = df.select(*known, F.col(score).alias(SCORE))
        counts = bin_counts(named, {c: self.edges[c] for c in [*known, SCORE]})
        rows = psi(self.table(df.sparkSession), proportions(counts)).collect()
        # one row per column; every report below reads this instead of the table again
        return small_table(df.sparkSession, [tuple(r) for r in rows], "feature string, psi double")

    def save(self, spark: SparkSession, path: str) -> None:
        save_scalars(spark, {"edges": self.edges, "shares": self.shares, "mean_score": self.mean_score}, path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> DriftBaseline:
        return DriftBaseline(**load_scalars(spark, path))


def feature_drift(compared: DataFrame) -> DataFrame:
    rows = compared.where(F.col("feature") != SCORE)
    return rows.select("feature", F.round("psi", 4).alias("psi"), psi_status(F.col("psi")).alias("status"))


def prediction_drift(baseline: DriftBaseline, df: DataFrame, score: str, compared: DataFrame) -> DataFrame:
    current = df.agg(F.avg(score).alias("m")).first()["m"] or 0.0
    return compared.where(F.col("feature") == SCORE).select(
        F.round("psi", 4).alias("psi"),
        psi_status(F.col("psi")).alias("status"),
        F.round(F.lit(float(baseline.mean_score)), 4).alias("baseline_avg_score"),
        F.round(F.lit(float(current)), 4).alias("current_avg_score"),
    )


def overall_drift(compared: DataFrame) -> DataFrame:
    """One row: the worst rounded index, the overall status and the drifted features in name order."""
    drifted = F.when((F.col("feature") != SCORE) & (psi_status(F.col("psi")) != "OK"), F.col("feature"))
    worst = F.coalesce(F.max(F.round("psi", 4)), F.lit(0.0))
    return compared.agg(worst.alias("max_psi"), F.sort_array(F.collect_list(drifted)).alias("features_with_drift")).select(
        "max_psi", overall_status(F.col("max_psi")).alias("overall_status"), "features_with_drift"
    )


def drift_report(baseline: DriftBaseline, df: DataFrame, score: str) -> DataFrame:
    """(section, name, psi, status) rows: the overall line, the prediction line, then the features in name order."""
    compared = baseline.compare(df, score)
    overall = overall_drift(compared).select(
        F.lit(0).alias("section"), F.lit("overall").alias("name"), F.col("max_psi").alias("psi"), F.col("overall_status").alias("status")
    )
    score_line = prediction_drift(baseline, df, score, compared).select(F.lit(1), F.lit("prediction"), "psi", "status")
    features = feature_drift(compared).select(F.lit(2), "feature", "psi", "status")
    return overall.union(score_line).union(features).orderBy("section", "name")
