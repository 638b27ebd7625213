"""Imputation, encoding and scaling; fitted on one table, applied to any."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.functions.scalar import age_years, clip_unit
from cardsentry.operators.ordering import exact_quantiles, extremes, lookup, running_totals
from cardsentry.schema import LABEL, RAW_NUMERIC, ROW_ID, TIME
from cardsentry.session import materialise

# Which columns are dropped, scaled, coded by position and coded by indicator.
DROPPED = ["first", "last", "trans_num"]
SCALED = [*RAW_NUMERIC, "age"]
CODED = ["merchant", "city", "job", "state"]
INDICATED = ["category", "gender"]
UNKNOWN = "unknown"
MOST_LEVELS = 10_000  # columns that indicators of their own may become


def drop_columns(df: DataFrame, columns: list[str] = DROPPED) -> DataFrame:
    return df.drop(*columns)


def with_age(df: DataFrame) -> DataFrame:
    return df.withColumn("age", age_years(F.col(TIME), F.col("dob")))


def clean(column: str):
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def fit_medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    return {c: q[0] if q else 0.0 for c, q in exact_quantiles(df, columns, [0.5]).items()}


def impute(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(clean(c), F.lit(m)) for c, m in medians.items()})


def fill_unknown(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in columns})


def ordinal_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, code, n): codes count from 0 in value order within each column."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    counted = (
        df.select(F.explode(cells).alias("cell"))
        .where("cell.value IS NOT NULL")
        .groupBy("cell.column", "cell.value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("one", F.lit(1).cast("long"))
    )
    numbered = running_totals(counted, ["column"], [F.col("value")], sums={"position": "one"})
    return numbered.select("column", "value", (F.col("position") - 1).alias("code"), "n")


def apply_codes(df: DataFrame, codes: DataFrame, columns: list[str]) -> DataFrame:
    """Replace texts by their codes; unseen texts become -1. ``codes`` must be materialised."""
    rows = {r["column"]: r["count"] for r in codes.groupBy("column").count().collect()}
    for c in columns:
        mine = codes.where(F.col("column") == c).select(F.col("value").alias(c), F.col("code").alias("_code"), "n")
        df = lookup(df, mine, c, "_code", "n", rows.get(c, 0)).withColumn(c, F.coalesce("_code", F.lit(-1))).drop("_code")
    return df


def indicator_levels(df: DataFrame, columns: list[str], most: int = MOST_LEVELS) -> dict[str, list[str]]:
    """Distinct values per column, sorted. Every level becomes a column of its own, so they are counted before they are
    brought to the driver: more than ``most`` raise an error, and the caller may raise the bound or take
    ``sparse_indicators``, which holds the same for any number of levels in one column."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    pairs = materialise(df.select(F.explode(cells).alias("c")).select("c.*").where("value IS NOT NULL").distinct())
    counts = {r["column"]: r["count"] for r in pairs.groupBy("column").count().collect()}
    if sum(counts.values()) > most:
        raise ValueError(f"too many levels for a column each ({counts}, at most {most}): use sparse_indicators")
    found = pairs.collect()
    return {c: sorted(r["value"] for r in found if r["column"] == c) for c in columns}


def indicators(df: DataFrame, levels: dict[str, list[str]]) -> dict:
    """``{column_value: 0.0 / 1.0}`` expressions; an unseen value is 0 everywhere."""
    return {
        f"{c}_{v}": F.coalesce((F.col(c) == v).cast("double"), F.lit(0.0)) for c, vs in levels.items() for v in vs
    }


def sparse_indicators(df: DataFrame, codes: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``<column>_indicator``, a map of the one position that is 1, or an empty map for an unseen value: indicators of
    any number of levels. ``codes`` are those of ``ordinal_codes``."""
    coded = apply_codes(df.withColumns({f"_{c}": F.col(c) for c in columns}), codes, columns)
    cells = {
        f"{c}_indicator": F.when(F.col(c) >= 0, F.create_map(F.col(c).cast("long"), F.lit(1.0))).otherwise(
            F.create_map().cast("map<bigint,double>")
        )
        for c in columns
    }
    return coded.withColumns(cells).withColumns({c: F.col(f"_{c}") for c in columns}).select(*df.columns, *cells)


def _scale(quartiles: list[float] | None) -> tuple[float, float]:
    low, mid, high = quartiles or (0.0, 0.0, 0.0)
    return mid, (high - low) or 1.0


def fit_robust_scale(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """(median, interquartile range or 1) per column."""
    if not columns:
        return {}
    return {c: _scale(q) for c, q in exact_quantiles(df, columns, [0.25, 0.5, 0.75]).items()}


def robust_scale(df: DataFrame, scales: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in scales.items()})


def fit_minmax(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    ends = df.agg(*[f(c).alias(f"{k}{i}") for i, c in enumerate(columns) for k, f in (("lo", F.min), ("hi", F.max))]).first()
    return {c: (float(ends[f"lo{i}"] or 0.0), float(ends[f"hi{i}"] or 0.0)) for i, c in enumerate(columns)}


def minmax(column, low: float, high: float, clip: bool = False):
    scaled = (column - F.lit(low)) / F.lit((high - low) or 1.0)
    return clip_unit(scaled) if clip else scaled


@dataclass
class Preprocessor:
    medians: dict[str, float]
    codes: DataFrame
    levels: dict[str, list[str]]
    scales: dict[str, tuple[float, float]]

    @staticmethod
    def prepare(df: DataFrame) -> DataFrame:
        return with_age(drop_columns(df, [c for c in DROPPED if c != ROW_ID]))

    @staticmethod
    def fit(train: DataFrame) -> Preprocessor:
        data = Preprocessor.prepare(train)
        ends = extremes(data.withColumn("_all", F.lit(1)), [*SCALED, "_all"])
        rows = ends.pop("_all")[2]
        quartiles = exact_quantiles(data, SCALED, [0.25, 0.5, 0.75], ends)
        medians = {c: q[1] if q else 0.0 for c, q in quartiles.items()}
        scales = {c: _scale(q) for c, q in quartiles.items()}
        data = fill_unknown(impute(data, medians), CODED + INDICATED)
        # only where values were filled in do the quartiles differ from those of the known values
        scales |= fit_robust_scale(data, [c for c in SCALED if ends[c][2] < rows])
        codes = materialise(ordinal_codes(data, CODED))
        return Preprocessor(medians, codes, indicator_levels(data, INDICATED), scales)

    def feature_names(self) -> list[str]:
        return [*SCALED, *CODED, *[f"{c}_{v}" for c, vs in self.levels.items() for v in vs]]

    def transform(self, df: DataFrame, keep: tuple[str, ...] = (ROW_ID, LABEL)) -> DataFrame:
        """Kept key and label columns, then 7 scaled numbers, 4 codes and the indicators."""
        data = fill_unknown(impute(self.prepare(df), self.medians), CODED + INDICATED)
        data = data.withColumns(indicators(data, self.levels))
        data = robust_scale(apply_codes(data, self.codes, CODED), self.scales)
        data = data.withColumns({c: F.col(c).cast("double") for c in CODED})
        return data.select(*[c for c in keep if c in data.columns], *[F.col(f"`{c}`") for c in self.feature_names()])


def split_and_preprocess(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, Preprocessor]:
    from cardsentry.operators.split import TimeSplit

    train, val, test = TimeSplit.fit(df).parts(df)
    model = Preprocessor.fit(train)
    return model.transform(train), model.transform(val), model.transform(test), model
