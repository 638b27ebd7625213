"""Validation, profiling and deduplication of transaction tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardsentry.schema import EXPECTED_NUMERIC, LABEL, NON_NULL_COLUMNS, REQUIRED_COLUMNS, ROW_ID, STREAM_REQUIRED
from cardsentry.session import small_table


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def null_profile(df: DataFrame) -> DataFrame:
    """(column, null_count) of every column, from one aggregate."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("null_count")) for c in df.columns])).alias(
            "r"
        )
    ).select("r.*")


def schema_report(df: DataFrame, strict: bool = False) -> DataFrame:
    """(column, present, type, type_ok, null_count) of every required column.

    ``strict`` raises on missing columns and on nulls in the columns that must have none; a wrong type only shows.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    if strict:
        require_columns(df, REQUIRED_COLUMNS)
        bad = null_profile(df.select(*NON_NULL_COLUMNS)).where("null_count > 0").collect()
        if bad:
            raise ValueError(f"nulls in columns that must have none: {sorted(r['column'] for r in bad)}")
    rows = [
        (
            c,
            c in types,
            types[c].simpleString() if c in types else None,
            c in types and (c not in EXPECTED_NUMERIC or isinstance(types[c], T.NumericType)),
        )
        for c in REQUIRED_COLUMNS
    ]
    report = small_table(df.sparkSession, rows, "column string, present boolean, type string, type_ok boolean")
    present = [c for c in REQUIRED_COLUMNS if c in types]
    return report.join(null_profile(df.select(*present)), "column", "left") if present else report


def dedup_first(df: DataFrame, key: str = ROW_ID, order: str | Column = "trans_date_trans_time") -> DataFrame:
    """Keep the first row (by ``order``) of every key; null keys count as one key, and null orders come last.

    An aggregate, not a window: copies of one id are combined before the shuffle, however many there are. The price is a
    sort of whole rows by the key on both sides of the shuffle.
    """
    at = F.col(order) if isinstance(order, str) else order
    # never null itself, or the row would not count
    first = F.min_by(F.struct(*df.columns), F.struct(at.isNull(), at)).alias("r")
    return df.groupBy(F.col(key).alias("_key")).agg(first).select("r.*")


def dataset_stats(df: DataFrame) -> DataFrame:
    """One row: rows, columns, positives and their share in percent."""
    positives = F.count_if(F.col(LABEL).cast("int") == 1)
    rows = F.count(F.lit(1))
    return df.agg(
        rows.alias("n_rows"),
        F.lit(len(df.columns)).alias("n_cols"),
        positives.alias("fraud_count"),
        F.coalesce(F.try_divide(100.0 * positives, rows), F.lit(0.0)).alias("fraud_ratio_pct"),
    )


def has_required_fields(columns: list[str] = STREAM_REQUIRED) -> Column:
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.col(c).isNotNull()
    return ok


def validate_required_fields(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); the rejected rows name the fields they lack."""
    ok = has_required_fields()
    lacking = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in STREAM_REQUIRED])
    return df.where(ok), df.where(~ok).withColumn("missing_fields", lacking)
