"""File sources and sinks: transaction CSV, JSON lines, scored records, the prediction log."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardsentry.operators.quality import dedup_first, schema_report
from cardsentry.schema import PREDICTION_LOG_SCHEMA, ROW_ID, TIME, TRANSACTION_SCHEMA

STRAY_INDEX = "Unnamed: 0"
MODEL_VERSION = "1.0.0"
BAD_RECORD = "_corrupt_record"
PLACE = "_place"


def parse_datetimes(df: DataFrame) -> DataFrame:
    """Cast the time and birth-date columns if present. Malformed text raises (ANSI mode)."""
    casts = {TIME: F.to_timestamp(F.col(TIME)), "dob": F.to_date(F.to_timestamp(F.col("dob").cast("string")))}
    return df.withColumns({c: x for c, x in casts.items() if c in df.columns})


def _read(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """The file's rows with their place in the input: file, block, then the order within the block."""
    raw = spark.read.format(fmt).options(**({"header": True} if fmt == "csv" else {})).load(path)
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    return raw.select("*", place.alias(PLACE)).drop(STRAY_INDEX)


def typed_transactions(raw: DataFrame) -> DataFrame:
    """Columns are matched by name and cast to the transaction schema; extra columns stay as they are."""
    typed = {
        f.name: F.col(f.name).cast(f.dataType)
        for f in TRANSACTION_SCHEMA.fields
        if f.name in raw.columns and f.name not in (TIME, "dob")
    }
    return parse_datetimes(raw.withColumns(typed))


def read_transactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """The typed table; a stray index column is dropped."""
    return typed_transactions(_read(spark, path, "csv")).drop(PLACE)


def load_transactions(spark: SparkSession, path: str, fmt: str = "csv", strict: bool = True) -> DataFrame:
    """Read, validate (missing columns and nulls in key columns raise) and keep the first row of every id."""
    placed = typed_transactions(_read(spark, path, fmt))
    if strict:
        schema_report(placed.drop(PLACE), strict=True)
    return dedup_first(placed, ROW_ID, PLACE).drop(PLACE)


def write_transactions_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header. ``single_file`` is for samples of a bounded size."""
    texts = df.withColumns({f.name: F.col(f.name).cast("string") for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)})
    (texts.coalesce(1) if single_file else texts).write.mode("overwrite").option("header", True).csv(path)


def with_bad_record(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType())])


def read_jsonl(
    spark: SparkSession, path: str, schema: T.StructType, limit: int | None = None, valid: Column | None = None
) -> DataFrame:
    """One JSON object per line; blank lines are skipped, broken ones carry their text in ``_corrupt_record``.

    With ``limit``, the first so many valid rows by file name and line, and no others: rows that are not broken, and for
    which ``valid`` holds where it is given. They are counted per block of a file, which is a row each for the driver; whole
    blocks are taken until one has the last row, and only that block's rows are put in order.
    """
    if limit is None:
        return parse_json_text(spark.read.text(path), "value", schema)
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    rows = parse_json_text(lines, "value", schema, keep=("_file", "_block", "_line"))
    good = F.col(BAD_RECORD).isNull() & (F.lit(True) if valid is None else F.coalesce(valid, F.lit(False)))
    rows = rows.where(good).drop(BAD_RECORD)
    left, whole, cut = limit, F.lit(False), None
    for r in sorted(rows.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("n")).collect()):
        own = (F.col("_file") == r["_file"]) & (F.col("_block") == r["_block"])
        if r["n"] > left:
            cut = rows.where(own).orderBy("_line").limit(left)
            break
        # blocks come in order, so those taken are all up to this one
        whole = (F.col("_file") < r["_file"]) | ((F.col("_file") == r["_file"]) & (F.col("_block") <= r["_block"]))
        left -= r["n"]
    out = rows.where(whole)
    return (out if cut is None else out.unionByName(cut)).drop("_file", "_block", "_line")


def stream_jsonl(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return parse_json_text(reader.text(path), "value", schema)


def good_and_bad(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, rejected texts)"""
    return df.where(F.col(BAD_RECORD).isNull()).drop(BAD_RECORD), df.where(F.col(BAD_RECORD).isNotNull()).select(BAD_RECORD)


def parse_json_text(df: DataFrame, text: str, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse a column of JSON texts (lines, messages) into columns; broken texts are kept in ``_corrupt_record``, and the
    columns ``keep`` beside them."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}
    present = df.where(F.trim(F.col(text)) != "")
    return present.select(*keep, F.from_json(F.col(text), with_bad_record(schema), options).alias("j")).select("j.*", *keep)


def to_json_text(df: DataFrame, name: str = "value") -> DataFrame:
    """One JSON object per row: nulls are written, dates and times become texts."""
    dated = (T.TimestampType, T.TimestampNTZType, T.DateType)
    plain = [
        (F.col(f.name).cast("string") if isinstance(f.dataType, dated) else F.col(f.name)).alias(f.name)
        for f in df.schema.fields
    ]
    return df.select(F.to_json(F.struct(*plain), {"ignoreNullFields": "false"}).alias(name))


def write_jsonl(df: DataFrame, path: str, limit: int | None = None, mode: str = "overwrite", compression: str = "none") -> None:
    """``limit`` replays the first rows only, in time order."""
    rows = df if limit is None else df.orderBy(TIME, ROW_ID).limit(limit)
    to_json_text(rows).write.mode(mode).option("compression", compression).text(path)


def prediction_records(scored: DataFrame, version: str = MODEL_VERSION, at: str | None = None) -> DataFrame:
    """Log records of scored rows. ``at`` names a column with the log time; default is now, in UTC ISO form."""
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
    when = F.col(at) if at else F.date_format(F.current_timestamp(), pattern)
    return scored.select(
        F.col("transaction_id").cast("string").alias("transaction_id"),
        when.cast("string").alias("timestamp"),
        F.col("fraud_score").cast("double").alias("fraud_score"),
        F.col("risk_tier").cast("string").alias("risk_tier"),
        F.col("processing_time_ms").cast("double").alias("processing_time_ms"),
        F.lit(version).alias("model_version"),
    )


def append_prediction_log(records: DataFrame, path: str, batch: str | int | None = None) -> None:
    """Append, whatever is there already: what a transaction's record is, reading tells. A caller that may repeat a call
    can name it by ``batch``: a batch owns a folder, which a repetition replaces."""
    records.write.mode("overwrite").json(f"{path}/batch={uuid.uuid4().hex if batch is None else batch}")


LOG_KEY = ["transaction_id", "model_version"]


def read_prediction_log(spark: SparkSession, path: str) -> DataFrame:
    """The log's parsed rows, of all batches, merged: one per transaction and model version, that with the newest log time,
    or of the newest file where times are equal. Records without an id, or with an empty one, are all there. A missing log is empty."""
    try:
        lines = spark.read.option("recursiveFileLookup", True).text(path)
        lines = lines.select("value", F.col("_metadata.file_modification_time").alias("_written"))
        rows = parse_json_text(lines, "value", PREDICTION_LOG_SCHEMA, keep=("_written",))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PREDICTION_LOG_SCHEMA)
    names = PREDICTION_LOG_SCHEMA.fieldNames()
    good = rows.where(F.col(BAD_RECORD).isNull())
    rest = [c for c in names if c not in LOG_KEY]
    newest = F.max_by(F.struct(*rest), F.struct("timestamp", "_written", *rest)).alias("r")
    named = F.coalesce("transaction_id", F.lit("")) != ""
    merged = good.where(named).groupBy(*LOG_KEY).agg(newest).select(*LOG_KEY, "r.*")
    return merged.select(*names).unionByName(good.where(~named).select(*names))


def compact_prediction_log(spark: SparkSession, path: str, into: str) -> None:
    """Write the merged log to a fresh path, as one batch."""
    append_prediction_log(read_prediction_log(spark, path), into, "merged")
