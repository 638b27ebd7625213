"""Helpers shared by the operators of this subpackage."""

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.session import scratch_path
from cardsentry.sources.tables import table

BATCH_BYTES = 8 << 20
BATCH_ROWS = 2_000
SENT_ROWS = 1_000_000  # rows of a table that is broadcast; about 30 MB


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; batches handed to Python are bounded in bytes, so long texts don't add up."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return table(spark, sf_dir, name)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read again."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def frozen(df: DataFrame) -> DataFrame:
    """A step that is read more than once, stored. A table is read without the constraints that a checkpoint remembers of its plan, which
    pile up from round to round."""
    return written(df, "step")


def sent_if_small(table: DataFrame) -> DataFrame:
    """A stored table of a few numbers a row, to be broadcast if a count says that it is small; else the join is a plain one."""
    return F.broadcast(table) if table.count() <= SENT_ROWS else table


def let_go() -> None:
    """Give what was freed in this process back to the system; else a worker keeps it until it ends."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (finaliser of a splitting generator)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow lists over one flat array."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def texts_of(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null reads as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b for b in rows if b.num_rows)


def uniform_of(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the digits of a digest, the same in any SQL engine that has MD5."""
    digits = F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{seed}"))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))


def join_parts(p: np.ndarray, q: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge the parts in ``label`` that the pairs (p, q), grouped by p, connect; returns the pairs that merged two."""
    if not len(p):
        return p, q
    starts = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
    a, b = [], []
    for start, end in zip(starts, [*starts[1:], len(p)], strict=True):
        own, others = label[p[start]], label[q[start:end]]
        far = np.flatnonzero(others != own)
        if len(far):
            roots, first = np.unique(others[far], return_index=True)
            label[np.isin(label, roots)] = own
            a.append(np.full(len(first), p[start]))
            b.append(q[start + far[first]])
    return (np.concatenate(a), np.concatenate(b)) if a else (p[:0], q[:0])
