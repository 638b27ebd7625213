"""Session settings and the shared folder used to cut lineage.

Lineage is cut only with reliable checkpoints or written tables. The folder is the one the cluster names in
``spark.checkpoint.dir``; a private temporary folder is used only where that setting is absent (tests, one machine).
"""

import gc
import tempfile
import uuid
import weakref
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session settings the operators rely on (UTC clock; the rest is Spark's default), and give the executors
    this package, so that functions that run in Python workers can import it wherever those are started."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if getattr(spark.sparkContext, "_cardsentry_sent", None) is None:
        spark.sparkContext._cardsentry_sent = _send_package(spark)
    return spark


def _send_package(spark: SparkSession) -> str:
    """Spark serves the archive from the driver; it is read here and copied by each executor."""
    here = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="cardsentry-")) / "cardsentry.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, f"cardsentry/{f.relative_to(here)}")
    spark.sparkContext.addPyFile(str(archive))
    return str(archive)


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, visible to every executor."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cardsentry-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute once, store reliably, and return a frame whose rows never change on recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder below the shared one that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def forget(df: DataFrame) -> None:
    """Delete what ``materialise`` stored as soon as nobody holds the frame any more. No other frame may read it by then."""
    plan = df._jdf.queryExecution().analyzed()
    stored = plan.rdd().getCheckpointFile() if plan.nodeName() == "LogicalRDD" else None
    if stored is not None and stored.isDefined():
        weakref.finalize(df, discard, df.sparkSession, stored.get()).atexit = False


def let_go(spark: SparkSession) -> None:
    """Have the files of shuffles that no frame refers to deleted now; else they stay until the driver runs out of heap."""
    gc.collect()
    spark._jvm.System.gc()


def small_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A local table whose size the optimizer knows, so that joins with it are broadcast without a hint."""
    schema = StructType.fromDDL(ddl)
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    arrow = to_arrow_schema(schema)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow))
