"""What the operators share: checkpoints, bounded samples, exact selection, Arrow maps."""

from __future__ import annotations

import ctypes
import gc
import platform
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or one of our own where that is unset and Spark is local.

    On a cluster a folder of the driver's machine would lose rows, so an unset one is an error there.
    """
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="claimforge-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def scratch(spark: SparkSession, what: str) -> str:
    """A path of its own in the shared folder; what is written there goes when the application ends."""
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    fs, at = _file_system(spark, path)
    fs.mkdirs(at)
    fs.deleteOnExit(at)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Deletes what scratch() gave."""
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut by a checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame, path: str) -> DataFrame:
    """The same rows, written as a table in a folder of scratch() and read again."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's code to the executors, once for each application; the driver serves the file."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        at = Path(tempfile.mkdtemp(prefix="claimforge-")) / "claimforge-code.zip"
        with zipfile.ZipFile(at, "w") as z:
            for p in sorted(package.rglob("*.py")):
                z.write(p, p.relative_to(package.parent))
        sc.addPyFile(str(at))
        _shipped.add(sc.applicationId)


#: Bytes of a batch that goes to Python. Workers hold a few batches and their arrays at a time.
BATCH_BYTES, BATCH_SETTING = "16m", "spark.sql.execution.arrow.maxBytesPerBatch"


def arrow(df: DataFrame, function, schema) -> DataFrame:
    """mapInArrow with batches of about BATCH_BYTES (one row at least); workers give freed memory back after each task.

    Spark takes the size of a batch from the session alone: it is set there unless the application has set its own.
    """
    ship(df.sparkSession)
    if df.sparkSession.conf.get(BATCH_SETTING, "1b") == "1b":
        df.sparkSession.conf.set(BATCH_SETTING, BATCH_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        if platform.libc_ver()[0] == "glibc":
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return df.mapInArrow(run, schema)


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the id as a long and the text as a string, whatever else the table holds."""
    return df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))


def label_rows(labels: DataFrame, label: str, where: Column | None = None, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label) of all labelled documents.

    Repeated rows of a document count once, with the smallest label; null ids and labels are left out.
    """
    rows = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label].cast("int").alias("label")).dropna()
    rows = rows.filter(where) if where is not None else rows
    return rows.groupBy("doc_id").agg(F.min("label").alias("label"))


def label_sample(labels: DataFrame, label: str, bound: int, where: Column | None = None, id_col: str = "doc_id") -> DataFrame:
    """About ``bound`` of the label_rows() at most, chosen by a hash of the id.

    The same documents come from the same table, however it is partitioned.
    """
    rows = label_rows(labels, label, where, id_col)
    n = rows.count()
    if n <= bound:
        return rows
    return rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < int(bound / n * (1 << 32)))


def kth_largest(df: DataFrame, col: str, k: int) -> tuple[int, int]:
    """The ``k``-th largest value of a non-null long column and how many rows are larger, exactly.

    Each pass counts rows in at most 4096 bins of the interval that still holds the value, so the driver
    sees bounded counts and no rows.
    """
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    above, bins = 0, 4096
    while hi > lo:
        width = -(-(hi - lo + 1) // bins)
        at = F.floor((F.col(col).cast("decimal(38,0)") - F.lit(str(lo)).cast("decimal(38,0)")) / F.lit(str(width)).cast("decimal(38,0)"))
        counts = {int(r[0]): r[1] for r in df.filter(F.col(col).between(lo, hi)).groupBy(at.cast("int")).count().collect()}
        for b in sorted(counts, reverse=True):
            if above + counts[b] >= k:
                lo, hi = lo + b * width, min(hi, lo + (b + 1) * width - 1)
                break
            above += counts[b]
    return lo, above
