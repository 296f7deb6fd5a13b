"""What the operators share: the shared checkpoint folder, document keys, word counts."""

from __future__ import annotations

import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands for a null doc_id inside an operator: it sorts after every real one.
NO_ID = (1 << 63) - 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder (``spark.checkpoint.dir``, or where that is unset one below the warehouse)."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder and read from there, so that lost executors cost no earlier work.

    The folder is the one that ``spark.checkpoint.dir`` names; where it is unset, one below the warehouse is taken.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None)
                            or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return df.checkpoint()


def free_shuffles(df: DataFrame) -> None:
    """Asks the driver's JVM to collect garbage: Spark deletes the shuffle and checkpoint files of results nobody refers to any more."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def doc_key(column: str = "doc_id") -> Column:
    """doc_id as a long without nulls."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def text_mark(column: str = "text") -> Column:
    """64-bit hash of the text: tells rows apart that share a doc_id."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def word_count(column: str = "text") -> Column:
    """Number of words in the whole text; none in a null."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def small_side(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df`` marked for broadcast if it is counted and has at most ``rows`` (narrow) rows; else as it is, for a shuffle join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Bytes of a batch that goes to Python, where the session does not say otherwise.  Spark's own 64 MB are held several times over, in the JVM and in Python.
BATCH_BYTES = "8m"
BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def _released(function: Callable) -> Callable:
    """``function``, upon whose end the worker gives memory that it has no more use for back to the machine."""

    def run(batches):
        yield from function(batches)
        pa.default_memory_pool().release_unused()

    return run


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package sent along, so that executors need no installation of it, in batches of a few MB."""
    spark = df.sparkSession
    if spark.conf.get(BYTES_SETTING, None) is None:
        spark.conf.set(BYTES_SETTING, BATCH_BYTES)
    sc = spark.sparkContext
    if not any(name.startswith("amberline") for name in sc._python_includes):
        package = Path(__file__).resolve().parents[1]
        sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/amberline", "zip", package.parent, package.name))
    return df.mapInArrow(_released(function), schema)
