"""Reading and writing tables and CSV, and staging of reused intermediate results."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import number

log = logging.getLogger(__name__)


# --- shared folder -------------------------------------------------------------

_staged: dict[str, list[str]] = {}  # by application: folders written and not removed yet


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can read: ``spark.checkpoint.dir``, or one below the warehouse if that is not set."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_amberline"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative estimators a place for their checkpoints."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name that ``drop_staged`` removes."""
    path = f"{shared_folder(spark).rstrip('/')}/amberline/{name}-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df: DataFrame, name: str = "stage", partition_by: Sequence[str] = ()) -> DataFrame:
    """Write once to the shared folder, in folders by ``partition_by``, and read back.

    Cuts the lineage before a result is used several times.  A columnar copy
    (rather than a checkpointed RDD) keeps column pruning and filter pushdown
    for the passes that follow, and survives the loss of any executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Removes on leaving what was staged inside; results must be written or collected before that."""
    before = len(_staged.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        drop_staged(spark, before)


def drop_staged(spark: SparkSession, keep: int = 0) -> None:
    """Remove this application's staged folders but for the first ``keep``."""
    paths = _staged.get(spark.sparkContext.applicationId, [])
    for path in paths[keep:]:
        remove_path(spark, path)
    del paths[keep:]


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by ``key`` to all cores.

    For work that is heavy per row on narrow rows, such as drawing a wide table from a key: the rows moved
    are small next to those made from them.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


# --- reading -------------------------------------------------------------------

def read_table_or_csv(spark: SparkSession, name: str, path: str, schema: T.StructType) -> DataFrame:
    """The table if the catalog has it, else the CSV export with a declared schema."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    log.info("table %s is absent, reading %s", name, path)
    return spark.read.schema(schema).option("header", True).csv(path)


def normalise_missing(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column; Spark sorts NaN above all numbers and averages it in."""
    changed = {f.name: number(f.name).cast(f.dataType) for f in df.schema.fields
               if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(changed) if changed else df


# --- writing -------------------------------------------------------------------

def ensure_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def remove_path(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.delete(where, True)


def _move(spark: SparkSession, source: str, target: str) -> None:
    files, where = _file_system(spark, source)
    if not files.rename(where, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{source} could not be moved to {target}")


def swapped(move, new: str, current: str, old: str, exists: bool) -> None:
    """Puts ``new`` in the place of ``current``, which is kept as ``old``; if that fails, ``current`` is as it was."""
    if exists:
        move(current, old)
    try:
        move(new, current)
    except Exception:
        if exists:
            move(old, current)
        raise


def save_table(df: DataFrame, name: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
               path: str | None = None) -> None:
    """Replace a managed table (an external one when ``path`` is given).  Failure raises.

    The rows are written beside the table first and put in its place when they are whole, so that a job that fails leaves
    the old table as it was.  ``df`` may read the table that it replaces.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex[:12]
    if path is not None:
        _save_external(df, name, fmt, partition_by, path.rstrip("/"), mark)
        return
    new, old = f"{name}__new_{mark}", f"{name}__old_{mark}"
    try:
        df.write.format(fmt).partitionBy(*partition_by).saveAsTable(new)
        exists = spark.catalog.tableExists(name)
        swapped(lambda a, b: spark.sql(f"ALTER TABLE {a} RENAME TO {b}"), new, name, old, exists)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    if partition_by and spark.conf.get("spark.sql.catalogImplementation") == "in-memory":
        _relocate_partitions(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def _relocate_partitions(spark: SparkSession, name: str) -> None:
    """A catalog in memory, unlike a metastore, leaves partitions where they were when a table is renamed."""
    place = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"].rstrip("/")
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():  # what the driver's catalog holds anyway
        parts = [part.split("=", 1) for part in row["partition"].split("/")]
        values = ["null" if v == "__HIVE_DEFAULT_PARTITION__" else "'" + unquote(v).replace("\\", "\\\\").replace("'", "\\'") + "'" for _, v in parts]
        spec = ", ".join(f"`{unquote(k)}` = {v}" for (k, _), v in zip(parts, values))
        spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION '{place}/{row['partition']}'")


def _save_external(df: DataFrame, name: str, fmt: str, partition_by: Sequence[str], path: str, mark: str) -> None:
    spark, new, old = df.sparkSession, f"{path}__new_{mark}", f"{path}__old_{mark}"
    try:
        df.write.format(fmt).partitionBy(*partition_by).save(new)
        swapped(lambda a, b: _move(spark, a, b), new, path, old, path_exists(spark, path))
    except Exception:
        remove_path(spark, new)
        raise
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files stay
    spark.catalog.createTable(name, path, fmt)
    if partition_by:
        spark.catalog.recoverPartitions(name)
    remove_path(spark, old)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header into a folder.  ``single_file`` is for small report tables only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def save_with_csv_copy(df: DataFrame, name: str, csv_path: str, fmt: str = "parquet",
                       path: str | None = None) -> bool:
    """Save the table, then try a CSV copy; only the table is critical.  Returns whether the copy worked."""
    save_table(df, name, fmt, path=path)
    try:
        export_csv(df.sparkSession.table(name), csv_path)
    except Exception as e:  # the copy is a convenience
        log.warning("no CSV copy of %s: %s", name, e)
        return False
    return True


def table_count(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).agg(F.count(F.lit(1)).alias("rows"))
