"""Scoring and deduplication of an arriving feed with frozen statistics, labels and model."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans.rate_routes import score_requests
from ..sources.tables import path_exists


def read_feed(spark: SparkSession, folder: str, schema: T.StructType, file_pattern: str | None = None,
              max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if file_pattern:
        reader = reader.option("pathGlobFilter", file_pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def first_of_key(stream: DataFrame, key: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """First arrival of each key; a key is remembered until the watermark has passed it."""
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(key))


#: Keeps state on disk, so that its size is not bounded by memory.
DISK_STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def first_in_window(stream: DataFrame, key: Sequence[str], event_time: str, span: str, delay: str, ties: Sequence[str] = ()) -> DataFrame:
    """The earliest event of each key in each ``span`` of event time, equal times by the columns ``ties``, as the columns of the stream.

    Which event is kept does not depend on the order of arrival.  It comes out, and its state goes, when the watermark, ``delay`` behind the
    latest event, has passed the end of its span; what arrives after that is dropped as late.  Keys may be missing; events without a time are dropped.
    """
    columns = stream.columns
    at = F.col(event_time)
    if isinstance(stream.schema[event_time].dataType, T.TimestampNTZType):
        at = F.concat(at.cast("string"), F.lit("+00:00"))  # a watermark needs an instant; spans follow the clock that was read
    at = at.cast("timestamp")
    timed = stream.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_event"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)],
                          at.alias("_at"), *[F.col(t).alias(f"_t{i}") for i, t in enumerate(ties)])
    order = F.struct("_at", *[f"_t{i}" for i in range(len(ties))])
    first = (timed.withWatermark("_at", delay).groupBy(F.window("_at", span).alias("_window"), *[f"_k{i}" for i in range(len(key))])
             .agg(F.min_by("_event", order).alias("_event")))
    return first.select(*[F.col(f"_event.`{c}`").alias(c) for c in columns])


def score_feed(stream: DataFrame, model: PipelineModel, labels: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """The batch request scorer; it is stateless and narrow, so it runs on a stream as it is."""
    return score_requests(stream, model, labels)


@contextmanager
def disk_state(spark: SparkSession) -> Iterator[None]:
    """Queries that are started inside keep their state on disk."""
    before = {k: spark.conf.get(k, None) for k in DISK_STATE}
    for k, v in DISK_STATE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def drain(stream: DataFrame, path: str, checkpoint: str, name: str | None = None) -> StreamingQuery:
    """Process everything that has arrived into a parquet folder (exactly once), then stop."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    query = writer.outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


# --- publishing by batches with a ledger ----------------------------------------------------

LEDGER = "query string, batch long, rows long"


def _ledger_path(path: str, query: str, batch: int) -> str:
    return f"{path}/ledger/query={query}/batch={batch}"


def publish_batch(rows: DataFrame, path: str, query: str, batch: int) -> bool:
    """Writes one batch into a folder of its own and then enters it in the ledger; returns whether that was still to be done.

    A batch that is in the ledger is left alone.  One that was written but not entered, as its job failed in between, is
    written over, so a repeated batch never publishes twice.
    """
    spark = rows.sparkSession
    if path_exists(spark, f"{_ledger_path(path, query, batch)}/_SUCCESS"):
        return False
    folder = f"{path}/data/query={query}/batch={batch}"
    rows.write.mode("overwrite").parquet(folder)
    written = spark.read.schema(rows.schema).parquet(folder).count()
    enter_batch(spark, path, query, batch, written)
    return True


def enter_batch(spark: SparkSession, path: str, query: str, batch: int, rows: int) -> None:
    spark.createDataFrame([(rows,)], "rows long").coalesce(1).write.mode("overwrite").parquet(_ledger_path(path, query, batch))


def publish(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Processes everything that has arrived, batch by batch, into ``path``, each batch once, then stops.

    Batches are known by the id of the query, which is in its checkpoint, and their number: a query with a new checkpoint publishes anew.
    """
    def each(rows: DataFrame, batch: int) -> None:
        publish_batch(rows, path, rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"), batch)

    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """(query, batch, rows) of the published batches."""
    if not path_exists(spark, f"{path}/ledger"):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("basePath", f"{path}/ledger").parquet(f"{path}/ledger")


def published(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all batches in the ledger; what a failed batch has left is not read."""
    known = ledger(spark, path).select("query", "batch")
    if not path_exists(spark, f"{path}/data"):
        return spark.createDataFrame([], schema)
    places = T.StructType([*schema.fields, T.StructField("query", T.StringType()), T.StructField("batch", T.LongType())])
    rows = spark.read.schema(places).option("basePath", f"{path}/data").parquet(f"{path}/data")
    return rows.join(known, ["query", "batch"], "left_semi").select(*[f"`{f.name}`" for f in schema.fields])
