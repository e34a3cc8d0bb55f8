"""Streaming extension: landing files to tables, late rows within ten days, event windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from actlens.operators import merge
from actlens.sources.store import Store

LATE = "10 days"


def read_stream(spark: SparkSession, path: str, schema: str, files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def windows(events: DataFrame, at: str, kind: str, width: str, late: str = LATE, slide: str | None = None) -> DataFrame:
    """(inicio, kind, n, total) by event-time windows with late rows; works on streams and on tables."""
    marked = events.withWatermark(at, late) if events.isStreaming else events
    frame = F.window(at, width, slide) if slide else F.window(at, width)
    return marked.groupBy(frame, kind).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("inicio"), kind, "n", "total")


def sessions(events: DataFrame, at: str, key: str, gap: str, late: str = LATE) -> DataFrame:
    marked = events.withWatermark(at, late) if events.isStreaming else events
    return marked.groupBy(F.session_window(at, gap), key).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("inicio"), key, "n")


def first_seen(events: DataFrame, keys: list[str], at: str, late: str = LATE) -> DataFrame:
    """Rows without repeats of a key inside the time that rows may be late."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark(keys) if events.isStreaming else events.dropDuplicates(keys)


def upsert_sink(path: str, keys: list[str], order: str) -> Callable[[DataFrame, int], None]:
    """Batch writer that merges each micro-batch into a ``Store``; of one key the latest row wins.

    Only the buckets that a batch touches are read and written. A batch that was published before a crash is passed
    over when it comes again, and one that was not leaves the table as it was.
    """

    def write(batch: DataFrame, number: int) -> None:
        store = Store(batch.sparkSession, path, keys, batch.schema)
        if store.current()["batch"] is not None and store.current()["batch"] >= number:
            return
        names = [c for c in batch.columns if c not in keys]
        latest = batch.groupBy(*keys).agg(F.max_by(F.struct(*names), order).alias("s")).select(*keys, "s.*").select(*batch.columns)
        touched = [r[0] for r in batch.select(store.bucket()).distinct().collect()]  # one row a bucket
        target = store.read(touched)
        newer = latest.join(target.select(*keys, F.col(order).alias("__o")), keys, "left").where(F.col("__o").isNull() | (F.col(order) >= F.col("__o"))).drop("__o")
        store.replace(merge.upsert(target, newer, keys), touched, number)

    return write


def run_once(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Handles all files there are, then stops."""
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
