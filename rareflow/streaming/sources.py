"""Event streams over stored files, and sinks in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rareflow.session import fresh_path, range_count
from rareflow.sources.views import label_column, score_column, seconds_since_epoch, table

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def as_instant(ts: str = "ts") -> Column:
    """A zone-less time read as UTC: watermarks need an instant."""
    return F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts}))")


def derive(df: DataFrame) -> DataFrame:
    """The transaction columns of raw events, with ``event_time`` for windows."""
    out = df.select(
        F.col("event_id").alias("txn_id"),
        "user_id",
        as_instant().alias("event_time"),
        seconds_since_epoch().alias("Time"),
        F.col("value").alias("Amount"),
        label_column().alias("Class"),
        "event_type",
    )
    return out.withColumn("score", score_column()).withColumn("pred", (F.col("score") >= 0.5).cast("int"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return derive(raw)


def replay_stream(spark: SparkSession, parts: list[DataFrame]) -> DataFrame:
    """A stream that delivers each part of the raw events as its own micro-batch.

    Parts are written one after the other with the same number of files, and a
    micro-batch takes that many files, oldest first.
    """
    path = fresh_path(spark, "replay")
    files = max(1, min([range_count(spark), *[p.count() for p in parts]]))
    for part in parts:
        part.repartition(files).write.mode("append").parquet(path)
    raw = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).parquet(path)
    return derive(raw)


def run_append(stream: DataFrame, label: str, progress: list | None = None) -> DataFrame:
    """Process all available input into Parquet files; finished windows only."""
    spark = stream.sparkSession
    path = fresh_path(spark, label)
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", f"{path}/data").option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if progress is not None:
        progress.extend(query.recentProgress)
    return spark.read.schema(stream.schema).parquet(f"{path}/data")


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which keyed state and timers need."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
