"""Structured Streaming over normalised posting events.

* ``decode``: Kafka-shaped rows (binary ``value``) -> typed records, with
  the event time parsed (Spark refuses a watermark on text or on
  TIMESTAMP_NTZ, so it is cast to TIMESTAMP).
* ``hourly_counts``: 2 h watermark, 1 h tumbling windows, count per family;
  append mode emits a window once the watermark passes its end, and rows
  later than the watermark are dropped.
* ``latest_per_key``: one record per posting; the hot table
  (``streaming.hot_table``) applies it to each micro-batch.
* ``kafka_options``: the reader options of a topic, with offsets to start from
  and a rate limit.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import STREAM_WATERMARK, STREAM_WINDOW
from ..schemas import STREAM_RECORD


def decode(kafka_rows: DataFrame, schema=STREAM_RECORD) -> DataFrame:
    """value (binary JSON) -> record columns; ``event_time`` is a TIMESTAMP."""
    p = F.from_json(F.col("value").cast("string"), schema).alias("p")
    out = kafka_rows.select(p).select("p.*")
    return out.withColumn("event_time", F.expr("try_cast(fetched_at AS TIMESTAMP)"))


def kafka_options(servers: str, topic: str, starting: str | Mapping[int, int] = "latest", max_per_trigger: int | None = None,
                  min_partitions: int | None = None, fail_on_data_loss: bool = True) -> dict[str, str]:
    """Options of ``readStream.format("kafka")`` for one topic.

    ``starting`` is "earliest", "latest", or an offset per partition of the
    topic (-2 earliest, -1 latest); it counts only until there is a
    checkpoint.  ``max_per_trigger`` limits the records of a micro-batch over
    all partitions, ``min_partitions`` splits large ones over more tasks.
    """
    if isinstance(starting, str):
        if starting not in ("earliest", "latest"):
            raise ValueError(f"starting must be earliest, latest or offsets per partition, got {starting!r}")
    elif not starting or any(not isinstance(k, int) or k < 0 or v < -2 for k, v in starting.items()):
        raise ValueError("offsets are given as partition number -> offset (from -2)")
    else:
        starting = json.dumps({topic: {str(k): int(v) for k, v in sorted(starting.items())}})
    for name, n in (("max_per_trigger", max_per_trigger), ("min_partitions", min_partitions)):
        if n is not None and n < 1:
            raise ValueError(f"{name} must be at least 1")
    out = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting,
           "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_per_trigger is not None:
        out["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions is not None:
        out["minPartitions"] = str(min_partitions)
    return out


def read_topic(spark: SparkSession, servers: str, topic: str, **how) -> DataFrame:
    """The records of a topic as a stream (needs the Kafka connector on the class path)."""
    return decode(spark.readStream.format("kafka").options(**kafka_options(servers, topic, **how)).load())


def hourly_counts(records: DataFrame, ts_col: str = "event_time", family_col: str = "role_family",
                  window: str = STREAM_WINDOW, watermark: str = STREAM_WATERMARK) -> DataFrame:
    """(window_start, window_end, role_family, n) with event-time watermark."""
    g = (
        records.withWatermark(ts_col, watermark)
        .groupBy(F.window(F.col(ts_col), window).alias("w"), F.col(family_col).alias("role_family"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return g.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        "role_family",
        "n",
    )


def start_with_state_partitions(spark: SparkSession, writer, state_partitions: int | None):
    """Start a streaming query whose state store has ``state_partitions`` partitions.

    The number is fixed in the checkpoint when the query first starts (it
    is the session's shuffle-partition count at that moment), so it is set
    only around ``start()``; a restart reuses the stored value.
    """
    key = "spark.sql.shuffle.partitions"
    prev = spark.conf.get(key)
    if state_partitions:
        spark.conf.set(key, str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, prev)


def run_to_parquet(stream_df: DataFrame, sink: str, checkpoint: str, output_mode: str = "append",
                   state_partitions: int | None = None) -> None:
    """Drain everything available now into a Parquet sink (recoverable via the checkpoint)."""
    writer = (
        stream_df.writeStream.outputMode(output_mode)
        .format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    start_with_state_partitions(stream_df.sparkSession, writer, state_partitions).awaitTermination()


def latest_per_key(records: DataFrame, key: str, order_cols: list[str], value_cols: list[str]) -> DataFrame:
    """Latest record per key (largest ``order_cols`` struct)."""
    order = F.struct(*[F.col(c) for c in order_cols])
    payload = F.struct(*[F.col(c) for c in value_cols])
    return records.groupBy(key).agg(F.max_by(payload, order).alias("r")).select(key, "r.*")


def recent(df: DataFrame, ts_col: str, within: str = "1 hour") -> DataFrame:
    """Rows newer than (latest time - ``within``).

    The latest time is a scalar subquery (a partial max per task, one row),
    so the filter needs no join.
    """
    latest = df.agg(F.max(ts_col)).scalar()
    return df.filter(F.col(ts_col) > latest - F.expr(f"INTERVAL {within}"))
