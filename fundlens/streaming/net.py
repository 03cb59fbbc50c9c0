"""Streams of arriving rows: an extension, each with a batch twin of equal result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fundlens.operators.orphans import apply_deltas


def net_positions(rows: DataFrame) -> DataFrame:
    """(ein, fiscal_year, net, n): what designations and rescissions leave."""
    return rows.groupBy("ein", "fiscal_year").agg(F.sum(F.coalesce("amount", F.lit(0))).cast("bigint").alias("net"), F.count(F.lit(1)).alias("n"))


def event_windows(events: DataFrame, length: str = "1 hour", late: str | None = "1 day") -> DataFrame:
    """(start, event_type, n, value): tumbling windows; rows later than ``late`` behind are dropped in a stream."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    e = e.withWatermark("ts", late) if late else e
    g = e.groupBy(F.window("ts", length).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
    return g.select(F.col("w.start").alias("start"), "event_type", "n", "value")


def event_sessions(events: DataFrame, gap: str = "30 minutes", late: str | None = "1 day") -> DataFrame:
    """(user_id, start, end, n): runs of events of a user without a longer gap."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    e = e.withWatermark("ts", late) if late else e
    g = e.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return g.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def keep_net_positions(spark: SparkSession, source: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Add every arriving batch to a Parquet table of net positions, once.

    The table is written anew under the number of the batch and found by the last number,
    so a batch that runs again after a loss replaces its own result.
    """

    def upsert(batch: DataFrame, number: int) -> None:
        new = net_positions(batch)
        if number:
            old = spark.read.parquet(f"{table}/{number - 1:012d}")
            new = old.unionByName(new).groupBy("ein", "fiscal_year").agg(F.sum("net").cast("bigint").alias("net"), F.sum("n").cast("bigint").alias("n"))
        new.write.mode("overwrite").parquet(f"{table}/{number:012d}")

    return source.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def keep_reference_state(spark: SparkSession, deltas: DataFrame, keys: list[str], table: str, checkpoint: str) -> StreamingQuery:
    """Signed reference and existence counts per key from a stream of deltas (keys, refs, present)."""

    def upsert(batch: DataFrame, number: int) -> None:
        d = batch.groupBy(*keys).agg(F.sum("refs").alias("refs"), F.sum("present").alias("present"))
        state = apply_deltas(spark.read.parquet(f"{table}/{number - 1:012d}"), d, keys) if number else d.where("refs <> 0 or present <> 0")
        state.write.mode("overwrite").parquet(f"{table}/{number:012d}")

    return deltas.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
