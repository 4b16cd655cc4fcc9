"""The batch rules on streams: revisions that arrive once, calendar-month sums, and the latest state of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.latest import latest, visible


def once(stream: DataFrame, keys: Sequence[str], event_time: str, lateness: str) -> DataFrame:
    """Replayed rows are dropped while their key is within the watermark."""
    return stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(list(keys))


def daily_sums(stream: DataFrame, keys: Sequence[str], event_time: str, value: str, lateness: str) -> DataFrame:
    """Sums by key and day, with the month beside: calendar months aren't fixed windows, days are."""
    day = F.window(event_time, "1 day")
    summed = stream.withWatermark(event_time, lateness).groupBy(day, *keys).agg(F.sum(value).alias(value), F.count(F.lit(1)).alias("n_rows"))
    return summed.withColumn("day", F.to_date("window.start")).withColumn("month", F.trunc("day", "month")).drop("window")


def upsert_latest(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], newest: Sequence[Column]):
    """Each batch is reduced to its latest rows and appended once (its number is the partition); `current` picks across batches."""

    def write(batch: DataFrame, number: int) -> None:
        out = latest(batch, keys, newest).withColumn("batch", F.lit(number))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(df: DataFrame, keys: Sequence[str], newest: Sequence[Column]) -> DataFrame:
    return latest(df, keys, newest).drop("batch")


def visible_stream(stream: DataFrame, event_time: str, as_of: str | None, lateness: str) -> DataFrame:
    """The stream up to a cutoff of business time, under a watermark: what is dated later never counts, whenever it arrives."""
    return visible(stream, event_time, as_of).withWatermark(event_time, lateness)
