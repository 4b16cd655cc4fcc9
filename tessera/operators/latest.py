"""Point-in-time selection over append-only revisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], newest: Sequence[Column], ties: str = "any") -> DataFrame:
    """The first row of each key in the order given; Spark keeps one row a key and task before it shuffles.

    ties: what happens where different rows of a key share the first place.  "any": one of them is taken, and not the same in every run or engine;
    "report": the least of them in all columns is taken, and `tied` says how many rows share the place (1: no tie; equal rows are no tie);
    "reject": the job fails and names the key.  The last two keep all rows of the first place up to the shuffle, and then a row a key.
    """
    if ties == "any":
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
        return df.withColumn("_place", place).filter("_place = 1").drop("_place")
    first = df.withColumn("_place", F.rank().over(Window.partitionBy(*keys).orderBy(*newest))).filter("_place = 1").drop("_place")
    row = F.struct(*[F.col(c) for c in df.columns])
    found = first.groupBy(*keys).agg(F.min(row).alias("_least"), F.max(row).alias("_most"), F.count(F.lit(1)).alias("_n"))
    tied = F.when(F.col("_least") == F.col("_most"), F.lit(1)).otherwise(F.col("_n")).cast("bigint")
    if ties == "report":
        return found.select("_least.*", tied.alias("tied"))
    if ties != "reject":
        raise ValueError(f"ties: {ties}")
    message = F.concat(F.lit("rows tie for the latest of "), F.to_json(F.struct(*keys)))
    return found.filter(F.when(tied > 1, F.raise_error(message).cast("boolean")).otherwise(True)).select("_least.*")


def visible(df: DataFrame, day: str, as_of: str | None) -> DataFrame:
    """Rows observed up to the cutoff; all of them without one."""
    return df if as_of is None else df.filter(F.col(day) <= F.lit(as_of).cast(df.schema[day].dataType))


def latest_ready(status: DataFrame, source: str, run: str, newest_status: Sequence[Column], ready: Column, newest_run: Sequence[Column]) -> DataFrame:
    """The newest run of each source whose last status is ready.

    The last status is taken first and judged then: judging first would revive a run that failed at its retry.
    """
    last = latest(status, [source, run], newest_status)
    return latest(last.filter(ready), [source], newest_run)


def latest_snapshot(snapshots: DataFrame, keys: Sequence[str], newest: Sequence[Column], members: DataFrame, snapshot: Sequence[str]) -> DataFrame:
    """The members of each key's newest snapshot; a newest snapshot that is empty stays, as a row without a member."""
    return latest(snapshots, keys, newest).join(members, list(snapshot), "left")


def revision_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[Column], content: str) -> DataFrame:
    """Adds `revision`: 0 for a key's first row, one more where the content differs from the row before."""
    by_key = Window.partitionBy(*keys).orderBy(*order)
    first = F.row_number().over(by_key) == 1
    changed = ~F.lag(content).over(by_key).eqNullSafe(F.col(content)) & ~first
    return df.withColumn("_changed", changed.cast("int")).withColumn("revision", F.sum("_changed").over(by_key.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint")).drop("_changed")


def prefer_revisions(revisions: DataFrame, snapshots: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All revisions, and the snapshots of keys that have none."""
    return revisions.unionByName(snapshots.join(revisions.select(*keys).distinct(), list(keys), "left_anti"), allowMissingColumns=True)
