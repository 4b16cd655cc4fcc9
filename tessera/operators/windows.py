"""Windows over months, districts and keys, with the guards under which a figure may be given at all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.parsing import month_index
from tessera.operators.quantiles import with_quantiles


def month_growth(df: DataFrame, keys: Sequence[str], month: str, values: Sequence[str]) -> DataFrame:
    """Adds <value>_growth against the row before, only if that is the month before and both are above 0."""
    w = Window.partitionBy(*keys).orderBy(month)
    neighbour = month_index(F.col(month)) - month_index(F.lag(month).over(w)) == 1
    grown = {f"{v}_growth": F.when(neighbour & (F.col(v) > 0) & (F.lag(v).over(w) > 0), F.col(v) / F.lag(v).over(w) - 1) for v in values}
    return df.withColumns(grown)


def growth_gap(df: DataFrame, keys: Sequence[str], month: str, demand: str, supply: str) -> DataFrame:
    """Growth of demand less growth of supply; null unless all four values are known and above 0."""
    return month_growth(df, keys, month, [demand, supply]).withColumn("growth_gap", F.col(f"{demand}_growth") - F.col(f"{supply}_growth"))


def tercile_band(df: DataFrame, period: Sequence[str], value: str, band: str, least: int = 12) -> DataFrame:
    """low up to the lower third's bound, high above the upper's, medium between; unclassified of fewer than `least`.

    The bounds are one row a period, joined back: only they travel, not the districts.
    """
    bounds = with_quantiles(df.groupBy(*period).agg(F.count(value).alias("_n")), df, period, {"_low": (value, 1 / 3), "_high": (value, 2 / 3)})
    v = F.col(value)
    label = F.when(v.isNull() | (F.col("_n") < least), "unclassified").when(v <= F.col("_low"), "low").when(v > F.col("_high"), "high").otherwise("medium")
    return df.join(bounds, list(period)).withColumn(band, label).drop("_low", "_high", "_n")


def complete_percentile(df: DataFrame, period: Sequence[str], value: str, universe: int) -> Column:
    """Share of the universe at or below the value; null unless each member of it is known."""
    all_of = Window.partitionBy(*period)
    whole = (F.count(value).over(all_of) == universe) & (F.count(F.lit(1)).over(all_of) == universe)
    return F.when(whole, F.cume_dist().over(all_of.orderBy(value)))


def month_islands(df: DataFrame, keys: Sequence[str], month: str) -> DataFrame:
    """Ranges of months without a gap."""
    months = df.select(*keys, F.trunc(month, "month").alias("_month")).distinct()
    run = month_index(F.col("_month")) - F.row_number().over(Window.partitionBy(*keys).orderBy("_month"))
    return (
        months.withColumn("_run", run)
        .groupBy(*keys, "_run")
        .agg(F.min("_month").alias("first_month"), F.max("_month").alias("last_month"), F.count(F.lit(1)).alias("n_months"))
        .drop("_run")
    )


def public_keys(df: DataFrame, order: str, prefix: str, width: int = 6) -> DataFrame:
    """Adds public_key <prefix>-000001, ... in the order of a unique column, without one task for all rows.

    A row's number is its place in its range partition after the rows of the partitions before.  The partitions come from a
    fixed list of bounds and not from where rows happen to lie, so both uses of them agree however they are read.
    """
    kind = df.schema[order].dataType.simpleString()
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    sampled = df.select(order).sample(min(1.0, 1000 * parts / max(df.count(), 1)), seed=7)  # about 1,000 rows a partition
    tops = [r.top for r in sampled.withColumn("_n", F.ntile(parts).over(Window.orderBy(order))).groupBy("_n").agg(F.max(order).alias("top")).orderBy("top").collect()][:-1]
    bounds = F.array(*(F.lit(t) for t in tops)).cast(f"array<{kind}>")
    placed = df.withColumn("_part", F.size(F.filter(bounds, lambda b: b < F.col(order))))
    placed = placed.withColumn("_place", F.row_number().over(Window.partitionBy("_part").orderBy(order)))
    sizes = df.groupBy(F.size(F.filter(bounds, lambda b: b < F.col(order))).alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.select("_part", F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    number = (F.col("_place") + F.col("_before")).cast("string")
    key = F.concat(F.lit(f"{prefix}-"), F.when(F.length(number) >= width, number).otherwise(F.lpad(number, width, "0")))
    return placed.join(before, "_part").withColumn("public_key", key).drop("_part", "_place", "_before")
