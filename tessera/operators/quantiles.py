"""Exact quantiles of groups of any size, by histograms that are refined around the wanted order statistics.

Equal values of a group are counted first, so a value that repeats travels once.  A range of values that holds a wanted rank is cut into
at most CELLS cells, the cells are counted with partial sums, and the cell that holds the rank becomes the next range; both ends of a
range have cells of their own, so each round takes values away.  A range of at most CELLS distinct values is ranked by a window.
Groups of more than CELLS distinct values are few for their rows, so their ranges are broadcast and their values stay where they are;
only groups of at most CELLS are brought together by key.  No task sees more than CELLS rows of a group, and no list of values is made.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.graph import cut_lineage

CELLS = 4096


def _cell(cells: int) -> Column:
    """The cell of _v in [_lo, _hi], which does not fall as _v grows; infinite ends are cells of their own like others."""
    inner = F.nanvl((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")), F.lit(0.5)) * (cells - 2)
    inside = F.least(F.greatest(F.floor(F.when(F.abs(inner) < cells, inner).otherwise(0.0)), F.lit(0)), F.lit(cells - 3)) + 1
    return F.when(F.col("_v") == F.col("_lo"), 0).when(F.col("_v") == F.col("_hi"), cells - 1).otherwise(inside).cast("int")


def exact_quantiles(df: DataFrame, keys: Sequence[str], wanted: Mapping[str, tuple[str, float]], cells: int = CELLS) -> DataFrame:
    """(keys, a column for each of `wanted`: column and fraction), interpolated linearly between neighbouring values.

    Nulls don't count; a group without values has no row; values are compared as doubles, -0.0 as 0.0 and NaN as the greatest; null keys are a group.
    """
    spark = df.sparkSession
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    values = F.array(*[F.struct(F.lit(c).alias("of"), F.col(c).cast("double").alias("v")) for c in columns])
    long = df.select(F.struct(*keys, F.lit(0).alias("_")).alias("_key"), F.explode(values).alias("_x")).filter("_x.v IS NOT NULL")
    counts = long.groupBy(F.col("_key"), F.col("_x.of").alias("_of"), (F.col("_x.v") + F.lit(0.0)).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    counts = cut_lineage(spark, counts.select(F.struct("_key", "_of").alias("_k"), "_v", "_n"))
    groups = counts.groupBy("_k").agg(F.sum("_n").alias("_total"), F.count(F.lit(1)).alias("_distinct"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))

    def place(fraction: float) -> Column:
        return (F.col("_total") - 1) * F.lit(float(fraction))

    due = F.array(*[F.when(F.col("_k._of") == c, F.array(F.floor(place(f)), F.ceil(place(f)))).otherwise(F.array().cast("array<bigint>")) for c, f in dict.fromkeys(wanted.values())])
    groups = cut_lineage(spark, groups.select("_k", "_total", "_distinct", "_lo", "_hi", F.array_distinct(F.flatten(due)).alias("_ranks")))
    ranks = groups.select("_k", F.explode("_ranks").alias("_rank"))
    ranges = groups.select("_k", F.lit(0).cast("bigint").alias("_before"), "_distinct", "_lo", "_hi")
    large = hot = ranges.filter(F.col("_distinct") > cells)
    plain = counts.join(F.broadcast(hot.select("_k")), "_k", "left_anti").join(ranges.filter(F.col("_distinct") <= cells).drop("_distinct"), "_k")
    refined = ranges.limit(0)
    while not large.isEmpty():
        held = counts.join(F.broadcast(large.drop("_distinct")), "_k").filter("_v >= _lo AND _v <= _hi")
        cut = held.groupBy("_k", "_before", _cell(cells).alias("_cell")).agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_distinct"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        below = Window.partitionBy("_k", "_before").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        cut = cut.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_n").over(below), F.lit(0)))
        holding = cut.join(ranks, "_k").filter("_rank >= _before AND _rank < _before + _n").select("_k", "_before", "_distinct", "_lo", "_hi").distinct()
        found = cut_lineage(spark, holding)
        refined = refined.unionByName(found.filter(F.col("_distinct") <= cells))
        large = found.filter(F.col("_distinct") > cells)
    below = Window.partitionBy("_k", "_before").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    placed = plain.unionByName(counts.join(F.broadcast(refined.drop("_distinct")), "_k")).filter("_v >= _lo AND _v <= _hi").withColumn("_from", F.col("_before") + F.coalesce(F.sum("_n").over(below), F.lit(0)))
    at = placed.join(ranks, "_k").filter("_rank >= _from AND _rank < _from + _n").join(groups.select("_k", "_total"), "_k")

    def quantile(column: str, fraction: float) -> Column:
        of, exact = F.col("_k._of") == column, place(fraction)
        value = lambda rank: F.max(F.when(of & (F.col("_rank") == rank), F.col("_v")))
        low, high, part = value(F.floor(exact)), value(F.ceil(exact)), F.max(F.when(of, exact - F.floor(exact)))
        return F.when(low == high, low).otherwise(low + (high - low) * part)

    out = at.groupBy(F.col("_k._key").alias("_key")).agg(*[quantile(c, f).alias(name) for name, (c, f) in wanted.items()])
    return out.select(*[F.col(f"_key.{k}").alias(k) for k in keys], *wanted)


def with_quantiles(measured: DataFrame, df: DataFrame, keys: Sequence[str], wanted: Mapping[str, tuple[str, float]]) -> DataFrame:
    """Measures of df by keys, with quantiles of df joined."""
    found = exact_quantiles(df, keys, wanted).select(F.struct(*keys).alias("_key"), *wanted)
    return measured.withColumn("_key", F.struct(*keys)).join(found, "_key", "left").drop("_key")
