"""Aggregate expressions in which unknown stays null and never becomes 0."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GOOD_COVERAGE = 0.8
WILSON_Z = 1.959963984540054


def known_share(value: Column) -> Column:
    return F.try_divide(F.count(value), F.count(F.lit(1)))


def share(condition: Column, among: Column | None = None) -> Column:
    """Of the rows where `among` isn't null (all rows without it), the part where the condition holds; null of none."""
    total = F.count(F.lit(1)) if among is None else F.count(among)
    return F.try_divide(F.count_if(condition), total)


def weighted_mean(value: Column, weight: Column) -> Column:
    used = value.isNotNull() & (weight > 0)
    return F.try_divide(F.sum(F.when(used, value * weight)), F.sum(F.when(used, weight)))


def sorted_distinct(value: Column) -> Column:
    """The different values in order: evidence for people, for groups of few values."""
    return F.array_sort(F.collect_set(value))


def complete_sum(value: Column) -> Column:
    """The sum if every row is known, else null."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value))


def single_value(df: DataFrame, keys: Sequence[str], value: str, also: Mapping[str, Column] | None = None) -> DataFrame:
    """The one distinct value of each key that is 0 or more; null with quality missing or conflicting otherwise.

    Lowest and highest suffice to tell one from several, so no set is gathered.
    """
    usable = F.when(F.col(value) >= 0, F.col(value))
    low, high = F.min(usable), F.max(usable)
    return df.groupBy(*keys).agg(
        F.when(low == high, low).alias(value),
        F.when(low.isNull(), "missing").when(low == high, "reported").otherwise("conflicting").alias(f"{value}_quality"),
        *(c.alias(n) for n, c in (also or {}).items()),
    )


def least_known(*parts: Column) -> Column:
    """The least of the parts, null if any is null (`least` alone would skip it)."""
    known = F.lit(True)
    for p in parts:
        known = known & p.isNotNull()
    return F.when(known, F.least(*parts) if len(parts) > 1 else parts[0])


def evidence_value(numerator: Column, denominator: Column, factor: float = 1.0) -> Column:
    return F.when(numerator.isNotNull() & (denominator > 0), numerator * F.lit(factor) / denominator)


def evidence_band(value: Column, coverage: Column, source: Column) -> Column:
    return (
        F.when(value.isNotNull() & (coverage >= GOOD_COVERAGE), "good")
        .when(value.isNotNull(), "warning")
        .when(source.startswith("incompatible") | source.startswith("no_"), "incompatible")
        .otherwise("insufficient")
    )


def comparison_band(coverage: Column) -> Column:
    return F.when(coverage >= GOOD_COVERAGE, "good").when(coverage > 0, "warning").otherwise("insufficient")


def wilson_lower(positive: Column, total: Column, least: int = 10) -> Column:
    """Lower end of the 95 % interval of a share; null of fewer than `least` trials."""
    n, z2 = total.cast("double"), WILSON_Z**2
    p = positive / n
    centre = p + z2 / (2 * n)
    margin = WILSON_Z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))
    return F.when(total >= least, (centre - margin) / (1 + z2 / n))


def dedupe_sum(df: DataFrame, keys: Sequence[str], identity: Sequence[str], newest: Sequence[Column], value: str) -> DataFrame:
    """Sum over each key of the newest revision of each identity."""
    from tessera.operators.latest import latest

    return latest(df, [*keys, *identity], newest).groupBy(*keys).agg(F.sum(value).alias(value))


def day_coverage(df: DataFrame, keys: Sequence[str], day: str, dimension: str, unit: str) -> DataFrame:
    """How complete the daily rows of each key and month are: days, dimensions a day, one unit; overall the least.

    The dimensions of a day are measured against the month's richest day.
    """
    month = F.trunc(F.col(day), "month")
    by_day = df.groupBy(*keys, month.alias("month"), F.to_date(day).alias("_day")).agg(F.count_distinct(dimension).alias("_dims"), F.min(unit).alias("_u0"), F.max(unit).alias("_u1"))
    days = F.count(F.lit(1)).cast("bigint")
    expected = F.day(F.last_day(F.first("month"))).cast("bigint")
    parts = by_day.groupBy(*keys, "month").agg(
        days.alias("observed_days"),
        expected.alias("expected_days"),
        (days / expected).alias("day_coverage"),
        (F.sum("_dims") / F.max("_dims") / days).alias("dimension_coverage"),
        F.when(F.min("_u0") == F.max("_u1"), 1.0).otherwise(0.0).alias("unit_coverage"),
    )
    return parts.withColumn("overall", F.least("day_coverage", "dimension_coverage", "unit_coverage"))


def table_digest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and a digest of the rows whatever their order, in bounded memory.

    The digest sums four 60-bit pieces of each row's SHA-256, so repeated rows count and partial sums combine.
    """
    row = F.sha2(F.to_json(F.struct(*(F.col(c).cast("string").alias(c) for c in columns)), {"ignoreNullFields": "false"}), 256)
    pieces = [F.sum(F.conv(F.substring("_row", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")) for i in range(4)]
    total = F.concat_ws("-", *(F.coalesce(p, F.lit(0).cast("decimal(30,0)")).cast("string") for p in pieces))
    return df.select(row.alias("_row")).agg(F.count(F.lit(1)).alias("n_rows"), F.sha2(total, 256).alias("digest"))
