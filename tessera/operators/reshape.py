"""Wide rows to long facts, with their dimensions as a map and stable keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.parsing import dimension_hash, number, observation_key


def measures(df: DataFrame, keep: Sequence[str], columns: Sequence[str], name: str = "metric_code", value: str = "metric_value") -> DataFrame:
    """A row for each measure that isn't null."""
    return df.unpivot(list(keep), list(columns), name, value).filter(F.col(value).isNotNull())


def pattern_measures(df: DataFrame, keep: Sequence[str], pattern: str, name: str, value: str) -> DataFrame:
    """Measures of the columns whose names match, such as hours or months; name is the pattern's first group."""
    import re

    found = [(c, m) for c in df.columns if (m := re.fullmatch(pattern, c))]
    if not found:
        return df.select(*keep, F.lit(None).cast("string").alias(name), F.lit(None).cast("double").alias(value)).limit(0)
    pairs = F.array(*(F.struct(F.lit(m[1] if m.groups() else c).alias(name), number(F.col(f"`{c}`").cast("string")).alias(value)) for c, m in found))
    return df.select(*keep, F.explode(pairs).alias("_m")).select(*keep, "_m.*").filter(F.col(value).isNotNull())


def dimensions(df: DataFrame, used: Sequence[str]) -> Column:
    """The columns not used otherwise as a map; nulls are left out."""
    rest = [c for c in df.columns if c not in used]
    if not rest:
        return F.create_map().cast("map<string,string>")
    return F.map_filter(F.create_map(*(x for c in rest for x in (F.lit(c), F.col(f"`{c}`").cast("string")))), lambda _, v: v.isNotNull())


def facts(df: DataFrame, source: Column, metric: Column, period: Column, district: Column, value: Column, unit: Column, dims: Column, revision: Column) -> DataFrame:
    """Long facts with dimension hash and observation key."""
    shaped = df.select(
        source.alias("source_id"), metric.alias("metric_code"), period.alias("period"), district.alias("district"),
        value.alias("metric_value"), unit.alias("unit"), dims.alias("dimensions"), revision.alias("source_revision"),
    )
    keyed = shaped.withColumn("dimension_hash", dimension_hash(F.col("dimensions")))
    return keyed.withColumn("observation_key", observation_key(*(F.col(c) for c in ("source_id", "metric_code", "period", "district", "dimension_hash", "source_revision"))))


def mapped_or(df: DataFrame, key: str, mapping: DataFrame, value: str, otherwise: str) -> DataFrame:
    """A dictionary lookup whose misses are named, not dropped."""
    return df.join(mapping.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit(otherwise)))
