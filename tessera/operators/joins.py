"""Joins beyond a plain equality, each as equi-joins so that nothing is compared with everything."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_either(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_key: str, how: str = "inner") -> DataFrame:
    """left.k1 = right.key OR left.k2 = right.key OR ...: a row for each pair, once."""
    keyed = left.withColumn("_key", F.explode(F.array_distinct(F.array_compact(F.array(*left_keys)))))
    return keyed.join(right, keyed["_key"] == right[right_key], how).drop("_key")


def longest_prefix(df: DataFrame, text: str, names: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Each row with the longest name that its text equals or begins with, before a space; null without one.

    The text's own prefixes are joined, so the work grows with words, not with the number of names.
    """
    words = F.split(F.col(text), " ")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: F.array_join(F.slice(words, 1, n), " "))
    found = df.select(*keys, F.explode(prefixes).alias("_prefix")).join(names.select(F.col(name).alias("_prefix")).distinct(), "_prefix")
    best = found.groupBy(*keys).agg(F.max_by("_prefix", F.length("_prefix")).alias(name))
    return df.join(best, list(keys), "left")


def reconcile(expected: DataFrame, actual: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Every key of either side with outcome matched, missing, extra or mismatched; null equals null."""
    e = expected.select(*keys, F.struct(*values).alias("expected"))
    a = actual.select(*keys, F.struct(*values).alias("actual"))
    both = e.join(a, list(keys), "full_outer")
    outcome = (
        F.when(F.col("actual").isNull(), "missing")
        .when(F.col("expected").isNull(), "extra")
        .when(F.col("expected").eqNullSafe(F.col("actual")), "matched")
        .otherwise("mismatched")
    )
    return both.select(*keys, outcome.alias("outcome"), "expected", "actual")


def missing(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    return expected.join(actual.select(*keys), list(keys), "left_anti")


def attach_single(df: DataFrame, candidates: DataFrame, group: str, identity: Sequence[str]) -> DataFrame:
    """Enrichment rows of a group: all of them if the group has one row here, else those with the same, complete identity."""
    # counted with partial sums and joined back, so that Spark can split a group of very many rows
    counted = df.join(df.groupBy(group).agg(F.count(F.lit(1)).alias("_rows")), group)
    single = counted.filter("_rows = 1").drop("_rows").join(candidates.drop(*identity), group)
    several = counted.filter("_rows > 1").drop("_rows").join(candidates, [group, *identity])
    return single.unionByName(several)


def shared_requests(df: DataFrame, request: Sequence[str], member: str) -> DataFrame:
    """One row for each distinct request, and how many members share it; members join back by its key."""
    key = F.sha2(F.to_json(F.struct(*request), {"ignoreNullFields": "false"}), 256)
    return df.withColumn("request_key", key).groupBy("request_key", *request).agg(F.count_distinct(member).alias("members"))

