"""Digest of a table in the order of its keys, as a tree over chunks of rows, which also tells where two tables first differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.graph import cut_lineage

CHUNK = 64  # rows of a chunk, and nodes under a node


def typed(column: Column, kind: T.DataType) -> Column:
    """A value as text from which value and type can be told: n, b, i, f, m (decimal), d, t, x (binary) or s with its length in bytes.

    -0.0 counts as 0.0; NaN and infinities have no digest and fail the job; arrays and structs are written part by part.
    """
    if isinstance(kind, T.ArrayType):
        text = F.concat(F.lit("a"), F.size(column).cast("string"), F.lit("["), F.array_join(F.transform(column, lambda x: typed(x, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, T.StructType):
        text = F.concat(F.lit("r["), F.concat_ws(",", *[typed(column[f.name], f.dataType) for f in kind.fields]), F.lit("]"))
    elif isinstance(kind, T.BooleanType):
        text = F.when(column, "b1").otherwise("b0")
    elif isinstance(kind, T.IntegralType):
        text = F.concat(F.lit("i"), column.cast("string"))
    elif isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        finite = ~F.isnan(column) & (F.abs(column) < float("inf"))
        text = F.when(finite, F.concat(F.lit("f"), (column + F.lit(0.0)).cast("double").cast("string"))).otherwise(F.raise_error(F.lit("a value that is not finite has no digest")).cast("string"))
    elif isinstance(kind, T.BinaryType):
        text = F.concat(F.lit("x"), F.lower(F.hex(column)))
    else:
        mark = {T.DecimalType: "m", T.DateType: "d", T.TimestampType: "t", T.TimestampNTZType: "t", T.StringType: "s"}.get(type(kind))
        if mark is None:
            raise TypeError(f"no digest for {kind.simpleString()}")
        said = column.cast("string")
        text = F.concat(F.lit(mark), F.octet_length(said).cast("string"), F.lit(":"), said) if mark == "s" else F.concat(F.lit(mark), said)
    return F.when(column.isNull(), "n").otherwise(text)


def positions(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(position, digest): each row's place in the order of the keys (nulls first, then by content), from 0, and the digest of its columns by name.

    Rows are dealt by ranges of the keys and sorted there; a row's place is its place in its range and the rows of the ranges before, of
    which there is one count each.  The ranges are kept, so that a lost executor can't shift them.
    """
    row = F.sha2(F.concat_ws(",", *[F.concat(F.lit(f"{f.name}="), typed(F.col(f"`{f.name}`"), f.dataType)) for f in sorted(df.schema.fields, key=lambda f: f.name)]), 256)
    order = [F.col(f"`{k}`").asc_nulls_first() for k in keys]
    rows = df.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], row.alias("digest"))
    order = [F.col(f"_k{i}").asc_nulls_first() for i in range(len(keys))] + [F.col("digest").asc()]
    ranged = cut_lineage(df.sparkSession, rows.repartitionByRange(*order).sortWithinPartitions(*order).select("digest"))
    numbered = ranged.withColumn("_id", F.monotonically_increasing_id())
    numbered = numbered.select("digest", F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_place"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    counts = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return numbered.join(counts.select("_part", "_before"), "_part").select((F.col("_before") + F.col("_place")).alias("position"), "digest")


def digest_tree(df: DataFrame, keys: Sequence[str], chunk: int = CHUNK) -> DataFrame:
    """(level, node, n_rows, digest): level 0 has a node for each `chunk` rows in order, each level above one for each `chunk` nodes, the last one node.

    No group has more than `chunk` digests.  An empty table has no nodes.
    """
    spark = df.sparkSession

    def grouped(rows: DataFrame, level: int) -> DataFrame:
        inside = F.array_sort(F.collect_list(F.struct("position", "digest")))
        out = rows.groupBy(F.floor(F.col("position") / chunk).alias("node")).agg(F.sum("n_rows").alias("n_rows"), inside.alias("_in"))
        return out.select(F.lit(level).alias("level"), "node", "n_rows", F.sha2(F.array_join(F.col("_in.digest"), ","), 256).alias("digest"))

    level = cut_lineage(spark, grouped(positions(df, keys).withColumn("n_rows", F.lit(1).cast("bigint")), 0))
    tree, n, number = level, level.count(), 0
    while n > 1:
        number += 1
        level = cut_lineage(spark, grouped(level.withColumnRenamed("node", "position").select("position", "digest", "n_rows"), number))
        tree, n = tree.unionByName(level), -(-n // chunk)
    return tree


def first_difference(one: DataFrame, other: DataFrame, chunk: int = CHUNK) -> int | None:
    """The first chunk of rows (level 0) in which two trees differ, or None; from the top down, a node's children at a time."""
    tops = [t.agg(F.max("level")).first()[0] for t in (one, other)]
    if None in tops:
        return None if tops[0] == tops[1] else 0
    node = None
    for level in range(min(tops), -1, -1):
        side = lambda t, name, level=level, node=node: t.filter((F.col("level") == level) & (F.lit(True) if node is None else F.col("node").between(node * chunk, node * chunk + chunk - 1))).select("node", F.col("digest").alias(name))
        found = side(one, "a").join(side(other, "b"), "node", "full_outer").filter("NOT (a <=> b)").agg(F.min("node")).first()[0]
        if found is None:
            return None
        node = found
    return node
