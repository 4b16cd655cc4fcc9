"""Mixing sources to target weights, in DataFrame operations only.

Words are counted per source, targets are the weight shares of all words, held at `cap` times what a
source has (the excess goes to the others by weight), and each document is taken floor(rate) times plus
once more if a hash of its id falls below the rate's fraction.

Defined results: a null text has size 0; the null source is a source of its own, last in order; an empty
table gives an empty result; equal ids draw the same number, so repeated rows are taken alike; columns of
the input are kept, and one named as a result column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import share, written

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_size, target, rate) from rows (source, size); one row per source.

    Levels: with sources sorted by cap * size / weight, those before the first level that fits stop at
    their cap, and the rest share what is left by weight.  The windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("place", place).withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")))
    most = F.col("source_size") * F.lit(cap)
    every = Window.partitionBy()
    order = Window.orderBy(most / F.col("weight"), "place")
    per = (
        per.withColumn("total", F.sum("source_size").over(every))
        .withColumn("stopped", F.coalesce(F.sum(most).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open", F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("stopped")) / F.col("open"))
    )
    fits = F.when(F.col("level") * F.col("weight") <= most, F.struct(most / F.col("weight"), "place", "level"))
    per = per.withColumn("level", F.coalesce(F.min(fits).over(every)["level"], F.lit(0.0)))
    target = F.least(most.cast("double"), F.col("level") * F.col("weight"))
    rate = F.coalesce(F.try_divide(target, F.col("source_size").cast("double")), F.lit(0.0))
    return per.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def mixing_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """One row per input row: id, size, source_size, target, rate, copies, taken (words, repeats counted)."""
    sizes = written(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")), "sizes")
    return _copies(sizes, written(source_targets(sizes, weights, cap), "rates"), seed).select(F.col("id").alias(id_col), "size", "source_size", "target", "rate", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def _copies(rows: DataFrame, rates: DataFrame, seed: str) -> DataFrame:
    """Rows with their source's rate and copies.  The rates are a small file: Spark broadcasts it if its size is under the session's limit."""
    r = rates.withColumnRenamed("source", "rate_source")
    extra = F.when(share(F.coalesce(F.col("id").cast("string"), F.lit("")), seed) < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return rows.join(r, rows["source"].eqNullSafe(r["rate_source"])).drop("rate_source").withColumn("copies", (F.floor("rate") + extra).cast("long"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """The mix itself: every document `copies` times, with the copy's number from 1 in mix_copy."""
    kept = [c for c in docs.columns if c != "mix_copy"]
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.struct(*kept).alias("row"))
    sizes = docs.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    out = _copies(rows, written(source_targets(sizes, weights, cap), "rates"), seed).filter("copies > 0")
    return out.select("row.*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("mix_copy"))
