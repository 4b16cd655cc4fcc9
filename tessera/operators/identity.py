"""Canonical ids of facilities as their components of registrations merge and split from run to run.

Components are settled in the order of their least keys.  A component's candidates are the earlier ids of its keys, each followed
along the aliases.  An id is open to the first component that has it as a candidate, for that component either keeps it or turns it into an alias.
Of its open ids a component keeps the least that is anchored in it, else the least; without any it gets an id made from its least key,
or, where an earlier component kept that very id, one made from all its keys.  Every other candidate becomes an alias of what was kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.parsing import name_uuid
from tessera.operators.graph import connected_components, cut_lineage

NAMESPACE_URL = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"  # fixed value: the URL namespace of RFC 4122


def _followed(to: DataFrame) -> DataFrame:
    """(node, next) with next the end of each chain, by doubling; there must be no circle."""
    to = cut_lineage(to.sparkSession, to)
    while True:
        onward = to.join(to.select(F.col("node").alias("next"), F.col("next").alias("far")), "next", "left")
        further = cut_lineage(to.sparkSession, onward.select("node", F.coalesce("far", "next").alias("next"), F.col("far").isNotNull().alias("moved")))
        to = further.select("node", "next")
        if further.filter("moved").isEmpty():
            return to


def alias_ends(aliases: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(node, next): the id that each alias (alias, canonical_id) stands for in the end; the aliases themselves as (node, next); and those in circles.

    A member of a circle of aliases stands for itself, and a chain into a circle for the member where it enters.
    Of several targets of one alias the least counts.
    """
    to = aliases.filter("alias IS NOT NULL AND canonical_id IS NOT NULL").groupBy(F.col("alias").alias("node")).agg(F.min("canonical_id").alias("next")).filter("node <> next")
    steps = to = cut_lineage(to.sparkSession, to)
    parts = connected_components(to, "node", "next")
    ends = to.select("next").distinct().join(to.select(F.col("node").alias("next")), "next", "left_anti")
    ended = parts.join(ends.withColumnRenamed("next", "node"), "node", "left_semi").select("component").distinct()
    turning = cut_lineage(to.sparkSession, to.join(parts.join(ended, "component", "left_anti").select("node"), "node", "left_semi"))
    n = turning.count()
    circles = turning
    if n:  # after as many steps as there are aliases every pointer is on a circle, and all of the circle is pointed at
        jump = turning
        for _ in range(n.bit_length()):
            jump = cut_lineage(to.sparkSession, jump.join(jump.select(F.col("node").alias("next"), F.col("next").alias("far")), "next").select("node", F.col("far").alias("next")))
        circles = turning.join(jump.select(F.col("next").alias("node")).distinct(), "node", "left_semi")
        to = to.join(circles.select("node"), "node", "left_anti")
    return _followed(to), steps, circles


class _Cluster:
    """Components that share ids, one after the other; `stands` holds only ids of the cluster."""

    def __init__(self) -> None:
        self.stands: dict[str, str] = {}
        self.given: set[str] = set()
        self.aliased: set[str] = set()

    def end(self, x: str) -> str:
        seen = set()
        while x in self.stands and x not in seen:
            seen.add(x)
            x = self.stands[x]
        return x

    def settle(self, facility: str, candidates: list[tuple[str, list]], kept: str | None, made: str, split: str) -> list[tuple]:
        """candidates: (id, ids anchored here).  Rows (facility, id, origin, alias): what was kept, then its new aliases."""
        had = {self.end(x) for x, _ in candidates}
        origin = "kept"
        if kept is None:
            own = {x for _, anchored in candidates for x in anchored}
            free = sorted(had - self.given, key=lambda x: (x not in own, x))
            origin = "kept" if free else "split" if made in self.given else "new"
            kept = free[0] if free else split if origin == "split" else made
        out = [(facility, kept, origin, None)]
        self.given.add(kept)
        for loser in sorted(had - {kept}):
            self.stands[loser] = kept
            if loser not in self.aliased:  # the first alias of an id is the one on record
                self.aliased.add(loser)
                out.append((facility, kept, origin, loser))
        return out


def _settled_in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (cluster, place, facility, id, to, anchored, kept, made, split), sorted: first aliases (id, to) without a place, then candidates by component."""
    cluster, at, state, own = None, None, _Cluster(), []

    def settle(out: list) -> None:
        if at is not None:
            out.extend(state.settle(at[1], own, *at[2:]))

    def frame(out: list) -> pd.DataFrame:
        return pd.DataFrame(out, columns=["facility", "canonical_id", "origin", "alias"])

    for batch in batches:
        out: list = []
        for part, place, facility, ident, to, anchored, kept, made, split in batch[["cluster", "place", "facility", "id", "to", "anchored", "kept", "made", "split"]].itertuples(index=False):
            if part != cluster or at is not None and place != at[0]:
                settle(out)
                at, own = None, []
                if part != cluster:
                    cluster, state = part, _Cluster()
            if place is None:
                state.stands[ident] = to
                continue
            at = (place, facility, kept, made, split)
            if ident is not None:
                own.append((ident, list(anchored)))
        yield frame(out)
    out = []
    settle(out)
    yield frame(out)


def surviving_ids(facility: DataFrame, previous: DataFrame, anchors: DataFrame, aliases: DataFrame, rounds: int = 1_000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(facility, canonical_id, origin: kept, new or split), new aliases (alias, canonical_id) and new anchors (canonical_id, key).

    facility: (key, facility), each key once; previous: (key, canonical_id) of the run before; anchors: (canonical_id, key).

    Which ids are open follows from the first component of each id, one aggregate.  Only an id that a component makes from its key may also be an
    earlier id; such claims are proposed by all components at once and taken into account until they no longer change, which
    settles at least one more component a round and mostly takes two.  Where ids are shared, their aliases follow in a
    stream over each cluster of components that share ids, in which only the ids of the cluster are kept.  In a cluster with a circle of aliases, or in
    which a component makes an id that is an alias already, what a candidate stands for depends on all components before; there the stream gives the ids too.
    """
    spark = facility.sparkSession
    keyed = facility.select("key", "facility").filter("key IS NOT NULL")
    firsts = cut_lineage(spark, keyed.groupBy("facility").agg(F.min("key").alias("first")))
    ends, steps, circles = alias_ends(aliases)
    had = previous.filter("canonical_id IS NOT NULL").select("key", F.col("canonical_id").alias("node")).join(ends, "node", "left").select("key", "node", F.coalesce("next", "node").alias("id"))
    of = cut_lineage(spark, had.join(keyed, "key").select("facility", "node", "id").distinct())
    anchored = anchors.select("key", F.col("canonical_id").alias("id")).join(keyed, "key").select("facility", "id").distinct()
    candidates = of.select("facility", "id").distinct().join(firsts, "facility").join(anchored.withColumn("anchored", F.lit(True)), ["facility", "id"], "left")
    candidates = cut_lineage(spark, candidates.select("facility", "first", "id", F.coalesce("anchored", F.lit(False)).alias("anchored")))
    sharing = candidates.groupBy("id").agg(F.min("first").alias("opened"), F.count(F.lit(1)).alias("n"))
    open_ids = cut_lineage(spark, candidates.join(sharing, "id").filter("first = opened").drop("opened", "n"))
    made = cut_lineage(spark, firsts.withColumn("made", name_uuid(NAMESPACE_URL, F.concat(F.lit("facility:"), F.col("first")))))
    claims = open_ids.select("id", F.col("first").alias("by")).filter("false")
    for _ in range(rounds):
        free = open_ids.join(claims, "id", "left").filter("by IS NULL OR by >= first")
        kept = free.groupBy("facility", "first").agg(F.min(F.struct((~F.col("anchored")).alias("other"), "id"))["id"].alias("kept"))
        without = made.join(kept.select("facility"), "facility", "left_anti")
        taken = kept.select(F.col("kept").alias("made"), F.col("first").alias("taken_by"))
        without = without.join(taken, "made", "left").groupBy("facility", "first", "made").agg(F.coalesce(F.bool_or(F.col("taken_by") < F.col("first")), F.lit(False)).alias("split"))
        kept, without = cut_lineage(spark, kept), cut_lineage(spark, without)
        claimed = cut_lineage(spark, without.filter("NOT split").select(F.col("made").alias("id"), F.col("first").alias("by")).join(candidates.select("id").distinct(), "id", "left_semi"))
        if claimed.exceptAll(claims).unionAll(claims.exceptAll(claimed)).isEmpty():
            break
        claims = claimed
    else:
        raise RuntimeError(f"claims still changed after {rounds} rounds")
    ids = kept.select("facility", F.col("kept").alias("canonical_id"), F.lit("kept").alias("origin")).unionByName(without.select("facility", F.col("made").alias("canonical_id"), F.when(F.col("split"), "split").otherwise("new").alias("origin")))

    # clusters of components (f) and ids (i): by shared candidates, by made ids that are known, and along the aliases that play a part
    known = of.select("id").union(of.select("node")).union(steps.select("node")).union(steps.select("next")).distinct()
    node = lambda kind, c: F.concat(F.lit(kind), F.col(c))
    of_made = made.join(known.withColumnRenamed("id", "made"), "made", "left_semi")
    edges = (
        of.select(node("f", "facility").alias("a"), node("i", "node").alias("b"))
        .unionByName(of_made.select(node("f", "facility").alias("a"), node("i", "made").alias("b")))
        .unionByName(steps.select(node("i", "node").alias("a"), node("i", "next").alias("b")))
    )
    parts = cut_lineage(spark, connected_components(edges, "a", "b").select("node", F.col("component").alias("cluster")))
    part_of = lambda kind, name: parts.filter(F.col("node").startswith(kind)).select(F.expr("substring(node, 2)").alias(name), "cluster")
    odd = without.filter("NOT split").join(steps.select(F.col("node").alias("made")), "made", "left_semi").join(part_of("f", "facility"), "facility").select("cluster")
    odd = cut_lineage(spark, odd.unionByName(circles.join(part_of("i", "node"), "node").select("cluster")).distinct().withColumn("odd", F.lit(True)))
    shared = sharing.filter("n > 1").join(part_of("i", "id"), "id").select("cluster").unionByName(odd.select("cluster")).distinct()
    inside = part_of("f", "facility").join(shared, "cluster", "left_semi").join(odd, "cluster", "left").join(made, "facility")
    own = anchored.groupBy("facility").agg(F.collect_set("id").alias("anchored"))
    # an id made from all keys is wanted for components that share ids only
    split = keyed.join(inside.select("facility"), "facility", "left_semi").groupBy("facility").agg(F.concat_ws("|", F.array_sort(F.collect_list("key"))).alias("keys"))
    split = cut_lineage(spark, split.select("facility", name_uuid(NAMESPACE_URL, F.concat(F.lit("facility-split:"), F.col("keys"))).alias("split_id")))
    ids = ids.join(split, "facility", "left").withColumn("canonical_id", F.when(F.col("origin") == "split", F.col("split_id")).otherwise(F.col("canonical_id"))).drop("split_id")
    ids = cut_lineage(spark, ids)
    inside = inside.join(split, "facility").join(ids.select("facility", "canonical_id"), "facility").join(own, "facility", "left").join(of.select("facility", F.col("node").alias("id")), "facility", "left")
    none = F.lit(None).cast("string")
    no_ids = F.array().cast("array<string>")
    given = F.when(F.col("odd").isNull(), F.col("canonical_id"))
    rows = inside.select("cluster", F.col("first").alias("place"), "facility", "id", none.alias("to"), F.coalesce("anchored", no_ids).alias("anchored"), given.alias("kept"), "made", F.col("split_id").alias("split"))
    stood = steps.join(part_of("i", "node"), "node").join(shared, "cluster", "left_semi")
    stood = stood.select("cluster", none.alias("place"), none.alias("facility"), F.col("node").alias("id"), F.col("next").alias("to"), no_ids.alias("anchored"), none.alias("kept"), none.alias("made"), none.alias("split"))
    # by an expression of its own: Spark leaves out a repartition that a union's sides seem to have already, and may then change the sides
    streamed = rows.unionByName(stood).repartition(F.concat(F.lit("c"), "cluster")).sortWithinPartitions("cluster", "place", "id")
    settled = cut_lineage(spark, streamed.mapInPandas(_settled_in_order, "facility string, canonical_id string, origin string, alias string"))
    decided = settled.filter("alias IS NULL").join(part_of("f", "facility").join(odd, "cluster", "left_semi").select("facility"), "facility", "left_semi").select("facility", "canonical_id", "origin")
    ids = cut_lineage(spark, ids.join(decided.select("facility"), "facility", "left_anti").unionByName(decided))
    alone = candidates.join(settled.select("facility").distinct(), "facility", "left_anti").join(ids.select("facility", "canonical_id"), "facility").filter("id <> canonical_id").select(F.col("id").alias("alias"), "canonical_id")
    new_aliases = alone.unionByName(settled.filter("alias IS NOT NULL").select("alias", "canonical_id")).join(aliases.select("alias"), "alias", "left_anti")
    new_anchors = ids.join(anchors.select("canonical_id"), "canonical_id", "left_anti").join(firsts, "facility").select("canonical_id", F.col("first").alias("key"))
    return ids, new_aliases, new_anchors
