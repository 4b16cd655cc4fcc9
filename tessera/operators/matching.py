"""Entity resolution: candidate pairs by blocking, scored features, a decision ladder, and merging that never
joins what some decision keeps apart.

Records have: key (unique string), source_id, record_id, name_key, phone, addresses, units, buildings (arrays
of strings), lon, lat, pension (boolean).  Nulls and empty arrays match nothing.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.geo import haversine_m
from tessera.functions.text import indel_similarity
from tessera.operators.graph import connected_components, cut_lineage
from tessera.operators.latest import latest

NEAR_M, NEAR_NAME = 30, 0.80
LON_STEP = NEAR_M / (111_000 * math.cos(math.radians(39)))  # at least 30 m anywhere within 33..39 N
LAT_STEP = NEAR_M / 111_000
SPLIT_BLOCK = 64
LARGE_BLOCK = 10_000
IN_TASK = 100_000  # decisions of a component that one task may merge in order


def _pairs_sharing(records: DataFrame, value: Column) -> DataFrame:
    """Pairs with a value in common.  Each side of a large block is dealt into parts, so that no task holds it whole."""
    keyed = records.select("key", value.alias("v")).filter("v IS NOT NULL").distinct()
    return _dealt_pairs(keyed, keyed)


def _dealt_pairs(keyed: DataFrame, others: DataFrame) -> DataFrame:
    """Pairs (left_key < right_key) with equal v of two tables (key, v)."""
    part = F.pmod(F.xxhash64("key"), F.lit(SPLIT_BLOCK))
    # counted with partial sums and joined back, so that no task gathers a large block to count it
    blocks = keyed.groupBy("v").agg((F.count(F.lit(1)) > LARGE_BLOCK).alias("large"))
    dealt, others = keyed.join(blocks, "v"), others.join(blocks, "v")
    left = dealt.select(F.col("key").alias("left_key"), "v", F.when(F.col("large"), part).otherwise(F.lit(0).cast("bigint")).alias("p"))
    zero, last = F.lit(0).cast("bigint"), F.lit(SPLIT_BLOCK - 1).cast("bigint")
    right = others.select(F.col("key").alias("right_key"), "v", F.explode(F.when(F.col("large"), F.sequence(zero, last)).otherwise(F.array(zero))).alias("p"))
    return left.join(right, ["v", "p"]).filter("left_key < right_key").select("left_key", "right_key")


def _near_pairs(records: DataFrame) -> DataFrame:
    """Pairs in the same or a neighbouring cell of at least 30 m: one side in its cell, the other in all nine."""
    placed = records.filter("lon BETWEEN 124 AND 132 AND lat BETWEEN 33 AND 39").select("key", F.floor(F.col("lon") / LON_STEP).alias("x"), F.floor(F.col("lat") / LAT_STEP).alias("y"))
    around = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    spread = placed.withColumn("d", F.explode(around)).select("key", F.struct((F.col("x") + F.col("d.i")).alias("x"), (F.col("y") + F.col("d.j")).alias("y")).alias("v"))
    return _dealt_pairs(placed.select("key", F.struct("x", "y").alias("v")), spread)


def candidate_pairs(records: DataFrame, adjudicated: DataFrame | None = None) -> DataFrame:
    """Every pair that can be a candidate, once: equal record id, shared building or address, or near by."""
    found = _pairs_sharing(records, F.col("record_id"))
    for column in ("buildings", "addresses"):
        found = found.unionByName(_pairs_sharing(records, F.explode(column)))
    found = found.unionByName(_near_pairs(records))
    if adjudicated is not None:
        found = found.unionByName(adjudicated.select(F.least("left_key", "right_key").alias("left_key"), F.greatest("left_key", "right_key").alias("right_key")))
    return found.distinct()


def features(pairs: DataFrame, records: DataFrame) -> DataFrame:
    side = lambda name: records.select(F.col("key").alias(f"{name}_key"), F.struct(*(c for c in records.columns if c != "key")).alias(name))
    df = pairs.join(side("left"), "left_key").join(side("right"), "right_key")
    both = lambda c: (F.col(f"left.{c}"), F.col(f"right.{c}"))
    known = lambda c: F.coalesce(c, F.lit(False))
    equal = lambda c: known(both(c)[0] == both(c)[1])
    shared = lambda c: known(F.arrays_overlap(*both(c)))
    differ = known(F.col("left.phone") != F.col("right.phone"))
    identified = F.coalesce(*both("name_key"), *both("phone")).isNotNull()
    df = df.withColumns(
        {
            "record_match": equal("record_id"),
            "official_identity": equal("record_id") & equal("source_id"),
            "building_match": shared("buildings"),
            "address_match": shared("addresses"),
            "unit_match": shared("units"),
            "distance_m": haversine_m(F.col("left.lon"), F.col("left.lat"), F.col("right.lon"), F.col("right.lat")),
            "phones_match": equal("phone"),
            "phone_missing": F.col("left.phone").isNull() != F.col("right.phone").isNull(),
            "phones_conflict": differ,
            "identified": identified,
            "pension": known(F.col("left.pension")) | known(F.col("right.pension")),
            "similarity": indel_similarity(*both("name_key")),
        }
    )
    near = known((F.col("distance_m") <= NEAR_M) & (F.col("similarity") >= NEAR_NAME))
    return df.withColumn("is_candidate", F.col("record_match") | F.col("building_match") | (F.col("address_match") & F.col("identified")) | near).drop("left", "right")


def decide(scored: DataFrame) -> DataFrame:
    """Adds decision: designation_link, auto_merge, separate or review, by the first rule that holds."""
    c = F.col
    rules = [
        (c("pension") & (c("record_match") | (c("building_match") & (c("similarity") >= 0.90))), "designation_link"),
        (c("official_identity"), "auto_merge"),
        (c("building_match") & c("phones_match") & (c("similarity") >= 0.90), "auto_merge"),
        (c("address_match") & (c("similarity") >= 0.94) & (c("phones_match") | c("unit_match")), "auto_merge"),
        (c("address_match") & ~c("identified"), "review"),
        (c("phones_conflict") & (c("similarity") < 0.75), "separate"),
        (c("is_candidate"), "review"),
    ]
    ladder = F.lit("separate")
    for condition, label in reversed(rules):
        ladder = F.when(condition, label).otherwise(ladder)
    return scored.withColumn("decision", ladder)


def latest_rulings(rulings: DataFrame, newest: list[Column]) -> DataFrame:
    """One ruling a pair, in key order whichever way it was written: the first by `newest`."""
    low, high = F.least("left_key", "right_key"), F.greatest("left_key", "right_key")
    return latest(rulings.withColumns({"_l": low, "_r": high}).drop("left_key", "right_key").withColumnsRenamed({"_l": "left_key", "_r": "right_key"}), ["left_key", "right_key"], newest)


def adjudicate(decided: DataFrame, rulings: DataFrame | None = None, calibrated: bool = False) -> DataFrame:
    """A ruling (left_key, right_key, ruling: merge or separate) replaces the decision; otherwise an uncalibrated auto_merge is for review."""
    own = F.when((F.col("decision") == "auto_merge") & F.lit(not calibrated), "review").otherwise(F.col("decision"))
    if rulings is None:
        return decided.withColumn("decision", own)
    ruled = F.when(F.col("ruling") == "merge", "auto_merge").otherwise(F.col("ruling"))
    return decided.join(rulings, ["left_key", "right_key"], "left").withColumn("decision", F.coalesce(ruled, own)).drop("ruling")


def merge_in_order(rows: pd.DataFrame) -> pd.DataFrame:
    """auto_merge pairs of one candidate component, in key order: a pair is blocked while any other decision spans its two groups."""
    group: dict[str, set[str]] = {k: {k} for c in ("left_key", "right_key") for k in rows[c]}
    apart: dict[str, set[str]] = {k: set() for k in group}
    for r in rows.itertuples():
        if r.decision in ("review", "separate") or r.phones_conflict:
            apart[r.left_key].add(r.right_key)
            apart[r.right_key].add(r.left_key)
    blocked = []
    for r in rows[rows.decision == "auto_merge"].sort_values(["left_key", "right_key"]).itertuples():
        a, b = group[r.left_key], group[r.right_key]
        if a is b:
            continue
        if any(apart[k] & b for k in a):
            blocked.append((r.left_key, r.right_key))
            continue
        a |= b
        for k in b:
            group[k] = a
    out = [("member", k, min(group[k])) for k in sorted(group)] + [("blocked", a, b) for a, b in blocked]
    return pd.DataFrame(out, columns=["kind", "key", "other"])


def merge_in_rounds(edges: DataFrame, apart: DataFrame, rounds: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """`merge_in_order` for components of any size: (node, group) and the blocked edges, in rounds over edges (left_key, right_key).

    apart: pairs (left_key, right_key) that some decision keeps apart.  Each group looks at its first undecided edge:

    * a group that nothing keeps apart from anything joins along it: no later growth of the other side can block it;
    * an edge is blocked if it is the first of either end and the two groups are kept apart, for groups only grow;
    * an edge that is the first of both ends joins two groups that nothing keeps apart.

    All of these give what the edges give in key order, so they are taken at once; then edges and pairs are renamed by group, and
    edges inside a group go.  Groups that nothing keeps apart at least halve in number each round; the others go on
    as their edges' order lets them.
    """
    spark = edges.sparkSession
    live = edges.select(F.col("left_key").alias("a"), F.col("right_key").alias("b"), "left_key", "right_key").filter("a <> b").distinct()
    nodes = cut_lineage(spark, live.select(F.col("a").alias("node")).union(live.select("b")).distinct().withColumn("group", F.col("node")))
    live = cut_lineage(spark, live)
    conflicts = apart.select(F.col("left_key").alias("a"), F.col("right_key").alias("b"))
    conflicts = cut_lineage(spark, conflicts.union(conflicts.select("b", "a")).filter("a <> b").distinct())
    blocked = live.filter("false").select("left_key", "right_key")
    for _ in range(rounds):
        if live.isEmpty():
            break
        ends = live.union(live.select("b", "a", "left_key", "right_key"))
        first = ends.groupBy(F.col("a").alias("g")).agg(F.min(F.struct("left_key", "right_key", F.col("b").alias("o"))).alias("e")).select("g", "e.*")
        first = first.join(conflicts.select(F.col("a").alias("g")).distinct().withColumn("bound", F.lit(True)), "g", "left")
        first = first.join(conflicts.select(F.col("a").alias("g"), F.col("b").alias("o"), F.lit(True).alias("spans")), ["g", "o"], "left")
        first = cut_lineage(spark, first.select("g", "o", "left_key", "right_key", F.col("bound").isNotNull().alias("bound"), F.col("spans").isNotNull().alias("spans")))
        stopped = first.filter("spans").select("left_key", "right_key").distinct()
        both = first.join(first.select(F.col("g").alias("o"), F.col("o").alias("g"), "left_key", "right_key"), ["g", "o", "left_key", "right_key"], "left_semi")
        joins = first.filter("NOT bound").select("g", "o").union(both.filter("NOT spans").select("g", "o"))
        renamed = connected_components(joins, "g", "o").select(F.col("node").alias("was"), F.col("component").alias("now"))

        def named(df: DataFrame, column: str, renamed: DataFrame = renamed) -> DataFrame:
            return df.join(renamed.withColumnRenamed("was", column), column, "left").withColumn(column, F.coalesce("now", column)).drop("now")

        nodes = cut_lineage(spark, named(nodes, "group"))
        live = live.join(stopped, ["left_key", "right_key"], "left_anti")
        live = cut_lineage(spark, named(named(live, "a"), "b").filter("a <> b").select("a", "b", "left_key", "right_key"))
        conflicts = cut_lineage(spark, named(named(conflicts, "a"), "b").select("a", "b").distinct())
        blocked = cut_lineage(spark, blocked.union(stopped))
    else:
        raise RuntimeError(f"edges were left after {rounds} rounds")
    return nodes.select("node", "group"), blocked


def merged(records: DataFrame, decided: DataFrame, in_task: int = IN_TASK) -> tuple[DataFrame, DataFrame]:
    """(key, facility) of every record, and the blocked merges (left_key, right_key).

    Where no decision of another kind lies inside a component of merges, all of it is one facility, whatever its size.
    Components with such a decision are merged in order: those of at most `in_task` decisions each in one task, larger ones in rounds over
    all tasks, with the same result.
    """
    spark = decided.sparkSession
    merges = decided.filter("decision = 'auto_merge'").select("left_key", "right_key")
    parts = cut_lineage(spark, connected_components(merges, "left_key", "right_key"))
    side = lambda name: parts.select(F.col("node").alias(f"{name}_key"), F.col("component").alias(f"{name}_part"))
    inside = decided.join(side("left"), "left_key").join(side("right"), "right_key").filter("left_part = right_part")
    inside = cut_lineage(spark, inside.select(F.col("left_part").alias("part"), "left_key", "right_key", "decision", "phones_conflict"))
    apart = F.col("decision").isin("review", "separate") | F.coalesce("phones_conflict", F.lit(False))
    torn = cut_lineage(spark, inside.groupBy("part").agg(F.bool_or(apart).alias("torn"), (F.count(F.lit(1)) > in_task).alias("large")).filter("torn").select("part", "large"))
    out = inside.join(torn.filter("NOT large"), "part", "left_semi").groupBy("part").applyInPandas(merge_in_order, "kind string, key string, other string")
    whole = parts.join(torn.withColumnRenamed("part", "component"), "component", "left_anti").select(F.col("node").alias("key"), F.col("component").alias("facility"))
    found = whole.unionByName(out.filter("kind = 'member'").select("key", F.col("other").alias("facility")))
    blocked = out.filter("kind = 'blocked'").select(F.col("key").alias("left_key"), F.col("other").alias("right_key"))
    large = torn.filter("large")
    if not large.isEmpty():
        of_large = inside.join(large, "part", "left_semi")
        groups, stopped = merge_in_rounds(of_large.filter("decision = 'auto_merge'"), of_large.filter(apart))
        least = groups.groupBy("group").agg(F.min("node").alias("facility"))
        found = found.unionByName(groups.join(least, "group").select(F.col("node").alias("key"), "facility"))
        blocked = blocked.unionByName(stopped)
    facility = records.select("key").join(found, "key", "left").withColumn("facility", F.coalesce("facility", "key"))
    return facility, blocked


def attach_designations(decided: DataFrame, facility: DataFrame, pensions: DataFrame) -> DataFrame:
    """Each designation (key) with its one facility; otherwise null with reason unmatched or ambiguous."""
    links = decided.filter("decision = 'designation_link'")
    ends = links.select(F.col("left_key").alias("key"), F.col("right_key").alias("target")).unionByName(links.select(F.col("right_key").alias("key"), F.col("left_key").alias("target")))
    targets = ends.join(pensions.select("key"), "key").join(pensions.select(F.col("key").alias("target")), "target", "left_anti").join(facility.select(F.col("key").alias("target"), "facility"), "target")
    found = targets.groupBy("key").agg(F.min("facility").alias("low"), F.max("facility").alias("high"))
    joined = pensions.select("key").join(found, "key", "left")
    return joined.select(
        "key",
        F.when(F.col("low") == F.col("high"), F.col("low")).alias("facility"),
        F.when(F.col("low").isNull(), "unmatched").when(F.col("low") != F.col("high"), "ambiguous").alias("reason"),
    )


def review_rows(decided: DataFrame, facility: DataFrame, blocked: DataFrame) -> DataFrame:
    """What people have to look at: reviews and blocked merges whose ends are different facilities."""
    reviews = decided.filter("decision = 'review'").select("left_key", "right_key", F.lit("review").alias("reason"))
    rows = reviews.unionByName(blocked.withColumn("reason", F.lit("blocked_merge")))
    for side in ("left", "right"):
        rows = rows.join(facility.select(F.col("key").alias(f"{side}_key"), F.col("facility").alias(f"{side}_facility")), f"{side}_key")
    return rows.filter("left_facility <> right_facility").dropDuplicates(["left_key", "right_key"])


def merge_quality(labelled: DataFrame) -> DataFrame:
    """Of pairs (decision, expected): how often auto_merge was right, with its lower bound."""
    from tessera.operators.aggregates import wilson_lower

    positive = F.col("decision") == "auto_merge"
    counted = labelled.agg(F.count_if(positive).alias("predicted"), F.count_if(positive & (F.col("expected") == "auto_merge")).alias("correct"))
    return counted.withColumns({"precision": F.try_divide("correct", "predicted"), "lower_bound": wilson_lower(F.col("correct"), F.col("predicted"))})
