"""Facility, district, group and signal marts as plans over facility and fact tables.

Facilities have: facility_id, district, region_group, registrations, rooms (null: unknown), tourism (boolean),
foreigner, foreign_capable (registrations), age (years, null: unknown), recent_permit (null: unknown).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.aggregates import comparison_band, complete_sum, evidence_band, evidence_value, known_share, least_known, share, weighted_mean
from tessera.operators.quantiles import with_quantiles

SMALL_ROOMS, YOUNGER, OLDER = 20, 20, 30


YEAR_DAYS, RECENT_DAYS = 365.2425, 5 * 365


def building_age(facilities: DataFrame, buildings: DataFrame, key: str = "facility_id") -> DataFrame:
    """(key, age, recent_permit, age_quality) of every facility, from its buildings (key, approved_on, permit_on, observed_on).

    The age needs one distinct approval date and counts to the newest observation.  Of a facility with an age, permits
    count from that day too, else from each building's own.  No permit is False; a facility without buildings is
    missing, with both unknown.
    """
    low, high, seen = F.min("approved_on"), F.max("approved_on"), F.max("observed_on")
    aged = F.coalesce(low == high, F.lit(False))
    own = F.coalesce(F.bool_or(F.datediff("observed_on", "permit_on").between(0, RECENT_DAYS)), F.lit(False))
    # permits are within the range that ends at the newest observation if any lies there: kept as days, a bounded set a facility
    days = F.collect_set("permit_on")
    found = buildings.groupBy(key).agg(low.alias("_low"), aged.alias("_aged"), seen.alias("_seen"), own.alias("_own"), days.alias("_days"))
    recent = F.when(F.col("_aged"), F.exists("_days", lambda d: F.datediff(F.col("_seen"), d).between(0, RECENT_DAYS))).otherwise(F.col("_own"))
    joined = facilities.select(key).distinct().join(found, key, "left")
    return joined.select(
        key,
        F.when(F.col("_aged"), F.greatest(F.lit(0.0), F.datediff("_seen", "_low") / F.lit(YEAR_DAYS))).alias("age"),
        F.when(F.col("_aged").isNotNull(), recent).alias("recent_permit"),
        F.when(F.col("_aged").isNull(), "missing").when(F.col("_aged"), "reported").when(F.col("_low").isNull(), "missing_use_approval").otherwise("ambiguous").alias("age_quality"),
    )


def past_building_measures(buildings: DataFrame, rooms: DataFrame, keys: Sequence[str], key: str = "facility_id", younger: int = YOUNGER, older: int = OLDER) -> DataFrame:
    """Building measures of a past month by `keys`, from buildings (keys, key, approved_on, permit_on, observed_on) and rooms (key, rooms).

    Unlike the current mart these need exactly one building a facility, and a permit is known only where the age is.
    """
    one = buildings.groupBy(*keys, key).agg(F.count(F.lit(1)).alias("_n"), *(F.max(c).alias(c) for c in ("approved_on", "permit_on", "observed_on"))).filter("_n = 1")
    known = one.filter("approved_on IS NOT NULL AND observed_on IS NOT NULL")
    recent = F.coalesce(F.datediff("observed_on", "permit_on").between(0, RECENT_DAYS), F.lit(False))
    aged = known.select(*keys, key, F.greatest(F.lit(0.0), F.datediff("observed_on", "approved_on") / F.lit(YEAR_DAYS)).alias("age"), recent.alias("recent"))
    n, age = F.count(F.lit(1)), F.col("age")
    measured = aged.join(rooms.select(key, "rooms"), key, "left").groupBy(*keys).agg(
        n.alias("age_known"), F.avg(age).alias("age_mean"), weighted_mean(age, F.col("rooms")).alias("age_by_rooms"),
        F.count_if(age >= younger).alias("age20_count"), F.count_if(age >= older).alias("age30_count"), share(age >= younger).alias("age20_share"), share(age >= older).alias("age30_share"),
        n.alias("permit_known"), F.count_if("recent").alias("permit_count"), share(F.col("recent")).alias("permit_share"),
    )
    return with_quantiles(measured, aged, keys, {"age_median": ("age", 0.5)})


def stock_measures(small: int = SMALL_ROOMS, younger: int = YOUNGER, older: int = OLDER) -> list[Column]:
    """The measures of a group of facilities but for quantiles; what isn't known is null, a true zero is 0."""
    rooms, age, tourism = F.col("rooms"), F.col("age"), F.col("tourism")
    tourist_rooms = F.when(F.count_if(tourism) == 0, 0.0).when(F.count_if(tourism & rooms.isNull()) == 0, F.sum(F.when(tourism, rooms)).cast("double"))
    return [
        F.count(F.lit(1)).alias("facilities"),
        F.sum("registrations").cast("bigint").alias("registrations"),
        F.count(rooms).alias("rooms_known"),
        known_share(rooms).alias("room_coverage"),
        F.sum(rooms).cast("double").alias("room_sum"),
        F.avg(rooms).alias("room_mean"),
        share(rooms <= small, rooms).alias("small_share"),
        F.count_if(tourism).alias("tourism_facilities"),
        share(tourism).alias("tourism_share"),
        tourist_rooms.alias("tourism_rooms"),
        F.try_divide(tourist_rooms, F.nullif(F.sum(rooms).cast("double"), F.lit(0.0))).alias("tourism_room_share"),
        F.coalesce(F.try_divide(F.count(F.when(tourism, rooms)), F.count_if(tourism)), F.lit(1.0)).alias("tourism_room_coverage"),
        F.try_divide(F.sum("foreigner"), F.sum("registrations")).alias("foreigner_share"),
        F.try_divide(F.sum("foreign_capable"), F.sum("registrations")).alias("foreign_capable_share"),
        F.avg(age).alias("age_mean"),
        weighted_mean(age, rooms).alias("age_by_rooms"),
        share(age >= younger, age).alias("age20_share"),
        share(age >= older, age).alias("age30_share"),
        F.count(age).alias("age_known"),
        share(F.col("recent_permit"), F.col("recent_permit")).alias("permit_share"),
    ]


STOCK_QUANTILES = {"room_median": ("rooms", 0.5), "room_q1": ("rooms", 0.25), "room_q3": ("rooms", 0.75), "age_median": ("age", 0.5)}


def measured_stock(facilities: DataFrame, keys: Sequence[str], also: Sequence[Column] = ()) -> DataFrame:
    """All measures of the stock by keys."""
    return with_quantiles(facilities.groupBy(*keys).agg(*stock_measures(), *also), facilities, keys, STOCK_QUANTILES)


def district_marts(facilities: DataFrame, universe: DataFrame, observed: DataFrame | None = None) -> DataFrame:
    """Measures of every district of the universe (district, region_group).

    An observed district without facilities has counts and sums of 0; one never observed has nulls and stock_observed false.
    Without `observed`, all are.
    """
    measured = measured_stock(facilities, ["district"])
    seen = F.lit(True)
    base = universe
    if observed is not None:
        base = universe.join(observed.select("district", F.lit(True).alias("_seen")).distinct(), "district", "left")
        seen = F.coalesce("_seen", F.lit(False))
    out = base.join(measured, "district", "left").withColumn("stock_observed", seen | F.col("facilities").isNotNull())
    zero = ("facilities", "registrations", "rooms_known", "room_sum", "tourism_facilities", "tourism_rooms", "age_known")
    empty = F.col("stock_observed") & F.col("facilities").isNull()
    return out.withColumns({c: F.when(empty, F.lit(0).cast(out.schema[c].dataType)).otherwise(F.col(c)) for c in zero}).drop("_seen")


def period_shares(records: DataFrame, keys: Sequence[str] = ("district",)) -> DataFrame:
    """The shares of a past month by keys, from its records (keys, facility_id, source_id, record_id).

    Unlike the current mart these count facilities over registrations, so a facility of both kinds counts twice.
    """
    per = records.groupBy(*keys, "facility_id").agg(
        F.count_distinct("source_id", "record_id").alias("registrations"),
        F.bool_or(F.col("source_id") == "tourist_accommodations").alias("tourism"),
        F.bool_or(F.col("source_id") == "foreigner_city_homestays").alias("foreigner"),
    )
    n = F.sum("registrations")
    return per.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("facilities"),
        n.alias("registrations"),
        share(F.col("tourism")).alias("tourism_share"),
        F.try_divide(F.count_if("foreigner"), n).alias("foreigner_share"),
        F.try_divide(F.count_if("foreigner") + F.count_if("tourism"), n).alias("foreign_capable_share"),
    )


def group_marts(district_months: DataFrame, facilities: DataFrame, members: DataFrame) -> DataFrame:
    """Groups of districts: sums only if every member is present and observed, medians of the pooled facilities."""
    due = members.groupBy("region_group").agg(F.count_distinct("district").alias("n_due"))
    sums = district_months.groupBy("region_group").agg(
        F.count_distinct(F.when(F.col("stock_observed"), F.col("district"))).alias("n_present"),
        *(complete_sum(F.col(c)).alias(c) for c in ("facilities", "room_sum")),
        F.min("room_coverage").alias("room_coverage"),
    )
    pooled = with_quantiles(facilities.groupBy("region_group").agg(F.avg("rooms").alias("room_mean")), facilities, ["region_group"], {"room_median": ("rooms", 0.5)})
    out = due.join(sums, "region_group", "left").join(pooled, "region_group", "left")
    whole = F.coalesce(F.col("n_present") == F.col("n_due"), F.lit(False))
    return out.withColumns({c: F.when(whole, F.col(c)) for c in ("facilities", "room_sum", "room_mean", "room_median")}).withColumn("complete", whole)


def comparisons(groups: DataFrame, left: str, right: str, metrics: Sequence[str], coverage: str = "room_coverage") -> DataFrame:
    """Difference and ratio of two groups for each metric, with the lesser coverage's band."""
    picked = groups.filter(F.col("region_group").isin(left, right))
    side = lambda m, g: F.max(F.when(F.col("region_group") == g, F.col(m).cast("double")))
    cols = [x for i, m in enumerate(metrics) for x in (side(m, left).alias(f"l{i}"), side(m, right).alias(f"r{i}"))]
    one = picked.agg(*cols, F.when(F.count(coverage) == 2, F.min(coverage)).alias("coverage"))
    rows = []
    for i, m in enumerate(metrics):
        a, b = F.col(f"l{i}"), F.col(f"r{i}")
        for kind, v in (("difference", a - b), ("ratio", F.when(b > 0, a / b))):
            band = F.when(v.isNull(), "insufficient").otherwise(comparison_band(F.col("coverage")))
            rows.append(F.struct(F.lit(m).alias("metric"), F.lit(kind).alias("kind"), v.alias("value"), a.alias("left_value"), b.alias("right_value"), F.col("coverage"), band.alias("quality")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def metric_evidence(df: DataFrame, keys: Sequence[str], specs: Sequence[tuple[str, Column, Column, float, Column, Column]]) -> DataFrame:
    """A row for each key and metric (name, numerator, denominator, factor, coverage, source label)."""
    rows = []
    for name, top, bottom, factor, coverage, source in specs:
        value = evidence_value(top.cast("double"), bottom.cast("double"), factor)
        rows.append(
            F.struct(
                F.lit(name).alias("metric"), value.alias("value"), top.cast("double").alias("numerator"), bottom.cast("double").alias("denominator"),
                coverage.cast("double").alias("coverage"), evidence_band(value, coverage, source).alias("quality"),
            )
        )
    return df.select(*keys, F.explode(F.array(*rows)).alias("e")).select(*keys, "e.*")


def evidence_counts(small: int = SMALL_ROOMS, younger: int = YOUNGER, older: int = OLDER) -> list[Column]:
    """Counts that only the evidence gives, beside `stock_measures`."""
    return [
        F.count_if(F.col("rooms") <= small).alias("small"), F.sum("foreigner").alias("foreigner"), F.sum("foreign_capable").alias("foreign_capable"), F.count_if(F.col("age") >= younger).alias("age20_count"), F.count_if(F.col("age") >= older).alias("age30_count"),
        F.count("recent_permit").alias("permit_known"), F.count_if("recent_permit").alias("permit_count"),
    ]


def district_evidence_specs(flows: dict[str, tuple[Column, Column, Column]]) -> list[tuple[str, Column, Column, float, Column, Column]]:
    """The 14 metrics of a district and month for `metric_evidence`, over `stock_measures` and `evidence_counts`.

    flows: (numerator, its coverage, source) of the three metrics that come from facts.  Rates over rooms need every room
    count, and their coverage is the least of both sides, unknown if either is.
    """
    c = F.col
    whole, one = F.when(c("rooms_known") == c("facilities"), c("room_sum")), F.lit(1.0)
    stock, ages, permits = F.lit("inventory"), c("age_known") / c("facilities"), c("permit_known") / c("facilities")

    def flow(name: str, factor: float) -> tuple[str, Column, Column, float, Column, Column]:
        top, coverage, source = flows[name]
        return name, top, whole, factor, least_known(coverage, c("room_coverage")), source

    return [
        ("physical_facility_count", c("facilities"), one, 1.0, one, stock),
        ("room_coverage", c("rooms_known"), c("facilities"), 1.0, c("room_coverage"), stock),
        ("small_facility_share", c("small"), c("rooms_known"), 1.0, c("room_coverage"), stock),
        flow("visitor_person_days_per_100_rooms", 100.0),
        flow("lodging_consumption_per_room", 1.0),
        flow("transport_inflow_per_room", 1.0),
        ("tourism_registration_facility_share", c("tourism_facilities"), c("facilities"), 1.0, one, stock),
        ("tourism_registration_room_share", c("tourism_rooms"), whole, 1.0, least_known(c("room_coverage"), c("tourism_room_coverage")), stock),
        ("foreigner_city_homestay_registration_share", c("foreigner"), c("registrations"), 1.0, one, stock),
        ("foreign_visitor_capable_registration_share", c("foreign_capable"), c("registrations"), 1.0, one, stock),
        ("building_20y_share", c("age20_count"), c("age_known"), 1.0, ages, F.lit("building_register")),
        ("building_30y_share", c("age30_count"), c("age_known"), 1.0, ages, F.lit("building_register")),
        ("recent_five_year_permit_event_share", c("permit_count"), c("permit_known"), 1.0, permits, F.lit("building_register")),
        ("visitor_growth_minus_room_supply_growth", F.lit(None), F.lit(None), 1.0, F.lit(None).cast("double"), F.lit("missing_consecutive_comparable_period")),
    ]


def event_counts(records: DataFrame, day: str, keys: Sequence[str]) -> DataFrame:
    """Distinct facilities' events (openings or closures) by key and month; pensions don't count."""
    kept = records.filter(~F.coalesce(F.col("pension"), F.lit(False)) & F.col(day).isNotNull())
    return kept.groupBy(*keys, F.trunc(day, "month").alias("month")).agg(F.count_distinct("facility_id", day).alias("n_events"))


# Fixed values of the policy rules: what each needs, and when it is triggered.
RULES = {
    "RENOVATION_SUPPORT": (("room_median", "small_share", "age30_share"), "room_median <= 20 AND small_share >= 0.5 AND age30_share >= 0.5"),
    "SUPPLY_EXPANSION_REVIEW": (("pressure_band", "stock_band"), "pressure_band = 'high' AND stock_band = 'low'"),
    "OLD_LOW_DEMAND_REPOSITIONING": (("age30_share", "pressure_band"), "age30_share >= 0.5 AND pressure_band = 'low'"),
    "DEMAND_GROWTH_LOW_TOURISM_CAPACITY": (("growth_gap", "tourism_room_share"), "growth_gap > 0 AND tourism_room_share < 0.3"),
    "CLOSURE_DOMINANT_MARKET_STABILIZATION": (("openings", "closures"), "closures > openings AND closures > 0"),
}


def policy_signals(df: DataFrame, keys: Sequence[str], coverage: dict[str, Column] | None = None) -> DataFrame:
    """A row for each key and rule: triggered, not_triggered, or unavailable.

    A rule is unavailable where a metric is null or unclassified or, if given, its evidence coverage is under 0.8 or unknown.
    """
    rows = []
    for rule, (needs, test) in RULES.items():
        known = F.lit(True)
        for m in needs:
            known = known & F.col(m).isNotNull() & (F.col(m).cast("string") != "unclassified")
            if coverage and m in coverage:
                known = known & F.coalesce(coverage[m] >= 0.8, F.lit(False))
        status = F.when(~known, "unavailable").when(F.expr(test), "triggered").otherwise("not_triggered")
        rows.append(F.struct(F.lit(rule).alias("rule"), status.alias("status")))
    return df.select(*keys, F.explode(F.array(*rows)).alias("r")).select(*keys, "r.*")


APPROVED = ("PUBLISHED", "PUBLISHED_WITH_WARNINGS")


def visible_runs(lineage: DataFrame, runs: DataFrame, run_id: str, published: str | None = None, most_depth: int = 100) -> DataFrame:
    """The audited inputs (run) of a run, itself included; an error if its lineage can't be trusted.

    lineage: (run_id, input_run_id); runs: (run_id, status, business_date, rebuildable).  Every run that is reached must
    list itself; inputs must be rebuildable, published (or running while they are the current publication) and not
    dated after the run; no run may reach itself by way of others.
    """
    edges = lineage.select(F.col("run_id").alias("parent"), F.col("input_run_id").alias("run")).distinct()
    target = runs.filter(F.col("run_id") == run_id).select("rebuildable", "business_date").first()
    if target is not None and target.rebuildable is not True:
        raise ValueError(f"run {run_id} can't be rebuilt")
    # all simple steps from the run on, level by level; a level is small, for it holds runs and not rows of data
    level = edges.filter((F.col("parent") == run_id) & (F.col("run") != run_id)).select("run", F.array("parent", "run").alias("path"))
    reached = edges.filter(F.col("parent") == run_id).limit(1).select(F.lit(run_id).alias("run"))
    for _ in range(most_depth):
        if level.isEmpty():
            break
        reached = reached.unionByName(level.select("run")).distinct()
        onward = level.join(edges.filter("parent <> run").select(F.col("parent").alias("run"), F.col("run").alias("next")), "run")
        if not onward.filter(F.array_contains("path", F.col("next"))).isEmpty():
            raise ValueError(f"the lineage of {run_id} has a cycle")
        level = onward.select(F.col("next").alias("run"), F.concat("path", F.array("next")).alias("path")).dropDuplicates(["run"])
    else:
        raise ValueError(f"the lineage of {run_id} is deeper than {most_depth}")
    alone = reached.join(edges.filter("parent = run").select("run"), "run", "left_anti")
    if reached.isEmpty() or not alone.isEmpty():
        raise ValueError(f"the lineage of {run_id} lacks a run's own membership")
    approved = F.col("status").isin(*APPROVED) | ((F.col("status") == "RUNNING") & (F.col("run") == F.lit(published)))
    dated = F.col("business_date") <= F.lit(None if target is None else target.business_date).cast("date")
    good = F.coalesce(F.col("rebuildable") & approved & dated, F.lit(False))
    told = reached.filter(F.col("run") != run_id).join(runs.withColumnRenamed("run_id", "run"), "run", "left")
    if not told.filter(~good).isEmpty():
        raise ValueError(f"the lineage of {run_id} has an unapproved, undated or later run")
    return edges.filter(F.col("parent") == run_id).select("run")


def district_periods(districts: DataFrame, dated: Sequence[tuple[DataFrame, str]], texts: Sequence[tuple[DataFrame, str]] = ()) -> DataFrame:
    """(district, period) of every month in which a district has a fact or an event, and `current` for each.

    dated: tables with district and a date; texts: with district and a period as text, of which the month counts.
    """
    parts = [districts.select("district", F.lit("current").alias("period"))]
    parts += [df.filter(F.col(day).isNotNull()).select("district", F.date_format(day, "yyyy-MM").alias("period")) for df, day in dated]
    parts += [df.filter(F.col(text).isNotNull()).select("district", F.substring(text, 1, 7).alias("period")) for df, text in texts]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p.join(districts.select("district"), "district", "left_semi").distinct())
    return found.distinct()


def month_spine(df: DataFrame, first: str, last: str, keys: DataFrame, month: str = "month") -> DataFrame:
    """Every key and month of a range, with the rows there are: what has none is pending."""
    months = keys.withColumn(month, F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("INTERVAL 1 MONTH"))))
    return months.join(df, [*keys.columns, month], "left")


def group_band(df: DataFrame, keys: Sequence[str], band: str) -> DataFrame:
    """The districts' common band, else unclassified."""
    return df.groupBy(*keys).agg(F.when((F.min(band) == F.max(band)) & (F.count(band) == F.count(F.lit(1))), F.min(band)).otherwise("unclassified").alias(band))

