"""The spatial marts: a point for each facility or a reason why not, and the month of each grid cell with its evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.parsing import close, is_finite
from tessera.operators.spatial import age_rating, composite, context_rating, rating_points, resolve_points, room_rating

LEAST_COVERAGE, LEAST_FACILITIES = 0.8, 3
SMALL_ROOMS, TINY_ROOMS, YOUNGER, OLDER = 20, 10, 20, 30


def facility_points(facilities: DataFrame, registrations: DataFrame, cells: DataFrame, pending: DataFrame | None = None, boundary: DataFrame | None = None) -> DataFrame:
    """Each facility (facility_id, name, district, n_buildings) with its point and cell, or an exception code.

    registrations: (facility_id, source_identity, coordinate_crs, longitude, latitude, projected_x, projected_y);
    cells: (grid_id, district).  A facility needs exactly one distinct accepted point; of equal ones the least
    source identity is named.  A facility without a name is not published, whatever its points.  boundary: the city's polygons (name, rings in
    degrees), outside of which a point is not accepted.  `display` is review_required with a pending duplicate (pending: facility_id) or more
    than one building, else public.
    """
    placed = resolve_points(registrations, boundary)
    fine = F.col("exception_code").isNull()
    spot = F.when(fine, F.struct("x", "y"))
    per = placed.groupBy("facility_id").agg(
        F.count_distinct(spot).alias("n_points"),
        F.min_by(F.struct("x", "y", "lon_wgs", "lat_wgs", "grid_id", "source_identity"), F.when(fine, F.col("source_identity"))).alias("p"),
        F.count_distinct("exception_code").alias("n_codes"),
        F.min("exception_code").alias("code"),
        F.array_sort(F.collect_set("source_identity")).alias("source_identities"),
    )
    known = facilities.join(per, "facility_id", "left").select("*", F.col("p.grid_id").alias("grid_id")).join(cells.select("grid_id", F.col("district").alias("cell_district")), "grid_id", "left")
    code = (
        F.when(F.coalesce(F.trim("name"), F.lit("")) == "", "MISSING_PUBLIC_NAME")
        .when(F.col("n_points").isNull(), "SELECTED_REVISION_UNAVAILABLE")
        .when(F.col("n_points") > 1, "AMBIGUOUS_COORDINATES")
        .when((F.col("n_points") == 0) & (F.col("n_codes") == 1), F.col("code"))
        .when(F.col("n_points") == 0, "UNMAPPED_COORDINATES")
        .when(F.col("cell_district").isNull(), "GRID_NOT_FOUND")
        .when(~F.coalesce(F.col("district") == F.col("cell_district"), F.lit(False)), "DISTRICT_COORDINATE_MISMATCH")
    )
    known = known.withColumn("exception", code)
    if pending is not None:
        known = known.join(pending.select("facility_id", F.lit(True).alias("_pending")).distinct(), "facility_id", "left")
    review = F.coalesce(F.col("n_buildings") > 1, F.lit(False)) | (F.coalesce("_pending", F.lit(False)) if pending is not None else F.lit(False))
    shown = lambda c: F.when(F.col("exception").isNull(), c)
    return known.select(
        "facility_id", "district", shown(F.col("grid_id")).alias("grid_id"), *(shown(F.col(f"p.{c}")).alias(c) for c in ("x", "y", "source_identity")),
        "source_identities", F.col("exception").alias("exception_code"), shown(F.when(review, "review_required").otherwise("public")).alias("display"),
    )


def grid_month(cells: DataFrame, facilities: DataFrame, snapshots: DataFrame, period: str) -> DataFrame:
    """The month of every cell (grid_id, district_code, district, dong_code, dong_name).

    facilities: mapped ones (grid_id, district, rooms, age, registrations); snapshots: a row for each district
    (district, observed, total_facilities, demand_band, supply_band).  Nothing is known of a district without an
    observed stock; an observed cell without facilities has zeros.  Under LEAST_COVERAGE of mapped facilities in the
    district nothing is graded; a cell with a score but fewer than LEAST_FACILITIES is a small_sample.
    """
    r, a = F.col("rooms"), F.col("age")
    per = facilities.groupBy("grid_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("registrations").cast("bigint").alias("legal"), F.count(r).alias("rk"), F.count(a).alias("ak"), F.sum(r).cast("double").alias("rs"),
        F.count_if(r <= SMALL_ROOMS).alias("small"), F.count_if(r <= TINY_ROOMS).alias("tiny"), F.count_if(a >= YOUNGER).alias("a20"), F.count_if(a >= OLDER).alias("a30"), F.median(r).alias("rm"), F.median(a).alias("am"),
        F.array_sort(F.collect_list(a)).alias("ages"),
    )
    mapped = facilities.groupBy("district").agg(F.count(F.lit(1)).alias("district_mapped"))
    base = cells.join(snapshots, "district", "left").join(mapped, "district", "left").join(per, "grid_id", "left")
    c = F.col
    seen = F.coalesce(c("observed") & c("total_facilities").isNotNull(), F.lit(False))
    base = base.withColumn("stock_observed", seen).withColumn("district_mapped", F.coalesce("district_mapped", F.lit(0)))
    if_seen = lambda v: F.when(c("stock_observed"), v)
    zero = lambda name: F.coalesce(name, F.lit(0))
    some = c("mapped_facilities") > 0
    base = base.withColumns({"mapped_facilities": if_seen(zero("n")), "legal_registrations": if_seen(zero("legal")), "coordinate_sample": if_seen(c("district_mapped")), "coordinate_coverage": if_seen(F.when(c("total_facilities") == 0, 1.0).otherwise(c("district_mapped") / c("total_facilities")))})
    known = lambda name: F.when(some & (zero(name) == 0), None).otherwise(if_seen(zero(name)))
    cover = lambda name: F.when(some, zero(name) / c("mapped_facilities")).when(c("mapped_facilities") == 0, 1.0)
    base = base.withColumns({"rooms_known": known("rk"), "age_known": known("ak"), "room_coverage": cover("rk"), "age_coverage": cover("ak"), "room_sum": F.when(zero("rk") > 0, if_seen(c("rs"))).when(c("mapped_facilities") == 0, 0.0)})
    counted = lambda name, of: F.when(c(of).isNotNull(), zero(name))
    base = base.withColumns({"small_count": counted("small", "rooms_known"), "tiny_count": counted("tiny", "rooms_known"), "age20_count": counted("a20", "age_known"), "age30_count": counted("a30", "age_known")})
    part = lambda top, bottom: F.try_divide(c(top), F.nullif(c(bottom), F.lit(0)))
    whole = lambda name: some & (c(name) == c("mapped_facilities"))
    base = base.withColumns({
        "small_share": part("small_count", "rooms_known"), "age20_share": part("age20_count", "age_known"), "age30_share": part("age30_count", "age_known"),
        "small_band": F.when(F.coalesce(whole("rooms_known"), F.lit(False)), room_rating(c("rm"))).otherwise("unavailable"),
        "age_band": F.when(F.coalesce(whole("age_known"), F.lit(False)), age_rating(c("am"))).otherwise("unavailable"),
        "context_band": F.when(F.coalesce(some, F.lit(False)), context_rating(c("demand_band"), c("supply_band"))).otherwise("unavailable"),
    })
    graded = F.coalesce(c("coordinate_coverage") >= LEAST_COVERAGE, F.lit(False))
    rating = composite(c("small_band"), c("age_band"), c("context_band"))
    base = base.withColumn("_c", rating).withColumn("score", F.when(graded, c("_c.score")))
    grade = F.when(~graded, "insufficient_evidence").when(c("score").isNotNull() & (c("mapped_facilities") < LEAST_FACILITIES), "small_sample").otherwise(c("_c.grade"))
    points = {f"{n}_points": F.when(graded, rating_points(c(f"{n}_band"))) for n in ("small", "age", "context")}
    status = F.when(~c("stock_observed"), "unobserved").when(c("total_facilities") == 0, "complete_empty").otherwise("observed")
    return base.withColumns({"grade": grade, "period": F.lit(period), "stock_status": status, "room_median": c("rm"), "age_median": c("am"), "ordered_ages": F.when(c("age_known").isNotNull(), F.coalesce("ages", F.array().cast("array<double>")))} | points).select(
        "grid_id", "district_code", "district", "dong_code", "dong_name", "period", "stock_status", "total_facilities", "mapped_facilities", "legal_registrations", "room_sum", "rooms_known", "room_coverage", "room_median", "small_count", "tiny_count", "small_share",
        "age_known", "age_coverage", "age_median", "ordered_ages", "age20_count", "age20_share", "age30_count", "age30_share", "coordinate_sample", "coordinate_coverage", "context_band", "context_points", "small_band", "small_points", "age_band", "age_points", "score", "grade",
    )


def grid_evidence(months: DataFrame) -> DataFrame:
    """22 rows for each cell and month: the metric's value (or label), numerator, denominator, coverage and quality."""
    c = F.col
    seen = c("stock_status") != "unobserved"
    guard = F.coalesce(c("coordinate_coverage") >= LEAST_COVERAGE, F.lit(False))

    def quality(coverage: Column, available: Column) -> Column:
        return F.when(~seen, "insufficient_evidence").when(c("stock_status") == "complete_empty", "complete_empty").when(~F.coalesce(available, F.lit(False)), "insufficient_evidence").when(coverage == 1.0, "good").otherwise("warning")

    room, age, where = quality(c("room_coverage"), c("rooms_known") > 0), quality(c("age_coverage"), c("age_known") > 0), quality(c("coordinate_coverage"), guard)
    count = lambda v: quality(c("coordinate_coverage"), c(v).isNotNull())
    part = F.when(~seen, "insufficient_evidence").when(c("stock_status") == "complete_empty", "complete_empty").when(guard, "good").otherwise("insufficient_evidence")
    graded = lambda points: F.when(c(points).isNotNull(), part).otherwise("insufficient_evidence")
    none, two, six = F.lit(None), F.lit(2), F.lit(6)
    rows = [  # metric, numerator, denominator, coverage, value, label, quality
        ("physical_facility_count", c("mapped_facilities"), c("total_facilities"), "coordinate", c("mapped_facilities"), none, count("mapped_facilities")),
        ("legal_registration_count", c("legal_registrations"), c("mapped_facilities"), "coordinate", c("legal_registrations"), none, count("legal_registrations")),
        ("room_sum", c("room_sum"), c("mapped_facilities"), "room", c("room_sum"), none, room),
        ("room_coverage", c("rooms_known"), c("mapped_facilities"), "room", c("room_coverage"), none, room),
        ("small_facility_count", c("small_count"), c("rooms_known"), "room", c("small_count"), none, room),
        ("small_facility_share", c("small_count"), c("rooms_known"), "room", c("small_share"), none, room),
        ("age_sample_size", c("age_known"), c("mapped_facilities"), "age", c("age_known"), none, age),
        ("age_coverage", c("age_known"), c("mapped_facilities"), "age", c("age_coverage"), none, age),
        ("age_20y_facility_count", c("age20_count"), c("age_known"), "age", c("age20_count"), none, age),
        ("age_20y_share", c("age20_count"), c("age_known"), "age", c("age20_share"), none, age),
        ("age_30y_facility_count", c("age30_count"), c("age_known"), "age", c("age30_count"), none, age),
        ("age_30y_share", c("age30_count"), c("age_known"), "age", c("age30_share"), none, age),
        ("coordinate_sample_size", c("coordinate_sample"), c("total_facilities"), "coordinate", c("coordinate_sample"), none, where),
        ("coordinate_coverage", c("coordinate_sample"), c("total_facilities"), "coordinate", c("coordinate_coverage"), none, where),
        ("small_scale_rating", c("room_median"), c("rooms_known"), "room", none, c("small_band"), graded("small_points")),
        ("small_scale_points", c("small_points"), two, "room", c("small_points"), none, graded("small_points")),
        ("aged_building_rating", c("age_median"), c("age_known"), "age", none, c("age_band"), graded("age_points")),
        ("aged_building_points", c("age_points"), two, "age", c("age_points"), none, graded("age_points")),
        ("district_context_rating", none, none, "coordinate", none, c("context_band"), graded("context_points")),
        ("district_context_points", c("context_points"), two, "coordinate", c("context_points"), none, graded("context_points")),
        ("composite_score", c("score"), six, "coordinate", c("score"), none, graded("score")),
        ("composite_grade", c("score"), six, "coordinate", none, c("grade"), graded("score")),
    ]
    shown = lambda v: F.when(seen, v.cast("double"))
    structs = [
        F.struct(F.lit(m).alias("metric"), shown(v).alias("value"), F.when(seen, label.cast("string")).alias("label"), shown(top).alias("numerator"), shown(bottom).alias("denominator"), shown(c(f"{cover}_coverage")).alias("coverage"), q.alias("quality"))
        for m, top, bottom, cover, v, label, q in rows
    ]
    return months.select("grid_id", "period", F.explode(F.array(*structs)).alias("e")).select("grid_id", "period", "e.*")


def stock_evidence(evidence: DataFrame, payload: str = "evidence_json") -> DataFrame:
    """Adds `problem` to district evidence (district, value, numerator, denominator, coverage, payload): null if all holds together.

    The payload must be an object that says whether the stock was observed; a value must be its numerator, whole, not negative and
    at full coverage; an unobserved one has neither.
    """
    said = F.from_json(payload, "stock_observed boolean, period string")
    e = evidence.withColumn("_said", said)
    v, n = F.col("value").cast("double"), F.col("numerator").cast("double")
    whole = is_finite(v) & (v >= 0) & close(v, F.round(v), absolute=1e-9)
    problem = (
        F.when(F.col("_said").isNull() | F.col("_said.stock_observed").isNull(), "no_stock_flag")
        .when(~F.col("_said.stock_observed") & (v.isNotNull() | n.isNotNull()), "value_without_stock")
        .when(F.col("_said.stock_observed") & ~whole, "value_not_a_count")
        .when(F.col("_said.stock_observed") & ~F.coalesce(close(v, n), F.lit(False)), "value_not_its_numerator")
        .when(F.col("_said.stock_observed") & ~F.coalesce(close(F.col("coverage").cast("double"), F.lit(1.0)), F.lit(False)), "coverage_not_full")
    )
    return e.withColumn("problem", problem).drop("_said")


def identity_problems(priorities: DataFrame, exceptions: DataFrame, facilities: DataFrame, months: DataFrame, cells: DataFrame) -> DataFrame:
    """(problem, id) of what must not be published: every facility is in one of the two tables, once; every cell has its month, once."""
    both = priorities.select("facility_id", F.lit(1).alias("p"), F.lit(0).alias("x")).unionByName(exceptions.select("facility_id", F.lit(0).alias("p"), F.lit(1).alias("x")))
    seen = both.groupBy("facility_id").agg(F.sum("p").alias("p"), F.sum("x").alias("x"))
    joined = facilities.select("facility_id", F.lit(True).alias("due")).distinct().join(seen, "facility_id", "full_outer")
    kind = F.when(F.col("due").isNull(), "unknown_facility").when(F.col("p").isNull(), "missing_facility").when((F.col("p") > 0) & (F.col("x") > 0), "facility_in_both").when(F.col("p") + F.col("x") > 1, "facility_repeated")
    one = joined.select(kind.alias("problem"), F.col("facility_id").cast("string").alias("id"))
    counted = months.groupBy("grid_id").agg(F.count(F.lit(1)).alias("n"))
    grid = cells.select("grid_id", F.lit(True).alias("due")).distinct().join(counted, "grid_id", "full_outer")
    kind = F.when(F.col("due").isNull(), "unknown_cell").when(F.col("n").isNull(), "missing_cell").when(F.col("n") > 1, "cell_repeated")
    return one.unionByName(grid.select(kind.alias("problem"), F.col("grid_id").alias("id"))).filter("problem IS NOT NULL")
