"""Queries of the spatial marts over stand-in facilities, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import geo
from tessera.plans import grid
from tessera.plans.queries import FACILITIES, districts, facilities, query, rounded, table

MAPPED = f"SELECT facility_id, district, rooms, age, registrations, 'g' || facility_id % 37 || '_' || district AS grid_id FROM ({FACILITIES}) WHERE rooms IS NOT NULL OR tourism OR district IN ('NATION_1', 'NATION_2')"
CELLS = "SELECT 'g' || k || '_' || n_name AS grid_id, 'c' || n_nationkey AS district_code, n_name AS district, 'd' || k AS dong_code, 'dong' AS dong_name FROM nation, range(40) t(k)"
SNAPSHOTS = f"SELECT n_name AS district, n_nationkey % 6 <> 0 AS observed, CASE WHEN n_nationkey % 7 <> 3 THEN n END AS total_facilities, CASE WHEN n_nationkey % 3 = 0 THEN 'unclassified' WHEN n_nationkey % 3 = 1 THEN 'high' ELSE 'low' END AS demand_band, CASE WHEN n_nationkey % 2 = 0 THEN 'low' ELSE 'medium' END AS supply_band FROM nation LEFT JOIN (SELECT district, count(*) AS n FROM ({FACILITIES}) GROUP BY 1) ON district = n_name"
MONTH_SQL = f"""
WITH p AS (SELECT grid_id, count(*) AS n, sum(registrations)::BIGINT AS legal, count(rooms) AS rk, count(age) AS ak, sum(rooms)::DOUBLE AS rs, count(*) FILTER (rooms <= 20) AS sm, count(*) FILTER (rooms <= 10) AS ti, count(*) FILTER (age >= 20) AS a20, count(*) FILTER (age >= 30) AS a30, median(rooms)::DOUBLE AS rm, median(age)::DOUBLE AS am, list_sort(list(age) FILTER (age IS NOT NULL)) AS ages FROM ({MAPPED}) GROUP BY 1),
dm AS (SELECT district, count(*) AS dmap FROM ({MAPPED}) GROUP BY 1),
b AS (SELECT c.*, s.total_facilities AS tf, demand_band, supply_band, coalesce(observed AND total_facilities IS NOT NULL, false) AS seen, coalesce(dmap, 0) AS dmap, coalesce(n, 0) AS n, coalesce(legal, 0) AS legal, coalesce(rk, 0) AS rk, coalesce(ak, 0) AS ak, rs, coalesce(sm, 0) AS sm, coalesce(ti, 0) AS ti, coalesce(a20, 0) AS a20, coalesce(a30, 0) AS a30, rm, am, ages
  FROM ({CELLS}) c LEFT JOIN ({SNAPSHOTS}) s USING (district) LEFT JOIN dm USING (district) LEFT JOIN p USING (grid_id)),
k AS (SELECT *, CASE WHEN seen THEN n END AS mapped, CASE WHEN seen THEN CASE WHEN tf = 0 THEN 1.0 ELSE dmap / tf END END AS cc, CASE WHEN seen AND NOT (n > 0 AND rk = 0) THEN rk END AS rkn, CASE WHEN seen AND NOT (n > 0 AND ak = 0) THEN ak END AS akn FROM b),
r AS (SELECT *, CASE WHEN n > 0 AND seen AND rk = n THEN CASE WHEN rm <= 0 THEN NULL WHEN rm <= 10 THEN 2 WHEN rm <= 20 THEN 1 ELSE 0 END END AS sp, CASE WHEN n > 0 AND seen AND ak = n THEN CASE WHEN am >= 30 THEN 2 WHEN am >= 20 THEN 1 ELSE 0 END END AS ap,
  CASE WHEN n > 0 AND seen AND demand_band <> 'unclassified' THEN CASE WHEN (demand_band = 'high') AND (supply_band = 'low') THEN 2 WHEN (demand_band = 'high') OR (supply_band = 'low') THEN 1 ELSE 0 END END AS cp, coalesce(cc >= 0.8, false) AS g FROM k),
months AS (SELECT grid_id, district_code, district, dong_code, dong_name, '2024-01' AS period, CASE WHEN NOT seen THEN 'unobserved' WHEN tf = 0 THEN 'complete_empty' ELSE 'observed' END AS stock_status, tf AS total_facilities, mapped AS mapped_facilities, CASE WHEN seen THEN legal END AS legal_registrations, CASE WHEN seen AND rk > 0 THEN rs WHEN mapped = 0 THEN 0.0 END::DOUBLE AS room_sum, rkn AS rooms_known,
  CASE WHEN mapped > 0 THEN rk / mapped WHEN mapped = 0 THEN 1.0 END::DOUBLE AS room_coverage, rm AS room_median, CASE WHEN rkn IS NOT NULL THEN sm END AS small_count, CASE WHEN rkn IS NOT NULL THEN ti END AS tiny_count, CASE WHEN rkn > 0 THEN sm / rkn END::DOUBLE AS small_share, akn AS age_known, CASE WHEN mapped > 0 THEN ak / mapped WHEN mapped = 0 THEN 1.0 END::DOUBLE AS age_coverage, am AS age_median,
  CASE WHEN akn IS NOT NULL THEN coalesce(array_to_string(ages, ','), '') END AS ordered_ages, CASE WHEN akn IS NOT NULL THEN a20 END AS age20_count, CASE WHEN akn > 0 THEN a20 / akn END::DOUBLE AS age20_share, CASE WHEN akn IS NOT NULL THEN a30 END AS age30_count, CASE WHEN akn > 0 THEN a30 / akn END::DOUBLE AS age30_share, CASE WHEN seen THEN dmap END AS coordinate_sample, cc::DOUBLE AS coordinate_coverage,
  CASE cp WHEN 2 THEN 'high' WHEN 1 THEN 'medium' WHEN 0 THEN 'low' ELSE 'unavailable' END AS context_band, CASE WHEN g THEN cp END AS context_points, CASE sp WHEN 2 THEN 'high' WHEN 1 THEN 'medium' WHEN 0 THEN 'low' ELSE 'unavailable' END AS small_band, CASE WHEN g THEN sp END AS small_points, CASE ap WHEN 2 THEN 'high' WHEN 1 THEN 'medium' WHEN 0 THEN 'low' ELSE 'unavailable' END AS age_band, CASE WHEN g THEN ap END AS age_points,
  CASE WHEN g THEN sp + ap + cp END AS score, CASE WHEN NOT g OR sp + ap + cp IS NULL THEN 'insufficient_evidence' WHEN mapped < 3 THEN 'small_sample' WHEN sp + ap + cp >= 5 THEN 'priority_1' WHEN sp + ap + cp >= 3 THEN 'priority_2' WHEN sp + ap + cp >= 1 THEN 'monitor' ELSE 'general' END AS grade FROM r)
"""
DOUBLES = ("room_coverage", "small_share", "age_coverage", "age20_share", "age30_share", "coordinate_coverage")


def months(spark, d):
    f, key = facilities(spark, d), F.col("facility_id")
    mapped = f.filter(F.col("rooms").isNotNull() | F.col("tourism") | F.col("district").isin("NATION_1", "NATION_2")).withColumn("grid_id", F.concat(F.lit("g"), key % 37, F.lit("_"), "district"))
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("district"))
    cells = n.select("*", F.explode(F.sequence(F.lit(0), F.lit(39))).alias("g")).select(F.concat(F.lit("g"), "g", F.lit("_"), "district").alias("grid_id"), F.concat(F.lit("c"), "k").alias("district_code"), "district", F.concat(F.lit("d"), "g").alias("dong_code"), F.lit("dong").alias("dong_name"))
    k = F.col("k")
    snapshots = n.join(f.groupBy("district").agg(F.count(F.lit(1)).alias("n")), "district", "left").select(
        "district", (k % 6 != 0).alias("observed"), F.when(k % 7 != 3, F.col("n")).alias("total_facilities"), F.when(k % 3 == 0, "unclassified").when(k % 3 == 1, "high").otherwise("low").alias("demand_band"), F.when(k % 2 == 0, "low").otherwise("medium").alias("supply_band"),
    )
    return grid.grid_month(cells, mapped, snapshots, "2024-01")


@query(MONTH_SQL + f"SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in DOUBLES)}, score::INTEGER AS score, context_points::INTEGER AS context_points, small_points::INTEGER AS small_points, age_points::INTEGER AS age_points) FROM months")
def grid_month(spark, d):
    return rounded(months(spark, d).withColumn("ordered_ages", F.array_join("ordered_ages", ",")))


def _evidence(metric: str, top: str, bottom: str, cover: str, value: str, label: str, quality: str) -> str:
    return f"SELECT grid_id, period, '{metric}' AS metric, {value}::DOUBLE AS value, {label}::VARCHAR AS label, {top}::DOUBLE AS numerator, {bottom}::DOUBLE AS denominator, {cover}_coverage AS coverage, {quality} AS quality, stock_status FROM months"


def _quality(cover: str, able: str) -> str:
    return f"CASE WHEN stock_status = 'complete_empty' THEN 'complete_empty' WHEN NOT coalesce({able}, false) THEN 'insufficient_evidence' WHEN {cover}_coverage = 1.0 THEN 'good' ELSE 'warning' END"


def _graded(points: str) -> str:
    return f"CASE WHEN {points} IS NULL THEN 'insufficient_evidence' WHEN stock_status = 'complete_empty' THEN 'complete_empty' WHEN coordinate_coverage >= 0.8 THEN 'good' ELSE 'insufficient_evidence' END"


_ROOM, _AGE, _PLACE = _quality("room", "rooms_known > 0"), _quality("age", "age_known > 0"), _quality("coordinate", "coordinate_coverage >= 0.8")
_ROWS = [
    ("physical_facility_count", "mapped_facilities", "total_facilities", "coordinate", "mapped_facilities", "NULL", _quality("coordinate", "mapped_facilities IS NOT NULL")),
    ("legal_registration_count", "legal_registrations", "mapped_facilities", "coordinate", "legal_registrations", "NULL", _quality("coordinate", "legal_registrations IS NOT NULL")),
    ("room_sum", "room_sum", "mapped_facilities", "room", "room_sum", "NULL", _ROOM),
    ("room_coverage", "rooms_known", "mapped_facilities", "room", "room_coverage", "NULL", _ROOM),
    ("small_facility_count", "small_count", "rooms_known", "room", "small_count", "NULL", _ROOM),
    ("small_facility_share", "small_count", "rooms_known", "room", "small_share", "NULL", _ROOM),
    ("age_sample_size", "age_known", "mapped_facilities", "age", "age_known", "NULL", _AGE),
    ("age_coverage", "age_known", "mapped_facilities", "age", "age_coverage", "NULL", _AGE),
    ("age_20y_facility_count", "age20_count", "age_known", "age", "age20_count", "NULL", _AGE),
    ("age_20y_share", "age20_count", "age_known", "age", "age20_share", "NULL", _AGE),
    ("age_30y_facility_count", "age30_count", "age_known", "age", "age30_count", "NULL", _AGE),
    ("age_30y_share", "age30_count", "age_known", "age", "age30_share", "NULL", _AGE),
    ("coordinate_sample_size", "coordinate_sample", "total_facilities", "coordinate", "coordinate_sample", "NULL", _PLACE),
    ("coordinate_coverage", "coordinate_sample", "total_facilities", "coordinate", "coordinate_coverage", "NULL", _PLACE),
    ("small_scale_rating", "room_median", "rooms_known", "room", "NULL", "small_band", _graded("small_points")),
    ("small_scale_points", "small_points", "2", "room", "small_points", "NULL", _graded("small_points")),
    ("aged_building_rating", "age_median", "age_known", "age", "NULL", "age_band", _graded("age_points")),
    ("aged_building_points", "age_points", "2", "age", "age_points", "NULL", _graded("age_points")),
    ("district_context_rating", "NULL", "NULL", "coordinate", "NULL", "context_band", _graded("context_points")),
    ("district_context_points", "context_points", "2", "coordinate", "context_points", "NULL", _graded("context_points")),
    ("composite_score", "score", "6", "coordinate", "score", "NULL", _graded("score")),
    ("composite_grade", "score", "6", "coordinate", "NULL", "grade", _graded("score")),
]


@query(
    MONTH_SQL
    + ", e AS ("
    + " UNION ALL ".join(_evidence(*r) for r in _ROWS)
    + ") SELECT grid_id, period, metric, "
    + ", ".join(f"round(CASE WHEN stock_status <> 'unobserved' THEN {c} END, 6) AS {c}" for c in ("value", "numerator", "denominator", "coverage"))
    + ", CASE WHEN stock_status <> 'unobserved' THEN label END AS label, CASE WHEN stock_status = 'unobserved' THEN 'insufficient_evidence' ELSE quality END AS quality FROM e"
)
def grid_evidence(spark, d):
    return rounded(grid.grid_evidence(months(spark, d)))


EAST = 127.1154  # of the city's boundary: between the lattice's columns 20 and 21, at x = 210,250 m

# Points in metres on a small lattice, so that cells and clashes follow from ids without a projection.
POINTS = """
SELECT o_custkey AS facility_id, 'o' || o_orderkey AS source_identity, CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 9 = 1 THEN 'EPSG:9999' ELSE 'EPSG:5174' END AS crs,
  CASE WHEN o_orderkey % 9 <> 2 THEN 200000.0 + (CASE WHEN o_custkey % 3 = 0 THEN o_orderkey % 2 ELSE 0 END + o_custkey % 25) * 500 + 10 END AS x, CASE WHEN o_orderkey % 9 <> 2 THEN 180000.0 END AS y FROM orders
"""


@query(f"""
WITH r AS (SELECT *, CASE WHEN crs IS NULL OR crs <> 'EPSG:5174' THEN 'UNKNOWN_CRS' WHEN x IS NULL THEN 'MISSING_COORDINATES' WHEN x > 210500 THEN 'OUTSIDE_BUSAN' END AS code FROM ({POINTS})),
p AS (SELECT facility_id, count(DISTINCT x) FILTER (code IS NULL) AS n, min(x) FILTER (code IS NULL) AS x, min(source_identity) FILTER (code IS NULL) AS source_identity, count(DISTINCT code) AS codes, min(code) AS code FROM r GROUP BY 1),
f AS (SELECT c_custkey AS facility_id, 'NATION_' || c_nationkey AS district, c_custkey % 3 AS n_buildings, c_acctbal, CASE WHEN c_name LIKE '%7' THEN ' ' ELSE c_name END AS name, p.* EXCLUDE (facility_id), 'g5174_500_' || floor(x / 500)::BIGINT || '_360' AS g FROM customer LEFT JOIN p ON p.facility_id = c_custkey),
c AS (SELECT 'g5174_500_' || (400 + n_nationkey)::BIGINT || '_360' AS g, 'NATION_' || (n_nationkey + CASE WHEN n_nationkey < 5 THEN 1 ELSE 0 END) AS cell_district FROM nation WHERE n_nationkey <> 7),
e AS (SELECT *, CASE WHEN trim(name) = '' THEN 'MISSING_PUBLIC_NAME' WHEN n IS NULL THEN 'SELECTED_REVISION_UNAVAILABLE' WHEN n > 1 THEN 'AMBIGUOUS_COORDINATES' WHEN n = 0 AND codes = 1 THEN code WHEN n = 0 THEN 'UNMAPPED_COORDINATES' WHEN cell_district IS NULL THEN 'GRID_NOT_FOUND' WHEN district <> cell_district THEN 'DISTRICT_COORDINATE_MISMATCH' END AS exception_code FROM f LEFT JOIN c USING (g))
SELECT facility_id, district, exception_code, CASE WHEN exception_code IS NULL THEN g END AS grid_id, CASE WHEN exception_code IS NULL THEN source_identity END AS source_identity, CASE WHEN exception_code IS NULL THEN CASE WHEN n_buildings > 1 OR c_acctbal > 8000 THEN 'review_required' ELSE 'public' END END AS display FROM e
""")
def facility_points(spark, d):
    key, order = F.col("o_custkey"), F.col("o_orderkey")
    there, none = order % 9 != 2, F.lit(None).cast("double")
    shift = F.when(key % 3 == 0, order % 2).otherwise(0) + key % 25
    registrations = table(spark, d, "orders").select(
        key.alias("facility_id"), F.concat(F.lit("o"), order).alias("source_identity"), F.when(order % 9 == 0, None).when(order % 9 == 1, "EPSG:9999").otherwise("EPSG:5174").alias("coordinate_crs"),
        none.alias("longitude"), none.alias("latitude"), F.when(there, F.lit(200000.0) + shift * 500 + 10).alias("projected_x"), F.when(there, F.lit(180000.0)).alias("projected_y"),
    )
    named = F.when(F.col("c_name").endswith("7"), " ").otherwise(F.col("c_name"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("facility_id"), named.alias("name"), F.concat(F.lit("NATION_"), "c_nationkey").alias("district"), (F.col("c_custkey") % 3).alias("n_buildings"))
    k = F.col("n_nationkey")
    cells = table(spark, d, "nation").filter("n_nationkey <> 7").select(geo.grid_id(F.lit(200000.0) + k * 500, F.lit(180000.0)).alias("grid_id"), F.concat(F.lit("NATION_"), k + (k < 5).cast("int")).alias("district"))
    corners = [(126.9, 35.0), (EAST, 35.0), (EAST, 35.2), (126.9, 35.2)]  # in degrees
    boundary = cells.limit(1).select(F.lit("city").alias("name"), F.array(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in corners])).alias("rings"))
    out = grid.facility_points(c, registrations, cells, c.join(table(spark, d, "customer").filter("c_acctbal > 8000").select(F.col("c_custkey").alias("facility_id")), "facility_id"), boundary)
    return out.select("facility_id", "district", "exception_code", "grid_id", "source_identity", "display")


@query(f"""
WITH f AS ({FACILITIES}), p AS (SELECT facility_id FROM f WHERE rooms >= 20 UNION ALL SELECT facility_id FROM f WHERE rooms >= 95), x AS (SELECT facility_id FROM f WHERE rooms < 18 UNION ALL SELECT facility_id FROM f WHERE rooms BETWEEN 40 AND 42 UNION ALL SELECT facility_id + 100000000 FROM f WHERE rooms = 50),
s AS (SELECT facility_id, count(*) FILTER (k = 'p') AS p, count(*) FILTER (k = 'x') AS x FROM (SELECT facility_id, 'p' AS k FROM p UNION ALL SELECT facility_id, 'x' FROM x) GROUP BY 1)
SELECT problem, id FROM (SELECT CASE WHEN f.facility_id IS NULL THEN 'unknown_facility' WHEN s.p IS NULL THEN 'missing_facility' WHEN s.p > 0 AND s.x > 0 THEN 'facility_in_both' WHEN s.p + s.x > 1 THEN 'facility_repeated' END AS problem, coalesce(f.facility_id, s.facility_id)::VARCHAR AS id FROM f FULL JOIN s USING (facility_id)) WHERE problem IS NOT NULL
UNION ALL SELECT 'missing_cell', 'c' || n_nationkey FROM nation WHERE n_regionkey = 2
""")
def identity_problems(spark, d):
    f = facilities(spark, d).select("facility_id", "rooms")
    where = lambda test, shift=0: f.filter(test).select((F.col("facility_id") + shift).alias("facility_id"))
    p = where("rooms >= 20").unionByName(where("rooms >= 95"))
    x = where("rooms < 18").unionByName(where("rooms BETWEEN 40 AND 42")).unionByName(where("rooms = 50", 100000000))
    cells = table(spark, d, "nation").select(F.concat(F.lit("c"), "n_nationkey").alias("grid_id"), "n_regionkey")
    return grid.identity_problems(p, x, f, cells.filter("n_regionkey <> 2"), cells)


@query(f"""
WITH e AS (SELECT district, count(*)::DOUBLE AS n, row_number() OVER (ORDER BY district) AS k FROM ({FACILITIES}) GROUP BY 1)
SELECT district, CASE WHEN k % 6 = 0 THEN 'no_stock_flag' WHEN k % 6 = 1 THEN 'value_without_stock' WHEN k % 6 = 2 THEN 'value_not_a_count' WHEN k % 6 = 3 THEN 'value_not_its_numerator' WHEN k % 6 = 4 THEN 'coverage_not_full' END AS problem FROM e
""")
def stock_evidence(spark, d):
    from pyspark.sql import Window

    k = F.row_number().over(Window.orderBy("district")) % 6
    e = facilities(spark, d).groupBy("district").agg(F.count(F.lit(1)).cast("double").alias("n")).withColumn("k", k)
    n, k = F.col("n"), F.col("k")
    e = e.select("district", F.when(k == 2, n + 0.5).otherwise(n).alias("value"), F.when(k == 3, n + 1).otherwise(n).alias("numerator"), F.when(k == 4, 0.9).otherwise(1.0).alias("coverage"), F.when(k == 0, "{}").when(k == 1, '{"stock_observed":false}').otherwise('{"stock_observed":true}').alias("evidence_json"))
    return grid.stock_evidence(e).select("district", "problem")


@query("""
WITH c AS (SELECT o_custkey % 40 AS i, o_orderkey % 30 AS j, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT 'g5174_500_' || i || '_' || j AS grid_id, n, a.total, b.cells FROM c, (SELECT count(*) AS total FROM orders) a, (SELECT count(*) AS cells FROM (SELECT DISTINCT o_custkey % 40, o_orderkey % 30 FROM orders)) b
""")
def single_row_cross(spark, d):
    o = table(spark, d, "orders").select((F.col("o_custkey") % 40).alias("i"), (F.col("o_orderkey") % 30).alias("j"))
    c = o.groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"))
    return c.crossJoin(F.broadcast(o.agg(F.count(F.lit(1)).alias("total")))).crossJoin(F.broadcast(o.distinct().agg(F.count(F.lit(1)).alias("cells")))).select(F.concat_ws("_", F.lit("g5174_500"), "i", "j").alias("grid_id"), "n", "total", "cells")  # one row each
