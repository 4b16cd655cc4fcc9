"""Queries of the register, building, demand and transport rules over stand-ins that hold odd values, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import parsing
from tessera.operators import aggregates as agg
from tessera.operators import latest, matching, quality, spatial
from tessera.plans import marts, normalise
from tessera.plans.queries import FACILITIES, districts, facilities, pick, query, rounded, sql_pick, table

ROADS = [None, "", "부산광역시  해운대구 우동로 1", "부산 북구 덕천로", "부산시 기장군 정관읍", "서울특별시 중구 세종대로", "부산광역시 어딘가", "부산진구 양정로"]
PLACES = [None, "부산광역시 사상구 괘법동 12", "경남 김해시", "부산 수영구 광안동"]
DAYS = [None, "", "20240131", "2024-02-30", "2023.05-01", "x"]
ROOMS = [None, "", "3", "1,200", "-1", "2.0", "2.5", "0"]
CODES = [None, "01", "02", "03", "04", "7", " "]
AUTHORITIES = [None, "3250000", "3260000", "6260000"]
DISTRICT_SQL = "'강서구|북구|사상구|사하구', '해운대구|수영구|기장군', '중구|서구|동구|영도구|부산진구|동래구|남구|금정구|연제구'"
GROUP_CASE = "CASE WHEN {d} IN ('강서구', '북구', '사상구', '사하구') THEN 'west' WHEN {d} IN ('해운대구', '수영구', '기장군') THEN 'east' WHEN {d} IN ('중구', '서구', '동구', '영도구', '부산진구', '동래구', '남구', '금정구', '연제구') THEN 'other' END"


def licence_rows(spark, d):
    k = "o_orderkey"
    fields = {
        "mng-no": F.when(F.col(k) % 17 != 0, F.col(k).cast("string")), "OPN_ATMY_GRP_CD": pick(AUTHORITIES, k), "bplc_nm": F.concat(F.lit("Ｈotel "), F.col("o_custkey")),
        "ROAD_NM_ADDR": pick(ROADS, k), "지번주소": pick(PLACES, "o_custkey"), "LCPMT_YMD": pick(DAYS, k), "CLSBIZ_YMD": pick(DAYS, "o_custkey"), "SALS_STTS_CD": pick(CODES, k),
        "DTL_SALS_STTS_CD": F.lit("0000"), "DTL_SALS_STTS_NM": F.lit("정상"), "KSRM_CNT": pick(ROOMS, k), "양실수": pick(ROOMS, "o_custkey"), "TEL": F.lit("051-123 4567"),
        "XCRD": F.when(F.col(k) % 2 == 0, "200000.5"), "LAST_MDFCN_YMD": F.lit("20240201"), "DATA_UPDT_YMD": pick(DAYS, "o_custkey + 1"), "other": F.lit("kept"),
    }
    row = F.map_filter(F.create_map(*(x for n, c in fields.items() for x in (F.lit(n), c))), lambda _, v: v.isNotNull())
    return table(spark, d, "orders").select(F.lit("lodgings").alias("source_id"), F.col(k), F.to_date("o_orderdate").alias("observed_on"), row.alias("row"))


DATE_SQL = "try_strptime(CASE WHEN regexp_full_match(trim({0}), '[0-9]{{4}}[-./]?[0-9]{{2}}[-./]?[0-9]{{2}}') THEN regexp_replace(trim({0}), '[-./]', '', 'g') END, '%Y%m%d')::DATE"
QUALITY_SQL = "CASE WHEN nullif(trim({0}), '') IS NULL THEN 'missing' WHEN " + DATE_SQL + " IS NULL THEN 'invalid' ELSE 'parsed' END"
COUNT_SQL = "CASE WHEN regexp_full_match(replace({0}, ',', ''), '[-+]?[0-9]+([.]0+)?') THEN replace({0}, ',', '')::DOUBLE::BIGINT END"
CITY = "coalesce(regexp_matches({0}, '(^|\\s)부산(광역시|시)?(\\s|$)'), false)"
LICENCE_SQL = f"""
WITH raw AS (SELECT o_orderkey, o_orderdate::DATE AS observed_on, CASE WHEN o_orderkey % 17 <> 0 THEN o_orderkey::VARCHAR END AS source_record_id, {sql_pick(AUTHORITIES, "o_orderkey")} AS jurisdiction_code, o_custkey,
  nullif(trim(regexp_replace({sql_pick(ROADS, "o_orderkey")}, '\\s+', ' ', 'g')), '') AS road, nullif(trim(regexp_replace({sql_pick(PLACES, "o_custkey")}, '\\s+', ' ', 'g')), '') AS lot, {sql_pick(DAYS, "o_orderkey")} AS l, {sql_pick(DAYS, "o_custkey")} AS c, {sql_pick(DAYS, "o_custkey + 1")} AS u,
  nullif(trim({sql_pick(CODES, "o_orderkey")}), '') AS status_code, {sql_pick(ROOMS, "o_orderkey")} AS kr, {sql_pick(ROOMS, "o_custkey")} AS wr FROM orders),
a AS (SELECT *, {CITY.format("road")} AS in_road, {CITY.format("lot")} AS in_lot, {COUNT_SQL.format("kr")} AS k, {COUNT_SQL.format("wr")} AS w FROM raw),
b AS (SELECT *, in_road OR in_lot AS is_busan, CASE WHEN (NOT in_road AND in_lot) OR road IS NULL THEN lot ELSE road END AS chosen FROM a),
e AS (SELECT *, CASE WHEN {CITY.format("chosen")} THEN nullif(regexp_extract(chosen, '([가-힣]+(구|군))', 1), '') END AS district FROM b),
licences AS (SELECT o_orderkey, observed_on, source_record_id, jurisdiction_code, 'hotel' || o_custkey AS normalized_name, road AS road_address, lot AS lot_address, district, {GROUP_CASE.format(d="district")} AS region_group,
  CASE WHEN NOT is_busan THEN 'not_busan' WHEN {GROUP_CASE.format(d="district")} IS NULL THEN 'unresolved' ELSE 'resolved' END AS region_quality, is_busan, {DATE_SQL.format("l")} AS license_date, {QUALITY_SQL.format("l")} AS license_date_quality, {DATE_SQL.format("c")} AS closure_date, {QUALITY_SQL.format("c")} AS closure_date_quality,
  {QUALITY_SQL.format("u")} AS data_updated_date_quality, status_code, CASE status_code WHEN '01' THEN 'active' WHEN '02' THEN 'suspended' WHEN '03' THEN 'closed' WHEN '04' THEN 'cancelled_or_expired_or_stopped' ELSE CASE WHEN status_code IS NOT NULL THEN 'unknown' END END AS status_class,
  CASE WHEN k < 0 OR w < 0 THEN NULL WHEN k IS NULL AND w IS NULL THEN NULL ELSE coalesce(k, 0) + coalesce(w, 0) END AS room_count, CASE WHEN k < 0 OR w < 0 THEN 'invalid_negative' WHEN k IS NULL AND w IS NULL THEN 'missing' WHEN coalesce(k, 0) + coalesce(w, 0) = 0 THEN 'reported_zero' ELSE 'reported' END AS room_count_quality,
  CASE WHEN o_orderkey % 2 = 0 THEN 'EPSG:5174' END AS coordinate_crs FROM e)
"""
LICENCE_COLUMNS = "observed_on, source_record_id, jurisdiction_code, normalized_name, road_address, lot_address, district, region_group, region_quality, is_busan, license_date, license_date_quality, closure_date, closure_date_quality, data_updated_date_quality, status_code, status_class, room_count, room_count_quality, coordinate_crs"


@query(f"{LICENCE_SQL} SELECT {LICENCE_COLUMNS}, '0511234567' AS normalized_phone, 'kept' AS other FROM licences WHERE is_busan AND source_record_id IS NOT NULL")
def licence_normalisation(spark, d):
    out = normalise.staged(normalise.licences(licence_rows(spark, d)))
    return out.select(*LICENCE_COLUMNS.split(", "), "normalized_phone", F.try_element_at("extra", F.lit("other")).alias("other"))


@query(f"{LICENCE_SQL} SELECT date_trunc('month', observed_on)::DATE AS month, count(*) FILTER (jurisdiction_code = '3250000') AS accepted, count(*) FILTER (jurisdiction_code <> '3250000') AS out_of_scope, count(*) FILTER (jurisdiction_code IS NULL) AS rejected FROM licences GROUP BY 1")
def jurisdiction_counts(spark, d):
    records = normalise.licences(licence_rows(spark, d)).withColumn("month", F.trunc("observed_on", "month"))
    return normalise.jurisdiction_counts(records, ["month"], F.lit("3250000"))


@query(f"""
{LICENCE_SQL}, c AS (SELECT year(observed_on) AS year, count(*) AS n_rows, count(*) FILTER (jurisdiction_code BETWEEN '3250000' AND '3400000') AS j, count(*) FILTER (license_date_quality = 'parsed' AND data_updated_date_quality = 'parsed') AS t,
  count(*) FILTER (status_code IN ('01', '02', '03', '04') AND (status_code IN ('01', '02') OR closure_date_quality = 'parsed')) AS s FROM licences WHERE is_busan GROUP BY 1)
SELECT year::INTEGER AS year, n_rows, round(j / n_rows, 6) AS jurisdiction_coverage, round(t / n_rows, 6) AS dates_coverage, round(s / n_rows, 6) AS status_coverage, CASE WHEN n_rows > 0 AND j = n_rows AND t = n_rows AND s = n_rows THEN 'pass' ELSE 'fail' END AS status_of_check FROM c
""")
def register_coverage(spark, d):
    records = normalise.licences(licence_rows(spark, d)).filter("is_busan").withColumn("year", F.year("observed_on"))
    return rounded(quality.register_coverage(records, ["year"]))


# -- buildings ---------------------------------------------------------------

AREAS = ["120.5", "1,200", None, "x"]
MARKS = [None, "Y", "정상", "폐쇄말소", "n", "true"]


def building_rows(spark, d):
    k = F.col("p_partkey")
    fields = {
        "mgmBldrgstPk": F.when(k % 13 != 0, F.when(k % 40 < 20, k % 40).otherwise(F.floor(k % 40 / 3) * 3).cast("string")), "sigunguCd": pick(["26110", "261", "x"], "p_partkey"), "bun": (k % 9).cast("string"), "ji": F.when(k % 2 == 0, "7"),
        "useAprDay": pick(["19990101", "2010-05-06", "20100506123", None], "p_partkey"), "archPmsDay": pick([None, "20230101"], "p_size"), "totArea": pick(AREAS, "p_partkey"), "grndFlrCnt": pick(["3", "3.0", "3.5", None], "p_size"), "shterGbCdNm": pick(MARKS, "p_size"),
    }
    row = F.map_filter(F.create_map(*(x for n, c in fields.items() for x in (F.lit(n), c))), lambda _, v: v.isNotNull())
    return table(spark, d, "part").select("p_partkey", F.concat(F.lit("parcel"), F.floor(k % 40 / 3)).alias("parcel_hash"), row.alias("row"))


HEAD_DATE = "try_strptime(CASE WHEN regexp_full_match(left({0}, 10), '[0-9]{{4}}[-./]?[0-9]{{2}}[-./]?[0-9]{{2}}') THEN regexp_replace(left({0}, 10), '[-./]', '', 'g') END, '%Y%m%d')::DATE"
BUILDING_SQL = f"""
WITH raw AS (SELECT p_partkey, 'parcel' || floor(p_partkey % 40 / 3)::BIGINT AS parcel_hash, CASE WHEN p_partkey % 13 <> 0 THEN (CASE WHEN p_partkey % 40 < 20 THEN p_partkey % 40 ELSE floor(p_partkey % 40 / 3) * 3 END)::BIGINT::VARCHAR END AS building_id, {sql_pick(["26110", "261", "x"], "p_partkey")} AS sg, lpad((p_partkey % 9)::VARCHAR, 4, '0') AS bun, CASE WHEN p_partkey % 2 = 0 THEN '0007' END AS ji,
  {sql_pick(["19990101", "2010-05-06", "20100506123", None], "p_partkey")} AS a, {sql_pick([None, "20230101"], "p_size")} AS pm, replace({sql_pick(AREAS, "p_partkey")}, ',', '') AS area, {sql_pick(["3", "3.0", "3.5", None], "p_size")} AS fl, {sql_pick(MARKS, "p_size")} AS closed_indicator FROM part),
b AS (SELECT p_partkey, parcel_hash, building_id, CASE WHEN regexp_full_match(sg, '[0-9]+') THEN lpad(sg, 5, '0') END AS sigungu_cd, bun, ji, {HEAD_DATE.format("a")} AS use_approval_date, {HEAD_DATE.format("pm")} AS permit_date, TRY_CAST(area AS DOUBLE) AS total_area,
  CASE WHEN fl IN ('3', '3.0') THEN 3::BIGINT END AS ground_floor_count, closed_indicator, coalesce(lower(closed_indicator) IN ('y', 'yes', 'true', '1') OR regexp_matches(closed_indicator, '폐쇄|말소|폐지'), false) AS is_closed FROM raw)
"""
BUILDING_COLUMNS = ["sigungu_cd", "bun", "ji", "use_approval_date", "permit_date", "total_area", "ground_floor_count", "closed_indicator", "is_closed"]


@query(f"{BUILDING_SQL} SELECT p_partkey, building_id, {', '.join(BUILDING_COLUMNS)} FROM b")
def building_titles(spark, d):
    return normalise.buildings(building_rows(spark, d)).select("p_partkey", "building_id", *BUILDING_COLUMNS)


@query(f"""
{BUILDING_SQL}, t AS (SELECT * FROM b WHERE building_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY building_id ORDER BY p_partkey) = 1),
x AS (SELECT *, 0 AS r FROM t UNION ALL SELECT b.*, 1 FROM b JOIN t USING (building_id))
SELECT building_id, arg_min(ji, (r, p_partkey)) FILTER (ji IS NOT NULL) AS ji, arg_min(use_approval_date, (r, p_partkey)) FILTER (use_approval_date IS NOT NULL) AS use_approval_date, arg_min(permit_date, (r, p_partkey)) FILTER (permit_date IS NOT NULL) AS permit_date,
  arg_min(total_area, (r, p_partkey)) FILTER (total_area IS NOT NULL) AS total_area, arg_min(closed_indicator, (r, p_partkey)) FILTER (closed_indicator IS NOT NULL) AS closed_indicator, bool_or(is_closed) AS is_closed FROM x GROUP BY building_id
""")
def building_merge(spark, d):
    b = normalise.buildings(building_rows(spark, d)).filter("building_id IS NOT NULL").select("building_id", "p_partkey", "ji", "use_approval_date", "permit_date", "total_area", "closed_indicator", "is_closed")
    titles = latest.latest(b, ["building_id"], [F.asc("p_partkey")])
    return normalise.merged_building(titles, b, "building_id", [F.col("p_partkey")]).drop("p_partkey")


PARCELS = "SELECT 's' AS source_id, s_suppkey::VARCHAR AS source_record_id, 'parcel' || s_suppkey % 20 AS parcel_hash FROM supplier"


def building_sides(spark, d):
    titles = normalise.buildings(building_rows(spark, d))
    licences = table(spark, d, "supplier").select(F.lit("s").alias("source_id"), F.col("s_suppkey").cast("string").alias("source_record_id"), F.concat(F.lit("parcel"), F.col("s_suppkey") % 20).alias("parcel_hash"))
    return normalise.building_links(titles, licences)


CANDIDATES = f"{BUILDING_SQL}, g AS (SELECT parcel_hash, list_sort(list(DISTINCT building_id)) AS c FROM b WHERE building_id IS NOT NULL GROUP BY 1)"


@query(f"{CANDIDATES} SELECT source_id, source_record_id, parcel_hash, c[1] AS building_id FROM ({PARCELS}) JOIN g USING (parcel_hash) WHERE len(c) = 1")
def building_links(spark, d):
    return building_sides(spark, d)[0]


@query(f"{CANDIDATES} SELECT source_id, source_record_id, parcel_hash, array_to_string(c, '|') AS candidates, sha256(array_to_string(c, '|')) AS candidate_hash FROM ({PARCELS}) JOIN g USING (parcel_hash) WHERE len(c) > 1")
def building_link_reviews(spark, d):
    return building_sides(spark, d)[1].withColumn("candidates", F.array_join("candidates", "|"))


@query(f"""
{BUILDING_SQL}, e AS (SELECT DISTINCT 'closed-register:' || parcel_hash || ':' || coalesce(building_id, 'row' || p_partkey) AS name, min(use_approval_date) OVER (PARTITION BY parcel_hash, coalesce(building_id, 'row' || p_partkey) ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS low, p_partkey, use_approval_date FROM b WHERE is_closed),
f AS (SELECT name, arg_min(coalesce(use_approval_date, DATE '9999-01-01'), 'row' || p_partkey) AS day FROM e GROUP BY 1), h AS (SELECT sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || name::BLOB) AS h, day FROM f)
SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', ('0x' || substr(h, 17, 1))::INTEGER % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS event_id, 'closed_register' AS event_type, nullif(day, DATE '9999-01-01') AS event_date FROM h
""")
def closed_events(spark, d):
    b = normalise.buildings(building_rows(spark, d)).filter("is_closed")
    rows = b.select("parcel_hash", "building_id", F.col("use_approval_date").alias("approval_date"), F.concat(F.lit("row"), "p_partkey").alias("payload"))
    return normalise.closed_events(rows).select("event_id", "event_type", "event_date")


LINKED = "SELECT o_custkey AS facility_id, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate::DATE - (o_custkey % 3 * 4000)::INTEGER END AS approved_on, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate::DATE - (o_orderkey % 4000)::INTEGER END AS permit_on, DATE '1999-01-01' + (o_orderkey % 30)::INTEGER AS observed_on FROM orders"


def linked_buildings(spark, d):
    c = F.col
    return table(spark, d, "orders").select(
        c("o_custkey").alias("facility_id"), F.when(c("o_orderkey") % 5 != 0, F.date_sub("o_orderdate", (c("o_custkey") % 3 * 4000).cast("int"))).alias("approved_on"),
        F.when(c("o_orderkey") % 3 == 0, F.date_sub("o_orderdate", (c("o_orderkey") % 4000).cast("int"))).alias("permit_on"), F.date_add(F.lit("1999-01-01").cast("date"), (c("o_orderkey") % 30).cast("int")).alias("observed_on"), F.trunc("o_orderdate", "quarter").alias("quarter"),
    )


@query(f"""
WITH b AS ({LINKED}), g AS (SELECT facility_id, count(DISTINCT approved_on) AS n, min(approved_on) AS low, max(observed_on) AS seen FROM b GROUP BY 1),
r AS (SELECT b.facility_id, coalesce(bool_or(CASE WHEN n = 1 THEN seen ELSE observed_on END - permit_on BETWEEN 0 AND 1825), false) AS recent FROM b JOIN g USING (facility_id) GROUP BY 1)
SELECT c_custkey AS facility_id, round(CASE WHEN n = 1 THEN greatest(0, (seen - low) / 365.2425) END, 6) AS age, recent AS recent_permit, CASE WHEN n IS NULL THEN 'missing' WHEN n = 1 THEN 'reported' WHEN n = 0 THEN 'missing_use_approval' ELSE 'ambiguous' END AS age_quality
FROM customer LEFT JOIN g ON g.facility_id = c_custkey LEFT JOIN r ON r.facility_id = c_custkey
""")
def building_age(spark, d):
    return rounded(marts.building_age(table(spark, d, "customer").select(F.col("c_custkey").alias("facility_id")), linked_buildings(spark, d)))


@query(f"""
WITH b AS (SELECT *, date_trunc('quarter', o.o_orderdate)::DATE AS quarter FROM (SELECT o_custkey AS facility_id, o_orderdate, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate::DATE - (o_custkey % 3 * 4000)::INTEGER END AS approved_on, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate::DATE - (o_orderkey % 4000)::INTEGER END AS permit_on, DATE '1999-01-01' + (o_orderkey % 30)::INTEGER AS observed_on FROM orders) o),
one AS (SELECT quarter, facility_id, max(approved_on) AS approved_on, max(permit_on) AS permit_on, max(observed_on) AS observed_on FROM b GROUP BY 1, 2 HAVING count(*) = 1),
a AS (SELECT quarter, greatest(0, (observed_on - approved_on) / 365.2425) AS age, coalesce(observed_on - permit_on BETWEEN 0 AND 1825, false) AS recent, rooms FROM one LEFT JOIN ({FACILITIES}) USING (facility_id) WHERE approved_on IS NOT NULL)
SELECT quarter, count(*) AS age_known, round(avg(age), 6) AS age_mean, round(median(age), 6) AS age_median, round(sum(age * rooms) FILTER (rooms > 0) / nullif(sum(rooms) FILTER (rooms > 0), 0), 6)::DOUBLE AS age_by_rooms, count(*) FILTER (age >= 20) AS age20_count, count(*) FILTER (age >= 30) AS age30_count,
  round(count(*) FILTER (age >= 20) / count(*), 6) AS age20_share, round(count(*) FILTER (age >= 30) / count(*), 6) AS age30_share, count(*) AS permit_known, count(*) FILTER (recent) AS permit_count, round(count(*) FILTER (recent) / count(*), 6) AS permit_share FROM a GROUP BY 1
""")
def past_building_measures(spark, d):
    return rounded(marts.past_building_measures(linked_buildings(spark, d), facilities(spark, d), ["quarter"]))


@query("""
WITH r AS (SELECT c_nationkey AS district, year(o_orderdate)::INTEGER AS year, o_custkey AS facility_id, CASE o_orderstatus WHEN 'F' THEN 'tourist_accommodations' WHEN 'O' THEN 'foreigner_city_homestays' ELSE 'lodgings' END AS source_id, o_orderkey % 5 AS record_id FROM orders JOIN customer ON o_custkey = c_custkey),
p AS (SELECT district, year, facility_id, count(DISTINCT (source_id, record_id)) AS n, bool_or(source_id = 'tourist_accommodations') AS t, bool_or(source_id = 'foreigner_city_homestays') AS f FROM r GROUP BY 1, 2, 3)
SELECT district, year, count(*) AS facilities, sum(n)::BIGINT AS registrations, round(count(*) FILTER (t) / count(*), 6) AS tourism_share, round(count(*) FILTER (f) / sum(n), 6) AS foreigner_share, round((count(*) FILTER (f) + count(*) FILTER (t)) / sum(n), 6) AS foreign_capable_share FROM p GROUP BY 1, 2
""")
def historical_shares(spark, d):
    o = table(spark, d, "orders").join(table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("district")), F.col("o_custkey") == F.col("c_custkey"))
    status = F.col("o_orderstatus")
    records = o.select("district", F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("facility_id"), F.when(status == "F", "tourist_accommodations").when(status == "O", "foreigner_city_homestays").otherwise("lodgings").alias("source_id"), (F.col("o_orderkey") % 5).alias("record_id"))
    return rounded(marts.period_shares(records, ["district", "year"]))


@query("""
WITH r AS (SELECT o_custkey, o_orderkey, o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate::DATE DESC, o_orderkey DESC) = 1)
SELECT o_custkey, o_orderkey, l_partkey AS building_id FROM r LEFT JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'R') ON l_orderkey = o_orderkey
""")
def latest_complete_buildings(spark, d):
    snapshots = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"))
    seen = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("building_id")).distinct()
    return latest.latest_snapshot(snapshots.filter("day < DATE '1997-01-01'"), ["o_custkey"], [F.desc("day"), F.desc("o_orderkey")], seen, ["o_orderkey"]).drop("day")


@query("""
WITH c AS (SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT o_custkey, o_orderkey, l_linenumber, l_partkey FROM c JOIN lineitem ON l_orderkey = o_orderkey QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1
""")
def component_then_snapshot(spark, d):
    component = latest.latest(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    order = [F.desc(c) for c in ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey")]
    return latest.latest(component.join(lines, "o_orderkey"), ["o_custkey"], order, ties="reject").select("o_custkey", "o_orderkey", "l_linenumber", "l_partkey")


@query("""
WITH r AS (SELECT l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, rank() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC) AS place FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (CASE WHEN count(DISTINCT (l_partkey, l_suppkey)) OVER (PARTITION BY l_orderkey) = 1 THEN 1 ELSE count(*) OVER (PARTITION BY l_orderkey) END)::BIGINT AS tied FROM r WHERE place = 1
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey) = 1
""")
def latest_with_ties(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey")
    return latest.latest(lines, ["l_orderkey"], [F.desc("l_shipdate"), F.desc("l_linenumber")], ties="report").drop("l_shipdate")


@query("""
SELECT least(l_partkey, l_suppkey) AS left_key, greatest(l_partkey, l_suppkey) AS right_key, l_returnflag AS ruling FROM lineitem
QUALIFY row_number() OVER (PARTITION BY least(l_partkey, l_suppkey), greatest(l_partkey, l_suppkey) ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_returnflag DESC) = 1
""")
def latest_rulings(spark, d):
    rulings = table(spark, d, "lineitem").select(F.col("l_partkey").alias("left_key"), F.col("l_suppkey").alias("right_key"), F.col("l_returnflag").alias("ruling"), "l_shipdate", "l_orderkey", "l_linenumber")
    return matching.latest_rulings(rulings, [F.desc("l_shipdate"), F.desc("l_orderkey"), F.desc("l_linenumber"), F.desc("ruling")]).select("left_key", "right_key", "ruling")


@query(f"""
{LICENCE_SQL} SELECT o_custkey, o_orderkey, lot_address FROM (SELECT l.*, o.o_custkey FROM licences l JOIN orders o USING (o_orderkey)) WHERE lot_address IS NOT NULL AND region_quality = 'resolved'
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY observed_on DESC, o_orderkey DESC) = 1
""")
def latest_eligible_address(spark, d):
    ids = licence_rows(spark, d).join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")
    rows = ids.select("source_id", F.struct("o_custkey", "o_orderkey", "observed_on").alias("of"), "row")
    fit = normalise.licences(rows, "of").filter("lot_address IS NOT NULL AND region_quality = 'resolved'").select("observed_on.*", "lot_address")
    return latest.latest(fit, ["o_custkey"], [F.desc("observed_on"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", "lot_address")


@query("""
SELECT user_id, event_type IN ('purchase', 'signup') AS designated, ts::DATE AS since FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def designation_state(spark, d):
    e = latest.latest(table(spark, d, "events").select("user_id", "event_type", "ts", "event_id"), ["user_id"], [F.desc("ts"), F.desc("event_id")])
    return e.select("user_id", F.col("event_type").isin("purchase", "signup").alias("designated"), F.to_date("ts").alias("since"))


@query(f"""
{LICENCE_SQL}, s AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (source_record_id IS NULL)::DOUBLE AS bare, count(*) FILTER (license_date_quality = 'parsed')::DOUBLE AS dated, count(*) FILTER (region_quality = 'resolved') / count(*) AS linked, (count(*) - count(DISTINCT coalesce(source_record_id, '-') )) / count(*) AS doubled FROM licences)
SELECT 'run_inputs_present' AS check_name, CASE WHEN n >= 1 THEN 'pass' ELSE 'fail' END AS status, n AS actual, '>=1' AS expected, 'required' AS severity FROM s
UNION ALL SELECT 'required_record_structure', CASE WHEN bare <= 0 THEN 'pass' ELSE 'fail' END, bare, '<=0', 'required' FROM s UNION ALL SELECT 'date_parse_success', CASE WHEN dated >= 1 THEN 'pass' ELSE 'fail' END, dated, '>=1', 'required' FROM s
UNION ALL SELECT 'building_link_coverage', CASE WHEN linked >= 0.7 THEN 'pass' ELSE 'warning' END, round(linked, 6), '>=0.7', 'warning' FROM s UNION ALL SELECT 'unresolved_duplicates', CASE WHEN doubled <= 0.1 THEN 'pass' ELSE 'warning' END, round(doubled, 6), '<=0.1', 'warning' FROM s
""")
def gate_checks(spark, d):
    n = F.count(F.lit(1))
    checks = [
        quality.Check("run_inputs_present", n, least=1),
        quality.Check("required_record_structure", F.count_if(F.col("source_record_id").isNull()), most=0),
        quality.Check("date_parse_success", F.count_if(F.col("license_date_quality") == "parsed"), least=1),
        quality.Check("building_link_coverage", agg.share(F.col("region_quality") == "resolved"), least=0.7, severity="warning"),
        quality.Check("unresolved_duplicates", (n - F.count_distinct(F.coalesce("source_record_id", F.lit("-")))) / n, most=0.1, severity="warning"),
    ]
    return rounded(quality.run_checks(normalise.licences(licence_rows(spark, d)), checks))


# -- demand and transport ----------------------------------------------------

SOURCES = ["tourism_data_lab", "area_tourism_demand", "area_tourism_consumption", "tourism_concentration_rate", "area_tourism_destination_division", "unknown"]
VALUES = ["12", "1,234.5", "", "n/a", "7.0"]
TOWNS = ["강서구", "해운대구", "중구", "없는구", ""]
SCOPES = ["26440", "11110", "264", None]
INDICATORS = ["2101", "2103", "2201", "1105", "3301", "A-1", None]


def demand_rows(spark, d):
    k, v = "event_id", pick(VALUES, "event_id")
    fields = {
        "touNum": F.when(F.expr(f"{k} % 6 = 0"), v), "tarSjrnDsIxVal": F.when(F.expr(f"{k} % 6 = 1 AND {k} % 4 <> 0"), v), "tarExpDsIxVal": F.when(F.expr(f"{k} % 6 = 1"), F.lit("5")), "culResDemIxVal": F.when(F.expr(f"{k} % 6 = 2"), v), "cnctrRate": F.when(F.expr(f"{k} % 6 = 3"), v), "intlDivIxVal": F.when(F.expr(f"{k} % 6 = 4"), v),
        "tarSjrnDsIxCd": pick(INDICATORS, "user_id"), "tarExpDsIxCd": pick(INDICATORS, "user_id + 1"), "culResDemIxCd": pick(INDICATORS, "user_id + 2"), "intlDivIxCd": pick(INDICATORS, "user_id"),
        "signguCode": pick(SCOPES, "user_id"), "signguNm": pick(TOWNS, "user_id"), "baseYm": pick(["202401", "2024-02", "x"], k), "baseYmd": pick(["20240105", "2024-02-06", "2024"], k), "note": F.lit("n"),
    }
    row = F.map_filter(F.create_map(*(x for n, c in fields.items() for x in (F.lit(n), c))), lambda _, x: x.isNotNull())
    return table(spark, d, "events").select(k, pick(SOURCES, k).alias("source_id"), row.alias("row"))


DEMAND_SQL = f"""
WITH r AS (SELECT event_id, event_id % 6 AS s, {sql_pick(SOURCES, "event_id")} AS source_id, {sql_pick(VALUES, "event_id")} AS v, {sql_pick(INDICATORS, "user_id")} AS i0, {sql_pick(INDICATORS, "user_id + 1")} AS i1, {sql_pick(INDICATORS, "user_id + 2")} AS i2,
  {sql_pick(SCOPES, "user_id")} AS scope, nullif(trim({sql_pick(TOWNS, "user_id")}), '') AS district, {sql_pick(["202401", "2024-02", "x"], "event_id")} AS ym, replace({sql_pick(["20240105", "2024-02-06", "2024"], "event_id")}, '-', '') AS ymd FROM events),
m AS (SELECT *, CASE WHEN s = 1 AND event_id % 4 <> 0 AND v <> '' THEN 'area_tar_sjrn_ds_list' WHEN s = 1 THEN 'area_tar_exp_ds_list' WHEN v = '' THEN NULL WHEN s = 0 THEN 'locgo_regn_visitr_dd_list.visitor_count' WHEN s = 2 THEN 'area_cul_res_dem_list' WHEN s = 3 THEN 'tats_cnctr_rated_list.visitor_concentration_rate' WHEN s = 4 THEN 'area_intl_div_list' END AS base FROM r),
f AS (SELECT *, CASE WHEN base = 'area_tar_exp_ds_list' THEN '5' ELSE nullif(v, '') END AS value, CASE base WHEN 'area_tar_sjrn_ds_list' THEN i0 WHEN 'area_tar_exp_ds_list' THEN i1 WHEN 'area_cul_res_dem_list' THEN i2 WHEN 'area_intl_div_list' THEN i0 END AS code, base IN ('area_tar_sjrn_ds_list', 'area_tar_exp_ds_list', 'area_cul_res_dem_list', 'area_intl_div_list') AS coded,
  CASE WHEN s IN (0, 3) THEN CASE WHEN length(ymd) = 8 THEN ymd[1:4] || '-' || ymd[5:6] || '-' || ymd[7:8] END WHEN ym <> 'x' THEN replace(ym, '-', '')[1:4] || '-' || replace(ym, '-', '')[5:6] END AS period, {GROUP_CASE.format(d="district")} AS region_group FROM m)
SELECT event_id, source_id, CASE WHEN coded THEN base || '.' || CASE WHEN code = 'A-1' THEN 'a_1' ELSE code END ELSE base END AS metric_code,
  CASE WHEN base IS NULL THEN NULL WHEN base LIKE 'locgo%' THEN 'count' WHEN base LIKE 'tats%' THEN 'percent' WHEN base = 'area_tar_sjrn_ds_list' AND code = '2101' THEN 'ratio' WHEN base = 'area_tar_sjrn_ds_list' AND code = '2103' THEN 'count' WHEN base = 'area_tar_exp_ds_list' AND code = '2201' THEN 'KRW' WHEN base = 'area_intl_div_list' AND code = '3301' THEN 'KRW' ELSE 'source_native' END AS unit,
  period, district, region_group, CASE WHEN base IS NOT NULL THEN TRY_CAST(replace(value, ',', '') AS DOUBLE) END AS metric_value,
  CASE WHEN s = 0 AND (scope IS NULL OR length(scope) <> 5) THEN 'bad_scope_code' WHEN s = 0 AND scope NOT LIKE '26%' THEN 'out_of_scope' WHEN period IS NULL THEN 'bad_period' WHEN region_group IS NULL THEN 'unknown_district' WHEN value IS NULL OR base IS NULL THEN 'no_metric' WHEN coded AND code IS NULL THEN 'no_indicator' WHEN TRY_CAST(replace(value, ',', '') AS DOUBLE) IS NULL THEN 'not_numeric' END AS reject
FROM f
"""


@query(DEMAND_SQL)
def demand_facts(spark, d):
    return normalise.demand(demand_rows(spark, d)).drop("dimensions")


@query(f"SELECT event_id, metric_code FROM ({DEMAND_SQL}) WHERE reject IS NULL AND metric_code LIKE 'area_tar_exp_ds_list.%'")
def demand_of_operation(spark, d):
    return normalise.of_operation(normalise.demand(demand_rows(spark, d)).filter("reject IS NULL"), "areaTarExpDsList").select("event_id", "metric_code")


SIDES = ["승차", " 하차 ", "환승", None]
TOTALS = ["100", "1,200", "", None, "x"]


def metro_rows(spark, d):
    fields = {"역명": pick(["하단", "서면", "없는역", None], "user_id"), "구분": pick(SIDES, "event_id"), "년월일": F.date_format("ts", "yyyyMMdd"), "호선": F.lit("1"), "합계": pick(TOTALS, "event_id"), "05시-06시": pick(["3", "", None], "user_id"), "06시-07시": pick(["4", "5"], "event_id"), "비고": pick(["-", "x", None], "event_id"), "역번호": pick(["095", None], "user_id")}
    fields["06시-07시"] = F.when(F.expr("event_id % 3 = 0"), fields["06시-07시"])
    row = F.map_filter(F.create_map(*(x for n, c in fields.items() for x in (F.lit(n), c))), lambda _, x: x.isNotNull())
    return table(spark, d, "events").select("event_id", row.alias("row"))


@query(f"""
WITH r AS (SELECT event_id, user_id, {sql_pick(["하단", "서면", "없는역", None], "user_id")} AS station, trim({sql_pick(SIDES, "event_id")}) AS side, date_trunc('month', ts)::DATE AS period, nullif({sql_pick(TOTALS, "event_id")}, '') AS t, nullif({sql_pick(["3", "", None], "user_id")}, '') AS h5, CASE WHEN event_id % 3 = 0 THEN {sql_pick(["4", "5"], "event_id")} END AS h6 FROM events),
m AS (SELECT r.*, 'total' AS scope, NULL AS hour_band, t AS v FROM r WHERE t IS NOT NULL UNION ALL SELECT r.*, 'hourly', '05시-06시', h5 FROM r WHERE h5 IS NOT NULL UNION ALL SELECT r.*, 'hourly', '06시-07시', h6 FROM r WHERE h6 IS NOT NULL UNION ALL SELECT r.*, NULL, NULL, NULL FROM r WHERE t IS NULL AND h5 IS NULL AND h6 IS NULL)
SELECT event_id, CASE side WHEN '승차' THEN 'metro_boarding' WHEN '하차' THEN 'metro_alighting' END AS metric_code, period, station, '1' AS line, CASE station WHEN '하단' THEN '사하구' WHEN '서면' THEN '부산진구' ELSE 'UNMAPPED' END AS district, scope, hour_band, TRY_CAST(replace(v, ',', '') AS DOUBLE) AS metric_value, 'passengers' AS unit,
  {sql_pick(["095", None], "user_id")} AS station_number, {GROUP_CASE.format(d="(CASE station WHEN '하단' THEN '사하구' WHEN '서면' THEN '부산진구' END)")} AS region_group,
  array_to_string(list_filter([CASE WHEN side IN ('승차', '하차') THEN 'flow_direction=' || CASE side WHEN '승차' THEN 'boarding' ELSE 'alighting' END END, 'line=1', 'station=' || station, 'station_number=' || {sql_pick(["095", None], "user_id")}, '비고=' || {sql_pick(["-", "x", None], "event_id")}, '역명=' || station, '역번호=' || {sql_pick(["095", None], "user_id")}, '호선=1'], lambda x: x IS NOT NULL), ';') AS dimensions,
  CASE WHEN side IS NULL OR side NOT IN ('승차', '하차') THEN 'no_direction' WHEN scope IS NULL THEN 'no_measure' WHEN TRY_CAST(replace(v, ',', '') AS DOUBLE) IS NULL THEN 'not_numeric' WHEN station IS NULL THEN 'no_station' END AS reject FROM m
""")
def metro_measures(spark, d):
    out = normalise.metro(metro_rows(spark, d), {"하단": "사하구", "서면": "부산진구"})
    said = F.transform(F.array_sort(F.map_entries("dimensions")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return out.withColumn("dimensions", F.array_join(said, ";"))


@query(f"""
SELECT event_id, concat_ws(' ', '경남', '김해시') AS origin, nullif(concat_ws(' ', '부산광역시', {sql_pick(TOWNS, "user_id")}), '') AS destination, 'bus' AS mode, strftime(ts, '%Y-%m') AS period, CASE WHEN {GROUP_CASE.format(d=sql_pick(TOWNS, "user_id"))} IS NOT NULL THEN {sql_pick(TOWNS, "user_id")} ELSE 'UNMAPPED' END AS district,
  'public_transport_od_volume' AS metric_code, TRY_CAST(replace({sql_pick(VALUES, "event_id")}, ',', '') AS DOUBLE) AS metric_value, 'passengers' AS unit, CASE WHEN TRY_CAST(replace({sql_pick(VALUES, "event_id")}, ',', '') AS DOUBLE) IS NULL THEN 'not_numeric' END AS reject FROM events
""".replace("concat_ws(' ', '부산광역시', list_extract", "concat_ws(' ', '부산광역시', nullif(list_extract").replace("::BIGINT)), '') AS destination", "::BIGINT), '')), '') AS destination"))
def trip_volumes(spark, d):
    fields = {"opr_ym": F.date_format("ts", "yyyyMM"), "dptre_ctpv_nm": F.lit("경남"), "dptre_sgg_nm": F.lit("김해시"), "arvl_ctpv_nm": F.lit("부산광역시"), "arvl_sgg_nm": pick(TOWNS, "user_id"), "trfvlm_se": F.lit("bus"), "trfvlm": pick(VALUES, "event_id")}
    rows = table(spark, d, "events").select("event_id", F.create_map(*(x for n, c in fields.items() for x in (F.lit(n), c))).alias("row"))
    return normalise.trips(rows).drop("dimensions")


# -- periods, preferences, gates, public values ------------------------------


@query("""
SELECT n_name AS district, 'current' AS period FROM nation UNION
SELECT n_name, strftime(o_orderdate, '%Y-%m') FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey UNION
SELECT n_name, strftime(o_orderdate + INTERVAL 45 DAY, '%Y-%m') FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'F' UNION
SELECT n_name, '2024-0' || (event_id % 9 + 1) FROM events JOIN nation ON user_id % 30 = n_nationkey
""")
def district_periods(spark, d):
    places = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("district"))
    o = table(spark, d, "orders").join(places, F.col("o_custkey") == F.col("c_custkey")).select("district", "o_orderdate", F.when(F.col("o_orderstatus") == "F", F.date_add("o_orderdate", 45)).alias("closed"))
    facts = table(spark, d, "events").select(F.concat(F.lit("NATION_"), F.col("user_id") % 30).alias("district"), F.concat(F.lit("2024-0"), F.col("event_id") % 9 + 1, F.lit("-15")).alias("period"))
    return marts.district_periods(districts(spark, d).select("district"), [(o, "o_orderdate"), (o, "closed")], [(facts, "period")])


@query("""
SELECT p_brand, p_type, p_partkey FROM (SELECT p_brand, p_type, p_partkey, CASE WHEN p_size % 3 = 0 THEN '*' WHEN p_size % 3 = 1 THEN '2024' ELSE '2023' END AS part FROM part)
WHERE part IN ('2024', '*') QUALIFY row_number() OVER (PARTITION BY p_brand, p_type ORDER BY CASE WHEN part = '2024' THEN 0 ELSE 1 END, p_partkey) = 1
""")
def preferred_partition(spark, d):
    size = F.col("p_size") % 3
    p = table(spark, d, "part").select("p_brand", "p_type", "p_partkey", F.when(size == 0, "*").when(size == 1, "2024").otherwise("2023").alias("part"))
    least = p.groupBy("p_brand", "p_type", "part").agg(F.min("p_partkey").alias("p_partkey"))
    return quality.preferred(least, ["p_brand", "p_type"], "part", F.lit("2024")).drop("part")


@query("""
WITH d AS (SELECT DISTINCT o_custkey AS key FROM orders), l AS (SELECT DISTINCT o_custkey AS key FROM orders WHERE o_orderstatus = 'F'), r AS (SELECT c_custkey AS key FROM customer WHERE c_acctbal > 5000)
SELECT count(*) AS designations, count(l.key) AS linked, count(*) FILTER (l.key IS NULL AND r.key IS NOT NULL) AS explicit_reviews, round((count(l.key) + count(*) FILTER (l.key IS NULL AND r.key IS NOT NULL)) / count(*), 6) AS coverage,
  CASE WHEN count(*) FILTER (l.key IS NULL AND r.key IS NULL) > 0 THEN 'warning' ELSE 'pass' END AS status FROM d LEFT JOIN l USING (key) LEFT JOIN r USING (key)
""")
def designation_coverage(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("key"), "o_orderstatus")
    return rounded(quality.designation_coverage(o, o.filter("o_orderstatus = 'F'"), table(spark, d, "customer").filter("c_acctbal > 5000").select(F.col("c_custkey").alias("key"))))


@query("""
SELECT c.n AS current, p.n AS previous, round(abs(c.n - p.n) / p.n, 6) AS change, CASE WHEN abs(c.n - p.n) / p.n <= 0.2 THEN 'pass' ELSE 'warning' END AS status FROM (SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F') c, (SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'O') p
""")
def active_change(spark, d):
    o = table(spark, d, "orders")
    count = lambda s: o.filter(F.col("o_orderstatus") == s).agg(F.count(F.lit(1)).alias("n"))
    return rounded(quality.active_change(count("F"), count("O")))


@query("SELECT 'entity_auto_merge_calibration' AS check_name, CASE WHEN count(*) = 0 THEN 'skipped' ELSE 'available' END AS status, count(*) AS n_pairs, 'informational' AS severity FROM labels")
def calibration_notice(spark, d):
    return quality.calibration_notice(table(spark, d, "labels"))


TEXTS = ["fine text", "", None, "see C:\\temp", "/etc/passwd", "a/b", "../up", "http://x", "www.x.kr", "password: abc", "token=1", "Bearer abcdef", "AKIA" + "A1" * 8, "ratio 1/2", "key akia" + "b2" * 8, "AIza" + "Sy_" * 11, "sk-" + "k" * 16, "sk-short", "glpat-12345678", "xoxb-1234-5678", "eyJa.eyJb.12345678", "sk_live_1", "ghp_" + "x" * 20]


@query(f"""
SELECT c_custkey, coalesce(length(t) > 0 AND NOT regexp_matches(t, '[A-Za-z]:[\\\\/]') AND NOT regexp_matches(t, '(^|[^A-Za-z0-9])/[A-Za-z0-9._~-]+(/|$)') AND NOT regexp_matches(t, '(^|[\\\\/])[.][.]([\\\\/]|$)') AND NOT regexp_matches(t, '(?i)(https?|ftp|file)://|\\bwww[.]')
  AND NOT regexp_matches(t, '(?i)(password|passwd|secret|token|api[_-]?key|servicekey|authorization)\\s*[:=]\\s*\\S+') AND NOT regexp_matches(t, '(?i)\\bbearer\\s+[A-Za-z0-9._~+/=-]+') AND NOT regexp_matches(t, '(?i)\\b(AKIA[0-9A-Z]{{16}}|sk-[A-Za-z0-9_-]{{16,}}|AIza[0-9A-Za-z_-]{{30,}}|eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]{{8,}}|glpat-[A-Za-z0-9_-]{{8,}}|(xox[a-z]?|xapp)-[A-Za-z0-9-]{{8,}}|gh[pousr]_[A-Za-z0-9]{{20,255}})\\b') AND NOT regexp_matches(t, '(?i)\\b(sk|pk)_(live|test)_[A-Za-z0-9]+'), false) AS text_ok,
  coalesce(c_acctbal >= 0 AND c_acctbal <= 9000, true) AS number_ok, c_acctbal / 30 BETWEEN -180 AND 180 AND c_custkey % 100 BETWEEN -90 AND 90 AS position_ok, round(c_acctbal / 7, 9) AS position
FROM (SELECT *, {sql_pick(TEXTS, "c_custkey")} AS t FROM customer)
""")
def public_values(spark, d):
    c = table(spark, d, "customer").withColumn("t", pick(TEXTS, "c_custkey"))
    x = F.col("c_acctbal")
    return c.select("c_custkey", quality.public_text(F.col("t")).alias("text_ok"), quality.public_number(x, 9000).alias("number_ok"), quality.public_position(x / 30, F.col("c_custkey") % 100).alias("position_ok"), parsing.rounded_position(x / 7).alias("position"))


@query(f"""
SELECT facility_id, CASE WHEN r IS NULL OR r <= 0 OR q <> 'reported' THEN 'unavailable' WHEN r <= 10 THEN 'high' WHEN r <= 20 THEN 'medium' ELSE 'low' END AS room_band, CASE WHEN a IS NULL OR a < 0 OR n <> 1 THEN 'unavailable' WHEN a >= 30 THEN 'high' WHEN a >= 20 THEN 'medium' ELSE 'low' END AS age_band
FROM (SELECT facility_id, rooms - 5 AS r, age - 3 AS a, CASE WHEN facility_id % 5 = 0 THEN 'conflicting' ELSE 'reported' END AS q, facility_id % 4 AS n FROM ({FACILITIES}))
""")
def rating_bounds(spark, d):
    key = F.col("facility_id")
    quality_of = F.when(key % 5 == 0, "conflicting").otherwise("reported")
    return facilities(spark, d).select("facility_id", spatial.room_rating(F.col("rooms") - 5, quality_of).alias("room_band"), spatial.age_rating(F.col("age") - 3, F.lit("reported"), key % 4).alias("age_band"))


@query(f"SELECT district, array_to_string(list_sort(list(DISTINCT rooms)), ',') AS rooms FROM ({FACILITIES}) WHERE rooms IS NOT NULL GROUP BY 1")
def sorted_values(spark, d):
    return facilities(spark, d).filter("rooms IS NOT NULL").groupBy("district").agg(F.array_join(agg.sorted_distinct(F.col("rooms")), ",").alias("rooms"))


YEARS = ["2024", "24x", None, "2,024"]
MONTHS = ["1", "12", "13", "0", None, "07"]


@query(f"""
WITH t AS (SELECT o_orderkey, o_orderdate::DATE AS d, replace({sql_pick(YEARS, "o_orderkey")}, ',', '') AS y, {sql_pick(MONTHS, "o_orderkey")} AS m FROM orders)
SELECT o_orderkey, (date_trunc('month', d) - INTERVAL 1 MONTH)::DATE AS last_complete, (year(d) * 12 + month(d) - 1)::INTEGER AS index, CASE WHEN TRY_CAST(y AS INTEGER) BETWEEN 1 AND 9999 AND TRY_CAST(m AS INTEGER) BETWEEN 1 AND 12 THEN make_date(y::INTEGER, m::INTEGER, 1) END AS from_columns, (o_orderkey % 14 + 1)::INTEGER AS n_months, greatest(1, ceil(o_orderkey % 40 / 9.0))::BIGINT AS pages
FROM t
""")
def month_arithmetic(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"), pick(YEARS, "o_orderkey").alias("y"), pick(MONTHS, "o_orderkey").alias("m"))
    month = F.trunc("d", "month")
    span = F.concat(F.date_format(month, "yyyy-MM"), F.lit(".."), F.date_format(F.add_months(month, (F.col("o_orderkey") % 14).cast("int")), "yyyy-MM"))
    return o.select("o_orderkey", parsing.last_complete_month(F.col("d")).alias("last_complete"), parsing.month_index(F.col("d")).alias("index"), parsing.year_month(F.col("y"), F.col("m")).alias("from_columns"), F.size(parsing.period_months(span)).alias("n_months"), parsing.expected_pages(F.col("o_orderkey") % 40, F.lit(9)).alias("pages"))


PHONES = [None, "", "051-123 4567", "+82 (51) 1", "none"]
SLUGS = ["Hello, World", "  a--b ", "", "한글 x", "A"]


@query(f"""
WITH t AS (SELECT o_orderkey, {sql_pick(PHONES, "o_orderkey")} AS p, {sql_pick(SLUGS, "o_orderkey")} AS s, nullif(trim(regexp_replace({sql_pick(ROADS, "o_orderkey")}, '\\s+', ' ', 'g')), '') AS a FROM orders)
SELECT o_orderkey, nullif(regexp_replace(p, '[^0-9]', '', 'g'), '') AS phone, trim(lower(regexp_replace(s, '[^\\p{{L}}\\p{{N}}]', '_', 'g')), '_') AS slug, a AS address, {CITY.format("a")} AS in_city, CASE WHEN {CITY.format("a")} THEN nullif(regexp_extract(a, '([가-힣]+(구|군))', 1), '') END AS district FROM t
""")
def text_keys(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", pick(PHONES, "o_orderkey").alias("p"), pick(SLUGS, "o_orderkey").alias("s"), pick(ROADS, "o_orderkey").alias("a"))
    return o.select("o_orderkey", parsing.phone_digits(F.col("p")).alias("phone"), parsing.slug(F.col("s")).alias("slug"), parsing.address_key(F.col("a")).alias("address"), parsing.in_city(F.col("a")).alias("in_city"), parsing.district_token(F.col("a")).alias("district"))


@query("""
SELECT l_orderkey, l_linenumber, round(CASE WHEN l_quantity % 5 <> 0 THEN abs(l_extendedprice - l_tax) / nullif(l_quantity % 5, 0) END, 6) AS change, l_discount < 0.05 AS finite, abs(l_quantity - l_quantity * (1 + l_discount / 1e8)) <= 1e-9 * greatest(l_quantity, l_quantity * (1 + l_discount / 1e8)) AS alike FROM lineitem
""")
def math_guards(spark, d):
    q, k = F.col("l_quantity"), F.col("l_discount")
    x = F.when(k < 0.05, q).when(k < 0.07, F.lit(float("inf"))).when(k < 0.09, F.lit(float("nan")))
    # |(a - b)| / |b| with a - b = price - tax and b = quantity modulo 5
    change = parsing.relative_change(F.col("l_extendedprice") - F.col("l_tax") + q % 5, q % 5)
    return rounded(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", change.alias("change"), parsing.is_finite(x).alias("finite"), parsing.close(q, q * (1 + k / 1e8)).alias("alike")))


# -- evidence ----------------------------------------------------------------

EVIDENCE_SQL = f"""
WITH m AS (SELECT district, count(*)::DOUBLE AS f, count(rooms)::DOUBLE AS known, sum(rooms)::DOUBLE AS rs, count(*) FILTER (rooms <= 20)::DOUBLE AS small, count(*) FILTER (tourism)::DOUBLE AS tf, CASE WHEN count(*) FILTER (tourism AND rooms IS NULL) = 0 THEN coalesce(sum(rooms) FILTER (tourism), 0) END::DOUBLE AS tr, count(rooms) FILTER (tourism)::DOUBLE AS trk,
  sum(foreigner)::DOUBLE AS fr, sum(foreign_capable)::DOUBLE AS fc, sum(registrations)::DOUBLE AS regs, count(age)::DOUBLE AS ak, count(*) FILTER (age >= 20)::DOUBLE AS a20, count(*) FILTER (age >= 30)::DOUBLE AS a30, count(recent_permit)::DOUBLE AS pk, count(*) FILTER (recent_permit)::DOUBLE AS pc FROM ({FACILITIES}) GROUP BY 1),
v AS (SELECT 'NATION_' || user_id % 20 AS district, round(sum(value), 4) AS visits FROM events GROUP BY 1),
j AS (SELECT m.*, visits, known / f AS rc, CASE WHEN known = f THEN rs END AS denom, CASE WHEN tf = 0 THEN 1.0 ELSE trk / tf END AS trc FROM m LEFT JOIN v USING (district)),
e AS (SELECT district, unnest([
  {{'metric': 'physical_facility_count', 'n': f, 'd': 1.0, 'k': 1.0, 'c': 1.0, 's': ''}}, {{'metric': 'room_coverage', 'n': known, 'd': f, 'k': 1.0, 'c': rc, 's': ''}}, {{'metric': 'small_facility_share', 'n': small, 'd': known, 'k': 1.0, 'c': rc, 's': ''}},
  {{'metric': 'visitor_person_days_per_100_rooms', 'n': visits, 'd': denom, 'k': 100.0, 'c': CASE WHEN visits IS NOT NULL THEN rc END, 's': CASE WHEN visits IS NULL THEN 'no_' ELSE '' END}}, {{'metric': 'lodging_consumption_per_room', 'n': NULL, 'd': denom, 'k': 1.0, 'c': NULL, 's': 'incompatible'}}, {{'metric': 'transport_inflow_per_room', 'n': NULL, 'd': denom, 'k': 1.0, 'c': NULL, 's': 'no_'}},
  {{'metric': 'tourism_registration_facility_share', 'n': tf, 'd': f, 'k': 1.0, 'c': 1.0, 's': ''}}, {{'metric': 'tourism_registration_room_share', 'n': tr, 'd': denom, 'k': 1.0, 'c': least(rc, trc), 's': ''}}, {{'metric': 'foreigner_city_homestay_registration_share', 'n': fr, 'd': regs, 'k': 1.0, 'c': 1.0, 's': ''}}, {{'metric': 'foreign_visitor_capable_registration_share', 'n': fc, 'd': regs, 'k': 1.0, 'c': 1.0, 's': ''}},
  {{'metric': 'building_20y_share', 'n': a20, 'd': ak, 'k': 1.0, 'c': ak / f, 's': ''}}, {{'metric': 'building_30y_share', 'n': a30, 'd': ak, 'k': 1.0, 'c': ak / f, 's': ''}}, {{'metric': 'recent_five_year_permit_event_share', 'n': pc, 'd': pk, 'k': 1.0, 'c': pk / f, 's': ''}}, {{'metric': 'visitor_growth_minus_room_supply_growth', 'n': NULL, 'd': NULL, 'k': 1.0, 'c': NULL, 's': ''}}]) AS e FROM j),
x AS (SELECT district, e.metric AS metric, CASE WHEN e.n IS NOT NULL AND e.d > 0 THEN e.n * e.k / e.d END AS value, e.n AS numerator, e.d AS denominator, e.c AS coverage, e.s AS s FROM e)
SELECT district, metric, round(value, 6) AS value, round(numerator, 6) AS numerator, round(denominator, 6) AS denominator, round(coverage, 6)::DOUBLE AS coverage, CASE WHEN value IS NOT NULL AND coverage >= 0.8 THEN 'good' WHEN value IS NOT NULL THEN 'warning' WHEN s <> '' THEN 'incompatible' ELSE 'insufficient' END AS quality FROM x
"""


@query(EVIDENCE_SQL)
def district_evidence(spark, d):
    f = facilities(spark, d)
    visits = table(spark, d, "events").groupBy(F.concat(F.lit("NATION_"), F.col("user_id") % 20).alias("district")).agg(F.round(F.sum("value"), 4).alias("visits"))
    stock = marts.measured_stock(f, ["district"], marts.evidence_counts())
    none = F.lit(None).cast("double")
    flows = {"visitor_person_days_per_100_rooms": (F.col("visits"), F.when(F.col("visits").isNotNull(), 1.0), F.when(F.col("visits").isNull(), "no_rows").otherwise("visitors")), "lodging_consumption_per_room": (none, none, F.lit("incompatible_units")), "transport_inflow_per_room": (none, none, F.lit("no_rows"))}
    return rounded(marts.metric_evidence(stock.join(visits, "district", "left"), ["district"], marts.district_evidence_specs(flows)))
