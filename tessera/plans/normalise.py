"""Provider rows (a column `row` of names and texts) to typed records: licences, buildings, demand, metro and trips.

A row that can't be used keeps a `reject` reason instead of ending the job; filters on it split good rows from bad ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import parsing as p
from tessera.functions.status import status_class
from tessera.functions.text import name_key, nfkc
from tessera.sources.pages import aliased

# The city's districts by group.
DISTRICTS = {
    "west": ("강서구", "북구", "사상구", "사하구"),
    "east": ("해운대구", "수영구", "기장군"),
    "other": ("중구", "서구", "동구", "영도구", "부산진구", "동래구", "남구", "금정구", "연제구"),
}

# The names under which the licence registers give a field.
LICENCE_FIELDS = {
    "source_record_id": ("MNG_NO", "MNGNO", "MANAGEMENT_NO", "MANAGE_NO", "관리번호"),
    "jurisdiction_code": ("OPN_ATMY_GRP_CD", "개방자치단체코드"),
    "name": ("BPLC_NM", "BPLCNM", "BIZPLC_NM", "BUSINESS_NAME", "사업장명", "업소명", "업체명"),
    "road_address": ("ROAD_NM_ADDR", "ROADNMADDR", "ROAD_ADDRESS", "도로명주소"),
    "lot_address": ("LOTNO_ADDR", "LOTNOADDR", "JIBUN_ADDR", "JIBUN_ADDRESS", "지번주소"),
    "license_date": ("LCPMT_YMD", "LICENSG_DE", "LICENS_DE", "PERMIT_DATE", "LICENSE_DATE", "인허가일자", "인허가일"),
    "closure_date": ("CLSBIZ_YMD", "CLSBIZ_DE", "CLOSURE_DATE", "CLOSE_DATE", "폐업일자", "폐업일"),
    "status_code": ("SALS_STTS_CD", "TRD_STATE_GBN", "STATE_CODE", "STATUS_CODE", "영업상태구분코드", "영업상태코드"),
    "status_name": ("SALS_STTS_NM", "TRD_STATE_NM", "STATUS_NAME", "영업상태명", "상태명"),
    "detailed_status_code": ("DTL_SALS_STTS_CD", "DTL_STATE_GBN", "상세영업상태코드"),
    "detailed_status_name": ("DTL_SALS_STTS_NM", "DTL_STATE_NM", "상세영업상태명"),
    "korean_rooms": ("KSRM_CNT", "KSRMCNT", "KOREAN_ROOM_COUNT", "한실수", "한실객실수"),
    "western_rooms": ("WSRM_CNT", "WSRMCNT", "WESTERN_ROOM_COUNT", "양실수", "양실객실수"),
    "phone": ("SITETEL", "TELNO", "TEL_NO", "PHONE", "TEL", "전화번호"),
    "longitude": ("LNG", "LONGITUDE", "경도"),
    "latitude": ("LAT", "LATITUDE", "위도"),
    "projected_x": ("XCRD",),
    "projected_y": ("YCRD",),
    "updated_at": ("LAST_MDFCN_YMD", "LAST_MOD_TS", "LAST_UPDT_DT", "UPDATE_DATE", "UPDATED_AT", "MODIFIED_AT", "최종수정일"),
    "data_updated_on": ("DATA_UPDT_YMD", "데이터기준일자"),
    "data_update_point": ("DAT_UPDT_PNT",),
}

# The names under which the building registers give a field.
BUILDING_FIELDS = {
    "building_id": ("mgmBldrgstPk", "mgmPmsrgstPk", "mgmShtregPk"),
    "sigungu_cd": ("sigunguCd",),
    "bjdong_cd": ("bjdongCd",),
    "plat_gb_cd": ("platGbCd",),
    "bun": ("bun",),
    "ji": ("ji",),
    "road_address": ("newPlatPlc", "roadAddr", "rnAdres"),
    "lot_address": ("platPlc", "jibunAddr"),
    "approval_date": ("useAprDay", "apvDay"),
    "use_approval_date": ("useAprDay",),
    "permit_date": ("archPmsDay", "pmsDay", "permitDay"),
    "main_use": ("mainPurpsCdNm", "mainPurpsCd"),
    "total_area": ("totArea", "archArea"),
    "ground_floor_count": ("grndFlrCnt",),
    "underground_floor_count": ("ugrndFlrCnt",),
    "closed_indicator": ("shterGbCdNm", "closedYn", "closureYn", "closed", "delGbn"),
}

# Fixed values: (source, field, field of its indicator code, metric, unit), in order of preference.
DEMAND_FIELDS = [
    ("tourism_data_lab", "touNum", None, "locgo_regn_visitr_dd_list.visitor_count", "count"),
    ("area_tourism_demand", "tarSjrnDsIxVal", "tarSjrnDsIxCd", "area_tar_sjrn_ds_list", "source_native"),
    ("area_tourism_demand", "tarExpDsIxVal", "tarExpDsIxCd", "area_tar_exp_ds_list", "source_native"),
    ("area_tourism_consumption", "tarSvcDemIxVal", "tarSvcDemIxCd", "area_tar_svc_dem_list", "source_native"),
    ("area_tourism_consumption", "culResDemIxVal", "culResDemIxCd", "area_cul_res_dem_list", "source_native"),
    ("tourism_concentration_rate", "cnctrRate", None, "tats_cnctr_rated_list.visitor_concentration_rate", "percent"),
    ("area_tourism_destination_division", "touDivIxVal", "touDivIxCd", "area_tou_div_list", "source_native"),
    ("area_tourism_destination_division", "expDivIxVal", "expDivIxCd", "area_exp_div_list", "source_native"),
    ("area_tourism_destination_division", "intlDivIxVal", "intlDivIxCd", "area_intl_div_list", "source_native"),
    ("related_tourism_destinations", "rlteRank", None, "area_based_list_1.related_destination_rank", "rank"),
]
# Units by indicator code, as ranges of codes.
DEMAND_UNITS = [
    ("tarSjrnDsIxCd", 2101, 2102, "ratio"),
    ("tarSjrnDsIxCd", 2103, 2105, "count"),
    ("tarExpDsIxCd", 2201, 2201, "KRW"),
    ("tarExpDsIxCd", 2202, 2202, "ratio"),
    ("tarExpDsIxCd", 2203, 2203, "KRW/person"),
    ("tarSvcDemIxCd", 1101, 1104, "SNS mentions"),
    ("tarSvcDemIxCd", 1105, 1109, "KRW"),
    ("tarSvcDemIxCd", 1110, 1112, "navigation searches"),
    ("culResDemIxCd", 1201, 1205, "navigation searches"),
    ("touDivIxCd", 3101, 3107, "count"),
    ("expDivIxCd", 3201, 3207, "KRW"),
    ("intlDivIxCd", 3301, 3301, "KRW"),
    ("intlDivIxCd", 3302, 3302, "count"),
]
# The metric prefix of each operation.
OPERATION_PREFIX = {
    "locgoRegnVisitrDDList": "locgo_regn_visitr_dd_list",
    "areaTarSjrnDsList": "area_tar_sjrn_ds_list",
    "areaTarExpDsList": "area_tar_exp_ds_list",
    "areaTarSvcDemList": "area_tar_svc_dem_list",
    "areaCulResDemList": "area_cul_res_dem_list",
    "tatsCnctrRatedList": "tats_cnctr_rated_list",
    "areaTouDivList": "area_tou_div_list",
    "areaExpDivList": "area_exp_div_list",
    "areaIntlDivList": "area_intl_div_list",
    "areaBasedList1": "area_based_list_1",
}


def district_group(district: Column) -> Column:
    """west, east or other; null for what is no district of the city."""
    known = F.create_map(*(F.lit(x) for group, names in DISTRICTS.items() for name in names for x in (name, group)))
    return F.try_element_at(known, district)


# -- licences ----------------------------------------------------------------


def licences(rows: DataFrame, observed_on: str = "observed_on") -> DataFrame:
    """One typed record a row (source_id, observed_on, row); what no known field names is kept in `extra`.

    The road address decides, unless only the lot address is in the city or there is no road address.
    """
    raw = aliased(rows, LICENCE_FIELDS)
    c = F.col
    road, lot = p.address_key(nfkc("road_address")), p.address_key(nfkc("lot_address"))
    raw = raw.withColumns({"road_address": road, "lot_address": lot})
    in_road, in_lot = p.in_city(c("road_address")), p.in_city(c("lot_address"))
    chosen = F.when((~in_road & in_lot) | c("road_address").isNull(), c("lot_address")).otherwise(c("road_address"))
    raw = raw.withColumns({"is_busan": in_road | in_lot, "district": p.district_token(chosen)})
    group = district_group(c("district"))
    rooms = p.room_count(p.whole_number(c("korean_rooms")), p.whole_number(c("western_rooms")))
    dates = {"license_date": "license_date", "closure_date": "closure_date", "source_modified": "updated_at", "data_updated": "data_updated_on"}
    date_names = {"license_date": ("license_date", "license_date_quality"), "closure_date": ("closure_date", "closure_date_quality"), "source_modified": ("source_modified_on", "source_modified_date_quality"), "data_updated": ("data_updated_on", "data_updated_date_quality")}
    return raw.select(
        "source_id", "source_record_id", "jurisdiction_code", c(observed_on).alias("observed_on"),
        c("name").alias("source_name"), name_key("name").alias("normalized_name"), "road_address", "lot_address", "district", group.alias("region_group"),
        F.when(~c("is_busan"), "not_busan").when(group.isNull(), "unresolved").otherwise("resolved").alias("region_quality"), "is_busan",
        *(x for kind, column in dates.items() for x in (p.strict_date(c(column)).alias(date_names[kind][0]), p.date_quality(c(column)).alias(date_names[kind][1]))),
        "status_code", "status_name", status_class(c("status_code")).alias("status_class"), "detailed_status_code", "detailed_status_name",
        rooms["rooms"].alias("room_count"), rooms["quality"].alias("room_count_quality"), p.phone_digits(c("phone")).alias("normalized_phone"),
        *(c(x).try_cast("double").alias(x) for x in ("longitude", "latitude", "projected_x", "projected_y")),
        F.when(F.coalesce("projected_x", "projected_y").isNotNull(), "EPSG:5174").alias("coordinate_crs"),
        c("updated_at").alias("source_updated_at"), "data_update_point", "extra",
    )


def staged(records: DataFrame) -> DataFrame:
    """Records in the city that have an id; those without a known district stay, for review."""
    return records.filter("is_busan AND source_record_id IS NOT NULL")


def jurisdiction_counts(records: DataFrame, keys: list[str], expected: Column) -> DataFrame:
    """By keys: rows of the expected authority, of another, and without one."""
    code = F.col("jurisdiction_code")
    return records.groupBy(*keys).agg(F.count_if(code == expected).alias("accepted"), F.count_if(code != expected).alias("out_of_scope"), F.count_if(code.isNull()).alias("rejected"))


# -- buildings ---------------------------------------------------------------


def buildings(rows: DataFrame) -> DataFrame:
    """Adds the typed fields of a building or permit row; dates aren't inferred."""
    raw = aliased(rows, BUILDING_FIELDS)
    c = F.col
    mark = c("closed_indicator")
    closed = F.coalesce(F.lower(mark).isin("y", "yes", "true", "1") | mark.rlike("폐쇄|말소|폐지"), F.lit(False))
    typed = {n: p.digit_code(c(n), w) for n, w in (("sigungu_cd", 5), ("bjdong_cd", 5), ("plat_gb_cd", 1), ("bun", 4), ("ji", 4))}
    typed |= {n: p.lenient_date(c(n)) for n in ("approval_date", "use_approval_date", "permit_date")}
    typed |= {"total_area": p.number(c("total_area")), **{n: p.whole_number(c(n)) for n in ("ground_floor_count", "underground_floor_count")}}
    return raw.withColumns(typed).withColumn("is_closed", closed).drop("extra")


def merged_building(titles: DataFrame, extras: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Each title with what its enrichment rows add: the first filled value in order for each field, closed if any is.

    Titles come first; `first` over an ordered struct is a minimum, so each field is one partial aggregate.
    """
    fields = [x for x in titles.columns if x not in (key, "is_closed")]
    both = titles.withColumn("_rank", F.lit(0)).unionByName(extras.join(titles.select(key).distinct(), key, "left_semi").withColumn("_rank", F.lit(1)), allowMissingColumns=True)
    place = F.struct("_rank", *order)
    return both.groupBy(key).agg(*(F.min_by(x, F.when(F.col(x).isNotNull(), place)).alias(x) for x in fields), F.bool_or("is_closed").alias("is_closed"))


def building_links(titles: DataFrame, licences_by_parcel: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Licences (source_id, source_record_id, parcel_hash) with their parcel's one title, and for parcels of several titles the
    licences to review, with the sorted candidates and their hash."""
    ids = F.array_sort(F.collect_set("building_id"))
    per = titles.filter("building_id IS NOT NULL").groupBy("parcel_hash").agg(F.count_distinct("building_id").alias("n"), F.min("building_id").alias("building_id"), ids.alias("candidates"))
    joined = licences_by_parcel.join(per, "parcel_hash")
    links = joined.filter("n = 1").select("source_id", "source_record_id", "parcel_hash", "building_id")
    review = joined.filter("n > 1").select("source_id", "source_record_id", "parcel_hash", "candidates", F.sha2(F.array_join("candidates", "|"), 256).alias("candidate_hash"))
    return links, review


URL_NAMESPACE = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"  # fixed value of RFC 4122


def closed_events(rows: DataFrame) -> DataFrame:
    """History of the closed register (parcel_hash, building_id, approval_date, payload); no row is taken for a current building."""
    name = F.concat(F.lit("closed-register:"), F.col("parcel_hash"), F.lit(":"), F.coalesce("building_id", "payload"))
    events = rows.select(p.name_uuid(URL_NAMESPACE, name).alias("event_id"), F.lit(None).cast("string").alias("building_id"), F.lit("closed_register").alias("event_type"), F.col("approval_date").alias("event_date"), F.col("payload").alias("source_payload_json"))
    return events.groupBy("event_id").agg(F.min_by(F.struct("building_id", "event_type", "event_date", "source_payload_json"), "source_payload_json").alias("e")).select("event_id", "e.*")


# -- demand and transport ----------------------------------------------------


def _field(*names: str) -> Column:
    return F.coalesce(*(F.nullif(F.try_element_at("row", F.lit(n)), F.lit("")) for n in names))


def _without(*names: str) -> Column:
    return F.map_filter("row", lambda k, _: ~k.isin(*names))


def indicator_unit(code_field: Column, code: Column) -> Column:
    unit = F.lit(None).cast("string")
    for name, low, high, said in DEMAND_UNITS:
        unit = F.when((code_field == name) & code.rlike(r"^\d{4}$") & code.try_cast("int").between(low, high), said).otherwise(unit)
    return unit


def demand(rows: DataFrame) -> DataFrame:
    """Facts from (source_id, row): metric, unit, period, district, value and the other fields as dimensions, or a reject reason.

    A national row outside the city is out_of_scope, which is no fault of its source.
    """
    source = F.col("source_id")
    value, metric, unit, field, code, code_field = (F.lit(None).cast("string") for _ in range(6))
    for name, f, cf, prefix, native in reversed(DEMAND_FIELDS):
        here = (source == name) & _field(f).isNotNull()
        said = F.lit(None).cast("string") if cf is None else _field(cf)
        slug = p.slug(said)
        full = F.lit(prefix) if cf is None else F.concat(F.lit(f"{prefix}."), slug)
        value, metric, field = F.when(here, _field(f)).otherwise(value), F.when(here, full).otherwise(metric), F.when(here, F.lit(f)).otherwise(field)
        code, code_field, unit = F.when(here, said).otherwise(code), F.when(here, F.lit(cf)).otherwise(code_field), F.when(here, native).otherwise(unit)
    daily = source.isin("tourism_data_lab", "tourism_concentration_rate")
    day = F.regexp_replace(F.trim(_field("baseYmd")), "-", "")
    month = F.date_format(p.period_month(_field("baseYm", "base_ym")), "yyyy-MM")
    period = F.when(daily, F.when(day.rlike(r"^\d{8}$"), F.concat_ws("-", F.substring(day, 1, 4), F.substring(day, 5, 2), F.substring(day, 7, 2)))).otherwise(month)
    district, scope = F.trim(_field("signguNm", "signgu_nm")), F.trim(_field("signguCode"))
    found = rows.withColumns({"_v": value, "metric_code": metric, "_f": field, "_code": code, "_cf": code_field, "_unit": unit, "period": period, "district": district, "_scope": scope})
    c = F.col
    national = source == "tourism_data_lab"
    reject = (
        F.when(national & ~F.coalesce(c("_scope").rlike(r"^\d{5}$"), F.lit(False)), "bad_scope_code")
        .when(national & ~c("_scope").startswith("26"), "out_of_scope")
        .when(c("period").isNull(), "bad_period")
        .when(district_group(c("district")).isNull(), "unknown_district")
        .when(c("_v").isNull(), "no_metric")
        .when(c("_cf").isNotNull() & c("_code").isNull(), "no_indicator")
        .when(p.number(c("_v")).isNull(), "not_numeric")
    )
    used = F.concat(F.array("_f"), F.when(daily, F.array(F.lit("baseYmd"))).otherwise(F.array(F.lit("baseYm"), F.lit("base_ym"))), F.array(F.lit("signguNm"), F.lit("signgu_nm")))
    out = found.withColumn("reject", reject).withColumn("_used", used)
    return out.select(
        *rows.columns[: rows.columns.index("row")], "metric_code", F.coalesce(indicator_unit(c("_cf"), c("_code")), "_unit").alias("unit"), "period", "district",
        district_group(c("district")).alias("region_group"), p.number(c("_v")).alias("metric_value"),
        F.map_filter("row", lambda k, _: ~F.coalesce(F.array_contains("_used", k), F.lit(False))).alias("dimensions"), "reject",
    )


def of_operation(facts: DataFrame, operation: str) -> DataFrame:
    """Facts whose metric belongs to the operation that was asked for; an unknown operation has none."""
    prefix = OPERATION_PREFIX.get(operation)
    return facts.filter(F.lit(False) if prefix is None else F.coalesce(F.col("metric_code").startswith(f"{prefix}."), F.lit(False)))


HOUR = r"^\d{2}시-\d{2}시$"


def station_district(given: Column, station: Column, stations: dict[str, str]) -> Column:
    """The given district if it is one of the city, else that of the station, else UNMAPPED."""
    own = F.when(district_group(given).isNotNull(), given)
    if stations:
        own = F.coalesce(own, F.try_element_at(F.create_map(*(F.lit(x) for pair in stations.items() for x in pair)), station))
    return F.coalesce(own, F.lit("UNMAPPED"))


def metro(rows: DataFrame, stations: dict[str, str] | None = None) -> DataFrame:
    """One row for the total and each hour that is filled, passengers of one direction; reject where there is neither or no direction.

    dimensions: the row's other fields, and station, station_number, line and flow_direction where they are known.
    """
    said = F.trim(_field("구분", "direction"))
    direction = F.when(said == "승차", "metro_boarding").when(said == "하차", "metro_alighting")
    station = F.trim(_field("역명", "station", "station_name"))
    hours = F.map_filter("row", lambda k, v: k.rlike(HOUR) & (v != ""))
    measures = F.concat(
        F.when(_field("합계", "total").isNotNull(), F.array(F.struct(F.lit("total").alias("scope"), F.lit(None).cast("string").alias("hour_band"), _field("합계", "total").alias("v")))).otherwise(F.array().cast("array<struct<scope:string,hour_band:string,v:string>>")),
        F.transform(F.array_sort(F.map_entries(hours)), lambda e: F.struct(F.lit("hourly").alias("scope"), e["key"].alias("hour_band"), e["value"].alias("v"))),
    )
    base = rows.withColumns({"metric_code": direction, "period": p.period_month(_field("년월일", "date")), "station": station, "station_number": _field("역번호", "station_number"), "line": _field("호선", "line"), "_m": measures})
    base = base.withColumn("district", station_district(_field("district", "구군", "자치구"), F.col("station"), stations or {}))
    own = {"station": F.col("station"), "station_number": F.col("station_number"), "line": F.col("line"), "flow_direction": F.regexp_replace("metric_code", "^metro_", "")}
    told = F.map_from_entries(F.filter(F.array(*(F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in own.items())), lambda e: e["value"].isNotNull()))
    rest = F.map_filter("row", lambda k, _: ~k.isin("년월일", "구분", "합계", *own) & ~k.rlike(HOUR))
    base = base.withColumns({"region_group": district_group(F.col("district")), "dimensions": F.map_concat(rest, told)})
    keep = [*rows.columns[: rows.columns.index("row")], "metric_code", "period", "station", "station_number", "line", "district", "region_group", "dimensions"]
    out = base.select(*keep, F.explode_outer("_m").alias("m")).withColumn("metric_value", p.number(F.col("m.v")))
    reject = F.when(F.col("metric_code").isNull(), "no_direction").when(F.col("m").isNull(), "no_measure").when(F.col("metric_value").isNull(), "not_numeric").when(F.col("station").isNull(), "no_station")
    return out.select(*keep, "m.scope", "m.hour_band", "metric_value", F.lit("passengers").alias("unit"), reject.alias("reject"))


def trips(rows: DataFrame) -> DataFrame:
    """Origin-destination rows as one measure each, in the district of arrival."""
    place = lambda side: F.nullif(F.concat_ws(" ", *(p.blank_to_null(_field(f"{side}_{part}_nm")) for part in ("ctpv", "sgg", "emd"))), F.lit(""))
    out = rows.withColumns({
        "origin": place("dptre"), "destination": place("arvl"), "mode": p.blank_to_null(_field("trfvlm_se", "trf_tp_nm", "mode")), "period": F.date_format(p.period_month(_field("opr_ym")), "yyyy-MM"),
        "district": station_district(p.blank_to_null(_field("arvl_sgg_nm")), F.lit(None).cast("string"), {}), "metric_code": F.lit("public_transport_od_volume"), "metric_value": p.number(_field("trfvlm")), "unit": F.lit("passengers"), "dimensions": _without("opr_ym", "trfvlm"),
    })
    reject = F.when(F.col("origin").isNull() | F.col("destination").isNull(), "no_place").when(F.col("metric_value").isNull(), "not_numeric").when(F.col("period").isNull(), "bad_period")
    return out.withColumn("reject", reject).drop("row")
