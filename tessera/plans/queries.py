"""The library's queries over the test tables, each beside the DuckDB SQL that states the same.

Stand-ins: district = nation, group = region, facility = customer (rooms = whole balance / 100, unknown if negative),
legal registration = order, fact series = events, wide row = lineitem.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import geo, parsing, status
from tessera.functions.text import indel_similarity, name_key
from tessera.operators import aggregates as agg
from tessera.operators import digests, graph, identity, joins, latest, matching, quality, quantiles, reshape, spatial, windows
from tessera.plans import marts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list, index: str) -> Column:
    """The value at index modulo the number of values; odd inputs for every row."""
    return F.element_at(F.array(*(F.lit(v).cast("string") for v in values)), (F.expr(f"pmod({index}, {len(values)})") + 1).cast("int"))


def sql_pick(values: list, index: str) -> str:
    """The same in SQL."""
    quoted = ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    return f"list_extract([{quoted}], (({index}) % {len(values)} + 1)::BIGINT)"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c, kind in df.dtypes if kind == "double"})


FACILITIES = """
SELECT c.c_custkey AS facility_id, n.n_name AS district, r.r_name AS region_group,
  CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal / 100)::BIGINT END AS rooms,
  c_mktsegment = 'BUILDING' AS tourism, coalesce(o.registrations, 0) AS registrations,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS foreigner,
  CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'BUILDING') THEN 1 ELSE 0 END AS foreign_capable,
  CASE WHEN c_custkey % 7 <> 0 THEN (c_custkey % 50)::DOUBLE END AS age,
  CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 50 < 5 END AS recent_permit
FROM customer c JOIN nation n ON c_nationkey = n_nationkey JOIN region r ON n_regionkey = r_regionkey
LEFT JOIN (SELECT o_custkey, count(*) AS registrations FROM orders GROUP BY 1) o ON o_custkey = c_custkey
"""


def facilities(spark: SparkSession, d: str) -> DataFrame:
    places = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    orders = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    key, known = F.col("c_custkey"), F.col("c_custkey") % 7 != 0
    segment = F.col("c_mktsegment")
    return (
        table(spark, d, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(orders, F.col("o_custkey") == key, "left")
        .select(
            key.alias("facility_id"), F.col("n_name").alias("district"), F.col("r_name").alias("region_group"),
            F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / 100)).alias("rooms"),
            (segment == "BUILDING").alias("tourism"), F.coalesce("n", F.lit(0)).alias("registrations"),
            (segment == "HOUSEHOLD").cast("int").alias("foreigner"), segment.isin("HOUSEHOLD", "BUILDING").cast("int").alias("foreign_capable"),
            F.when(known, (key % 50).cast("double")).alias("age"), F.when(known, key % 50 < 5).alias("recent_permit"),
        )
    )


def districts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("district"), F.col("r_name").alias("region_group"))


def daily(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("day", F.to_date("ts"))


# -- latest revisions --------------------------------------------------------


@query("""
SELECT user_id, event_type, event_id, round(value, 2) AS value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_revision(spark, d):
    out = latest.latest(table(spark, d, "events").select("user_id", "event_type", "event_id", "ts", "value"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])
    return out.select("user_id", "event_type", "event_id", F.round("value", 2).alias("value"))


@query("""
SELECT user_id, event_type, event_id FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00'
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_revision_as_of(spark, d):
    seen = latest.visible(table(spark, d, "events").select("user_id", "event_type", "event_id", "ts"), "ts", "2024-01-15 00:00:00")
    return latest.latest(seen, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query("""
WITH last AS (
  SELECT user_id, ts::DATE AS run_day, event_type, ts, event_id FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts DESC, event_id DESC) = 1
)
SELECT user_id, run_day, event_type AS status FROM last WHERE event_type IN ('view', 'click', 'signup')
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY run_day DESC) = 1
""")
def two_stage_complete_snapshot(spark, d):
    runs = table(spark, d, "events").select("user_id", F.to_date("ts").alias("run_day"), F.col("event_type").alias("status"), "ts", "event_id")
    ready = F.col("status").isin("view", "click", "signup")
    return latest.latest_ready(runs, "user_id", "run_day", [F.desc("ts"), F.desc("event_id")], ready, [F.desc("run_day")]).select("user_id", "run_day", "status")


@query("""
WITH c AS (
  SELECT user_id, event_id, event_type,
    CASE WHEN row_number() OVER w > 1 AND event_type IS DISTINCT FROM lag(event_type) OVER w THEN 1 ELSE 0 END AS changed, ts
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
)
SELECT user_id, event_id, event_type, sum(changed) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS revision FROM c
""")
def revision_change_sequence(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    return latest.revision_numbers(e, ["user_id"], [F.asc("ts"), F.asc("event_id")], "event_type").drop("ts")


@query("""
SELECT o_custkey AS key, o_orderkey AS id, 'revision' AS origin FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_custkey, o_orderkey, 'snapshot' FROM orders WHERE o_orderstatus = 'O' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
""")
def revisions_or_legacy(spark, d):
    o = table(spark, d, "orders")
    part = lambda s, n: o.filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("id"), F.lit(n).alias("origin"))
    return latest.prefer_revisions(part("F", "revision"), part("O", "snapshot"), ["key"])


# -- filters and status ------------------------------------------------------


STATUS_CODES = [None, "", "1", "01", "02", "3", " 04 ", "9", "  "]
STATUS_NAMES = [None, "", "영업/정상", "영업(정상)", "폐업", "휴업 중", " 정상 ", "영업중.", "취소/말소", "미상", "정상영업"]
STATUS_TEXT = f"SELECT o_orderkey, {sql_pick(STATUS_CODES, 'o_orderkey')} AS code, {sql_pick(STATUS_NAMES, 'o_custkey')} AS name, o_orderkey % 11 = 0 AS gone, o_orderkey % 13 = 0 AS later FROM orders"


@query(f"""
WITH t AS (SELECT o_orderkey, gone AND NOT later AS gone, nullif(trim(code), '') AS code, nullif(trim(name), '') AS name FROM ({STATUS_TEXT})),
m AS (SELECT *, coalesce(regexp_matches(name, '폐업|휴업|취소|말소|정지|폐쇄'), false) AS marked, lpad(code, 2, '0') AS two FROM t)
SELECT o_orderkey, CASE WHEN gone THEN false WHEN code IS NOT NULL THEN two = '01' WHEN name IS NULL OR marked THEN false ELSE regexp_replace(name, '[^0-9A-Za-z가-힣]', '', 'g') IN ('영업', '영업정상', '정상', '영업중') END AS active,
  gone OR coalesce(two IN ('02', '03', '04'), false) OR marked AS inactive,
  CASE WHEN code IS NOT NULL THEN coalesce(map_extract(MAP {{'01': 'active', '02': 'suspended', '03': 'closed', '04': 'cancelled_or_expired_or_stopped'}}, code)[1], 'unknown') END AS class
FROM m
""")
def active_status(spark, d):
    key = F.col("o_orderkey")
    closed = F.when(key % 11 == 0, F.when(key % 13 == 0, F.date_add("o_orderdate", 1)).otherwise(F.to_date("o_orderdate")))
    o = table(spark, d, "orders").select(key, pick(STATUS_CODES, "o_orderkey").alias("code"), pick(STATUS_NAMES, "o_custkey").alias("name"), closed.alias("closed"), F.to_date("o_orderdate").alias("seen"))
    args = [F.col(c) for c in ("code", "name", "closed", "seen")]
    return o.select("o_orderkey", status.is_active(*args).alias("active"), status.is_inactive(*args).alias("inactive"), status.status_class(F.col("code")).alias("class"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01'")
def month_range_filter(spark, d):
    return table(spark, d, "orders").filter(parsing.in_month(F.col("o_orderdate"), "1997-03")).select("o_orderkey", "o_custkey")


@query("""
SELECT c_custkey FROM customer c
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
""")
def semi_and_anti(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer").select("c_custkey")
    keys = lambda s: o.filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("c_custkey"))
    return joins.missing(c.join(keys("F"), "c_custkey", "left_semi"), keys("P"), ["c_custkey"])


# -- joins -------------------------------------------------------------------


@query("""
WITH b AS (SELECT o_custkey, min(o_orderkey) AS first_run, max(o_orderkey) AS last_run FROM orders GROUP BY 1)
SELECT b.o_custkey AS facility_id, o.o_orderkey, o.o_orderstatus FROM b JOIN orders o ON o.o_orderkey = b.first_run OR o.o_orderkey = b.last_run
""")
def or_join_rewritten(spark, d):
    o = table(spark, d, "orders")
    ends = o.groupBy(F.col("o_custkey").alias("facility_id")).agg(F.min("o_orderkey").alias("first_run"), F.max("o_orderkey").alias("last_run"))
    return joins.join_either(ends, o.select("o_orderkey", "o_orderstatus"), ["first_run", "last_run"], "o_orderkey").select("facility_id", "o_orderkey", "o_orderstatus")


@query("""
WITH names AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS place FROM part UNION SELECT DISTINCT p_name || ' ' || p_type FROM part WHERE p_size % 5 = 0),
texts AS (SELECT p_partkey, p_name || ' ' || p_type || ' ' || p_brand AS address FROM part)
SELECT p_partkey, address, arg_max(place, length(place)) AS place FROM texts LEFT JOIN names ON address = place OR starts_with(address, place || ' ') GROUP BY 1, 2
""")
def longest_prefix_join(spark, d):
    p = table(spark, d, "part")
    names = p.select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("place")).union(p.filter("p_size % 5 = 0").select(F.concat_ws(" ", "p_name", "p_type")))
    texts = p.select("p_partkey", F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("address"))
    return joins.longest_prefix(texts, "address", names, "place", ["p_partkey"])


@query("""
WITH e AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1), a AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1)
SELECT coalesce(e.k, a.k) AS k, CASE WHEN a.k IS NULL THEN 'missing' WHEN e.k IS NULL THEN 'extra' WHEN e.n IS NOT DISTINCT FROM a.n THEN 'matched' ELSE 'mismatched' END AS outcome, e.n AS expected_n, a.n AS actual_n
FROM e FULL JOIN a ON e.k = a.k
""")
def reconcile_full_outer(spark, d):
    o = table(spark, d, "orders")
    per = lambda df: df.groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    out = joins.reconcile(per(o.filter("o_orderstatus <> 'P'")), per(o.filter("o_orderpriority <> '5-LOW'")), ["k"], ["n"])
    return out.select("k", "outcome", F.col("expected.n").alias("expected_n"), F.col("actual.n").alias("actual_n"))


@query("SELECT p_name, p_type, count(DISTINCT p_partkey) AS members FROM part GROUP BY ALL")
def shared_requests(spark, d):
    return joins.shared_requests(table(spark, d, "part"), ["p_name", "p_type"], "p_partkey").drop("request_key")


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, o.priority FROM l JOIN (SELECT o_orderkey, o_custkey % 7 + 1 AS ln, o_orderpriority AS priority FROM orders) o ON o.o_orderkey = l.l_orderkey AND (l.n = 1 OR o.ln = l.l_linenumber)
""")
def enrichment_by_identity(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    more = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 7 + 1).cast("int").alias("l_linenumber"), F.col("o_orderpriority").alias("priority"))
    return joins.attach_single(lines, more, "l_orderkey", ["l_linenumber"])


# -- aggregates --------------------------------------------------------------


@query("""
WITH v AS (SELECT l_partkey, l_suppkey % 3 AS slot, CASE WHEN l_quantity < 5 THEN -1 ELSE floor(l_quantity / 25) END AS rooms, l_returnflag FROM lineitem)
SELECT l_partkey, slot, CASE WHEN min(rooms) FILTER (rooms >= 0) = max(rooms) FILTER (rooms >= 0) THEN max(rooms) FILTER (rooms >= 0)::BIGINT END AS rooms,
  CASE WHEN count(*) FILTER (rooms >= 0) = 0 THEN 'missing' WHEN min(rooms) FILTER (rooms >= 0) = max(rooms) FILTER (rooms >= 0) THEN 'reported' ELSE 'conflicting' END AS rooms_quality,
  bool_or(l_returnflag = 'R') AS has_return, count(*) AS registrations
FROM v GROUP BY 1, 2
""")
def facility_collapse_single_value(spark, d):
    v = table(spark, d, "lineitem").select("l_partkey", (F.col("l_suppkey") % 3).alias("slot"), F.when(F.col("l_quantity") < 5, -1).otherwise(F.floor(F.col("l_quantity") / 25)).alias("rooms"), "l_returnflag")
    return agg.single_value(v, ["l_partkey", "slot"], "rooms", {"has_return": F.bool_or(F.col("l_returnflag") == "R"), "registrations": F.count(F.lit(1))})


STOCK_SQL = """
  count(*) AS facilities, sum(registrations)::BIGINT AS registrations, count(rooms) AS rooms_known, round(count(rooms) / count(*), 6) AS room_coverage,
  sum(rooms)::DOUBLE AS room_sum, round(avg(rooms), 6) AS room_mean, median(rooms)::DOUBLE AS room_median, quantile_cont(rooms, 0.25)::DOUBLE AS room_q1, quantile_cont(rooms, 0.75)::DOUBLE AS room_q3,
  round(count(*) FILTER (rooms <= 20) / nullif(count(rooms), 0), 6) AS small_share, count(*) FILTER (tourism) AS tourism_facilities, round(count(*) FILTER (tourism) / count(*), 6) AS tourism_share,
  CASE WHEN count(*) FILTER (tourism) = 0 THEN 0.0 WHEN count(*) FILTER (tourism AND rooms IS NULL) = 0 THEN sum(rooms) FILTER (tourism) END::DOUBLE AS tourism_rooms,
  round(CASE WHEN count(*) FILTER (tourism) = 0 THEN 0.0 WHEN count(*) FILTER (tourism AND rooms IS NULL) = 0 THEN sum(rooms) FILTER (tourism) END::DOUBLE / nullif(sum(rooms), 0), 6) AS tourism_room_share,
  round(CASE WHEN count(*) FILTER (tourism) = 0 THEN 1.0 ELSE count(rooms) FILTER (tourism)::DOUBLE / count(*) FILTER (tourism) END, 6) AS tourism_room_coverage,
  round(sum(foreigner) / nullif(sum(registrations), 0), 6)::DOUBLE AS foreigner_share, round(sum(foreign_capable) / nullif(sum(registrations), 0), 6)::DOUBLE AS foreign_capable_share,
  round(avg(age), 6) AS age_mean, median(age) AS age_median, round(sum(age * rooms) FILTER (rooms > 0) / nullif(sum(rooms) FILTER (age IS NOT NULL AND rooms > 0), 0), 6)::DOUBLE AS age_by_rooms,
  round(count(*) FILTER (age >= 20) / nullif(count(age), 0), 6) AS age20_share, round(count(*) FILTER (age >= 30) / nullif(count(age), 0), 6) AS age30_share, count(age) AS age_known,
  round(count(*) FILTER (recent_permit) / nullif(count(recent_permit), 0), 6) AS permit_share
"""


@query(f"SELECT district, {STOCK_SQL} FROM ({FACILITIES}) GROUP BY district")
def district_distribution(spark, d):
    return rounded(marts.measured_stock(facilities(spark, d), ["district"]))


@query(f"SELECT region_group, round(avg(rooms), 6) AS room_mean, median(rooms)::DOUBLE AS room_median, quantile_cont(rooms, 0.25)::DOUBLE AS room_q1 FROM ({FACILITIES}) GROUP BY region_group")
def pooled_group_median(spark, d):
    f = facilities(spark, d)
    mean = f.groupBy("region_group").agg(F.avg("rooms").alias("room_mean"))
    return rounded(quantiles.with_quantiles(mean, f, ["region_group"], {"room_median": ("rooms", 0.5), "room_q1": ("rooms", 0.25)}))


@query("""
WITH v AS (SELECT coalesce(l_returnflag, '-') AS flag, l_extendedprice AS price, l_quantity AS quantity FROM lineitem)
SELECT flag, round(quantile_cont(price, 0.5), 4) AS price_median, round(quantile_cont(price, 0.999), 4) AS price_p999, round(quantile_cont(quantity, 0.1), 4) AS quantity_p10 FROM v GROUP BY 1
""")
def large_group_quantiles(spark, d):
    v = table(spark, d, "lineitem").select(F.coalesce("l_returnflag", F.lit("-")).alias("flag"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"))
    return rounded(quantiles.exact_quantiles(v, ["flag"], {"price_median": ("price", 0.5), "price_p999": ("price", 0.999), "quantity_p10": ("quantity", 0.1)}), 4)


@query(f"""
WITH m AS (SELECT district, count(*) AS facilities, sum(rooms)::DOUBLE AS room_sum, round(count(rooms) / count(*), 6) AS room_coverage, median(rooms)::DOUBLE AS room_median FROM ({FACILITIES}) WHERE district NOT IN ('NATION_3', 'NATION_4') GROUP BY 1)
SELECT n_name AS district, coalesce(facilities, CASE WHEN n_nationkey <> 4 THEN 0 END) AS facilities, coalesce(room_sum, CASE WHEN n_nationkey <> 4 THEN 0 END) AS room_sum, room_coverage, room_median, n_nationkey <> 4 OR facilities IS NOT NULL AS stock_observed
FROM nation LEFT JOIN m ON district = n_name
""")
def seed_universe_zero_vs_null(spark, d):
    seen = districts(spark, d).filter("district <> 'NATION_4'")
    out = marts.district_marts(facilities(spark, d).filter(~F.col("district").isin("NATION_3", "NATION_4")), districts(spark, d), seen)
    return rounded(out.select("district", "facilities", "room_sum", "room_coverage", "room_median", "stock_observed"))


@query("""
WITH r AS (SELECT ts::DATE AS day, event_type, user_id, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type, ts::DATE, user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT event_type, day, round(sum(value), 4) AS value FROM r GROUP BY ALL
""")
def dedupe_sum(spark, d):
    e = daily(spark, d).select("event_type", "day", "user_id", "ts", "event_id", "value")
    return rounded(agg.dedupe_sum(e, ["event_type", "day"], ["user_id"], [F.desc("ts"), F.desc("event_id")], "value"), 4)


@query("""
WITH b AS (SELECT event_type, date_trunc('month', ts)::DATE AS month, ts::DATE AS day, count(DISTINCT user_id) AS dims FROM events GROUP BY ALL)
SELECT event_type, month, count(*) AS observed_days, day(last_day(month)) AS expected_days, round(count(*) / day(last_day(month)), 6) AS day_coverage, round(sum(dims) / max(dims) / count(*), 6)::DOUBLE AS dimension_coverage,
  1.0::DOUBLE AS unit_coverage, round(least(count(*) / day(last_day(month)), sum(dims) / max(dims) / count(*)), 6)::DOUBLE AS overall
FROM b GROUP BY event_type, month
""")
def coverage_decomposition(spark, d):
    return rounded(agg.day_coverage(table(spark, d, "events").withColumn("unit", F.lit("count")), ["event_type"], "ts", "user_id", "unit"))


@query("""
SELECT o_orderstatus AS kind, date_trunc('month', o_orderdate)::DATE AS month, count(DISTINCT (o_custkey, o_orderdate)) AS n_events FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY ALL
""")
def event_open_close_counts(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("facility_id"), F.col("o_orderstatus").alias("kind"), "o_orderdate", (F.col("o_orderpriority") == "5-LOW").alias("pension"))
    return marts.event_counts(o, "o_orderdate", ["kind"])


@query(f"""
WITH f AS (SELECT * FROM ({FACILITIES}) WHERE district <> 'NATION_7'), s AS (SELECT region_group, count(DISTINCT district) AS n, count(*) AS facilities, sum(rooms)::DOUBLE AS room_sum FROM f GROUP BY 1), due AS (SELECT r_name AS region_group, count(*) AS n_due FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1)
SELECT region_group, n = n_due AS complete, CASE WHEN n = n_due THEN facilities END AS facilities, CASE WHEN n = n_due THEN room_sum END AS room_sum FROM due JOIN s USING (region_group)
""")
def group_complete_sums(spark, d):
    f = facilities(spark, d).filter("district <> 'NATION_7'")
    seen = districts(spark, d).filter("district <> 'NATION_7'")
    return marts.group_marts(marts.district_marts(f, districts(spark, d), seen), f, districts(spark, d)).select("region_group", "complete", "facilities", "room_sum")


@query(f"""
WITH m AS (SELECT district, count(*) AS n, count(rooms) AS known, sum(rooms)::DOUBLE AS total FROM ({FACILITIES}) GROUP BY 1)
SELECT district, 'room_coverage' AS metric, round(known / n, 6) AS value, known::DOUBLE AS numerator, n::DOUBLE AS denominator, 1.0::DOUBLE AS coverage, 'good' AS quality FROM m
UNION ALL SELECT district, 'rooms_per_facility', round(total / known, 6), total, known::DOUBLE, round(known / n, 6), CASE WHEN known / n >= 0.8 THEN 'good' ELSE 'warning' END FROM m
UNION ALL SELECT district, 'visitor_pressure', NULL, NULL, total, NULL, 'incompatible' FROM m
""")
def metric_evidence_long(spark, d):
    m = facilities(spark, d).groupBy("district").agg(F.count(F.lit(1)).alias("n"), F.count("rooms").alias("known"), F.sum("rooms").alias("total"))
    c, none = F.col, F.lit(None).cast("double")
    specs = [
        ("room_coverage", c("known"), c("n"), 1.0, F.lit(1.0), F.lit("stock")),
        ("rooms_per_facility", c("total"), c("known"), 1.0, c("known") / c("n"), F.lit("stock")),
        ("visitor_pressure", none, c("total"), 100.0, none, F.lit("no_visitors")),
    ]
    return rounded(marts.metric_evidence(m, ["district"], specs))


@query("""
SELECT source, count(*) FILTER (quality = 1) AS positive, count(*) AS total,
  round(CASE WHEN count(*) >= 10 THEN (p + z2 / (2 * n) - 1.959963984540054 * sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n) END, 6) AS lower_bound
FROM (SELECT d.source, quality, avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END) OVER w AS p, (count(*) OVER w)::DOUBLE AS n, 1.959963984540054 * 1.959963984540054 AS z2 FROM labels l JOIN documents d USING (doc_id) WINDOW w AS (PARTITION BY d.source))
GROUP BY source, p, n, z2
""")
def wilson_lower_bound(spark, d):
    j = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "source"), "doc_id")
    out = j.groupBy("source").agg(F.count_if(F.col("quality") == 1).alias("positive"), F.count(F.lit(1)).alias("total"))
    return rounded(out.withColumn("lower_bound", agg.wilson_lower(F.col("positive"), F.col("total"))))


@query("""
WITH h AS (SELECT sha256('{"o_orderkey":"' || o_orderkey || '","o_custkey":"' || o_custkey || '","o_orderstatus":"' || o_orderstatus || '","o_orderpriority":"' || o_orderpriority || '"}') AS h FROM orders),
p AS (SELECT count(*) AS n_rows, sum(('0x' || substr(h, 1, 15))::BIGINT) AS a, sum(('0x' || substr(h, 16, 15))::BIGINT) AS b, sum(('0x' || substr(h, 31, 15))::BIGINT) AS c, sum(('0x' || substr(h, 46, 15))::BIGINT) AS d FROM h)
SELECT n_rows, sha256(a || '-' || b || '-' || c || '-' || d) AS digest FROM p
""")
def manifest_digest(spark, d):
    return agg.table_digest(table(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


# -- windows -----------------------------------------------------------------


MONTHLY = "SELECT n_name AS district, date_trunc('month', o_orderdate)::DATE AS month, sum(o_totalprice) AS visitors, count(*) AS rooms FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE month(o_orderdate) <> 6 GROUP BY ALL"


def monthly(spark: SparkSession, d: str) -> DataFrame:
    places = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("district"))
    o = table(spark, d, "orders").filter(F.month("o_orderdate") != 6)
    return o.join(places, F.col("o_custkey") == F.col("c_custkey")).groupBy("district", F.trunc("o_orderdate", "month").alias("month")).agg(F.sum("o_totalprice").alias("visitors"), F.count(F.lit(1)).alias("rooms"))


@query(f"""
WITH m AS ({MONTHLY}), g AS (SELECT *, lag(month) OVER w AS before, lag(visitors) OVER w AS v0, lag(rooms) OVER w AS r0 FROM m WINDOW w AS (PARTITION BY district ORDER BY month))
SELECT district, month, round(CASE WHEN before + INTERVAL 1 MONTH = month AND visitors > 0 AND v0 > 0 AND rooms > 0 AND r0 > 0 THEN (visitors / v0 - 1) - (rooms / r0 - 1) END, 6) AS growth_gap FROM g
""")
def consecutive_growth(spark, d):
    return rounded(windows.growth_gap(monthly(spark, d), ["district"], "month", "visitors", "rooms").select("district", "month", "growth_gap"))


@query(f"""
WITH m AS (SELECT district, month, rooms FROM ({MONTHLY})), q AS (SELECT month, quantile_cont(rooms, 1.0::DOUBLE / 3) AS lo, quantile_cont(rooms, 2.0::DOUBLE / 3) AS hi, count(rooms) AS n FROM m GROUP BY 1)
SELECT district, month, rooms, CASE WHEN n < 12 THEN 'unclassified' WHEN rooms <= lo THEN 'low' WHEN rooms > hi THEN 'high' ELSE 'medium' END AS band FROM m JOIN q USING (month)
""")
def tercile_band(spark, d):
    return windows.tercile_band(monthly(spark, d).select("district", "month", "rooms"), ["month"], "rooms", "band")


@query(f"""
SELECT district, month, round(CASE WHEN count(*) OVER (PARTITION BY month) = 25 THEN cume_dist() OVER (PARTITION BY month ORDER BY rooms) END, 6) AS percentile FROM ({MONTHLY})
""")
def percentile_rank_guarded(spark, d):
    m = monthly(spark, d)
    return rounded(m.select("district", "month", windows.complete_percentile(m, ["month"], "rooms", 25).alias("percentile")))


@query("""
WITH m AS (SELECT DISTINCT o_custkey, date_trunc('month', o_orderdate)::DATE AS month FROM orders), r AS (SELECT *, year(month) * 12 + month(month) - row_number() OVER (PARTITION BY o_custkey ORDER BY month) AS run FROM m)
SELECT o_custkey, min(month) AS first_month, max(month) AS last_month, count(*) AS n_months FROM r GROUP BY o_custkey, run
""")
def month_islands(spark, d):
    return windows.month_islands(table(spark, d, "orders"), ["o_custkey"], "o_orderdate")


@query("SELECT s_suppkey, 'supplier-' || lpad((row_number() OVER (ORDER BY s_suppkey))::VARCHAR, 6, '0') AS public_key FROM supplier")
def dense_public_key(spark, d):
    return windows.public_keys(table(spark, d, "supplier").select("s_suppkey"), "s_suppkey", "supplier")


# -- reshaping ---------------------------------------------------------------


@query("""
SELECT l_orderkey, l_linenumber, metric_code, round(metric_value, 4) AS metric_value FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem) ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME metric_code VALUE metric_value)
""")
def unpivot_measures(spark, d):
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded(reshape.measures(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *names), ["l_orderkey", "l_linenumber"], names), 4)


@query("""
SELECT p_partkey, hour, value::DOUBLE AS value FROM (SELECT p_partkey, unnest([{'hour': '05', 'value': p_size}, {'hour': '06', 'value': CASE WHEN p_size > 10 THEN p_size * 2 END}]) AS m FROM part), LATERAL (SELECT m.hour AS hour, m.value AS value) WHERE value IS NOT NULL
""")
def hourly_columns(spark, d):
    wide = table(spark, d, "part").select("p_partkey", F.col("p_size").alias("05시-06시"), F.when(F.col("p_size") > 10, F.col("p_size") * 2).alias("06시-07시"))
    return reshape.pattern_measures(wide, ["p_partkey"], r"(\d\d)시-\d\d시", "hour", "value")


@query("""
SELECT p_partkey, dimension_hash, sha256(concat_ws('|', 'parts', 'retail', '2024-01', p_brand, dimension_hash, p_partkey::VARCHAR)) AS observation_key
FROM (SELECT p_partkey, p_brand, sha256('{"p_name":"' || p_name || '","p_type":"' || p_type || '"}') AS dimension_hash FROM part)
""")
def dimension_hash(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_name", "p_retailprice")
    dims = reshape.dimensions(p, ["p_partkey", "p_brand", "p_retailprice"])
    f = reshape.facts(p, F.lit("parts"), F.lit("retail"), F.lit("2024-01"), F.col("p_brand"), F.col("p_retailprice"), F.lit("KRW"), dims, F.col("p_partkey").cast("string"))
    return f.select(F.col("source_revision").cast("long").alias("p_partkey"), "dimension_hash", "observation_key")


@query("""
SELECT event_id, coalesce(r.r_name, 'UNMAPPED') AS r_name FROM events LEFT JOIN region r ON user_id % 8 = r_regionkey
""")
def mapped_dictionary(spark, d):
    e = table(spark, d, "events").select("event_id", (F.col("user_id") % 8).cast("int").alias("r_regionkey"))
    return reshape.mapped_or(e, "r_regionkey", table(spark, d, "region"), "r_name", "UNMAPPED").select("event_id", "r_name")


# -- scalar functions --------------------------------------------------------


@query("""
WITH t AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y%m%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN '20260230' END AS raw, o_orderdate::DATE AS d FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN d END AS parsed, CASE WHEN raw IS NULL THEN 'missing' WHEN o_orderkey % 4 = 2 THEN 'invalid' ELSE 'parsed' END AS quality, CASE WHEN o_orderkey % 4 < 2 THEN date_trunc('month', d)::DATE WHEN o_orderkey % 4 = 2 THEN DATE '2026-02-01' END AS month FROM t
""")
def date_parse_quality(spark, d):
    k = F.col("o_orderkey") % 4
    raw = F.when(k == 0, F.date_format("o_orderdate", "yyyyMMdd")).when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 2, "20260230")
    return table(spark, d, "orders").withColumn("raw", raw).select("o_orderkey", parsing.strict_date(F.col("raw")).alias("parsed"), parsing.date_quality(F.col("raw")).alias("quality"), parsing.period_month(F.col("raw")).alias("month"))


NUMBERS = [None, "", " 12 ", "12.00", "1,234", "1,234.5", "-7", "+3.0", "n/a", "1e3", "NaN", "Infinity", "12.5.1", ".5", "0012"]


@query(f"""
WITH t AS (SELECT c_custkey, replace(trim({sql_pick(NUMBERS, 'c_custkey')}), ',', '') AS plain, trim({sql_pick(NUMBERS, 'c_custkey')}) AS raw FROM customer)
SELECT c_custkey, CASE WHEN regexp_full_match(plain, '[-+]?[0-9]+([.]0+)?') THEN plain::DOUBLE::BIGINT END AS whole,
  CASE WHEN regexp_full_match(plain, '[-+]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][-+]?[0-9]+)?') THEN plain::DOUBLE END AS num, CASE WHEN regexp_full_match(raw, '[0-9]+') THEN lpad(raw, 5, '0') END AS code FROM t
""")
def number_parse(spark, d):
    c = table(spark, d, "customer").select("c_custkey", pick(NUMBERS, "c_custkey").alias("raw"))
    return c.select("c_custkey", parsing.whole_number(F.col("raw")).alias("whole"), parsing.number(F.col("raw")).alias("num"), parsing.digit_code(F.col("raw"), 5).alias("code"))


LOTS = [None, "", "12-3", "산 12 - 3", "산12-3", "12", "산 7", "하단동 12-3", "12-3 외 1", "12 -", "0012- 0003", "a12"]
UNITS = ["", "3층", "로 12 3층 301호", "301호, 3 층", "지하1층 B101호", "1234층", "123456호", "3층 4층 12호 99호"]


@query(f"""
WITH t AS (SELECT p_partkey, regexp_extract(trim({sql_pick(LOTS, 'p_partkey')}), '^(산)?\\s*([0-9]+)(?:\\s*-\\s*([0-9]+))?$', ['hill', 'main', 'sub']) AS l, {sql_pick(UNITS, 'p_partkey + p_size')} AS u FROM part),
w AS (SELECT *, ' ' || u AS v FROM t)
SELECT p_partkey, CASE WHEN l.main <> '' THEN CASE WHEN l.hill = '산' THEN '1' ELSE '0' END END AS mountain, CASE WHEN l.main <> '' THEN lpad(l.main, 4, '0') END AS main, CASE WHEN l.main <> '' THEN lpad(CASE WHEN l.sub = '' THEN '0' ELSE l.sub END, 4, '0') END AS sub,
  nullif(array_to_string(list_concat(regexp_extract_all(v, '[^0-9]([0-9]{{1,3}})\\s*층', 1), regexp_extract_all(v, '[^0-9]([0-9]{{1,5}})\\s*호', 1)), '|'), '') AS units
FROM w
""")
def lot_and_unit_parse(spark, d):
    t = table(spark, d, "part").select("p_partkey", pick(LOTS, "p_partkey").alias("lot"), pick(UNITS, "p_partkey + p_size").alias("unit"))
    lot = parsing.lot_number(F.col("lot"))
    return t.select("p_partkey", lot["mountain"].alias("mountain"), lot["main"].alias("main"), lot["sub"].alias("sub"), parsing.unit_tokens(F.col("unit")).alias("units"))


DATES = [None, "", "20240131", "2024-01-31", "2024.01-31", "2024/0131", "20240230", "2024-01-31T10:00", "202401311", "2024-1-3", "20240131 05:00", "n/a"]


@query(f"""
WITH t AS (SELECT o_orderkey, nullif(trim({sql_pick(DATES, 'o_orderkey')}), '') AS raw FROM orders),
s AS (SELECT *, CASE WHEN regexp_full_match(raw, '[0-9]{{4}}[-./]?[0-9]{{2}}[-./]?[0-9]{{2}}') THEN regexp_replace(raw, '[-./]', '', 'g') END AS whole, CASE WHEN regexp_full_match(left(raw, 10), '[0-9]{{4}}[-./]?[0-9]{{2}}[-./]?[0-9]{{2}}') THEN regexp_replace(left(raw, 10), '[-./]', '', 'g') END AS head FROM t)
SELECT o_orderkey, try_strptime(whole, '%Y%m%d')::DATE AS strict, CASE WHEN raw IS NULL THEN 'missing' WHEN try_strptime(whole, '%Y%m%d') IS NULL THEN 'invalid' ELSE 'parsed' END AS quality, try_strptime(head, '%Y%m%d')::DATE AS lenient FROM s
""")
def odd_dates(spark, d):
    t = table(spark, d, "orders").select("o_orderkey", pick(DATES, "o_orderkey").alias("raw"))
    return t.select("o_orderkey", parsing.strict_date(F.col("raw")).alias("strict"), parsing.date_quality(F.col("raw")).alias("quality"), parsing.lenient_date(F.col("raw")).alias("lenient"))


@query("""
SELECT c_custkey, CASE WHEN k < 0 OR w < 0 THEN NULL ELSE (coalesce(k, 0) + coalesce(w, 0)) END AS rooms, CASE WHEN k < 0 OR w < 0 THEN 'invalid_negative' WHEN k + w = 0 THEN 'reported_zero' ELSE 'reported' END AS quality
FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN -1 ELSE c_custkey % 3 END AS k, c_custkey % 2 AS w FROM customer)
""")
def room_count_quality(spark, d):
    k = F.when(F.col("c_acctbal") < 0, -1).otherwise(F.col("c_custkey") % 3)
    return table(spark, d, "customer").select("c_custkey", parsing.room_count(k.cast("bigint"), F.col("c_custkey") % 2).alias("r")).select("c_custkey", "r.*")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract_props(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query("""
SELECT event_type, count(*) AS n_fields, sha256(string_agg(field, ',' ORDER BY field)) AS fingerprint FROM (SELECT DISTINCT event_type, unnest(json_keys(props)) AS field FROM events) GROUP BY 1
""")
def schema_fingerprint(spark, d):
    return quality.schema_fingerprint(table(spark, d, "events"), ["event_type"], "props")


@query("""
WITH p AS (SELECT c_custkey, 128.9 + (c_custkey % 97) * 0.003 AS lon, 35.0 + (c_custkey % 89) * 0.003 AS lat FROM customer)
SELECT c_custkey, round(2 * 6371000.0 * asin(least(1.0, sqrt(sin(radians(35.1 - lat) / 2) ** 2 + cos(radians(lat)) * cos(radians(35.1)) * sin(radians(129.05 - lon) / 2) ** 2))), 3) AS metres FROM p
""")
def haversine(spark, d):
    lon, lat = F.lit(128.9) + (F.col("c_custkey") % 97) * F.lit(0.003), F.lit(35.0) + (F.col("c_custkey") % 89) * F.lit(0.003)
    return table(spark, d, "customer").select("c_custkey", F.round(geo.haversine_m(lon, lat, F.lit(129.05), F.lit(35.1)), 3).alias("metres"))


# -- spatial -----------------------------------------------------------------


GRID_SQL = f"SELECT 'g5174_500_' || (floor(x / 500))::BIGINT || '_' || (floor(y / 500))::BIGINT AS grid_id, district, rooms, age, CASE WHEN facility_id % 3 = 0 THEN 'high' ELSE 'low' END AS context FROM (SELECT *, facility_id % 40 * 125.0 - 2500 AS x, facility_id % 9 * 250.0 AS y FROM ({FACILITIES}))"


def gridded(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("facility_id")
    return facilities(spark, d).select(geo.grid_id(key % 40 * 125.0 - 2500, key % 9 * 250.0).alias("grid_id"), "district", "rooms", "age", F.when(key % 3 == 0, "high").otherwise("low").alias("context"))


@query(f"SELECT grid_id, count(*) AS n, sum(rooms)::BIGINT AS rooms FROM ({GRID_SQL}) GROUP BY 1")
def grid_cell_floor(spark, d):
    return gridded(spark, d).groupBy("grid_id").agg(F.count(F.lit(1)).alias("n"), F.sum("rooms").alias("rooms"))


@query(f"""
WITH g AS ({GRID_SQL}), c AS (SELECT district, count(*) FILTER (rooms IS NOT NULL) / count(*) AS coverage FROM g GROUP BY 1),
m AS (SELECT grid_id, district, count(*) AS n_facilities, CASE WHEN count(rooms) = count(*) THEN median(rooms) END AS rooms, CASE WHEN count(age) = count(*) THEN median(age) END AS age, min(context) AS context FROM g GROUP BY 1, 2),
s AS (SELECT m.*, coverage, CASE WHEN rooms <= 0 THEN NULL WHEN rooms <= 10 THEN 2 WHEN rooms <= 20 THEN 1 WHEN rooms IS NOT NULL THEN 0 END + CASE WHEN age >= 30 THEN 2 WHEN age >= 20 THEN 1 WHEN age IS NOT NULL THEN 0 END + CASE context WHEN 'high' THEN 2 ELSE 0 END AS raw FROM m JOIN c USING (district))
SELECT grid_id, district, n_facilities, rooms, age, round(coverage, 6) AS coverage, CASE WHEN coverage >= 0.8 THEN raw END::INTEGER AS score,
  CASE WHEN coverage < 0.8 OR raw IS NULL THEN 'insufficient_evidence' WHEN n_facilities < 3 THEN 'small_sample' WHEN raw >= 5 THEN 'priority_1' WHEN raw >= 3 THEN 'priority_2' WHEN raw >= 1 THEN 'monitor' ELSE 'general' END AS grade
FROM s
""")
def grid_grades(spark, d):
    g = gridded(spark, d)
    coverage = g.groupBy("district").agg(agg.known_share(F.col("rooms")).alias("coverage"))
    return rounded(spatial.grid_grades(g, coverage))


@query("""
WITH b AS (SELECT a.n AS rooms, b.n AS age, c.n AS supply, e.n AS demand FROM (VALUES ('low'), ('medium'), ('high'), ('unavailable')) a(n), (VALUES ('low'), ('medium'), ('high')) b(n), (VALUES ('low'), ('medium'), ('high'), ('unclassified')) c(n), (VALUES ('low'), ('high')) e(n)),
x AS (SELECT *, CASE WHEN supply = 'unclassified' THEN NULL ELSE (demand = 'high')::INT + (supply = 'low')::INT END AS ctx, CASE rooms WHEN 'high' THEN 2 WHEN 'medium' THEN 1 WHEN 'low' THEN 0 END AS r, CASE age WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END AS a FROM b)
SELECT rooms, age, supply, demand, (r + a + ctx)::INTEGER AS score, CASE WHEN r + a + ctx IS NULL THEN 'insufficient_evidence' WHEN r + a + ctx >= 5 THEN 'priority_1' WHEN r + a + ctx >= 3 THEN 'priority_2' WHEN r + a + ctx >= 1 THEN 'monitor' ELSE 'general' END AS grade FROM x
""")
def rating_composite(spark, d):
    bands = lambda name, values: F.explode(F.array(*(F.lit(v) for v in values))).alias(name)
    df = spark.range(1).select(bands("rooms", ("low", "medium", "high", "unavailable"))).select("rooms", bands("age", ("low", "medium", "high")))
    df = df.select("*", bands("supply", ("low", "medium", "high", "unclassified"))).select("*", bands("demand", ("low", "high")))
    return df.select("*", spatial.composite(F.col("rooms"), F.col("age"), spatial.context_rating(F.col("demand"), F.col("supply"))).alias("c")).select("rooms", "age", "supply", "demand", "c.*")


# -- signals, quality --------------------------------------------------------


@query(f"""
WITH g AS (SELECT region_group, count(*)::DOUBLE AS facilities, median(rooms)::DOUBLE AS room_median, min(cov) AS cov FROM (SELECT *, count(rooms) OVER w / count(*) OVER w AS cov FROM ({FACILITIES}) WINDOW w AS (PARTITION BY district)) GROUP BY 1),
p AS (SELECT max(facilities) FILTER (region_group = 'ASIA') AS lf, max(facilities) FILTER (region_group = 'EUROPE') AS rf, max(room_median) FILTER (region_group = 'ASIA') AS lm, max(room_median) FILTER (region_group = 'EUROPE') AS rm, min(cov) FILTER (region_group IN ('ASIA', 'EUROPE')) AS c FROM g)
SELECT metric, kind, round(value, 6) AS value, left_value, right_value, round(c, 6) AS coverage, CASE WHEN c >= 0.8 THEN 'good' WHEN c > 0 THEN 'warning' ELSE 'insufficient' END AS quality FROM (
  SELECT 'facilities' AS metric, 'difference' AS kind, lf - rf AS value, lf AS left_value, rf AS right_value, c FROM p UNION ALL SELECT 'facilities', 'ratio', lf / rf, lf, rf, c FROM p
  UNION ALL SELECT 'room_median', 'difference', lm - rm, lm, rm, c FROM p UNION ALL SELECT 'room_median', 'ratio', lm / rm, lm, rm, c FROM p)
""")
def region_comparison(spark, d):
    f = facilities(spark, d)
    groups = marts.group_marts(marts.district_marts(f, districts(spark, d)), f, districts(spark, d))
    return rounded(marts.comparisons(groups, "ASIA", "EUROPE", ["facilities", "room_median"]))


@query(f"""
WITH s AS (SELECT district, {STOCK_SQL} FROM ({FACILITIES}) GROUP BY district), x AS (SELECT s.*, CASE WHEN n_nationkey % 4 = 0 THEN 'unclassified' WHEN n_nationkey % 4 = 1 THEN 'high' ELSE 'low' END AS pressure_band, CASE WHEN n_nationkey % 2 = 1 THEN 'low' ELSE 'high' END AS stock_band, n_nationkey - 5 AS growth_gap, n_nationkey AS openings, CASE WHEN n_nationkey <> 2 THEN 10 END AS closures FROM s JOIN nation ON n_name = district)
SELECT district, 'RENOVATION_SUPPORT' AS rule, CASE WHEN room_median IS NULL OR small_share IS NULL OR age30_share IS NULL THEN 'unavailable' WHEN room_median <= 20 AND small_share >= 0.5 AND age30_share >= 0.5 THEN 'triggered' ELSE 'not_triggered' END AS status FROM x
UNION ALL SELECT district, 'SUPPLY_EXPANSION_REVIEW', CASE WHEN pressure_band = 'unclassified' THEN 'unavailable' WHEN pressure_band = 'high' AND stock_band = 'low' THEN 'triggered' ELSE 'not_triggered' END FROM x
UNION ALL SELECT district, 'OLD_LOW_DEMAND_REPOSITIONING', CASE WHEN pressure_band = 'unclassified' OR age30_share IS NULL THEN 'unavailable' WHEN age30_share >= 0.5 AND pressure_band = 'low' THEN 'triggered' ELSE 'not_triggered' END FROM x
UNION ALL SELECT district, 'DEMAND_GROWTH_LOW_TOURISM_CAPACITY', CASE WHEN tourism_room_share IS NULL THEN 'unavailable' WHEN growth_gap > 0 AND tourism_room_share < 0.3 THEN 'triggered' ELSE 'not_triggered' END FROM x
UNION ALL SELECT district, 'CLOSURE_DOMINANT_MARKET_STABILIZATION', CASE WHEN closures IS NULL THEN 'unavailable' WHEN closures > openings AND closures > 0 THEN 'triggered' ELSE 'not_triggered' END FROM x
""")
def policy_signals(spark, d):
    n = F.regexp_extract("district", r"\d+", 0).cast("int")
    s = marts.measured_stock(facilities(spark, d), ["district"])
    x = s.withColumns({"pressure_band": F.when(n % 4 == 0, "unclassified").when(n % 4 == 1, "high").otherwise("low"), "stock_band": F.when(n % 2 == 1, "low").otherwise("high"), "growth_gap": n - 5, "openings": n, "closures": F.when(n != 2, 10)})
    return marts.policy_signals(x, ["district"])


@query(f"""
WITH f AS ({FACILITIES}), m AS (SELECT count(*)::DOUBLE AS n, count(rooms) / count(*) AS r, count(DISTINCT district)::DOUBLE AS ds, count(age) / count(*) AS a FROM f)
SELECT 'active_facility_count' AS check_name, CASE WHEN n >= 1 THEN 'pass' ELSE 'fail' END AS status, n AS actual, '>=1' AS expected, 'required' AS severity FROM m
UNION ALL SELECT 'room_coverage', CASE WHEN r >= 0.8 THEN 'pass' ELSE 'warning' END, round(r, 6), '>=0.8', 'warning' FROM m
UNION ALL SELECT 'districts', CASE WHEN ds = 25 THEN 'pass' ELSE 'fail' END, ds, '>=25 and <=25', 'required' FROM m
UNION ALL SELECT 'age_coverage', CASE WHEN a >= 0.9 THEN 'pass' ELSE 'warning' END, round(a, 6), '>=0.9', 'warning' FROM m
""")
def quality_report(spark, d):
    checks = [
        quality.Check("active_facility_count", F.count(F.lit(1)), least=1),
        quality.Check("room_coverage", agg.known_share(F.col("rooms")), least=0.8, severity="warning"),
        quality.Check("districts", F.count_distinct("district"), 25, 25),
        quality.Check("age_coverage", agg.known_share(F.col("age")), least=0.9, severity="warning"),
    ]
    return rounded(quality.run_checks(facilities(spark, d), checks))


@query("""
SELECT event_type, date_diff('day', max(ts)::DATE, DATE '2024-02-10')::INTEGER AS age_days, CASE WHEN date_diff('day', max(ts)::DATE, DATE '2024-02-10') BETWEEN 0 AND 11 THEN 'pass' ELSE 'fail' END AS status FROM events GROUP BY 1
""")
def freshness(spark, d):
    return quality.freshness(table(spark, d, "events"), ["event_type"], "ts", "2024-02-10", 11)


@query("""
WITH p AS (SELECT user_id, ts::DATE AS day, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts) AS n, count(*) OVER (PARTITION BY user_id, ts::DATE) AS total, value FROM events),
g AS (SELECT user_id, day, (n - 1) // 2 + 1 AS page, count(*) AS received, max(total) AS total FROM p WHERE value < 20 OR n <> 2 GROUP BY ALL)
SELECT user_id, day, count(DISTINCT page) AS pages_seen, greatest(1, ceil(max(total) / 2.0))::BIGINT AS pages_due, min(total) = max(total) AS steady, sum(received)::BIGINT AS received, max(total) AS total, max(page)::BIGINT AS last_page,
  count(DISTINCT page) = greatest(1, ceil(max(total) / 2.0)) AND max(page) = greatest(1, ceil(max(total) / 2.0)) AND sum(received) = max(total) AS complete
FROM g GROUP BY 1, 2
""")
def page_completeness(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id", "day")
    p = daily(spark, d).select("user_id", "day", F.row_number().over(w.orderBy("ts")).alias("n"), F.count(F.lit(1)).over(w).alias("total"), "value")
    g = p.filter("value < 20 OR n <> 2").groupBy("user_id", "day", F.expr("cast((n - 1) div 2 + 1 AS bigint)").alias("page")).agg(F.count(F.lit(1)).alias("received"), F.max("total").alias("total"))
    return quality.page_completeness(g, ["user_id", "day"], "page", 2, "total", "received")


# -- graphs and matching -----------------------------------------------------


@query("""
WITH RECURSIVE e AS (SELECT c_custkey AS a, c_custkey + 7 AS b FROM customer WHERE c_acctbal > 4000), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), n AS (SELECT DISTINCT a AS node FROM u),
reach(node, low) AS (SELECT node, node FROM n UNION SELECT u.b, r.low FROM reach r JOIN u ON u.a = r.node WHERE r.low < u.b)
SELECT node, min(low) AS component FROM reach GROUP BY 1
""")
def connected_components(spark, d):
    e = table(spark, d, "customer").filter("c_acctbal > 4000").select(F.col("c_custkey").alias("a"), (F.col("c_custkey") + 7).alias("b"))
    return graph.connected_components(e, "a", "b")


def registrations(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers and customers as records of two registers, with some names, phones and places in common."""
    key = F.col("id")
    rows = table(spark, d, "customer").select(F.lit("c").alias("source_id"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    rows = rows.unionByName(table(spark, d, "supplier").select(F.lit("s").alias("source_id"), F.col("s_suppkey").alias("id"), F.concat(F.lit("Customer#"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("name")))
    return rows.select(
        F.concat_ws(":", "source_id", "id").alias("key"), "source_id", F.when(key % 10 == 0, key.cast("string")).alias("record_id"), name_key("name").alias("name_key"),
        F.when(key % 4 != 0, F.lpad((key % 1000).cast("string"), 8, "0")).alias("phone"), F.array(F.concat(F.lit("street "), key)).alias("addresses"),
        F.array(F.concat(key % 3, F.lit("층"))).alias("units"), F.when(key % 2 == 0, F.array(F.concat(F.lit("b"), key))).otherwise(F.array().cast("array<string>")).alias("buildings"),
        F.lit(None).cast("double").alias("lon"), F.lit(None).cast("double").alias("lat"), ((F.col("source_id") == "s") & (key % 7 == 0)).alias("pension"),
    )


# A supplier and the customer of the same number share an address, a unit and, by number, a building, a phone and a record id.
PAIRS = """
SELECT 'c:' || c_custkey AS left_key, 's:' || s_suppkey AS right_key, CASE WHEN lower(c_name) = 'customer#' || lpad(s_suppkey::VARCHAR, 9, '0') THEN 1.0 END::DOUBLE AS similarity, c_custkey % 10 = 0 AS record_match, c_custkey % 2 = 0 AS building_match, c_custkey % 4 <> 0 AS phones_match, c_custkey % 7 = 0 AS pension
FROM customer JOIN supplier ON c_custkey = s_suppkey
"""


@query(f"""
SELECT left_key, right_key, similarity, CASE WHEN pension AND (record_match OR (building_match AND similarity >= 0.9)) THEN 'designation_link' WHEN building_match AND phones_match AND similarity >= 0.9 THEN 'auto_merge' WHEN similarity >= 0.94 THEN 'auto_merge' ELSE 'review' END AS decision FROM ({PAIRS})
""")
def entity_decisions(spark, d):
    r = registrations(spark, d)
    scored = matching.decide(matching.features(matching.candidate_pairs(r), r))
    return scored.select("left_key", "right_key", "decision", F.round("similarity", 6).alias("similarity"))


@query(f"""
SELECT 'c:' || c_custkey AS key, 'c:' || c_custkey AS facility FROM customer
UNION ALL SELECT 's:' || s_suppkey, coalesce(p.left_key, 's:' || s_suppkey) FROM supplier LEFT JOIN ({PAIRS}) p ON p.right_key = 's:' || s_suppkey AND p.similarity >= 0.94 WHERE s_suppkey % 7 <> 0
""")
def entity_facilities(spark, d):
    r = registrations(spark, d)
    decided = matching.adjudicate(matching.decide(matching.features(matching.candidate_pairs(r), r)), calibrated=True)
    return matching.merged(r.filter("NOT pension"), decided)[0]


# Customers of a nation and segment are a facility; an earlier id is shared by customers of several, and ids below 50 are aliases up to the next that ends in 9.
EARLIER = "(c_custkey * 7 + c_nationkey) % 97"


@query(f"""
WITH c AS (SELECT 'c:' || c_custkey AS key, c_nationkey || c_mktsegment AS part, {EARLIER} AS n FROM customer),
p AS (SELECT part, min(key) AS facility FROM c GROUP BY 1), a AS (SELECT n, min(key) AS key FROM c GROUP BY 1),
k AS (SELECT DISTINCT facility, CASE WHEN n < 50 THEN n - n % 10 + 9 ELSE n END AS n FROM c JOIN p USING (part) WHERE n <> 13),
f AS (SELECT n, min(facility) AS facility FROM k GROUP BY 1),
o AS (SELECT k.*, coalesce(own.part = p.part, false) AS anchored FROM k JOIN f USING (n, facility) JOIN p USING (facility) LEFT JOIN (SELECT a.n, c.part FROM a JOIN c USING (key)) own ON own.n = k.n)
SELECT p.facility, first(n ORDER BY NOT anchored, 'p' || n) AS kept, CASE WHEN count(n) = 0 THEN 'new' ELSE 'kept' END AS origin FROM p LEFT JOIN o USING (facility) GROUP BY 1
""")
def canonical_ids(spark, d):
    c = table(spark, d, "customer").select(F.concat(F.lit("c:"), "c_custkey").alias("key"), F.concat("c_nationkey", "c_mktsegment").alias("part"), F.expr(EARLIER).cast("int").alias("n"))
    name = lambda n: F.concat(F.lit("p"), n)
    facility = c.join(c.groupBy("part").agg(F.min("key").alias("facility")), "part").select("key", "facility")
    anchors = c.groupBy(name(F.col("n")).alias("canonical_id")).agg(F.min("key").alias("key"))
    aliases = c.filter("n < 50 AND n % 10 < 9").select(F.explode(F.expr("sequence(n, n - n % 10 + 8)")).alias("n")).distinct().select(name(F.col("n")).alias("alias"), name(F.col("n") + 1).alias("canonical_id"))
    ids = identity.surviving_ids(facility, c.filter("n <> 13").select("key", name(F.col("n")).alias("canonical_id")), anchors, aliases)[0]
    return ids.select("facility", F.when(F.col("origin") == "kept", F.substring("canonical_id", 2, 9).cast("bigint")).alias("kept"), "origin")


_ROW = "sha256('l_linenumber=i' || l_linenumber || ',l_orderkey=i' || l_orderkey || ',l_returnflag=' || coalesce('s' || strlen(l_returnflag) || ':' || l_returnflag, 'n') || ',l_shipdate=' || coalesce('d' || l_shipdate::DATE, 'n'))"
_ABOVE = "l{n} AS (SELECT {n} AS level, node // 64 AS node, sum(n_rows)::BIGINT AS n_rows, sha256(string_agg(digest, ',' ORDER BY node)) AS digest FROM l{m} WHERE (SELECT count(*) FROM l{m}) > 1 GROUP BY 2)"


@query(f"""
WITH r AS (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, digest) - 1 AS position, digest FROM (SELECT l_orderkey, l_linenumber, {_ROW} AS digest FROM lineitem)),
l0 AS (SELECT 0 AS level, position // 64 AS node, count(*) AS n_rows, sha256(string_agg(digest, ',' ORDER BY position)) AS digest FROM r GROUP BY 2),
{", ".join(_ABOVE.format(n=n, m=n - 1) for n in range(1, 6))}
{" UNION ALL ".join(f"SELECT level, node, n_rows, digest FROM l{n}" for n in range(6))}
""")
def ordered_digest(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.to_date("l_shipdate").alias("l_shipdate"))
    return digests.digest_tree(lines, ["l_orderkey", "l_linenumber"])


# The longest common subsequence by the rows of its table: a row's value at j is the best of what ends at any k up to j.
@query("""
WITH t AS (SELECT p_partkey, string_split(regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g'), '') AS a, string_split(regexp_replace(lower(p_type), '[^a-z0-9]', '', 'g'), '') AS b FROM part),
c AS (SELECT p_partkey, list_transform(a, lambda x: [ascii(x)::BIGINT]) AS a, list_transform(b, lambda x: ascii(x)::BIGINT) AS b FROM t),
r AS (SELECT p_partkey, len(a) AS n, len(b) AS m, list_reduce(list_prepend(list_transform(range(len(b) + 1), lambda j: 0::BIGINT), a),
  lambda row, x: list_transform(range(len(b) + 1), lambda j: coalesce(list_max(list_transform(range(1, j + 1), lambda k: greatest(row[k + 1], row[k] + CASE WHEN b[k] = x[1] THEN 1 ELSE 0 END))), 0)))[-1] AS common FROM c)
SELECT p_partkey, round(2.0 * common / (n + m), 6) AS similarity FROM r
""")
def name_similarity(spark, d):
    p = table(spark, d, "part")
    return rounded(p.select("p_partkey", indel_similarity(name_key("p_name"), name_key("p_type")).alias("similarity")))


# -- set operations ----------------------------------------------------------


@query("""
SELECT s_nationkey AS k, 'both' AS side FROM supplier INTERSECT SELECT c_nationkey, 'both' FROM customer WHERE c_acctbal > 9900
UNION ALL (SELECT s_nationkey, 'only_left' FROM supplier EXCEPT SELECT c_nationkey, 'only_left' FROM customer WHERE c_acctbal > 9900)
""")
def set_differences(spark, d):
    left = table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))
    right = table(spark, d, "customer").filter("c_acctbal > 9900").select(F.col("c_nationkey").alias("k"))
    return left.intersect(right).withColumn("side", F.lit("both")).union(left.subtract(right).withColumn("side", F.lit("only_left")))


@query("""
WITH k AS (SELECT n_name AS district FROM nation), m AS (SELECT unnest(range(DATE '1995-01-01', DATE '1995-07-01', INTERVAL 1 MONTH))::DATE AS month)
SELECT k.district, m.month, x.rooms FROM k CROSS JOIN m LEFT JOIN (""" + MONTHLY + """) x ON x.district = k.district AND x.month = m.month
""")
def pending_months(spark, d):
    return marts.month_spine(monthly(spark, d).select("district", "month", "rooms"), "1995-01-01", "1995-06-01", districts(spark, d).select("district"))


@query("SELECT 'r' || b.n_nationkey AS run FROM nation a, nation b WHERE a.n_nationkey = 23 AND (a.n_nationkey = b.n_nationkey OR (b.n_nationkey < a.n_nationkey AND a.n_nationkey % (b.n_nationkey + 1) = 2))")
def run_lineage(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("a"))
    name = lambda c: F.concat(F.lit("r"), c)
    edges = n.join(n.withColumnRenamed("a", "b"), F.expr("a = b OR (b < a AND a % (b + 1) = 2)"))
    runs = n.select(name("a").alias("run_id"), F.lit("PUBLISHED").alias("status"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("a")).alias("business_date"), F.lit(True).alias("rebuildable"))
    return marts.visible_runs(edges.select(name("a").alias("run_id"), name("b").alias("input_run_id")), runs, "r23")


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Every district's stock: counts, pooled distribution, shares and coverage, with unknown kept apart from zero."""
    return marts.district_marts(facilities(spark, d), districts(spark, d))
