"""Lineage, quality, matching, spatial and streaming rules against plain Python."""

import datetime as dt
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import geo
from tessera.functions.parsing import year_month
from tessera.functions.text import indel_similarity, name_key, nfkc
from tessera.operators import graph, joins, matching, quality, spatial, windows
from tessera.plans import marts
from tessera.streaming import revisions


def lineage(spark, edges, runs, target="c", published=None):
    got = marts.visible_runs(spark.createDataFrame(edges, "run_id string, input_run_id string"), spark.createDataFrame(runs, "run_id string, status string, business_date date, rebuildable boolean"), target, published)
    return sorted(r.run for r in got.collect())


def test_lineage_is_audited(spark):
    own = [(r, r) for r in "abc"]
    day = lambda n: dt.date(2024, 1, n)
    runs = [("a", "PUBLISHED", day(1), True), ("b", "PUBLISHED_WITH_WARNINGS", day(2), True), ("c", "RUNNING", day(3), True)]
    assert lineage(spark, [*own, ("c", "b"), ("b", "a")], runs) == ["b", "c"]
    bad = [
        ([*own, ("c", "b"), ("b", "a"), ("a", "b")], runs),  # a circle
        ([("a", "a"), ("c", "c"), ("c", "b")], runs),  # b lists no self
        ([("c", "b"), ("b", "b")], runs),  # nor does the run
        ([*own, ("c", "b")], [runs[0], ("b", "FAILED", day(2), True), runs[2]]),
        ([*own, ("c", "b")], [runs[0], ("b", "RUNNING", day(2), True), runs[2]]),
        ([*own, ("c", "b")], [runs[0], ("b", "PUBLISHED", day(9), True), runs[2]]),
        ([*own, ("c", "b")], [runs[0], ("b", "PUBLISHED", None, True), runs[2]]),
        ([*own, ("c", "b")], [runs[0], ("b", "PUBLISHED", day(2), False), runs[2]]),
        ([*own, ("c", "b")], [runs[0], runs[1], ("c", "RUNNING", day(3), None)]),
        ([*own, ("c", "x"), ("x", "x")], runs),  # an unknown run
    ]
    for edges, table in bad:
        with pytest.raises(ValueError):
            lineage(spark, edges, table)
    assert lineage(spark, [*own, ("c", "b")], [runs[0], ("b", "RUNNING", day(2), True), runs[2]], published="b") == ["b", "c"]


def test_gate_fails_closed(spark):
    rows = [("a", "pass", 1.0, "", "required"), ("b", "fail", 0.0, "", "warning")]
    checks = spark.createDataFrame(rows, "check_name string, status string, actual double, expected string, severity string")
    state = lambda df, names: tuple(quality.gate(df, names).first())
    assert state(checks, ["a", "b"]) == (True, 0, 0) and state(checks, ["a", "b", "c"]) == (False, 1, 0)
    worse = quality.all_checks([checks.filter("check_name = 'a'"), checks.filter("check_name = 'b'").withColumn("severity", F.lit("required"))])
    assert state(worse, ["a", "b"]) == (False, 0, 1)
    counted = quality.active_change(spark.createDataFrame([(90,)], "n long"), spark.createDataFrame([(100,)], "n long"))
    more = quality.as_checks(counted, "active_change", "change", "<=0.2", "required")
    assert state(quality.all_checks([checks, more]), ["a", "b", "active_change"]) == (True, 0, 0)
    low = quality.run_checks(spark.range(3), [quality.Check("few", F.count(F.lit(1)), least=5, severity="warning"), quality.Check("some", F.count(F.lit(1)), least=5)])
    assert {r.check_name: r.status for r in low.collect()} == {"few": "warning", "some": "fail"}
    assert quality.suite_hash(checks).first().suite_hash == quality.suite_hash(checks.orderBy(F.desc("check_name"))).first().suite_hash != quality.suite_hash(worse).first().suite_hash
    files = spark.createDataFrame([("p", bytearray(b"x")), ("q", bytearray(b"y"))], "path string, content binary")
    recorded = files.select("path", F.sha2("content", 256).alias("content_hash")).unionByName(spark.createDataFrame([("gone", "0")], "path string, content_hash string"))
    changed = files.withColumn("content", F.when(F.col("path") == "q", F.lit(bytearray(b"z"))).otherwise(F.col("content")))
    assert {r.path: r.status for r in quality.content_hashes(changed, recorded).collect()} == {"p": "pass", "q": "fail", "gone": "fail"}
    seen = quality.schema_fingerprint(spark.createDataFrame([("g", '{"b":1,"a":2}')], "g string, j string"), ["g"], "j")
    good = quality.fingerprint_check(seen, seen, ["g"]).first().status
    assert good == "pass" and quality.fingerprint_check(seen, seen.limit(0), ["g"]).first().status == "fail"


# -- matching ----------------------------------------------------------------


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def similarity(a, b):
    return 0.0 if a is None or b is None else 1.0 if not a and not b else 2 * common(a, b) / (len(a) + len(b))


def test_name_similarity_matches_the_table_of_subsequences(spark):
    r = random.Random(3)
    texts = ["", None, "호텔서울", "hotel", "x" * 90] + ["".join(r.choice("abc가나") for _ in range(r.randint(0, 20))) for _ in range(40)]
    pairs = [(a, b) for a in texts for b in texts[:12]]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", indel_similarity("a", "b").alias("s")).collect()
    assert all(abs(g.s - similarity(g.a, g.b)) < 1e-12 for g in got) and len(got) == len(pairs)


def test_name_keys(spark):
    cases = [("Ｈotel  Sea-side!", "hotelseaside"), ("호텔 (주)", "호텔주"), ("STRASSE ß", "strassess"), ("--", None), (None, None), ("é", "é")]
    df = spark.createDataFrame(cases, "name string, want string")
    assert df.filter(~name_key("name").eqNullSafe(F.col("want"))).count() == 0
    assert spark.createDataFrame([("１２　３", ), (None,)], "x string").select(nfkc("x").alias("y")).first().y == "12 3"


SCHEMA = "key string, source_id string, record_id string, name_key string, phone string, addresses array<string>, units array<string>, buildings array<string>, lon double, lat double, pension boolean"


def registers(n=60, seed=5):
    r = random.Random(seed)
    pick = lambda *x: r.choice(x)
    names = ["seaside", "seasyde", "hillhouse", "hillhous", "harbour", None]
    return [
        (f"k{i:03d}", pick("a", "b", "p"), pick(None, f"r{i % 9}"), pick(*names), pick(None, "111", "222"), [f"st{r.randrange(6)}"] if r.random() < 0.7 else [], [f"u{r.randrange(3)}"] if r.random() < 0.5 else [], [f"b{r.randrange(12)}"] if r.random() < 0.4 else [],
         pick(None, 129.0 + r.randrange(4) * 0.0002), 35.1 + r.randrange(4) * 0.0001, r.random() < 0.15)
        for i in range(n)
    ]


def metres(a, b):
    (lon1, lat1), (lon2, lat2) = a, b
    h = np.sin(np.radians(lat2 - lat1) / 2) ** 2 + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6_371_000 * np.arcsin(min(1, np.sqrt(h)))


def plain_decision(x, y):
    _, sa, ra, na, pa, aa, ua, ba, oa, la, da = x
    _, sb, rb, nb, pb, ab, ub, bb, ob, lb, db = y
    s = similarity(na, nb)
    same_record, building, address, unit = ra is not None and ra == rb, bool(set(ba) & set(bb)), bool(set(aa) & set(ab)), bool(set(ua) & set(ub))
    phones, differ = pa is not None and pa == pb, pa is not None and pb is not None and pa != pb
    identified = any(v is not None for v in (na, nb, pa, pb))
    near = oa is not None and ob is not None and metres((oa, la), (ob, lb)) <= 30 and s >= 0.8
    candidate = same_record or building or (address and identified) or near
    if (da or db) and (same_record or (building and s >= 0.9)):
        return "designation_link"
    if same_record and sa == sb:
        return "auto_merge"
    if (building and phones and s >= 0.9) or (address and s >= 0.94 and (phones or unit)):
        return "auto_merge"
    if address and not identified:
        return "review"
    if differ and s < 0.75:
        return "separate"
    return "review" if candidate else "separate"


def test_decisions_match_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(matching, "LARGE_BLOCK", 5)  # so that blocks are dealt
    rows = registers()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.left_key, r.right_key): r.decision for r in matching.decide(matching.features(matching.candidate_pairs(df), df)).collect()}
    want = {(x[0], y[0]): plain_decision(x, y) for x, y in itertools.combinations(rows, 2)}
    assert all(want[p] == d for p, d in got.items())
    assert all(p in got for p, d in want.items() if d in ("auto_merge", "designation_link")) and len(set(got.values())) == 4


def test_merging_never_joins_what_is_kept_apart(spark):
    rows = registers(seed=8)
    df = spark.createDataFrame(rows, SCHEMA)
    decided = matching.adjudicate(matching.decide(matching.features(matching.candidate_pairs(df), df)), calibrated=True)
    facility, blocked = matching.merged(df, decided)
    of = {r.key: r.facility for r in facility.collect()}
    pairs = decided.collect()
    assert len(of) == len(rows) and len(set(of.values())) < len(rows)
    apart = {(r.left_key, r.right_key) for r in pairs if r.decision in ("review", "separate") or r.phones_conflict}
    assert all(of[a] != of[b] for a, b in apart)
    refused = {(r.left_key, r.right_key) for r in blocked.collect()}
    assert all(of[r.left_key] == of[r.right_key] or (r.left_key, r.right_key) in refused for r in pairs if r.decision == "auto_merge")
    ruling = spark.createDataFrame([(*next((r.left_key, r.right_key) for r in pairs if r.decision == "review"), "merge")], "left_key string, right_key string, ruling string")
    assert matching.adjudicate(matching.decide(matching.features(matching.candidate_pairs(df), df)), ruling).filter("decision = 'auto_merge'").count() == 1
    reviews = matching.review_rows(decided, facility, blocked).collect()
    assert {(r.left_key, r.right_key) for r in reviews} == {p for p in refused | {(r.left_key, r.right_key) for r in pairs if r.decision == "review"} if of[p[0]] != of[p[1]]}
    pensions = df.filter("pension").select("key")
    links = {}
    for r in pairs:
        if r.decision == "designation_link":
            for a, b in ((r.left_key, r.right_key), (r.right_key, r.left_key)):
                links.setdefault(a, set()).add(b)
    own = {r.key for r in pensions.collect()}
    for r in matching.attach_designations(decided, facility, pensions).collect():
        found = {of[b] for b in links.get(r.key, ()) if b not in own}
        assert (r.facility, r.reason) == ((next(iter(found)), None) if len(found) == 1 else (None, "unmatched" if not found else "ambiguous"))


def test_merge_quality(spark):
    row = matching.merge_quality(spark.createDataFrame([("auto_merge", "auto_merge")] * 19 + [("auto_merge", "review"), ("review", "auto_merge")], "decision string, expected string")).first()
    assert (row.predicted, row.correct, row.precision) == (20, 19, 0.95) and 0.7 < row.lower_bound < 0.95


# -- spatial -----------------------------------------------------------------


def test_projection_and_its_inverse_agree(spark):
    rows = [(128.7 + i * 0.05, 35.0 + j * 0.05) for i in range(8) for j in range(8)]
    df = spark.createDataFrame(rows, "lon double, lat double").withColumn("p", geo.projected(F.col("lon"), F.col("lat"))).withColumn("g", geo.geographic(F.col("p.x"), F.col("p.y")))
    got = df.collect()
    assert all(abs(r.g.lon - r.lon) < 2e-7 and abs(r.g.lat - r.lat) < 2e-7 for r in got)
    a, b = got[0], got[1]  # 0.05 degrees of latitude are about 5,547 m
    assert abs(np.hypot(b.p.x - a.p.x, b.p.y - a.p.y) - metres((a.lon, a.lat), (b.lon, b.lat))) < 20


def test_points_are_resolved_by_the_stated_system(spark):
    rows = [("EPSG:4326", 129.0, 35.1, None, None, None), (" EPSG:5174 ", None, None, 382293.0, 179709.0, None), (None, 129.0, 35.1, None, None, "UNKNOWN_CRS"), ("EPSG:3857", 1.0, 2.0, None, None, "UNKNOWN_CRS"), ("EPSG:4326", None, None, 1.0, 2.0, "CRS_MISMATCH"), ("EPSG:4326", None, None, None, None, "MISSING_COORDINATES"), ("EPSG:4326", 129.0, None, None, None, "INVALID_COORDINATES"), ("EPSG:4326", float("nan"), 35.0, None, None, "INVALID_COORDINATES"), ("EPSG:4326", 12.0, 35.0, None, None, "OUTSIDE_SOUTH_KOREA")]
    df = spark.createDataFrame(rows, "coordinate_crs string, longitude double, latitude double, projected_x double, projected_y double, want string")
    got = spatial.resolve_points(df).collect()
    assert [r.exception_code for r in got] == [r[-1] for r in rows]
    assert got[0].grid_id == got[1].grid_id == "g5174_500_764_359" and all(r.grid_id is None for r in got[2:])


def ring(points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def test_grid_cells_share_the_area_of_polygons(spark):
    rows = [("d1", "01", "a", [ring([(0, 0), (1300, 0), (1300, 700), (0, 700)]), ring([(100, 100), (200, 100), (200, 200), (100, 200)])]), ("d1", "02", "b", [ring([(1300, 0), (2000, 0), (2000, 700), (1300, 700)])]), ("d2", "03", "c", [ring([(0, 1000), (500, 1000), (250, 1500)])])]
    cells = {r.grid_id: (r.dong_code, round(r.inside_area, 6)) for r in spatial.grid_cells(spark.createDataFrame(rows, f"district string, dong_code string, dong_name string, rings {spatial.RING}")).collect()}
    assert cells == {"g5174_500_0_0": ("01", 240000.0), "g5174_500_1_0": ("01", 250000.0), "g5174_500_2_0": ("01", 250000.0), "g5174_500_3_0": ("02", 250000.0), "g5174_500_0_1": ("01", 100000.0), "g5174_500_1_1": ("01", 100000.0), "g5174_500_2_1": ("01", 100000.0), "g5174_500_3_1": ("02", 100000.0), "g5174_500_0_2": ("03", 125000.0)}


def test_grid_areas_make_up_the_districts(spark):
    cells = spark.createDataFrame([("a", 10.0), ("a", 5.0), ("b", 1.0), ("c", 1.0)], "district string, inside_area double")
    expected = spark.createDataFrame([("a", 15.0), ("b", 2.0), ("d", 1.0)], "district string, area double")
    assert sorted(tuple(r) for r in spatial.grid_problems(cells, expected).collect()) == [("area_differs", "b"), ("area_differs", "d"), ("unknown_district", "c")]


def test_points_in_polygons_edges_and_holes(spark):
    rings = [ring([(0, 0), (1000, 0), (1000, 1000), (0, 1000)]), ring([(400, 400), (600, 400), (600, 600), (400, 600)])]
    polygons = spark.createDataFrame([("p", rings), ("q", [ring([(900, 900), (2000, 900), (1450, 2000)])])], f"name string, rings {spatial.RING}")
    points = [(1, 10.0, 10.0, "p"), (2, 500.0, 500.0, None), (3, 0.0, 500.0, "p"), (4, 1000.0, 1000.0, "pq"), (5, 1400.0, 1500.0, "q"), (6, -1.0, 5.0, None), (7, 400.0, 500.0, "p")]
    got = spatial.points_in(spark.createDataFrame([p[:3] for p in points], "i int, x double, y double"), polygons).collect()
    assert sorted((r.i, r.name) for r in got) == sorted((i, n) for i, _, _, names in points for n in names or "")
    counts = spark.createDataFrame([("a", 3), ("b", 1)], "district string, n_mapped int")
    assert [r.district for r in spatial.quarantined(counts, spark.createDataFrame([("a", 2), ("b", 2)], "district string, n_observed int")).collect()] == ["a"]


# -- streams and the rest ----------------------------------------------------


def test_streams_drop_replays_and_keep_late_corrections(spark, tmp_path):
    source, store, done = (f"{tmp_path}/{n}" for n in ("in", "out", "check"))
    schema = "k int, rev int, v double, ts timestamp"

    def arrive(rows):
        spark.createDataFrame([(k, r, v, dt.datetime(2024, 1, d)) for k, r, v, d in rows], schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        revisions.upsert_latest(spark.readStream.schema(schema).parquet(source), store, done, ["k"], [F.desc("rev")]).awaitTermination()
        return {r.k: r.v for r in revisions.current(spark.read.parquet(store), ["k"], [F.desc("rev")]).collect()}

    arrive([(1, 1, 1.0, 1), (1, 2, 2.0, 2), (2, 1, 5.0, 1)])
    assert run() == {1: 2.0, 2: 5.0}
    arrive([(1, 1, 9.0, 3), (2, 7, 6.0, 1)])  # an old revision that comes late changes nothing, a newer one does
    assert run() == {1: 2.0, 2: 6.0} == run()
    seen = revisions.visible_stream(spark.readStream.schema(schema).parquet(source), "ts", "2024-01-01 12:00:00", "1 day")
    q = seen.writeStream.format("memory").queryName("seen_rows").option("checkpointLocation", f"{tmp_path}/c1").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.k, r.rev) for r in spark.table("seen_rows").collect()) == [(1, 1), (2, 1), (2, 7)]
    arrive([(1, 2, 2.0, 2)])
    stream = revisions.once(spark.readStream.schema(schema).parquet(source), ["k", "rev"], "ts", "60 days")
    q = stream.writeStream.format("memory").queryName("once_rows").option("checkpointLocation", f"{tmp_path}/c2").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("once_rows").count() == 4  # (1, 1), (1, 2), (2, 1), (2, 7)
    sums = revisions.daily_sums(spark.readStream.schema(schema).parquet(source), ["k"], "ts", "v", "1 day")
    q = sums.writeStream.format("memory").queryName("daily_rows").outputMode("complete").option("checkpointLocation", f"{tmp_path}/c3").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.k, str(r.day), str(r.month)): r.v for r in spark.table("daily_rows").collect()} == {(1, "2024-01-01", "2024-01-01"): 1.0, (1, "2024-01-02", "2024-01-01"): 4.0, (1, "2024-01-03", "2024-01-01"): 9.0, (2, "2024-01-01", "2024-01-01"): 11.0}


def test_public_keys_number_all_rows_in_order(spark):
    df = spark.createDataFrame([(i * 7 % 1009,) for i in range(1009)], "k int")
    assert [(r.k, r.public_key) for r in windows.public_keys(df, "k", "x").orderBy("k").collect()] == [(i, f"x-{i + 1:06d}") for i in range(1009)]
    assert windows.public_keys(df.limit(0), "k", "x").count() == 0


def test_components_end_and_group_bands_agree(spark):
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 51)], "a int, b int"), "a", "b").collect()}
    assert got == {**dict.fromkeys(range(31), 0), 50: 50, 51: 50}
    bands = spark.createDataFrame([("g", "low"), ("g", "low"), ("h", "low"), ("h", "high"), ("i", None)], "g string, band string")
    assert {r.g: r.band for r in marts.group_band(bands, ["g"], "band").collect()} == {"g": "low", "h": "unclassified", "i": "unclassified"}
    rows = spark.createDataFrame([("d", "f1", "tourist_accommodations", "1"), ("d", "f1", "foreigner_city_homestays", "2"), ("d", "f2", "lodgings", "3")], "district string, facility_id string, source_id string, record_id string")
    r = marts.period_shares(rows).first()
    assert (r.facilities, r.registrations, r.tourism_share, r.foreigner_share, r.foreign_capable_share) == (2, 3, 0.5, 1 / 3, 2 / 3)
    months = spark.createDataFrame([("2024", "1"), ("2024", "13"), (None, "2"), ("24x", "3")], "y string, m string").select(year_month(F.col("y"), F.col("m")).alias("d"))
    assert [r.d for r in months.collect()] == [dt.date(2024, 1, 1), None, None, None]
    assert joins.missing(rows.select("facility_id"), rows.filter("facility_id = 'f1'").select("facility_id"), ["facility_id"]).count() == 1
