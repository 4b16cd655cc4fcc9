"""Files, pages and sinks on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.sources import files, pages, sinks


def test_pages_of_all_envelopes(spark):
    bodies = [
        ('{"data":[{"a":"1","b":null},{"a":"2"}],"totalCount":2}', 2, 2, "ok"),
        ('{"response":{"body":{"items":{"item":{"a":"1"}},"totalCount":"7"}}}', 1, 7, "ok"),
        ('{"body":{"items":{"item":[{"a":"1"},{"a":"2"},{"a":"3"}]},"totalCount":3}}', 3, 3, "ok"),
        ('{"data":[],"totalCount":0}', 0, 0, "empty"),
        ('{"data":[],"totalCount":5}', 0, 5, "malformed"),
        ("not json", 0, None, "malformed"),
        (None, 0, None, "malformed"),
    ]
    df = spark.createDataFrame([(i, b) for i, (b, *_) in enumerate(bodies)], "i int, body string")
    parsed = pages.parsed_pages(df, "body")
    assert [(r.received, r.total, r.state) for r in parsed.orderBy("i").collect()] == [tuple(x[1:]) for x in bodies]
    assert pages.exploded(parsed, ["i"]).count() == 6
    xml = "<response><body><items><item><a>x</a></item><item><a>y</a></item></items><totalCount>2</totalCount></body></response>"
    assert [r.a for r in spark.createDataFrame([(xml,)], "x string").select(F.explode(pages.xml_rows(F.col("x"), "a string")).alias("r")).select("r.a").collect()] == ["x", "y"]


def test_probe_states_and_newest_catalogue(spark):
    cases = [(200, None, 5, "READY"), (200, None, 0, "EMPTY"), (200, "30", 5, "AUTH_FAILED"), (200, "22", 5, "QUOTA_EXCEEDED"), (429, None, None, "QUOTA_EXCEEDED"), (500, None, None, "HTTP_FAILED"), (200, None, None, "SCHEMA_CHANGED")]
    df = spark.createDataFrame(cases, "http int, code string, total long, want string")
    assert df.filter(pages.source_state(F.col("http"), F.col("code"), F.col("total")) != F.col("want")).count() == 0
    assert df.filter(pages.source_state(F.col("http"), F.col("code"), F.col("total"), F.lit(False)) != "SPEC_UNRESOLVED").count() == 0
    rows = [("d", "2024-01-01", "u1"), ("d", "2024-02-01", "u0"), ("d", "2024-02-01", "u3"), ("d", None, "u9"), ("e", None, "x"), ("e", None, "y")]
    df = spark.createDataFrame(rows, "name string, day string, uddi string").select("name", F.col("day").cast("date").alias("data_as_of"), "uddi")
    assert {r.name: r.uddi for r in pages.newest_catalogue(df, "name").select(F.col("name"), "uddi").collect()} == {"d": "u3", "e": "y"}


def test_aliases_ignore_case_and_punctuation_and_keep_the_rest(spark):
    df = spark.createDataFrame([({"MNG-no": " 7 ", "Name": "", "업체명": "x", "Other Field": "o"},), ({"management_no": "9"},)], "row map<string,string>")
    got = pages.aliased(df, {"id": ("MNG_NO", "MANAGEMENT_NO"), "name": ("NAME", "업체명")}).select("id", "name", "extra").collect()
    assert [(r.id, r.name) for r in got] == [("7", "x"), ("9", None)] and got[0].extra == {"otherfield": "o"}


def test_file_discovery_and_dates(spark, tmp_path):
    for name in ("Busan_visitors_20240131.csv", "busan_other_2024.csv", "seoul_visitors.csv"):
        (tmp_path / name).write_text("a\n1\n")
    found = files.discover(spark, str(tmp_path), ["BUSAN"], ["visitors", "방문"])
    assert [r.path.rsplit("/", 1)[1] for r in found.collect()] == ["Busan_visitors_20240131.csv"]
    names = ["x_20240131.csv", "x_2024-02.csv", "x 2023 y", "none", "12024013199"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(files.file_date(F.col("n")).alias("d")).select("d.*").collect()
    assert [(str(r.day), r.grain) for r in got] == [("2024-01-31", "day"), ("2024-02-01", "month"), ("2023-01-01", "year"), ("None", "unknown"), ("None", "unknown")]


def test_delimited_files_of_two_encodings_and_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿이름,수\n가,1\n".encode())
    (tmp_path / "b.csv").write_bytes("수,이름\n2,나\n".encode("cp949"))
    (tmp_path / "c.csv").write_bytes("수,이름,more\n3,다,x\n".encode())
    got = sorted((r["이름"], r["수"], r["more"]) for r in files.read_delimited(spark, str(tmp_path)).collect())
    assert got == [("가", "1", None), ("나", "2", None), ("다", "3", "x")]
    (tmp_path / "bad").mkdir()
    with pytest.raises(Exception):
        files.read_delimited(spark, str(tmp_path / "bad"))
    (tmp_path / "bad" / "d.csv").write_text("a,,b\n1,2,3\n")
    with pytest.raises(ValueError):
        files.read_delimited(spark, str(tmp_path / "bad"))


def test_place_codes(spark):
    rows = [("2611010100", " 중앙동 ", "존재"), ("2611010100", "중앙동", None), ("2611010200", "동광동", "폐지"), ("2611010300", "x", "TRUE"), ("1111010100", "서울", None), ("261101", "short", None), ("2611010400", "y", "odd word")]
    df = spark.createDataFrame(rows, "code string, name string, closed string")
    assert sorted((r.code, r.name) for r in files.place_codes(df, "code", "name", "closed", "26").select("code", "name").collect()) == [("2611010100", "중앙동"), ("2611010400", "y")]


def square(x, y, n=1.0):
    return [[x, y], [x + n, y], [x + n, y + n], [x, y + n], [x, y]]


def test_boundaries_of_polygons_and_multipolygons(spark, tmp_path):
    feature = lambda code, kind, coordinates: {"type": "Feature", "properties": {"district": "d" + code[0], "dong_code": code, "dong_name": "n"}, "geometry": {"type": kind, "coordinates": coordinates}}
    body = {"type": "FeatureCollection", "features": [feature("1", "Polygon", [square(129, 35), square(129.2, 35.2, 0.1)]), feature("2", "MultiPolygon", [[square(128, 35)], [square(127, 34)]]), feature("3", "Point", [1, 2])]}
    (tmp_path / "b.json").write_text(json.dumps(body))
    got = files.boundaries(spark, str(tmp_path / "b.json"))
    rows = sorted((r.dong_code, None if r.rings is None else [len(x) for x in r.rings]) for r in got.collect())
    assert rows == [("1", [4, 4]), ("2", [4]), ("2", [4]), ("3", None)]
    checks = {r.check_name: r.status for r in files.boundary_checks(got.filter("rings IS NOT NULL"), 2, (124, 33, 132, 39)).collect()}
    assert checks == {"boundary_districts": "pass", "boundary_rings": "pass", "boundary_bounds": "pass", "boundary_codes": "pass"}


def test_sinks_are_idempotent(spark, tmp_path):
    at = f"file://{tmp_path}/t"
    df = spark.createDataFrame([(1, "a", "p"), (1, "b", "p"), (2, "c", "q")], "k int, v string, part string")
    for _ in range(2):
        sinks.append_new(df, at, ["k"])
    assert sorted((r.k, r.v) for r in spark.read.parquet(at).collect()) == [(1, "a"), (2, "c")]
    up = f"file://{tmp_path}/u"
    sinks.upsert(df, up, ["k"], [F.desc("v")], "part")
    sinks.upsert(spark.createDataFrame([(1, "z", "p"), (3, "n", "p")], df.schema), up, ["k"], [F.desc("v")], "part")
    assert sorted((r.k, r.v, r.part) for r in spark.read.parquet(up).collect()) == [(1, "z", "p"), (2, "c", "q"), (3, "n", "p")]
    runs = f"file://{tmp_path}/r"
    sinks.replace_run(spark.createDataFrame([("r1", 1), ("r2", 2)], "run_id string, v int"), runs)
    sinks.replace_run(spark.createDataFrame([("r1", 9)], "run_id string, v int"), runs)
    assert sorted((r.run_id, r.v) for r in spark.read.parquet(runs).collect()) == [("r1", 9), ("r2", 2)]
    raw = spark.createDataFrame([("s", "2024-01-01", "body"), ("s", "2024-01-01", "body"), ("s", "2024-01-02", "body")], "source_id string, ingest_date string, body string")
    for _ in range(2):
        sinks.write_artifacts(raw, f"file://{tmp_path}/a")
    stored = spark.read.parquet(f"file://{tmp_path}/a").collect()
    assert len(stored) == 2 and {r.n_bytes for r in stored} == {4}
    bad = spark.createDataFrame([("s", "2024-01-03", "b0dy", stored[0].content_hash, 4)], "source_id string, ingest_date string, body string, content_hash string, n_bytes long")
    bad.write.mode("append").partitionBy("source_id", "ingest_date").parquet(f"file://{tmp_path}/a")
    sound, quarantined = sinks.checked_artifacts(spark, f"file://{tmp_path}/a")
    assert sound.count() == 2 and [(r.body, r.reason) for r in quarantined.collect()] == [("b0dy", "hash_mismatch")]


def test_redaction_at_any_depth(spark):
    row = {"Service-Key": "abc", "q": "plain", "body": '{"a":{"api_key":"x","n":[1,{"Token": 5}]},"author":"me","list":[{"password":{"p":1}}],"ok":"t"}'}
    got = sinks.redacted(spark.createDataFrame([(row,)], "m map<string,string>"), "m").first().m
    assert got["Service-Key"] == "[redacted]" and got["q"] == "plain"
    assert json.loads(got["body"]) == {"a": {"api_key": "[redacted]", "n": [1, {"Token": "[redacted]"}]}, "author": "[redacted]", "list": [{"password": "[redacted]"}], "ok": "t"}


def test_export_verifies_and_finds_damage(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    folder = f"file://{tmp_path}/e"
    sinks.export({"one": df, "two": df.limit(1)}, folder)
    assert {r["name"]: r.status for r in sinks.verify_export(spark, folder).collect()} == {"one": "pass", "two": "pass"}
    df.limit(1).write.mode("overwrite").parquet(f"{folder}/one.parquet")
    assert {r["name"]: r.status for r in sinks.verify_export(spark, folder).collect()} == {"one": "fail", "two": "pass"}
    line = sinks.geojson_features(spark.createDataFrame([('{"type":"Point","coordinates":[1,2]}', "x", None)], "g string, a string, b string"), "g", ["a", "b"]).first().value
    assert json.loads(line) == {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {"a": "x", "b": None}}


def test_publication_log(spark, tmp_path):
    at = f"file://{tmp_path}/log"
    gate = lambda ok: spark.createDataFrame([(ok,)], "publishable boolean")
    sinks.publish(spark, at, "r1", "2024-01-31", gate(True))
    sinks.publish(spark, at, "r2", "2024-02-29", gate(True))
    with pytest.raises(ValueError):
        sinks.publish(spark, at, "r3", "2024-03-31", gate(False))
    with pytest.raises(ValueError):
        sinks.publish(spark, at, "r0", "2023-12-31", gate(True))
    checks = spark.createDataFrame([("a", "pass", 1.0, "", "required")], "check_name string, status string, actual double, expected string, severity string")
    with pytest.raises(ValueError):
        sinks.publish(spark, at, "r4", "2024-04-30", gate(True), suite=(checks, "another hash"))
    assert sinks.current_run(spark, at).first().run_id == "r2"
    sinks.publish(spark, at, "r0", "2023-12-31", gate(True), reason="rollback")
    assert sinks.current_run(spark, at).first().run_id == "r0"


def test_spatial_bundle(spark, tmp_path):
    cells = spark.createDataFrame([("g1", "d", '{"type":"Polygon","coordinates":[]}'), ("g2", None, '{"type":"Polygon","coordinates":[]}')], "grid_id string, district string, geometry string")
    places = spark.createDataFrame([("f1", 129.1234567891, 35.0)], "facility_id string, lon double, lat double")
    folder = f"file://{tmp_path}/s"
    manifest = {r["name"]: r.n_rows for r in sinks.export_spatial(cells, places, folder).collect()}
    assert manifest == {"cells": 2, "facilities": 1}
    point = json.loads(spark.read.text(f"{folder}/facilities.geojsonl").first().value)
    assert point["geometry"]["coordinates"] == [129.123456789, 35.0] and point["properties"] == {"facility_id": "f1"}
    assert {r["name"]: r.status for r in sinks.verify_export(spark, folder).collect()} == {"cells": "pass", "facilities": "pass"}
