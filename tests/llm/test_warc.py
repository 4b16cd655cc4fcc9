import base64
import gzip
import hashlib
import random

import pytest

from tessera.llm import warc
from tessera.llm.common import fresh_path

SCHEMA = "page_id long, url string, html string, shard string, first long"


def data():
    r = random.Random(3)
    rows = [(i, "http://a/%d" % i, r.choice(["<p>same</p>", "", None, "é" * 50, "x" * r.randrange(4000)]) if r.random() < 0.7 else "own %d" % i) for i in range(300)]
    rows += [(5, rows[5][1], rows[5][2]), (5, rows[5][1], rows[5][2]), (None, None, "alone"), (None, "u", "alone"), (None, "u", "own 1"), (-7, "neg", "same é"), (10**15, "far", "same é")]
    return [(*row, "clash", 1) for row in rows]


def expected(rows):
    sums = [base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() for _, _, h, *_ in rows]
    groups = {}
    for (i, *_), d in zip(rows, sums):
        groups.setdefault(d, []).append(i)
    out = []
    used = set()
    for (i, _, h, *_), d in zip(rows, sums):
        first = min((x for x in groups[d] if x is not None), default=None)
        response = i == first and (d, i) not in used
        used.add((d, i))
        out.append((i, len((h or "").encode()), d, "response" if response else "revisit", None if response else first))
    return out


def test_round_trip(spark):
    rows = data()
    got = warc.round_trip(spark.createDataFrame(rows, SCHEMA))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()]
    key = lambda x: tuple((v is not None, v or 0) if not isinstance(v, str) else v for v in x)
    assert sorted(got, key=key) == sorted(expected(rows), key=key)


def test_files_roll_are_deterministic_and_whole(spark):
    frames = [spark.createDataFrame(rows, SCHEMA).repartition(n) for n, rows in ((2, data()), (5, data()[::-1]))]
    manifests = []
    for df in frames:
        to = fresh_path(spark, "warc")
        m = warc.write(df, to, shard_bytes=50_000, roll_bytes=4_000)
        manifests.append(sorted(tuple(r) for r in m.collect()))
        for r in m.collect():
            raw = open(f"{to}/{r.name}".removeprefix("file://"), "rb").read()
            assert len(raw) == r.bytes and hashlib.sha256(raw).hexdigest() == r.sha256
            assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == r.records
        texts = {r.key: r.payload.decode() for r in warc.records(m, to).filter("record_type = 'response' AND key IS NOT NULL").collect()}
        assert all(texts[str(i)] == (h or "") for i, _, h, *_ in data() if str(i) in texts)
    assert manifests[0] == manifests[1] and len(manifests[0]) > 10


def test_damage_is_found(spark, tmp_path):
    one = warc.record("1", "u", b"payload", warc.sha1_base32(b"payload"), None)
    text = gzip.decompress(one)
    assert warc.parse(text)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(text.replace(b"payload\r\n\r\n", b"paYload\r\n\r\n"))
    (tmp_path / "f").write_bytes(one + one[: len(one) // 2])
    with pytest.raises(ValueError):
        list(warc.read_file(f"file://{tmp_path}/f"))


def test_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
