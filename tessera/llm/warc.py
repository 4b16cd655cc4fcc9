"""Deterministic sharded WARC writer and reader.

Records are ordered by id.  Shards are ranges of ids that hold about SHARD_BYTES of payload each, taken from exact
running sums, so the same rows give the same shards on any cluster; from MOST_SHARDS on they grow instead, so that
their bounds stay a short list.  A shard is a partition of its own, written by one task, which rolls to a new file when a file's compressed size reaches ROLL_BYTES.  Headers and digests are made anew from
the payload; of equal payloads of at least MIN_REVISIT bytes the smallest id is a response and the others are
revisits of it.  Each attempt writes under a temporary name of its own and returns a manifest row per file
(name, size, records, SHA-256); the files of the attempts that Spark accepted are renamed to their final names
by tasks, the manifest is written as a table, and a _SUCCESS marker comes last.  A lost executor leaves only a
temporary file behind, and a repeated rename finds its work done.

Files are reached through pyarrow's file systems, so the folder may be any store that those open.

Defined results: a null payload is empty; null ids have shards of their own, as many as their bytes ask for, dealt by
payload; they are revisits of any other row
with the payload; rows that repeat an id and payload are one response and revisits of it; a null url is written as
an empty URI; an empty table gives a manifest without rows.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import fresh_path, mapped, written

DATE = "2024-01-01T00:00:00Z"
SHARD_BYTES = 16 << 20
ROLL_BYTES = 2 << 20
MIN_REVISIT = 0
MOST_SHARDS = 1 << 16
_SPACE = uuid.UUID("6ba7b812-9dad-11d1-80b4-00c04fd430c8")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
MANIFEST = pa.schema([("shard", pa.int64()), ("part", pa.int64()), ("tmp", pa.string()), ("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])
RECORDS = pa.schema([("key", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())])
FILES = "shard long, part long, tmp string, name string, records long, bytes long, sha256 string"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{key}/{digest}')}>"


def record(key: str, url: str, payload: bytes, digest: str, refers: str | None, date: str = DATE) -> bytes:
    """One WARC/1.1 record as a gzip member; refers: the key of the response that a revisit points at."""
    block = _HTTP % len(payload) + (payload if refers is None else b"")
    head = [
        ("WARC-Type", "response" if refers is None else "revisit"),
        ("WARC-Record-ID", record_id(key, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("X-Record-Key", key),
    ]
    if refers is not None:
        head += [("WARC-Refers-To", record_id(refers, digest)), ("X-Refers-To-Key", refers), ("WARC-Profile", _PROFILE)]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)  # gzip without a time
    return pack.compress(text.encode() + block + b"\r\n\r\n") + pack.flush()


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def shard_bounds(sizes: DataFrame, shard_bytes: int) -> tuple[list, int]:
    """The first ids of all shards but the first, and the number of shards for rows without an id; from sizes (id, n)."""
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("bare"), F.count_if(F.col("id").isNull()).alias("rows")).first()
    step = max(shard_bytes, -(-total.n // MOST_SHARDS))
    per = sizes.filter("id IS NOT NULL").groupBy("id").agg(F.sum("n").alias("n"))
    ranged = per.repartitionByRange("id").select("id", "n", F.spark_partition_id().alias("part"))
    ranged = written(ranged, "ranged")  # the partitions' numbers are fixed from here on
    # a row for each partition; what is before it
    before = ranged.groupBy("part").agg(F.sum("n").alias("held")).select("part", (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("before"))
    run = F.sum("n").over(Window.partitionBy("part").orderBy("id")) - F.col("n")
    shards = ranged.join(written(before, "before"), "part").select("id", F.floor((F.col("before") + run) / step).alias("shard"))
    firsts = shards.groupBy("shard").agg(F.min("id").alias("id")).orderBy("id").collect()  # at most MOST_SHARDS + 1
    return [r.id for r in firsts[1:]], -(-total.bare // step) or min(total.rows, 1)


def _shard_of(bounds: list, bare: int, kind: str) -> Column:
    """How many bounds are at or below the id: first among every 256th, then among the 256 there."""
    step = 256
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    heads = F.from_json(F.lit(json.dumps([g[0] for g in groups])), f"array<{kind}>")
    inner = F.from_json(F.lit(json.dumps(groups)), f"array<array<{kind}>>")
    at = F.size(F.filter(heads, lambda b: b <= F.col("id")))
    within = F.when(at == 0, 0).otherwise((at - 1) * step + F.size(F.filter(F.get(inner, at - 1), lambda b: b <= F.col("id"))))
    spread = F.lit(len(bounds) + 1) + F.pmod(F.xxhash64("hexed"), F.lit(max(bare, 1)))
    return F.when(F.col("id").isNull(), spread).otherwise(within).cast("long")


def _write_sorted(batches: Iterator[pa.RecordBatch], to: str, roll_bytes: int) -> Iterator[pa.RecordBatch]:
    """Write rows that come in order of shard and id; a manifest row for each file."""
    attempt = uuid.uuid4().hex
    fs, root = _open(to)
    stream, digest, row, last, seen = None, None, {}, None, set()

    def closed() -> pa.RecordBatch:
        stream.close()
        return pa.RecordBatch.from_pylist([row | {"sha256": digest.hexdigest()}], schema=MANIFEST)

    for batch in batches:
        for shard, key, url, payload, shared, first in zip(*(batch.column(c).to_pylist() for c in ("shard", "id", "url", "payload", "shared", "first")), strict=True):
            if stream is not None and (shard != row["shard"] or row["bytes"] >= roll_bytes):
                part = row["part"] + 1 if shard == row["shard"] else 0
                yield closed()
                stream = None
            elif stream is None:
                part = 0
            if stream is None:
                name = f"records-{shard:06d}-{part:05d}.warc.gz"
                row = {"shard": shard, "part": part, "tmp": f"_tmp/{attempt}-{name}", "name": name, "records": 0, "bytes": 0}
                fs.create_dir(f"{root}/_tmp", recursive=True)
                stream, digest = fs.open_output_stream(f"{root}/{row['tmp']}", compression=None), hashlib.sha256()
            data = payload.encode()
            name_of = sha1_base32(data)
            if key != last:
                last, seen = key, set()
            response = not shared or (key == first and name_of not in seen)
            seen.add(name_of)
            packed = record(_key(key), (url or "").replace("\r", "%0D").replace("\n", "%0A"), data, name_of, None if response else _key(first))
            stream.write(packed)
            digest.update(packed)
            row["records"] += 1
            row["bytes"] += len(packed)
    if stream is not None:
        yield closed()


def _key(value) -> str:
    return "" if value is None else str(value)


def write(pages: DataFrame, to: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write `pages` (integer or string ids) under the folder `to`; returns the manifest (shard, part, name, records, bytes, sha256)."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"), F.sha1(payload.cast("binary")).alias("hexed"))
    sizes = written(rows.select("id", F.octet_length("payload").cast("long").alias("n"), "hexed"), "payloads")
    firsts = sizes.filter(F.col("n") >= min_revisit).groupBy(F.col("hexed").alias("h")).agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    firsts = written(firsts.filter("copies > 1").select("h", "first"), "firsts")
    # rows that share a payload are marked by id, so that no partition gathers the pages of a common payload
    marks = sizes.select(F.col("id").alias("of_id"), "hexed").distinct().join(firsts, F.col("hexed") == F.col("h")).select("of_id", "h", "first")
    bounds, bare = shard_bounds(sizes, shard_bytes)
    rows = rows.join(written(marks, "marks"), F.col("id").eqNullSafe(F.col("of_id")) & (F.col("hexed") == F.col("h")), "left")
    rows = rows.select(_shard_of(bounds, bare, pages.schema[id_col].dataType.simpleString()).alias("shard"), "id", "url", "payload", F.col("h").isNotNull().alias("shared"), "first")
    rows = rows.repartitionById(len(bounds) + 1 + bare, F.col("shard").cast("int")).sortWithinPartitions("shard", "id", F.col("url").asc_nulls_first(), "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _write_sorted(batches, to, roll_bytes)

    tried = written(rows.mapInArrow(run, FILES), "tried")

    def rename(batch: pa.RecordBatch) -> pa.RecordBatch:
        for tmp, name, size in zip(*(batch.column(c).to_pylist() for c in ("tmp", "name", "bytes")), strict=True):
            fs, src = _open(f"{to}/{tmp}")
            dst = _open(f"{to}/{name}")[1]
            if fs.get_file_info(src).type != pafs.FileType.NotFound:
                fs.move(src, dst)
            elif fs.get_file_info(dst).size != size:  # neither the source nor an earlier rename's result
                raise OSError(f"{name} is lost")
        return batch

    done = mapped(tried, rename, FILES, text=None).drop("tmp")
    done.write.parquet(f"{to}/manifest")
    manifest = spark.read.schema(done.schema).parquet(f"{to}/manifest")
    total = manifest.agg(F.count("*").alias("files"), F.coalesce(F.sum("records"), F.lit(0)).alias("records")).first()
    fs, path = _open(f"{to}/_SUCCESS.json")
    with fs.open_output_stream(path) as f:
        f.write(json.dumps({"files": total.files, "records": total.records}).encode())
    return manifest


def records(manifest: DataFrame, at: str, payloads: bool = True) -> DataFrame:
    """(key, url, record_type, payload_bytes, payload_digest, refers_to, payload) of all records of the files, each checked against its digests.

    payload is null for revisits, and everywhere if `payloads` is false.
    """
    n = max(1, min(manifest.count(), 100_000))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, held = [], 0
                for row in read_file(f"{at}/{name}"):
                    held += len(row["payload"] or b"")
                    rows.append(row if payloads else row | {"payload": None})
                    if held > 4 << 20 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_pylist(rows, schema=RECORDS)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=RECORDS)

    return manifest.select("name").repartition(n).mapInArrow(each, "key string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary")


def read_file(path: str) -> Iterator[dict]:
    """The records of a file, one gzip member at a time."""
    fs, at = _open(path)
    with fs.open_input_stream(at, compression=None) as f:
        data, unpack, out = b"", zlib.decompressobj(31), []
        while data or (data := f.read(1 << 16)):
            out.append(unpack.decompress(data))
            data = b""
            if unpack.eof:
                data, unpack = unpack.unused_data, zlib.decompressobj(31)
                yield parse(b"".join(out))
                out = []
        if any(out):
            raise ValueError(f"{path} ends within a record")


def parse(data: bytes) -> dict:
    """A record's fields; raises ValueError where it does not agree with its own digests or length."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:-4]
    if lines[0] != "WARC/1.1" or rest[-4:] != b"\r\n\r\n" or len(block) != int(fields["Content-Length"]) or fields["WARC-Block-Digest"] != f"sha1:{sha1_base32(block)}":
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest, revisit = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "revisit"
    if not revisit and sha1_base32(payload) != digest:
        raise ValueError(f"damaged payload {fields['WARC-Record-ID']}")
    length = int(http.rpartition(b"Content-Length: ")[2])
    return {"key": fields["X-Record-Key"] or None, "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"], "payload_bytes": length, "payload_digest": digest, "refers_to": (fields["X-Refers-To-Key"] or None) if revisit else None, "payload": None if revisit else payload}


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write `pages` to a new folder of the shared storage and read the archives back: one row per record."""
    to = fresh_path(pages.sparkSession, "warc")
    manifest = write(pages, to, id_col, url_col, payload_col, min_revisit=min_revisit)
    kind = pages.schema[id_col].dataType.simpleString()
    return records(manifest, to, payloads=False).select(F.col("key").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
