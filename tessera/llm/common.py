"""Helpers shared by the corpus operators: shared storage, word and shingle hashes, components.

Words are runs of bytes other than space and 0x09-0x0D after lower-casing A-Z only.  All hashing is
vectorised over the Arrow buffers of a batch, so no Python object is made per word.
"""

from __future__ import annotations

import ctypes
import functools
import glob
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
_PIECE = 1 << 20  # bytes hashed at a time
_BASE = 0x9E3779B97F4A7C15 | 5  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_FALLBACK: dict[str, str] = {}


# ---------------------------------------------------------------- shared storage


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: spark.checkpoint.dir; where that is unset a local one, on a local master only."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.conf.get("spark.master", "").startswith("local") or spark.conf.get("spark.master").startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = _FALLBACK.setdefault("dir", f"file://{tempfile.mkdtemp(prefix='tessera-')}")
    return at.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted when the application's JVM ends."""
    path = f"{shared_dir(spark)}/tessera/{label}-{uuid.uuid4().hex}"
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(conf).deleteOnExit(at)
    return path


def written(df: DataFrame, label: str = "step") -> DataFrame:
    """Cut the lineage: write to the shared folder and read back, so a lost executor costs no recomputation."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- words and shingles


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), so that every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    space = np.zeros(256, dtype=bool)
    space[[32, *range(9, 14)]] = True
    value = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return low, space, value[low]


LOW, _SPACE, _VALUE = _tables()


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, _PIECE + 1)
            self.up, self.down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
            self.up[0] = self.down[0] = 1
            self.up, self.down = np.cumprod(self.up), np.cumprod(self.down)
        return self.up, self.down


POWERS = _Powers()


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and its len + 1 offsets; null counts as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    texts = texts.cast(pa.large_string())
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), off


class Words:
    """The words of a batch: hash, byte span [start, end) and, for document i, range first[i]:first[i + 1].

    separators: a table of 256 flags, by default space and 0x09-0x0D.
    """

    def __init__(self, texts: pa.Array, separators: np.ndarray | None = None):
        data, off = text_buffer(texts)
        self.base = int(off[0]) if len(off) else 0
        self.data = data[self.base : int(off[-1])] if len(off) else data
        self.off = off - self.base
        n = len(self.data)
        space = (_SPACE if separators is None else separators)[self.data]
        before, after = np.empty(n, bool), np.empty(n, bool)
        if n:
            before[0], before[1:] = True, space[:-1]
            after[-1], after[:-1] = True, space[1:]
            full = self.off[:-1] < self.off[1:]
            before[self.off[:-1][full]] = True
            after[self.off[1:][full] - 1] = True
        self.start = np.flatnonzero(before & ~space)
        self.end = np.flatnonzero(after & ~space) + 1
        self.first = np.searchsorted(self.start, self.off)
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        out, i, n = np.empty(len(self.start), np.uint64), 0, len(self.start)
        while i < n:
            a = int(self.start[i])
            j = max(i + 1, int(np.searchsorted(self.end, a + _PIECE, "right")))
            b = int(self.end[j - 1])
            up, down = POWERS(b - a + 1)
            run = np.empty(b - a + 1, np.uint64)
            run[0] = 0
            np.cumsum(_VALUE[self.data[a:b]] * up[: b - a], out=run[1:])
            s, e = self.start[i:j] - a, self.end[i:j] - a
            out[i:j] = mix((run[e] - run[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            i = j
        return out

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all k-word runs in order, and len + 1 offsets per document; a shorter text is one run."""
        n, lens = len(self.hash), self.counts()
        acc, tag = self.hash.copy(), np.uint64(0xC2B2AE3D27D4EB4F)
        left = np.repeat(self.first[1:], lens) - np.arange(n)  # words from here to the document's end
        for d in range(1, k):
            more = left > d
            nxt = np.zeros(n, np.uint64)
            nxt[: max(n - d, 0)] = self.hash[d:]
            acc = np.where(more, mix(acc * tag + nxt), acc)
        head = np.zeros(n, bool)
        head[self.first[:-1][lens > 0]] = True
        keep = (left >= k) | head
        per = np.where(lens >= k, lens - k + 1, np.minimum(lens, 1))
        return acc[keep], np.concatenate([[0], np.cumsum(per)])


def text_slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in row ranges of about `limit` bytes of text (one row at least), which bounds a worker's memory."""
    texts = batch.column(column)
    size = np.cumsum(np.nan_to_num(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)))
    at = 0
    while at < batch.num_rows:
        done = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, done + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def row_slices(batch: pa.RecordBatch, rows: int = 2048) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


@functools.cache
def one_blas_thread() -> None:
    """In a worker: matrix products take one thread, for Spark's tasks are the parallelism and idle threads of a pool for each worker spin.

    Spark sets OMP_NUM_THREADS only where the executors' cores are configured, and the library reads it only when it is loaded.
    """
    for path in glob.glob(os.path.join(os.path.dirname(np.__file__), "..", "numpy.libs", "*openblas*")):
        library = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)


def mapped(df: DataFrame, each: Callable[[pa.RecordBatch], pa.RecordBatch | list], schema: str, text: str | None = "text", limit: int | None = None) -> DataFrame:
    """mapInArrow with slices of bounded text size, or of so many rows where there is no text; limit: in bytes or rows."""

    def run(batches):
        one_blas_thread()
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in text_slices(batch, text, limit or 4 << 20) if text else row_slices(batch, limit or 2048):
                    out = each(part)
                    yield from out if isinstance(out, list) else [out]

    return df.mapInArrow(run, schema)


# ---------------------------------------------------------------- hashing in SQL


def share(column: Column, seed: str) -> Column:
    """A number in [0, 1) from a value and a seed, the same in any engine with md5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), column.cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


# ---------------------------------------------------------------- connected components


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable over the edges (a, b); only ids with an edge appear.

    Alternating large-star and small-star steps, whose rows never exceed the edges and which end in
    O(log^2 n) rounds on chains too.  Every round is written to the shared folder; per-node minima are
    written before they are joined, so that a node with very many neighbours is split by skew handling.
    Self-loops and null ends are ignored; repeated edges count once.
    """
    e = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "edges")

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()

    was = state(e)
    for _ in range(rounds):
        if not was[0]:
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "least")
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.filter("a > b").distinct(), "large")
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small")
        now = state(e)
        if now == was:
            break
        was = now
    else:
        raise RuntimeError(f"labels still changed after {rounds} rounds")
    roots = e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return written(e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots), "components")
