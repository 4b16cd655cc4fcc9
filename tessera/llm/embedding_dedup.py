"""Near-duplicate embeddings by an inverted multi-index: a product grid of two codebooks, one for each half.

Vectors are compared as unit vectors in double precision.  Equal unit vectors of a label are one class.  Codebooks
are fitted on a bounded sample (SAMPLE vectors, the smallest by hash); every vector is indexed in the cell of its
two nearest centroids.  A query walks the cells in multi-sequence order, nearest pair of centroids first, and stops
after as many cells as it takes until TARGET of the pairs that lie exactly at the threshold are found by one of
their two ends: the number is measured on the sample by moving its vectors to that angle in random directions, the
hardest links there are.  A vector goes to each cell it visits as it was given (in single precision if the column is),
to its own cell once for both parts.  Members of a cell are dealt to blocks of BLOCK, queries too, so that a hot
cell is many tasks; a block's cosines are one matrix product in double precision, and every pair at or over the
threshold is a link.

A block reports a number of linked vectors per vector and a spanning forest of its links instead of the links, so the
rows grow with the vectors even where thousands are linked with each other.  A link counts at both of its ends,
whichever end found it: where a query finds a member that does not visit the query's cell, it is counted for the
member too.

Defined results: one row per row.  Vectors that are null, empty, zero or hold null or non-finite components, and rows
with a null label, link with nothing (n_links 0, a component of their own); vectors of different lengths do not link;
rows with a null id link with nothing and have a null component; rows with equal id, vector and label are one vector
given several times and alike; an id with several vectors has a row for each.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import components, mapped, one_blas_thread, written

THRESHOLD = 0.93
TARGET = 0.999
SAMPLE = 20_000
PER_CELL = 512
BLOCK = 2048
_SEED = 11


@dataclass
class Grid:
    """Two codebooks and how many cells a query visits; one for each length of vectors."""

    left: np.ndarray
    right: np.ndarray
    visits: int

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = x.shape[1] // 2
        return _squared(x[:, :h], self.left), _squared(x[:, h:], self.right)

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves(x)
        return a.argmin(1) * len(self.right) + b.argmin(1)

    def visited(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Whether each vector visits its cell of `cell`."""
        return (self.walk(x) == cell[:, None]).any(1) if len(x) else np.zeros(0, bool)

    def walk(self, x: np.ndarray, visits: int | None = None) -> np.ndarray:
        """(vectors, visits) cells in multi-sequence order: rising sum of the two squared distances.

        Only pairs of the i-th nearest left and j-th nearest right centroid with i * j <= visits can be among the
        first `visits`, since all pairs of nearer centroids come before.
        """
        visits = visits or self.visits
        a, b = self.halves(x)
        ia, ib = np.argsort(a, 1, kind="stable"), np.argsort(b, 1, kind="stable")
        sa, sb = np.take_along_axis(a, ia, 1), np.take_along_axis(b, ib, 1)
        i, j = np.meshgrid(np.arange(a.shape[1]), np.arange(b.shape[1]), indexing="ij")
        near = (i + 1) * (j + 1) <= visits
        i, j = i[near], j[near]
        order = np.argsort(sa[:, i] + sb[:, j], 1, kind="stable")[:, :visits]
        return np.take_along_axis(ia[:, i], order, 1) * len(self.right) + np.take_along_axis(ib[:, j], order, 1)


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances, rounded so that they do not depend on which vectors are in a batch."""
    return np.round((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 9)


def _codebook(x: np.ndarray, k: int, r: np.random.Generator) -> np.ndarray:
    c = x[r.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(12):
        at = _squared(x, c).argmin(1)
        n = np.bincount(at, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def fit_grid(sample: np.ndarray, largest: int, threshold: float = THRESHOLD, target: float = TARGET) -> Grid:
    """largest: the classes of the commonest label, which sets the number of cells."""
    r = np.random.default_rng(_SEED)
    k = int(np.clip(np.ceil(np.sqrt(largest / PER_CELL)), 1, len(sample)))
    h = sample.shape[1] // 2
    grid = Grid(_codebook(sample[:, :h], k, r), _codebook(sample[:, h:], k, r), 1)
    n_cells = len(grid.left) * len(grid.right)
    if n_cells == 1:
        return grid
    x = sample[r.choice(len(sample), min(2000, len(sample)), replace=False)]
    noise = r.normal(size=x.shape)
    noise -= (noise * x).sum(1)[:, None] * x
    noise /= np.maximum(np.linalg.norm(noise, axis=1), 1e-12)[:, None]
    moved = threshold * x + np.sqrt(1 - threshold**2) * noise
    there, back = ((grid.walk(u, n_cells) == grid.cells(v)[:, None]).argmax(1) for u, v in ((x, moved), (moved, x)))
    place = np.minimum(there, back)
    grid.visits = min(n_cells, int(np.sort(place)[int(np.ceil(target * len(place))) - 1]) + 1)
    return grid


def _units(x: np.ndarray) -> np.ndarray:
    """Rows at unit length; rows that are zero or not finite become NaN."""
    with np.errstate(all="ignore"):
        n = np.sqrt((x * x).sum(1))
        most = np.abs(x).max(1, initial=0)
        far = np.isfinite(most) & (most > 0) & ((n == 0) | ~np.isfinite(n))  # the squares leave the doubles
        if far.any():
            x = x.copy()
            x[far] /= most[far, None]
            n[far] = np.sqrt((x[far] * x[far]).sum(1))
        return x / np.where(n > 0, n, np.nan)[:, None]


def keyed(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, key, size, vector): components as bytes; key is a digest of label and unit vector, null where the row links with nothing."""
    kinds = [rows.schema[c].dataType.simpleString() for c in (id_col, label_col)]
    wide = rows.schema[vector_col].dataType.elementType.simpleString() != "float"

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, labels, column = (batch.column(c) for c in ("id", "label", "v"))
        values = column.flatten()
        flat = np.asarray(values.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False), float)
        size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(int)
        start = np.cumsum(size) - size
        fit = (size > 0) & ~ids.is_null().to_numpy(zero_copy_only=False) & ~labels.is_null().to_numpy(zero_copy_only=False)
        keys, raws = [None] * len(size), [None] * len(size)
        said = labels.to_pylist()
        for n in np.unique(size[fit]):
            own = np.flatnonzero(fit & (size == n))
            x = flat[start[own][:, None] + np.arange(n)]
            unit = _units(x) + 0.0  # no negative zeros
            raw = x if wide else x.astype(np.float32)
            for i in np.flatnonzero(np.isfinite(unit).all(1)):
                k = own[i]
                keys[k] = hashlib.blake2b(repr(said[k]).encode() + b":" + unit[i].tobytes(), digest_size=16).digest()
                raws[k] = raw[i].tobytes()
        return pa.record_batch([ids, labels, pa.array(keys, pa.binary()), pa.array(size, pa.int32()), pa.array(raws, pa.binary())], names=["id", "label", "key", "size", "vector"])

    picked = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").alias("v"))
    return mapped(picked, each, f"id {kinds[0]}, label {kinds[1]}, key binary, size int, vector binary", text=None)


def _matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """The unit vectors of a column of bytes."""
    raw = column.to_pylist()
    kind = np.float32 if raw and len(raw[0]) == 4 * dims else np.float64
    return _units(np.frombuffer(b"".join(raw), kind).reshape(-1, dims).astype(float))


def block_links(part: pa.Table, grid: Grid, threshold: float) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """(classes, numbers of vectors that are linked with one of each, spanning forest as pairs of classes) of a block.

    part: (cls, copies, vector, home, query, member); home: the block's cell is the row's own.
    """
    x, cls, copies = _matrix(part["vector"], grid.left.shape[1] + grid.right.shape[1]), part["cls"].to_numpy(), part["copies"].to_numpy()
    home, query, member = (part[c].to_numpy() for c in ("home", "query", "member"))
    qs, ms = np.flatnonzero(query), np.flatnonzero(member)
    counts = np.zeros(len(cls))
    forest: list[tuple[int, int]] = []
    root: dict[int, int] = {}

    def find(v: int) -> int:
        while root.setdefault(v, v) != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    for at in range(0, len(qs), 512):
        own = qs[at : at + 512]
        linked = (x[own] @ x[ms].T >= threshold) & (cls[own][:, None] != cls[ms])
        counts[own] += linked @ copies[ms]
        i, j = np.nonzero(linked)
        a, b = own[i], ms[j]
        for p, q in zip(cls[a].tolist(), cls[b].tolist(), strict=True):
            r, t = find(p), find(q)
            if r != t:
                root[max(r, t)] = min(r, t)
                forest.append((p, q))
        away = np.flatnonzero(~home[a])  # both of a cell's own vectors visit it
        for k in range(0, len(away), 1 << 14):
            p, q = a[away[k : k + (1 << 14)]], b[away[k : k + (1 << 14)]]
            unseen = ~grid.visited(x[q], grid.cells(x[p]))
            np.add.at(counts, q[unseen], copies[p[unseen]])
    full = np.flatnonzero(counts)
    return cls[full], counts[full].astype(np.int64), forest


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, target: float = TARGET, sample: int = SAMPLE) -> DataFrame:
    """(id, n_links, component_id, kept) per row."""
    read = keyed(rows, id_col, vector_col, label_col)
    classes = read.filter("key IS NOT NULL").groupBy("key").agg(F.first("label").alias("label"), F.first("size").alias("size"), F.first("vector").alias("vector"), F.min("id").alias("rep"), F.count_distinct("id").alias("copies"))
    classes = written(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    largest = classes.groupBy("label", "size").count().groupBy("size").agg(F.max("count").alias("most")).collect()  # a row for each length
    found = []
    for r in largest:
        own = classes.filter(F.col("size") == r["size"])
        picked = own.orderBy(F.xxhash64("key"), "key").limit(sample).select("vector").toArrow()
        grid = fit_grid(_matrix(picked["vector"], r["size"]), r.most, threshold, target)
        found.append(_linked(own, grid, threshold))
    return _summed(read.select("id", "key"), classes, found)


def _linked(classes: DataFrame, grid: Grid, threshold: float) -> DataFrame:
    """(cls, n, other): counts of linked vectors, by block, and forest edges with n 0."""
    kind = classes.schema["label"].dataType.simpleString()
    sent = classes.sparkSession.sparkContext.broadcast(grid)  # two codebooks of at most `sample` centroids
    dims = grid.left.shape[1] + grid.right.shape[1]

    def index(with_vectors: bool):
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            walk = sent.value.walk(_matrix(batch.column("vector"), dims))
            got = batch.take(pa.array(np.repeat(np.arange(len(walk)), walk.shape[1])))
            home = np.tile(np.arange(walk.shape[1]) == 0, len(walk))  # the nearest cell is the own one
            cols = ("label", "cls", "copies", "vector") if with_vectors else ("label", "cls")
            return pa.record_batch([*(got.column(c) for c in cols), pa.array(walk.ravel()), pa.array(home)], names=[*cols, "cell", "home"])

        return each

    # planned twice, so that the copies of the vectors are only shuffled and never written
    size = mapped(classes.select("label", "cls", "vector"), index(False), f"label {kind}, cls long, cell long, home boolean", text=None)
    size = size.groupBy("label", "cell").agg(F.count_if("home").alias("m"), F.count("*").alias("q"))
    size = size.select(F.col("label").alias("l"), F.col("cell").alias("c"), F.ceil(F.col("m") / BLOCK).alias("mb"), F.ceil(F.col("q") / BLOCK).alias("qb")).filter("mb > 0")
    placed = mapped(classes.select("label", "cls", "copies", "vector"), index(True), f"label {kind}, cls long, copies long, vector binary, cell long, home boolean", text=None)
    rows = placed.join(written(size, "size"), F.expr("label = l AND cell = c"))
    rows = rows.withColumn("q", F.pmod(F.xxhash64("cls"), F.col("qb"))).withColumn("m", F.pmod(F.xxhash64("cls", F.lit(1)), F.col("mb")))
    as_query = F.transform(F.sequence(F.lit(0).cast("long"), F.col("mb") - 1), lambda j: F.struct(F.col("q").alias("q"), j.alias("m")))
    as_member = F.transform(F.sequence(F.lit(0).cast("long"), F.col("qb") - 1), lambda i: F.struct(i.alias("q"), F.col("m").alias("m")))
    rows = rows.withColumn("block", F.explode(F.when(F.col("home"), F.array_union(as_query, as_member)).otherwise(as_query)))
    rows = rows.withColumn("query", F.col("block.q") == F.col("q")).withColumn("member", F.col("home") & (F.col("block.m") == F.col("m")))

    def each(part: pa.Table) -> pa.Table:
        one_blas_thread()
        cls, n, forest = block_links(part, sent.value, threshold)
        ends = np.array(forest, np.int64).reshape(-1, 2)
        return pa.table({
            "cls": pa.array(np.concatenate([cls, ends[:, 0]])),
            "n": pa.array(np.concatenate([n, np.zeros(len(ends), np.int64)])),
            "other": pa.concat_arrays([pa.nulls(len(cls), pa.int64()), pa.array(ends[:, 1])]),
        })

    return rows.select("label", "cell", "block", "cls", "copies", "vector", "home", "query", "member").groupBy("label", "cell", "block").applyInArrow(each, "cls long, n long, other long")


def _summed(read: DataFrame, classes: DataFrame, found: list[DataFrame]) -> DataFrame:
    if not found:
        return read.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    links = written(links, "links")
    counts = links.filter("other IS NULL").groupBy("cls").agg(F.sum("n").alias("n"))
    parts = components(links.filter("other IS NOT NULL").select(F.col("cls").alias("a"), F.col("other").alias("b"))).withColumnRenamed("id", "cls")
    least = written(classes.select("cls", "rep").join(parts, "cls").groupBy("component").agg(F.min("rep").alias("least")), "least")
    of = classes.select("key", "cls", "rep", "copies").join(counts, "cls", "left").join(parts.join(least, "component").select("cls", "least"), "cls", "left")
    of = of.select(F.col("key").alias("k"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("least", "rep").alias("c"))
    component = F.coalesce("c", "id")
    joined = read.join(written(of, "numbers"), F.col("key") == F.col("k"), "left")
    return joined.select("id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
