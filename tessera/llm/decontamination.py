"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact containment.

Test items are put into partitions by their number of shingles (5 to 8, to 16, to 32, to 64, ...).  For a
partition of items up to U the documents are read as windows of 2U shingles, each U after the last, so that an
item's whole passage lies in some window.  Windows are the indexed domains: within a partition their size is
fixed, which is what lets MinHash find a short item inside a text of any length.  Minima are taken per block of
U and joined for two blocks, and blocks of a larger partition are made from those of the smaller, so the
texts are hashed once for all partitions.

Item and window share a band if one of PERMUTATIONS minima agrees (bands of one row: with containment 0.8 the
Jaccard similarity is at least 0.19, and the chance that no minimum of 80 agrees is under 1e-7).  Candidates
are verified by exact containment of the item's distinct shingles in the document's: found >= percent of the
item's.  Items of four shingles or fewer are looked up by each of their shingles; items of fewer than five words
are one run of so many words.

Items are taken in blocks of BLOCK words at most, each broadcast to all documents: the size sent is bounded
whatever the size of the benchmark, and no document is shuffled.

Defined results: null, empty and blank items match nothing, as do such documents; repeated rows of the
benchmark count once, and items with equal ids and different texts are each an item; documents with null ids
are searched too; repeated documents give a row each; other columns are kept by `decontaminated`.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.common import SHINGLE_WORDS, Words, mapped, mix

PERMUTATIONS = 80
PERCENT = 80
DIRECT = 4  # items of so many shingles are looked up
BLOCK = 1 << 18  # words of items broadcast at once: 2 MB of shingles, and at most 20 MB of minima
_SEED = 77


def _family() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(_SEED)
    return r.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1), r.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


@dataclass
class Items:
    """A block of items: distinct shingles per item, and per partition the minima of its items."""

    ids: list
    sets: list[np.ndarray]
    lengths: np.ndarray  # words
    sizes: list[tuple[int, np.ndarray, list[np.ndarray]]]  # (U, items, per permutation: sorted minima)
    order: list[list[np.ndarray]]  # the items in the order of those minima
    short: list[tuple[int, np.ndarray, np.ndarray]]  # (words in a run, sorted hashes, items)


def prepare(ids: list, texts: list[str | None]) -> Items:
    words = Words(pa.array(texts, pa.string()))
    grams, off = words.grams()
    sets = [np.unique(grams[off[i] : off[i + 1]]) for i in range(len(ids))]
    lengths, n = words.counts(), np.diff(off)
    a, b = _family()
    size = np.where(n > DIRECT, 2 ** np.ceil(np.log2(np.maximum(n, 1))), 0).astype(int)
    sizes, order = [], []
    for u in sorted(set(size.tolist()) - {0}):
        own = np.flatnonzero(size == u)
        flat, start = np.concatenate([sets[i] for i in own]), np.cumsum([0, *(len(sets[i]) for i in own[:-1])])
        mins = np.stack([np.minimum.reduceat(flat * a[k] + b[k], start) for k in range(PERMUTATIONS)], 1)
        by = [np.argsort(mins[:, k], kind="stable") for k in range(PERMUTATIONS)]
        sizes.append((u, own, [mins[by[k], k] for k in range(PERMUTATIONS)]))
        order.append([own[by[k]] for k in range(PERMUTATIONS)])
    short = []
    for k in range(1, SHINGLE_WORDS + 1):
        own = np.flatnonzero((np.minimum(lengths, SHINGLE_WORDS) == k) & (n <= DIRECT))
        if len(own):
            h, item = np.concatenate([sets[i] for i in own]), np.repeat(own, [len(sets[i]) for i in own])
            by = np.argsort(h, kind="stable")
            short.append((k, h[by], item[by]))
    return Items(ids, sets, lengths, sizes, order, short)


def _hits(values: np.ndarray, keys: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in values, item) for every equal pair; keys is sorted and may repeat."""
    lo, hi = np.searchsorted(keys, values, "left"), np.searchsorted(keys, values, "right")
    n = hi - lo
    at = np.repeat(np.arange(len(values)), n)
    return at, items[np.repeat(lo, n) + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)]


def candidates(words: Words, grams: np.ndarray, off: np.ndarray, items: Items) -> set[tuple[int, int]]:
    """(document, item) pairs that share a band in some window of the item's partition, and exact short runs."""
    found: set[tuple[int, int]] = set()
    for n, keys, own in items.short:
        runs, at = (grams, off) if n == SHINGLE_WORDS else words.grams(n)
        where, item = _hits(runs, keys, own)
        doc = np.searchsorted(at, where, "right") - 1
        found.update((int(d), int(i)) for d, i in zip(doc, item, strict=True) if words.first[d + 1] - words.first[d] >= n)
    lens = np.diff(off)
    full = np.flatnonzero(lens)
    if not len(full) or not items.sizes:
        return found
    a, b = _family()
    smallest = items.sizes[0][0]
    # blocks of the smallest size: each document's shingles in runs of that many, the last one shorter
    per = -(-lens[full] // smallest)
    doc = np.repeat(full, per)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    start = off[doc] + nth * smallest
    levels = []  # for each partition: (document, minima's first blocks)
    u, d, order = smallest, doc, nth
    for size, _, _ in items.sizes:
        folds = []
        while u < size:
            head = np.flatnonzero(order % 2 == 0)
            folds.append(head)
            d, order, u = d[head], order[head] // 2, u * 2
        levels.append((folds, d))
    for k in range(PERMUTATIONS):
        mins = np.minimum.reduceat(grams * a[k] + b[k], start)
        for (folds, docs), (_, _, keys), by in zip(levels, items.sizes, items.order, strict=True):
            for head in folds:
                mins = np.minimum.reduceat(mins, head)
            window = mins.copy()  # two blocks in a row of one document
            same = docs[1:] == docs[:-1]
            window[:-1][same] = np.minimum(mins[:-1], mins[1:])[same]
            at, item = _hits(window, keys[k], by[k])
            if len(at):
                found.update(zip(docs[at].tolist(), item.tolist(), strict=True))
    return found


def matches(texts: pa.Array, items: Items, percent: int) -> list[tuple[int, int, int, int]]:
    """(document, item, shingles found, shingles of the item), in order, for a batch of texts."""
    words = Words(texts)
    grams, off = words.grams()
    out = []
    sets: dict[int, np.ndarray] = {}
    for d, i in sorted(candidates(words, grams, off, items)):
        own = items.sets[i]
        n = 1
        if items.lengths[i] >= SHINGLE_WORDS:
            if d not in sets:
                sets = {d: np.unique(grams[off[d] : off[d + 1]])}
            n = len(np.intersect1d(own, sets[d], assume_unique=True))
        if 100 * n >= percent * len(own):
            out.append((d, i, n, len(own)))
    return out


def item_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", block: int = BLOCK) -> Iterator[Broadcast]:
    """The items in blocks of at most `block` words (one item at least), broadcast; the driver holds one block at a time."""
    send = benchmark.sparkSession.sparkContext.broadcast
    ids, texts, held = [], [], 0
    for r in benchmark.selectExpr(f"`{item_col}` AS i", f"`{text_col}` AS t").filter("t IS NOT NULL").distinct().toLocalIterator():
        n = len(r.t.split()) or 1
        if held and held + n > block:
            yield send(prepare(ids, texts))
            ids, texts, held = [], [], 0
        ids.append(r.i)
        texts.append(r.t)
        held += n
    yield send(prepare(ids, texts))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(id, item_id, n_found, n_item): the items that a document holds; n_found of the item's n_item shingles."""
    rows = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    kinds = [f.dataType for f in (docs.schema[id_col], benchmark.schema[item_col])]
    item_type = to_arrow_type(kinds[1])

    def search(sent: Broadcast) -> DataFrame:
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            items = sent.value
            found = matches(batch.column("text"), items, percent)
            ids = batch.column("id").take(pa.array([x[0] for x in found], pa.int32()))
            return pa.record_batch(
                [ids, pa.array([items.ids[x[1]] for x in found], item_type), pa.array([x[2] for x in found], pa.int64()), pa.array([x[3] for x in found], pa.int64())],
                names=["id", "item_id", "n_found", "n_item"],
            )

        return mapped(rows, each, f"id {kinds[0].simpleString()}, item_id {kinds[1].simpleString()}, n_found long, n_item long")

    return functools.reduce(DataFrame.unionByName, map(search, item_blocks(benchmark, item_col, "text", block)))


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """The documents that hold no item, with all their columns; one pass for each block of items, no shuffle."""
    for sent in item_blocks(benchmark, item_col, "text", block):

        def each(batch: pa.RecordBatch, sent: Broadcast = sent) -> pa.RecordBatch:
            keep = np.ones(batch.num_rows, bool)
            keep[[x[0] for x in matches(batch.column(text_col), sent.value, percent)]] = False
            return batch.filter(pa.array(keep))

        docs = mapped(docs, each, docs.schema, text=text_col)
    return docs
