"""Line dedup by pairwise alignment: overlapping documents, patience diff, common blocks cut from the later one.

A line is a run of text between line feeds; lines count as equal if their words are, after lower-casing A-Z, and
blank lines count for nothing.  What links two documents is a key: the hash of the fewest lines from a line on, or up to a
line, that hold `min_words` words together.  So lines of fewer words, such as menu lines, link nothing on their own; a longer line,
such as a licence line, is a key itself, and however frequent it is, it links each holder with the earliest only: a passage
of n documents makes n - 1 pairs, not n^2 / 2, and no bound on frequency is needed.  Every two documents with a common run
of lines of min_words words share a key, and each line of the run is in a shared one.

Before pairs are aligned, lines that are in no shared key are left out of the sequences; they can be in no common
block.  Each pair is then aligned by patience diff, and aligned blocks (consecutive lines in both) of min_words words
are cut from the later document.  Passages that one rising chain cannot hold, as they are repeated or crossed, are
aligned again: where the later document still has lines in a key of both, the places of the key are aligned by themselves, and
aligned blocks cut in the same way.  Nothing is cut that no alignment holds.  A document with fewer words is cut whole if an
earlier one has just the same lines.

So a line goes exactly if it is in a run of lines of min_words words that stands in an earlier document too, and one
copy of every passage stays, in its earliest holder.

Defined results: null and blank texts have no lines and are returned as they are; repeated ids with equal texts are
one document (all its rows are treated alike), with different texts they are documents in the order of a hash of
the text; rows with null ids keep their text and cut nothing from others; extra columns are kept, but for n_lines,
n_cut and cut, which are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import POWERS, Words, lists, mapped, mix, written

MIN_WORDS = 20


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, hash[], words[], at[]) for each document: its non-blank lines in order; `at` counts all lines from 0; doc: id and a hash of the text."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(batch.column("text"), "")
        words = Words(texts)
        feeds = np.flatnonzero(words.data == 10)
        line = np.searchsorted(feeds, words.start)  # the number of line feeds before each word
        doc = np.repeat(np.arange(len(texts)), words.counts())
        head = np.ones(len(line), bool)
        head[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(head)
        n = np.diff(np.append(at, len(line)))
        # a line's hash: a polynomial over its word hashes by place, summed modulo 2**64
        place = (np.arange(len(line)) - np.repeat(at, n)).astype(np.uint64)
        term = mix(words.hash + mix(place * np.uint64(0xA0761D6478BD642F) + np.uint64(1)))
        hashed = mix(np.add.reduceat(term, at) + n.astype(np.uint64)) if len(at) else np.zeros(0, np.uint64)
        off = np.searchsorted(doc[at], np.arange(len(texts) + 1))
        number = line[at] - np.searchsorted(feeds, words.off[:-1])[doc[at]]
        return pa.record_batch(
            [batch.column("doc"), lists(hashed.view(np.int64), off, pa.int64()), lists(n, off, pa.int32()), lists(number, off, pa.int32())],
            names=["doc", "hash", "words", "at"],
        )

    rows = docs.filter(F.col(f"`{id_col}`").isNotNull())
    rows = rows.select(F.struct(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("d")).alias("doc"), F.col(f"`{text_col}`").alias("text"))
    out = mapped(rows, each, f"{_doc(docs, id_col)}, hash array<long>, words array<int>, at array<int>").filter(F.size("hash") > 0)
    return out.groupBy("doc").agg(F.min(F.struct("hash", "words", "at")).alias("s")).select("doc", "s.*")


def _doc(docs: DataFrame, id_col: str) -> str:
    return f"doc struct<id:{docs.schema[id_col].dataType.simpleString()},d:bigint>"


def keys(hashes: np.ndarray, words: np.ndarray, off: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first, end) of all keys of line sequences; off: where each sequence starts in the flat arrays, and the end.

    For each line the shortest runs from it on and up to it with min_words words; a sequence with fewer words has one
    key, of its own kind, for all of it.
    """
    n = len(hashes)
    run = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    size = np.diff(off)
    begin, end = np.repeat(off[:-1], size), np.repeat(off[1:], size)
    place = np.arange(n)
    to = np.searchsorted(run, run[:-1] + min_words)
    since = np.searchsorted(run, run[1:] - min_words, "right") - 1
    on, up = to <= end, since >= begin
    short = np.flatnonzero((size > 0) & (run[off[1:]] - run[off[:-1]] < min_words))
    first = np.concatenate([place[on], since[up], off[short]])
    last = np.concatenate([to[on], place[up] + 1, off[short + 1]])
    code = np.unique(first * (n + 1) + last)
    first, last = code // (n + 1), code % (n + 1)
    powers, back = POWERS(n + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes.view(np.uint64) * powers[:n])])
    key = mix((total[last] - total[first]) * back[first] + (last - first).astype(np.uint64))
    whole = run[last] - run[first] < min_words
    return np.where(whole, mix(key + np.uint64(1)), key).view(np.int64), first, last


def key_table(lines: DataFrame, min_words: int) -> DataFrame:
    """(doc, key, first, end) of all keys of all documents; first and end count non-blank lines."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column("hash")
        off = column.offsets.to_numpy()
        hashes, words = (x.to_numpy()[off[0] : off[-1]] for x in (column.values, batch.column("words").values))
        off = (off - off[0]).astype(np.int64)
        key, first, end = keys(hashes, words, off, min_words)
        doc = np.searchsorted(off, first, "right") - 1
        return pa.record_batch([batch.column("doc").take(pa.array(doc)), pa.array(key), pa.array((first - off[doc]).astype(np.int32)), pa.array((end - off[doc]).astype(np.int32))], names=["doc", "key", "first", "end"])

    return mapped(lines.select("doc", "hash", "words"), each, f"doc {lines.schema['doc'].dataType.simpleString()}, key long, first int, end int", text=None)



def _increasing(right: list[int]) -> list[int]:
    """Indexes of a longest increasing subsequence, by patience piles."""
    tops: list[int] = []
    top_at: list[int] = []
    back = [-1] * len(right)
    for i, v in enumerate(right):
        k = int(np.searchsorted(tops, v)) if tops and v < tops[-1] else len(tops)
        if k == len(tops):
            tops.append(v)
            top_at.append(i)
        else:
            tops[k], top_at[k] = v, i
        back[i] = top_at[k - 1] if k else -1
    out, i = [], top_at[-1] if top_at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def patience(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int]]:
    """Aligned blocks (start in a, start in b, length), in order, of a patience diff of two line sequences.

    Common heads and tails are matched first, then lines that occur once on each side anchor the rest, and
    the gaps between anchors are aligned the same way; a gap without such lines has only its head and tail
    matched.
    """
    out: list[tuple[int, int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, I, j, J = todo.pop()
        n = min(I - i, J - j)
        if n <= 0:
            continue
        differ = np.flatnonzero(a[i : i + n] != b[j : j + n])
        head = int(differ[0]) if len(differ) else n
        if head:
            out.append((i, j, head))
            i, j, n = i + head, j + head, n - head
        if n:
            differ = np.flatnonzero(a[I - n : I][::-1] != b[J - n : J][::-1])
            tail = int(differ[0]) if len(differ) else n
            if tail:
                out.append((I - tail, J - tail, tail))
                I, J = I - tail, J - tail
        if i >= I or j >= J:
            continue
        av, ai, ac = np.unique(a[i:I], return_index=True, return_counts=True)
        bv, bi, bc = np.unique(b[j:J], return_index=True, return_counts=True)
        _, x, y = np.intersect1d(av[ac == 1], bv[bc == 1], assume_unique=True, return_indices=True)
        pa_, pb_ = ai[ac == 1][x], bi[bc == 1][y]
        order = np.argsort(pa_)
        pa_, pb_ = pa_[order] + i, pb_[order] + j
        chain = _increasing(pb_.tolist())
        if not chain:
            continue
        at = (i, j)
        for k in chain:
            p, q = int(pa_[k]), int(pb_[k])
            todo.append((at[0], p, at[1], q))
            out.append((p, q, 1))
            at = (p + 1, q + 1)
        todo.append((at[0], I, at[1], J))
    out.sort()
    joined: list[tuple[int, int, int]] = []
    for p, q, n in out:
        if joined and joined[-1][0] + joined[-1][2] == p and joined[-1][1] + joined[-1][2] == q:
            joined[-1] = (joined[-1][0], joined[-1][1], joined[-1][2] + n)
        else:
            joined.append((p, q, n))
    return joined


@dataclass
class Sequence:
    """Lines of a document that are in shared keys: numbers for their hashes, words, and places among its non-blank lines."""

    code: np.ndarray
    hash: np.ndarray
    words: np.ndarray
    place: np.ndarray

    def cuts(self) -> np.ndarray:
        """Where a line does not follow the one before, and the end."""
        return np.concatenate([[0], np.flatnonzero(np.diff(self.place) != 1) + 1, [len(self.place)]]) if len(self.place) else np.zeros(1, np.int64)

    def parted(self, mark: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes with a number of no other line (mark, mark - 2, ...) in each gap, and for each the line's index, -1 for gaps."""
        gaps = self.cuts()[1:-1]
        return np.insert(self.code, gaps, mark - 2 * np.arange(len(gaps))), np.insert(np.arange(len(self.code)), gaps, -1)


def cut_lines(a: Sequence, b: Sequence, min_words: int) -> np.ndarray:
    """Indexes of b's lines in blocks of min_words words that are shared with a, or all of b where it is shorter and equal."""
    if b.words.sum() < min_words:
        return np.arange(len(b.code)) if np.array_equal(a.code, b.code) else np.zeros(0, np.int64)
    x, _ = a.parted(-1)
    y, line = b.parted(-2)
    cut = np.zeros(len(b.code), bool)
    run = np.concatenate([[0], np.cumsum(b.words)])

    def cut_blocks(blocks: list[tuple[int, int, int]], line: np.ndarray) -> None:
        """Cut aligned blocks of min_words words; line: b's line of each element, -1 for gaps, which are in no block."""
        for _, q, n in blocks:
            first = int(line[q])
            if run[first + n] - run[first] >= min_words:
                cut[first : first + n] = True

    cut_blocks(patience(x, y), line)
    if cut.all():
        return np.flatnonzero(cut)
    known, first_a, end_a = keys(a.hash, a.words, a.cuts(), min_words)
    mine, first_b, end_b = keys(b.hash, b.words, b.cuts(), min_words)
    known, where = np.unique(known, return_index=True)
    at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
    for k in np.flatnonzero(known[at] == mine).tolist() if len(known) else []:
        i, j, p = int(first_b[k]), int(end_b[k]), where[at[k]]
        if not cut[i:j].all():
            cut_blocks(patience(a.code[first_a[p] : end_a[p]], b.code[i:j]), np.arange(i, j))
    return np.flatnonzero(cut)


def line_cuts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, cut[]): line numbers to cut from each document that has any."""
    lines = written(line_table(docs, id_col, text_col), "lines")
    table = key_table(lines, min_words)
    # shared keys are written, so that the join reads both sides by a plain shuffle and Spark can split a hot key's rows
    ends = [f(F.col("doc").getField(c)).alias(f"{n}_{c}") for c in ("id", "d") for n, f in (("lo", F.min), ("hi", F.max))]
    held = written(table.groupBy("key").agg(*ends).filter("lo_id < hi_id OR lo_d < hi_d").select("key"), "shared")
    shared = written(table.join(held, "key"), "holders")
    owners = written(shared.groupBy("key").agg(F.min("doc").alias("owner")), "owners")
    pairs = written(shared.select("key", "doc").join(owners, "key").filter("owner < doc").select("doc", "owner").distinct(), "pairs")
    spans = shared.groupBy("doc").agg(F.collect_list(F.struct("first", "end")).alias("spans"))

    def trim(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, sizes, places = [], [], []
        start = batch.column("hash").offsets.to_numpy()
        for k in range(batch.num_rows):
            n = start[k + 1] - start[k]
            spans = batch.column("spans")[k].values
            first, end = (spans.field(c).to_numpy() for c in ("first", "end"))
            inside = np.flatnonzero(np.cumsum(np.bincount(first, minlength=n + 1) - np.bincount(end, minlength=n + 1))[:n] > 0)
            keep.append(start[k] + inside)
            places.append(inside)
            sizes.append(len(inside))
        off = np.concatenate([[0], np.cumsum(sizes)])
        at, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keep, places))
        got = [lists(batch.column(c).values.to_numpy()[at], off, batch.column(c).type.value_type) for c in ("hash", "words", "at")]
        return pa.record_batch([batch.column("doc"), *got, lists(place, off, pa.int32())], names=["doc", "hash", "words", "at", "place"])

    kind = lines.schema["doc"].dataType.simpleString()
    parts = mapped(lines.join(spans, "doc"), trim, f"doc {kind}, hash array<long>, words array<int>, at array<int>, place array<int>", text=None)
    parts = written(parts, "parts")
    earlier = parts.select(F.col("doc").alias("owner"), *[F.col(c).alias(f"{c}_a") for c in ("hash", "words", "place")])
    both = pairs.join(earlier, "owner").join(parts, "doc")

    def align(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, cuts = [], []
        cols = [batch.column(c) for c in ("hash_a", "words_a", "place_a", "hash", "words", "place", "at")]
        for k in range(batch.num_rows):
            *a, h, w, p, at = (c[k].values.to_numpy() for c in cols)
            code = np.unique(np.concatenate([a[0], h]), return_inverse=True)[1]
            got = cut_lines(Sequence(code[: len(a[0])], *a), Sequence(code[len(a[0]) :], h, w, p), min_words)
            if len(got):
                rows.append(k)
                cuts.append(at[got])
        off = np.concatenate([[0], np.cumsum([len(c) for c in cuts], dtype=np.int64)])
        flat = np.concatenate(cuts) if cuts else np.zeros(0, np.int32)
        return pa.record_batch([batch.column("doc").take(pa.array(rows, pa.int32())), lists(flat, off, pa.int32())], names=["doc", "cut"])

    cuts = mapped(both.select("doc", "hash_a", "words_a", "place_a", "hash", "words", "place", "at"), align, f"doc {kind}, cut array<int>", text=None)
    return cuts.select("doc", F.explode("cut").alias("cut")).groupBy("doc").agg(F.collect_set("cut").alias("cut"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with the cut lines taken out of the text, and n_lines (all), n_cut and cut (line numbers).

    Documents without a cut keep their text byte for byte.  A document of which every line with words is cut
    is left with an empty text.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_cut", "cut")]
    cuts = line_cuts(docs, id_col, text_col, min_words).withColumnRenamed("doc", "of")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{id_col}`").alias("join_id"), F.xxhash64(f"`{text_col}`").alias("join_d"))
    rows = rows.join(cuts, F.expr("join_id = of.id AND join_d = of.d"), "left")
    text = F.col("row").getField(text_col)
    n_lines = F.when(text.isNull() | (text == ""), 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)
    lines = F.split(text, "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "cut")
    rest = F.array_join(F.transform(left, lambda i: lines[i]), "\n")
    blank = ~rest.rlike(r"[^\x20\x09-\x0D]")
    new = F.when(F.col("cut").isNull(), text).when(blank, F.lit("")).otherwise(rest)
    cut = F.array_sort(F.coalesce("cut", F.array().cast("array<int>")))
    return rows.select(*[(new if c == text_col else F.col("row").getField(c)).alias(c) for c in kept], n_lines.cast("long").alias("n_lines"), F.size(cut).cast("long").alias("n_cut"), cut.alias("cut"))
