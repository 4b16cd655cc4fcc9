"""Language-model scoring: a causal self-attention model in numpy on subword ids, in overlapping windows.

Units: a word is one unit if it is among the DICTIONARY commonest training words, else the byte-level BPE pieces
of a public tokenizer, each marked as last in its word or not; a text ends with one end unit.  The model gives
log10 p(unit | context) = log10 p(class | context) + log10 p(unit | class): attention over the units before
predicts one of CLASSES classes (mixed with their plain shares by FLOOR), and counts over the training corpus
give the share of a unit in its class.  Words, first pieces and inner pieces have classes of their own, made
from the company that units keep (a projection of the common units around them).

A word outside the dictionary is spelled, or recalled: p = (1 - m) p(pieces) + m p(first pieces | context) r, with
r the add-one share of the word among the training words outside the dictionary, and m the share of such words
that training had seen before (Good-Turing).  The counts for r come from the join that the base score needs.
Every unit is in one class and a word has one spelling, so the probabilities of all texts add up to one at most.

A window holds 2 * HALF positions, the last HALF of which are scored; the next window starts HALF later, so each
token is scored once, with HALF to 2 * HALF - 1 units before it (all there are, near the start).  Windows of many texts are one
batch with a causal mask.

Each text is spelled once; the table of units serves counting, training and scoring.  Training reads all rows that
are not held out.  Word counts are exact.  Piece counts, class shares and company are counted, and attention is
trained, on all training texts: the texts are dealt to ROUNDS rounds by a hash, in each round every task runs Adam
once over its share, in sequences of up to SEQUENCE units and PART units at a time, and the parameters are averaged
over tasks, weighted by windows.  Small shares are gone over up to AGAIN times, to reach STEPS steps.  The result depends a
little on how rows fall into tasks, as the average does.

The base score is the add-one unigram score of the contract.  The counts of the KNOWN commonest words are
sent to the tasks (a fixed bound); the others are joined by word.

Defined results: null, empty and blank texts are the end token alone; a null id counts as the empty text for the
split; repeated rows are scored each; without training rows the counts are 0 and the model is its uniform start.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOW, Words, lists, mapped, mix, one_blas_thread, row_slices, written
from tessera.llm.token_alignment import ranked
from tessera.llm.toxicity import remainder

DICTIONARY = 1 << 15
KNOWN = 1 << 17
WORD_CLASSES, FIRST_CLASSES, INNER_CLASSES = 18, 7, 6  # the last of each holds the units seen once or not at all
CLASSES = WORD_CLASSES + FIRST_CLASSES + INNER_CLASSES + 1  # and the end
FIRST = slice(WORD_CLASSES, WORD_CLASSES + FIRST_CLASSES)
HALF = 12
DEPTH = 16
ROWS = 4096  # of the table of input vectors: the commonest units have their own, others share by hash
OWN_ROWS = 3072
SEQUENCE = 60  # units of a text that training takes in one go, with nothing from before
PART = 1 << 19  # units trained on at a time in a task, which bounds its memory
ROUNDS = 3
STEPS = 400  # of Adam in a round, which a small share reaches by being gone over again, at most AGAIN times
AGAIN = 6
DECAY = 2e-3
LOGIT = 60.0  # bound of all logits; sums of their exponentials stay finite in single precision, and above zero
FLOOR = 0.1  # weight of the context-free class shares in the prediction
BATCH = 256
COMPANY = 8  # numbers that describe the company of a unit
END = np.uint64(0)  # stands for the end token among word hashes
SLICE = 1 << 20  # bytes of text that a worker has in hand
ROWS_AT_ONCE = 512  # spelled texts
SPELLED_AT_ONCE = 8192  # words given to the tokenizer
REMEMBERED = 1 << 18  # spelled words that a worker keeps from batch to batch


@functools.cache
def pieces(path: str):
    """The tokenizer and, per id, whether a piece opens a word (it starts with the space)."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    opens = np.zeros(t.get_vocab_size(), bool)
    opens[[i for s, i in t.get_vocab().items() if s.startswith("Ġ")]] = True
    return t, opens


fast_pieces = functools.cache(ranked)  # of a worker


class Places:
    """Sorted distinct 64-bit hashes, looked up through a table of where each leading bit pattern begins: hashes are evenly spread, so it is a step or two."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys

    @functools.cached_property
    def _begin(self) -> tuple[np.ndarray, np.uint64]:  # made in the worker, once
        bits = len(self.keys).bit_length() + 2
        shift = np.uint64(64 - bits)
        return np.searchsorted(self.keys, np.arange(1 << bits, dtype=np.uint64) << shift).astype(np.int32), shift

    def __getstate__(self) -> dict:
        return {"keys": self.keys}

    def __call__(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are among the keys, and where (any place for the others)."""
        if not len(self.keys):
            return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
        begin, shift = self._begin
        at = begin.take((h >> shift).view(np.int64)).astype(np.int64)
        last = len(self.keys) - 1
        np.minimum(at, last, out=at)
        key = self.keys.take(at)
        met = key == h
        left = np.flatnonzero(key < h)
        while len(left):
            left = left[at[left] < last]
            at[left] += 1
            key = self.keys.take(at[left])
            met[left] = key == h[left]
            left = left[key < h[left]]
        return met, at


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each start, so many, end to end."""
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


@dataclass
class Units:
    """Word hashes of the dictionary (sorted) with their unit numbers; then come 2 units per piece, end and begin."""

    hashes: np.ndarray
    numbers: np.ndarray
    size: int  # of the dictionary
    n_pieces: int
    path: str
    memo: tuple[np.ndarray, ...] = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))  # sorted hashes, where their pieces begin, how many; pieces as they came

    @functools.cached_property
    def places(self) -> Places:
        return Places(self.hashes)

    @property
    def end(self) -> int:
        return self.size + 2 * self.n_pieces

    @property
    def total(self) -> int:  # without begin, which is never predicted
        return self.end + 1

    def kinds(self) -> np.ndarray:
        """0 for words, 1 for pieces that open a word, 2 for others, 3 for the end."""
        return np.concatenate([np.zeros(self.size, int), np.repeat(np.where(pieces(self.path)[1], 1, 2), 2), [3]])

    def spell(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Units of the words in order, and how many each has."""
        h = words.hash
        unit, n = np.zeros(len(h), np.int64), np.ones(len(h), np.int64)
        known, at = self.places(h)
        unit[known] = self.numbers[at[known]]
        rare = np.flatnonzero(~known)
        if not len(rare):
            return unit, n
        distinct, first, which = np.unique(h[rare], return_index=True, return_inverse=True)
        flat, sizes = self._remembered(words, distinct, rare[first])
        begin = np.cumsum(sizes) - sizes
        k = sizes[which]
        n[rare] = k
        total = np.cumsum(n)
        out = np.zeros(int(total[-1]), np.int64)
        out[(total - n)[known]] = unit[known]
        inner = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        out[np.repeat((total - n)[rare], k) + inner] = flat[np.repeat(begin[which], k) + inner]
        return out, n

    def _remembered(self, words: Words, distinct: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece units of the chosen words, whose sorted hashes are `distinct`; what earlier batches of the worker spelled is in the memo."""
        hashes, begin, sizes, flat = self.memo
        at = np.searchsorted(hashes, distinct)
        inside = at.clip(0, max(len(hashes) - 1, 0))
        met = hashes[inside] == distinct if len(hashes) else np.zeros(len(distinct), bool)
        new = np.flatnonzero(~met)
        if len(new):
            if len(hashes) > REMEMBERED:  # only what this batch holds stays
                held = inside[met]
                flat, sizes = flat[_ranges(begin[held], sizes[held])], sizes[held]
                hashes, begin = distinct[met], np.cumsum(sizes) - sizes
                at = np.cumsum(met) - met
            more, n = self._pieces(words, chosen[new])
            begin = np.insert(begin, at[new], np.cumsum(n) - n + len(flat))
            hashes, sizes, flat = np.insert(hashes, at[new], distinct[new]), np.insert(sizes, at[new], n), np.concatenate([flat, more.astype(np.int32)])
            self.memo = hashes, begin, sizes, flat
            at = at + np.cumsum(~met) - ~met
        return flat[_ranges(begin[at], sizes[at])].astype(np.int64), sizes[at]

    def _pieces(self, words: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece units of the chosen words, end to end, and how many each has."""
        tokenizer, fast = pieces(self.path)[0], fast_pieces(self.path)
        slow = lambda text: tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        if fast is None:
            return self._cut(words, chosen, slow)
        beyond = np.concatenate([[0], np.cumsum(words.data >= 0xC9, dtype=np.int32)])  # U+0240 and on, so that all below are under PLAIN
        odd = beyond[words.end[chosen]] > beyond[words.start[chosen]]
        flat, sizes = self._cut(words, chosen[~odd], fast.encode_ordinary)
        if not odd.any():
            return flat, sizes
        more, n = self._cut(words, chosen[odd], slow)
        order = np.argsort(np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)]))
        flat, sizes = np.concatenate([flat, more]), np.concatenate([sizes, n])
        return flat[_ranges((np.cumsum(sizes) - sizes)[order], sizes[order])], sizes[order]

    def _cut(self, words: Words, chosen: np.ndarray, encode: Callable[[str], list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Units and sizes as a tokenizer gives them for the words with a space before each."""
        opens = pieces(self.path)[1]
        units, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a in range(0, len(chosen), SPELLED_AT_ONCE):
            start, end = (x[chosen[a : a + SPELLED_AT_ONCE]] for x in (words.start, words.end))
            size = end - start + 1  # with a space before
            to = np.cumsum(size) - size
            text = LOW[words.data.take(np.repeat(start - to - 1, size) + np.arange(size.sum()), mode="clip")]
            text[to] = 32
            ids = np.array(encode(text.tobytes().decode()))
            open_at = np.append(np.flatnonzero(opens[ids]), len(ids))
            last = np.zeros(len(ids), np.int64)
            last[open_at[1:] - 1] = 1
            units.append(self.size + 2 * ids + last)
            sizes.append(np.diff(open_at))
        return np.concatenate(units), np.concatenate(sizes)

    def word_ends(self, u: np.ndarray) -> np.ndarray:
        """Which units are the last of a word: whole words, and pieces marked so; the end unit is none."""
        return (u < self.size) | ((u < self.end) & ((u - self.size) % 2 == 1))


# ---------------------------------------------------------------- counts


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over rows (text, train): exact counts in the training texts; each text adds one end."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = batch.filter(batch.column("train"))
        word, c = np.unique(Words(own.column("text")).hash, return_counts=True)
        if own.num_rows:
            word, c = np.append(word, END), np.append(c, own.num_rows)
        return pa.record_batch({"word": pa.array(word.view(np.int64)), "c": pa.array(c.astype(np.int64))})

    return mapped(docs, each, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def spelled_table(rows: DataFrame, units: Units, known: np.ndarray, c: np.ndarray, spread: float, tail_size: float) -> DataFrame:
    """Each row (row, id, text, train) as its units, what the base score takes from the counts c of the `known` words, and the other words.

    units: with the end unit, 32 bits each; recalled: for each spelled word in order its share among the words outside the
    dictionary, or -1 where its count is not among the known ones; words: the hashes of those.
    """
    kind = rows.schema["id"].dataType.simpleString()
    sent = rows.sparkSession.sparkContext.broadcast((units, Places(known), c, int(c[known == END].sum())))  # of fixed sizes

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        units, known, c, ends_known = sent.value
        words = Words(batch.column("text"))
        n = words.counts()
        u, per = units.spell(words)
        done = np.concatenate([[0], np.cumsum(per)])
        full = np.insert(u, done[words.first[1:]], units.end)
        lens = np.diff(done[words.first]) + 1
        doc = np.repeat(np.arange(len(n)), n)
        h = words.hash
        hit, at = known(h)
        seen = c[at] if len(c) else np.zeros(len(h))
        base = np.bincount(doc[hit], np.log10((seen[hit] + 1) / spread), len(n)) + np.log10((ends_known + 1) / spread)
        n_known = np.bincount(doc[hit], minlength=len(n)) + (ends_known > 0)
        spelled = u[done[:-1]] >= units.size
        recalled = np.where(hit, (seen + 1) / tail_size, -1)[spelled].astype(np.float32)
        rest = np.flatnonzero(~hit)
        off = lambda chosen: np.searchsorted(doc[chosen], np.arange(len(n) + 1))
        return pa.record_batch(
            [batch.column("row"), batch.column("id"), batch.column("train"), pa.array(n + 1), pa.array(n_known), pa.array(base), packed(full.astype(np.int32), np.concatenate([[0], np.cumsum(lens)])), packed(recalled, off(np.flatnonzero(spelled))), packed(h[rest], off(rest))],
            names=["row", "id", "train", "n_tokens", "n_known", "base", "units", "recalled", "words"],
        )

    return mapped(rows, each, f"row long, id {kind}, train boolean, n_tokens long, n_known long, base double, units binary, recalled binary, words binary", limit=SLICE)


def packed(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Runs of numbers as their bytes, which Spark copies as a whole where it would take an array number by number."""
    at = pa.py_buffer(np.ascontiguousarray(offsets * values.itemsize, np.int32))
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, at, pa.py_buffer(np.ascontiguousarray(values))])


def unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a batch end to end, and the len + 1 offsets of its rows."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, kind), np.zeros(1, np.int64)
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    own = np.frombuffer(data, np.uint8)[off[0] : off[-1]].view(kind) if data is not None and data.size else np.zeros(0, kind)
    return own, (off - off[0]) // own.itemsize


def _flat_units(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The units of a batch end to end, and the len + 1 offsets of its texts."""
    u, off = unpacked(batch.column("units"), np.int32)
    return u.astype(np.int64), off


def _sequences(off: np.ndarray) -> np.ndarray:
    """Offsets of the texts' runs of SEQUENCE units, the last of each text being shorter."""
    lens = np.diff(off)
    per = -(-lens // SEQUENCE)
    nth = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    return np.append(np.repeat(off[:-1], per) + nth * SEQUENCE, off[-1])


# ---------------------------------------------------------------- the model


@dataclass
class Model:
    """Parameters of the attention and the shares of units in their classes."""

    row: np.ndarray  # input row of each unit; one more for begin
    of: np.ndarray  # class of each unit
    log_share: np.ndarray  # log10 p(unit | class)
    share: np.ndarray  # of the classes, without context
    params: dict[str, np.ndarray]


def fresh(log_class: np.ndarray, seed: int = 3) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    normal = lambda *shape, s: r.normal(0, s, shape).astype(np.float32)
    return {
        "x": normal(ROWS, DEPTH, s=0.5),
        "q": normal(DEPTH, DEPTH, s=0.2),
        "k": normal(DEPTH, DEPTH, s=0.2),
        "v": normal(DEPTH, DEPTH, s=0.3),
        "near": np.zeros((HALF, 2 * HALF), np.float32),
        "last": np.zeros((DEPTH, len(log_class)), np.float32),
        "seen": np.zeros((DEPTH, len(log_class)), np.float32),
        "bias": log_class.astype(np.float32),
    }


_CAUSAL = np.where(np.arange(2 * HALF)[None] <= np.arange(HALF)[:, None] + HALF, 0, -1e9).astype(np.float32)


def windows(lens: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index matrix (windows, 2 * HALF) into positions begin[d] + 0..lens[d] - 1, -1 outside, and each window's sequence."""
    per = -(-lens // HALF)
    seq = np.repeat(np.arange(len(lens)), per)
    stop = np.cumsum(per)
    nth = np.arange(len(seq)) - np.repeat(stop - per, per)
    at = (begin[seq] + nth * HALF - HALF)[:, None] + np.arange(2 * HALF)
    some = per > 0  # only the first and the last window of a sequence reach outside
    at[(stop - per)[some], :HALF] = -1
    last = at[stop[some] - 1]
    at[stop[some] - 1] = np.where(last < (begin + lens)[some][:, None], last, -1)
    return at, seq


def _forward(p: dict[str, np.ndarray], kv: np.ndarray, ql: np.ndarray, pad: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(logits of the classes, attention, mixed values) from the keys and values of all positions and the queries and direct logits of the scored ones.

    All logits are bounded by LOGIT, so no largest one is taken off before the exponential.
    """
    s = ql[:, :, :DEPTH] @ kv[:, :, :DEPTH].transpose(0, 2, 1)
    s += p["near"]
    s.clip(-LOGIT, LOGIT, out=s)
    s += _CAUSAL
    edge = np.flatnonzero(pad.any(1))
    if len(edge):
        s[edge] += np.where(pad[edge], np.float32(-1e9), np.float32(0))[:, None]
    np.exp(s, out=s)
    s /= _sums(s)
    h = s @ kv[:, :, DEPTH:]
    z = (h.reshape(-1, DEPTH) @ p["seen"]).reshape(*h.shape[:2], -1)
    z += ql[:, :, DEPTH:]
    z.clip(-LOGIT, LOGIT, out=z)
    return z, s, h


def _sums(x: np.ndarray) -> np.ndarray:
    """Over the last axis, as a product with ones, which is faster for short rows."""
    return (x.reshape(-1, x.shape[2]) @ np.ones((x.shape[2], 1), x.dtype)).reshape(*x.shape[:2], 1)


def attend(p: dict[str, np.ndarray], tables: tuple[np.ndarray, ...], rows: np.ndarray, pad: np.ndarray) -> tuple[np.ndarray, ...]:
    """(log p of the classes, attention, mixed values) for input rows (windows, 2 * HALF)."""
    z, s, h = _forward(p, tables[0].take(rows, 0), tables[1].take(rows[:, HALF:], 0), pad)
    z -= np.log(_sums(np.exp(z)))
    return z, s, h


def _joined(p: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The matrices for keys and values, and for scaled queries and direct logits, side by side: one product instead of two."""
    return np.hstack([p["k"], p["v"]]), np.hstack([p["q"] * p["q"].dtype.type(DEPTH**-0.5), p["last"]])


def tables(p: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and values, and queries and direct logits, of every input row, made once for many windows."""
    inner, outer = _joined(p)
    ql = p["x"] @ outer
    ql[:, DEPTH:] += p["bias"]
    return p["x"] @ inner, ql


_PLACES = np.arange(ROWS * DEPTH // 2).reshape(ROWS, -1)  # of pairs of numbers in the table of input vectors


def gradients(p: dict[str, np.ndarray], rows: np.ndarray, pad: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean log loss over positions whose target class is not -1."""
    n, kind = len(rows), p["x"].dtype
    inner, outer = _joined(p)
    x = p["x"].take(rows.ravel(), 0)
    own = x.reshape(n, 2 * HALF, DEPTH)[:, HALF:].reshape(-1, DEPTH)
    kv = (x @ inner).reshape(n, 2 * HALF, -1)
    ql = own @ outer
    ql[:, DEPTH:] += p["bias"]
    ql = ql.reshape(n, HALF, -1)
    dz, a, h = _forward(p, kv, ql, pad)
    h = h.reshape(-1, DEPTH)
    live = np.flatnonzero(target.ravel() >= 0)
    np.exp(dz, out=dz)
    weight = np.zeros((n * HALF, 1), kind)
    weight[live] = 1 / max(1, len(live))
    weight /= _sums(dz).reshape(-1, 1)
    flat = dz.reshape(n * HALF, -1)
    flat *= weight
    flat[live, target.ravel()[live]] -= kind.type(1 / max(1, len(live)))
    # all products with a matrix over rows of both axes at once
    g = {"bias": np.ones(len(flat), kind) @ flat, "seen": h.T @ flat}
    dh = flat @ p["seen"].T
    inner_sum = _sums((dh * h).reshape(n, HALF, -1))  # of attention times its slope, as the mixed values hold it
    dh = dh.reshape(n, HALF, DEPTH)
    ds = dh @ kv[:, :, DEPTH:].transpose(0, 2, 1)
    ds -= inner_sum
    ds *= a
    g["near"] = ds.sum(0)
    dkv = np.empty_like(kv)
    np.matmul(ds.transpose(0, 2, 1), ql[:, :, :DEPTH], out=dkv[:, :, :DEPTH])
    np.matmul(a.transpose(0, 2, 1), dh, out=dkv[:, :, DEPTH:])
    dkv = dkv.reshape(-1, 2 * DEPTH)
    dq = (ds @ kv[:, :, :DEPTH]).reshape(-1, DEPTH)
    both = x.T @ dkv
    g["k"], g["v"] = both[:, :DEPTH], both[:, DEPTH:]
    g["q"], g["last"] = own.T @ dq * kind.type(DEPTH**-0.5), own.T @ flat
    dx = dkv @ inner.T
    dx.reshape(n, 2 * HALF, DEPTH)[:, HALF:] += (dq @ outer[:, :DEPTH].T + flat @ p["last"].T).reshape(n, HALF, DEPTH)
    g["x"] = np.zeros_like(p["x"])
    pair = np.result_type(kind, np.complex64)  # two numbers are added at a time
    np.add.at(g["x"].ravel().view(pair), _PLACES.take(rows.ravel(), 0).ravel(), dx.ravel().view(pair))
    return {name: g[name] for name in p}


def local_training(model: Model, u: np.ndarray, off: np.ndarray, rate: float, seed: int, again: bool) -> tuple[dict[str, np.ndarray], int]:
    """Adam over the windows of one share (units and offsets of sequences), from the model's parameters; the parameters and the number of windows.

    again: go over a small share several times.
    """
    begin, lens = off[:-1], np.diff(off)
    rows = np.empty(len(u), np.int64)
    rows[1:] = model.row[u[:-1]]
    rows[begin] = model.row[-1]
    at, _ = windows(lens, begin)
    pad = at < 0
    target = np.where(pad[:, HALF:], -1, model.of[u][at[:, HALF:]])
    rows = rows[at]
    flat = _flat(model.params)
    p = _views(flat, model.params)
    decayed = flat[: -p["bias"].size]  # the bias comes last
    m, v, part = np.zeros_like(flat), np.zeros_like(flat), np.empty_like(flat)
    r = np.random.default_rng(seed)
    once = -(-len(at) // BATCH)
    steps = max(once, min(STEPS, AGAIN * once)) if again else once
    for t in range(1, steps + 1):
        if (t - 1) * BATCH % max(len(at), 1) < BATCH:
            order = r.permutation(len(at))
        w = order[((t - 1) * BATCH + np.arange(min(BATCH, len(at)))) % len(at)]
        g = _flat(gradients(p, rows[w], pad[w], target[w]))
        step = rate * (1 - 0.9 * t / steps) * (1 - 0.99**t) ** 0.5 / (1 - 0.9**t)  # no numpy scalar, which would make all of the step double
        # in place: m += 0.1 (g - m), v += 0.01 (g g - v), p -= step (m / (sqrt(v) + 1e-6) + DECAY p)
        np.subtract(g, m, out=part)
        part *= 0.1
        m += part
        g *= g
        g -= v
        g *= 0.01
        v += g
        np.sqrt(v, out=part)
        part += 1e-6
        np.divide(m, part, out=part)
        part *= step
        decayed *= 1 - step * DECAY
        flat -= part
    return p, len(at)


def _flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([x.ravel() for x in p.values()])


def _views(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The parts of a flat array in the shapes of the parameters."""
    out, at = {}, 0
    for n, x in like.items():
        out[n] = flat[at : at + x.size].reshape(x.shape)
        at += x.size
    return out


def describe(parts: DataFrame, units: Units) -> tuple[np.ndarray, np.ndarray]:
    """Per unit: how often it is in the sequences of the texts, and the mean of their projections.  One row per unit comes back."""
    signs = np.random.default_rng(9).normal(size=(2049, COMPANY)).astype(np.float32)
    signs[2048] = 0  # for all units but the commonest
    ones = np.ones((COMPANY, 1), np.float32)

    def run(batches):
        one_blas_thread()
        n, sums = np.zeros(units.total, np.int64), np.zeros((COMPANY, units.total))  # of a task
        for batch in batches:
            for part in row_slices(batch, ROWS_AT_ONCE):
                u, texts = _flat_units(part)
                if not len(u):
                    continue
                off = _sequences(texts)
                one = signs.take(np.minimum(u, 2048), 0)  # numbers rise as counts fall
                around = np.repeat(np.add.reduceat(one, off[:-1]), np.diff(off), axis=0)
                around -= one
                around /= np.maximum(np.sqrt((around * around) @ ones), 1e-9)
                n += np.bincount(u, minlength=units.total)
                for i in range(COMPANY):
                    sums[i] += np.bincount(u, around[:, i], units.total)
        unit = np.flatnonzero(n)
        yield pa.record_batch({"unit": pa.array(unit, pa.int32()), "n": pa.array(n[unit]), **{c: pa.array(sums[i, unit]) for i, c in enumerate(cols)}})

    cols = [f"c{i}" for i in range(COMPANY)]
    got = parts.select("units").mapInArrow(run, "unit int, n long, " + ", ".join(f"{c} double" for c in cols))
    got = got.groupBy("unit").agg(F.sum("n").alias("n"), *[F.sum(c).cast("float").alias(c) for c in cols])
    table = got.toArrow()  # at most one row for each unit
    n, company = np.zeros(units.total, np.int64), np.zeros((units.total, COMPANY), np.float32)
    u = table["unit"].to_numpy()
    n[u] = table["n"].to_numpy()
    company[u] = np.stack([table[c].to_numpy() for c in cols], 1) / n[u][:, None]
    return n, company


def classes(kinds: np.ndarray, n: np.ndarray, company: np.ndarray, seed: int = 8) -> np.ndarray:
    """A class per unit: for each kind, weighted k-means on the company that units keep.

    Units seen once are a class with those not seen, so that training meets that class as often as scoring will.
    """
    r = np.random.default_rng(seed)
    of = np.full(len(n), CLASSES - 1, np.int64)
    begin = 0
    for kind, k in enumerate((WORD_CLASSES, FIRST_CLASSES, INNER_CLASSES)):
        of[kinds == kind] = begin + k - 1
        seen = np.flatnonzero((kinds == kind) & (n > 1))
        if len(seen):
            w = np.sqrt(n[seen])
            common = seen[np.argsort(-n[seen], kind="stable")]
            c = company[common[np.unique(np.linspace(0, min(len(seen), 4000) - 1, k - 1).astype(int))]].astype(float)
            c += r.normal(0, 1e-3, c.shape)
            for _ in range(15):
                at = np.concatenate([((c**2).sum(1) - 2 * company[part] @ c.T).argmin(1) for part in np.array_split(seen, len(seen) // 20_000 + 1)])
                mass = np.bincount(at, w, len(c))
                total = np.stack([np.bincount(at, w * company[seen, i], len(c)) for i in range(COMPANY)], 1)
                c[mass > 0] = total[mass > 0] / mass[mass > 0, None]
            of[seen] = begin + at
        begin += k
    return of


def dictionary(counts: DataFrame, path: str) -> tuple[Units, np.ndarray]:
    """The units, and the counts of the dictionary's words by number."""
    top = counts.filter(F.col("word") != int(END)).orderBy(F.desc("c"), "word").limit(DICTIONARY).toArrow()  # a fixed bound
    order = np.lexsort((top["word"].to_numpy(), -top["c"].to_numpy()))
    words, c = top["word"].to_numpy()[order].view(np.uint64), top["c"].to_numpy()[order]
    by = np.argsort(words)
    return Units(words[by], by, len(words), len(pieces(path)[1]), path), c


def fit(parts: DataFrame, units: Units, c: np.ndarray) -> Model:
    """The model, from the spelled training texts (row, units) and the counts of the dictionary."""
    n, company = describe(parts, units)
    kinds = units.kinds()
    of = classes(kinds, n, company)
    weight = n.astype(float)
    weight[units.size :] = n[units.size :] + 0.5
    weight[: units.size] = c
    mass = np.bincount(of, weight, CLASSES) + 1e-9
    row = np.full(units.total + 1, 0, np.int64)
    best = np.argsort(-weight, kind="stable")[: OWN_ROWS - 1]
    shared = (ROWS - OWN_ROWS) // 4  # the others share rows with their kind
    row[:-1] = OWN_ROWS + kinds * shared + (mix(np.arange(units.total, dtype=np.uint64)) % np.uint64(shared)).astype(np.int64)
    row[best] = np.arange(len(best))
    row[-1] = OWN_ROWS - 1
    total = np.bincount(of, n, CLASSES) + 0.5
    model = Model(row, of, np.log10(weight / mass[of]), total / total.sum(), fresh(np.log(total / total.sum())))
    for number in range(ROUNDS):
        share = parts.filter(F.pmod(F.xxhash64("row"), F.lit(ROUNDS)) == number)
        model = replace(model, params=_round(share, model, 0.01 / (number + 1), number))
    return model


def _round(parts: DataFrame, model: Model, rate: float, seed: int) -> dict[str, np.ndarray]:
    """One round of training: the mean of the tasks' parameters, weighted by their windows."""
    sent = parts.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        one_blas_thread()
        now, total, held = sent.value, 0, []

        def trained() -> None:
            nonlocal now, total, held
            u = np.concatenate([x for x, _ in held])
            lens = np.concatenate([np.diff(o) for _, o in held])
            p, n = local_training(now, u, np.concatenate([[0], np.cumsum(lens)]), rate, seed, again=len(u) < PART // 2 and not total)
            now, total, held = replace(now, params=p), total + n, []

        with np.errstate(over="ignore"):
            for batch in batches:
                u, texts = _flat_units(batch)
                off = _sequences(texts)
                for a in range(0, len(off) - 1, PART // SEQUENCE):  # so that no more than PART units are held
                    own = off[a : a + PART // SEQUENCE + 1]
                    if held and sum(len(x) for x, _ in held) + own[-1] - own[0] > PART:
                        trained()
                    held.append((u[own[0] : own[-1]], own - own[0]))
            if held and sum(len(x) for x, _ in held):
                trained()
            if total:
                flat = _flat(now.params).astype(float) * total
                yield pa.record_batch({"at": pa.array(np.arange(len(flat), dtype=np.int32)), "p": pa.array(flat), "n": pa.array(np.full(len(flat), total))})

    got = parts.select("units").mapInArrow(run, "at int, p double, n long").groupBy("at").agg((F.sum("p") / F.sum("n")).alias("p")).toArrow()
    if not got.num_rows:
        return model.params
    flat = np.zeros(sum(x.size for x in model.params.values()))
    flat[got["at"].to_numpy()] = got["p"].to_numpy()
    return _views(flat.astype(np.float32), model.params)


def score_units(model: Model, u: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 p of each unit, and for first pieces that of any first piece (0 for others), given what is before; u: sequences end to end, each with its end unit."""
    begin = np.cumsum(lens) - lens
    rows = np.empty(len(u), np.int64)
    rows[1:] = model.row[u[:-1]]
    rows[begin] = model.row[-1]
    target = model.of[u]
    at, _ = windows(lens, begin)
    made = tables(model.params)
    got, enter = np.zeros(len(u)), np.zeros(len(u))
    summed = np.zeros((CLASSES, 2), np.float32)  # over all classes, and over those of first pieces
    summed[:, 0] = summed[FIRST, 1] = 1
    opens = (target >= FIRST.start) & (target < FIRST.stop)
    for a in range(0, len(at), 512):
        w = at[a : a + 512]
        in_rows = rows[w]
        z, _, _ = _forward(model.params, made[0].take(in_rows, 0), made[1].take(in_rows[:, HALF:], 0), w < 0)
        z = np.exp(z, out=z).reshape(-1, CLASSES)
        sums = z @ summed
        own = w[:, HALF:].ravel()
        live = np.flatnonzero(own >= 0)
        place = own[live]
        got[place] = z.ravel()[live * CLASSES + target[place]] / sums[live, 0]
        first = np.flatnonzero(opens[place])
        enter[place[first]] = sums[live[first], 1] / sums[live[first], 0]
    got = np.log10((1 - FLOOR) * got + FLOOR * model.share[target]) + model.log_share[u]
    enter[opens] = np.log10((1 - FLOOR) * enter[opens] + FLOOR * model.share[FIRST].sum())
    return got, enter


def lm_scores(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held_fold: int = 2) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row."""
    held = remainder(F.col("id"), folds) == held_fold
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("train", ~held)
    counts = written(word_counts(rows.select("text", "train")), "counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    units, top = dictionary(counts, path)
    known = counts.orderBy(F.desc("c"), "word").limit(KNOWN).toArrow()  # a fixed bound
    outside = counts.join(counts.orderBy(F.desc("c"), "word").limit(DICTIONARY).select("word"), "word", "left_anti").filter(F.col("word") != int(END))
    tail = outside.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.count_if(F.col("c") == 1).alias("once")).first()
    recall = float(np.clip(1 - tail.once / max(tail.n, 1), 0.02, 0.98)) if tail.n else 0.02
    tail_size = float(max(tail.n + tail.v, 1))
    by = np.argsort(known["word"].to_numpy().view(np.uint64))
    spread = float(total.n + total.v + 1)
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "id", "text", "train")
    spelled = spelled_table(numbered, units, known["word"].to_numpy().view(np.uint64)[by], known["c"].to_numpy()[by], spread, tail_size)
    spelled = written(spelled, "spelled")  # the row numbers are fixed from here on
    model = fit(spelled.filter("train").select("row", "units"), units, top)
    sent = docs.sparkSession.sparkContext.broadcast((model, units))
    kind = docs.schema[id_col].dataType.simpleString()

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, units = sent.value
        u, off = _flat_units(batch)
        p, enter = score_units(model, u, np.diff(off))
        ends = units.word_ends(u)
        stop = np.flatnonzero(ends)  # of each word; a word starts where no other goes on
        inside = u != units.end
        start = np.ones(len(u), bool)
        start[1:] = ends[:-1] | ~inside[:-1]
        start = np.flatnonzero(start & inside)
        run = np.concatenate([[0], np.cumsum(p)])
        of_word = run[stop + 1] - run[start]
        doc = np.searchsorted(off, start, "right") - 1
        spelled = np.flatnonzero(u[start] >= units.size)
        r = unpacked(batch.column("recalled"), np.float32)[0].astype(float)
        met = spelled[r >= 0]
        of_word[met] = np.log10((1 - recall) * 10 ** of_word[met] + recall * 10 ** enter[start[met]] * r[r >= 0])
        here = np.ones(len(start), bool)
        here[spelled[r < 0]] = False
        score = p[off[1:] - 1] + np.bincount(doc[here], of_word[here], len(off) - 1)
        rest = spelled[r < 0]
        cut = np.searchsorted(doc[rest], np.arange(len(off)))
        return pa.record_batch(
            [*(batch.column(c) for c in ("row", "id", "n_tokens", "n_known", "base")), pa.array(score), lists(*unpacked(batch.column("words"), np.int64), pa.int64()), lists(of_word[rest], cut, pa.float32()), lists(enter[start[rest]], cut, pa.float32())],
            names=["row", "id", "n_tokens", "n_known", "base", "score", "words", "spelled", "enter"],
        )

    scored = mapped(spelled.drop("train"), each, f"row long, id {kind}, n_tokens long, n_known long, base double, score double, words array<long>, spelled array<float>, enter array<float>", text=None, limit=ROWS_AT_ONCE)
    scored = written(scored, "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("words", "spelled", "enter")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.spelled").cast("double").alias("spelled"), F.col("w.enter").cast("double").alias("enter"))
    c = F.coalesce("c", F.lit(0))
    recalled = F.when(c > 0, F.lit(recall) * F.pow(F.lit(10.0), "enter") * (c + 1) / F.lit(tail_size)).otherwise(0.0)
    p = F.log10(F.lit(1 - recall) * F.pow(F.lit(10.0), "spelled") + recalled)
    p = F.when(F.col("spelled") < -280, F.greatest(F.col("spelled") + F.lit(float(np.log10(1 - recall))), F.log10(recalled))).otherwise(p)
    more = rare.join(counts, "word", "left").groupBy("row").agg(F.sum(F.log10((c + 1) / F.lit(spread))).alias("base2"), F.count_if(c > 0).alias("known2"), F.sum(p).alias("score2"))
    out = scored.select("row", "id", "n_tokens", "n_known", "base", "score").join(more, "row", "left")
    return out.select(
        "id",
        held.alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known2", F.lit(0))).cast("long").alias("n_known"),
        F.lit(int(total.n)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base2", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("score2", F.lit(0.0))).alias("score"),
    )
