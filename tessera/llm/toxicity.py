"""Toxicity by nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

Terms are runs of ASCII letters and digits and of bytes from 0x80 on, lower-cased A-Z.  All
terms of the training rows count.  The at most TERMS whose presence tells most about the label there (chi-square)
have their full weight, all others PLAIN of it; for that, the count of a term is held to the number of different
word pairs around it, so that one text copied many times is no evidence.  Labelled examples become TF-IDF vectors
over all terms; equal vectors are one entry with its counts of either label.  The index keeps the list of each term;
for lists of at least one entry in COMMON also the largest weight in each block of BLOCK entries.  A text's rarer lists
are added up whole, then common lists are read only in blocks whose bound reaches the K-th best found, and what comes
near it is confirmed in double precision, so the K nearest are exact.  Texts are searched in batches.  Their votes,
weighted by 1 / (distance + 0.05) and counts, are mapped to probabilities by isotonic regression on
leave-one-out votes of the training rows.  A text without any term of the training rows gets the rate of such texts.

Training uses at most SAMPLE labelled rows (documented bound; the smallest by hash of the id); every document
is scored over its whole text.  The score depends on the text alone.

Defined results: null, empty and blank texts are texts without terms; labels that are null are ignored, as are
ids without a document; a document with several labels counts once for each; without labels every score is
0.25; repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Words, mapped, mix, written

SAMPLE = 20_000
TERMS = 512
PLAIN = 0.1
TRIED = 2048
LEAST_CHI2 = 25.0
K = 24
BLOCK = 64
COMMON = 24
FIRST = 4
BATCH = 128
SLACK = 5e-5
_SEPARATORS = np.ones(256, bool)
_SEPARATORS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def remainder(id_col: Column, by: int) -> Column:
    """crc32 of the id as text, modulo `by`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % by


def _tfs(words: Words, terms: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per document the places of its terms in the sorted `terms`, and how often each occurs."""
    n = len(words.first) - 1
    if not len(terms):
        return [(np.zeros(0, np.int64),) * 2] * n
    at = np.searchsorted(terms, words.hash).clip(0, len(terms) - 1)
    hit = np.flatnonzero(terms[at] == words.hash)
    doc = np.searchsorted(words.first, hit, "right") - 1
    code, count = np.unique(doc * len(terms) + at[hit], return_counts=True)
    cut = np.searchsorted(code, np.arange(n + 1) * len(terms))
    return [(code[cut[i] : cut[i + 1]] % len(terms), count[cut[i] : cut[i + 1]]) for i in range(n)]


def _key(tf: tuple[np.ndarray, np.ndarray]) -> bytes:
    return np.stack(tf, 1).astype(np.int32).tobytes()


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _unkey(key: bytes) -> tuple[np.ndarray, np.ndarray]:
    places, counts = np.frombuffer(key, np.int32).reshape(-1, 2).T
    return places.astype(np.int64), counts.astype(np.int64)


@dataclass
class Index:
    """Inverted lists of TF-IDF weights.  The list of a term in at least one entry of COMMON is kept by blocks, with each block's largest weight."""

    terms: np.ndarray  # sorted hashes
    idf: np.ndarray
    entry: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))  # postings by term, then entry
    tf: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    df: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # per term: its postings
    positive: np.ndarray = field(default_factory=lambda: np.zeros(0))
    count: np.ndarray = field(default_factory=lambda: np.zeros(0))
    example: list = field(default_factory=list)  # an id for each entry
    number: dict = field(default_factory=dict)  # of each entry, by the digest of its key
    bare: float = 0.25  # rate of texts without terms
    prior: float = 0.25
    knots: tuple[np.ndarray, np.ndarray] = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def vector(self, tf: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        w = (1 + np.log(tf[1])) * self.idf[tf[0]]
        return w / np.sqrt((w * w).sum())

    def add(self, tfs: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Index entries, which should be sorted so that like stands by like."""
        flat = np.concatenate([np.stack(t, 1).astype(np.int32) for t in tfs]) if tfs else np.zeros((0, 2), np.int32)
        self.add_flat(np.array([len(t[0]) for t in tfs], int), flat[:, 0], flat[:, 1])
        self.build()

    def add_flat(self, lens: np.ndarray, places: np.ndarray, counts: np.ndarray) -> None:
        """The entries' lists alone; build() makes them ready for searching, where that is done."""
        order = np.argsort(places, kind="stable")
        self.df = np.bincount(places, minlength=len(self.terms))
        self.tf = counts[order]
        self.entry = np.repeat(np.arange(len(lens), dtype=np.int32), lens)[order]

    def build(self) -> None:
        """What searching needs, from the postings' entries and counts; several workers share an executor's memory, so in small types and parts."""
        n, self.blocks = len(self.count), -(-len(self.count) // BLOCK)
        term = np.repeat(np.arange(len(self.df), dtype=np.int32), self.df)
        w = 1 + np.log(self.tf)
        w *= self.idf[term]
        w /= np.sqrt(np.bincount(self.entry, w * w, n))[self.entry]
        # common lists: weights and block maxima as dense blocks
        common = np.flatnonzero(self.df * COMMON >= max(n, 1))
        self.place = np.full(len(self.df), -1, np.int32)
        self.place[common] = np.arange(len(common))
        often = np.repeat(self.place >= 0, self.df)
        hit = np.flatnonzero(often)
        self.dense = np.zeros((self.blocks, len(common), BLOCK), np.float32)
        self.dense[self.entry[hit] // BLOCK, self.place[term[hit]], self.entry[hit] % BLOCK] = w[hit]
        del hit
        self.most = np.ascontiguousarray(self.dense.max(2).T) if self.blocks else np.zeros((len(common), 0), np.float32)
        # the other lists as they are
        self.rare_entry, self.rare_weight = self.entry[~often], w[~often].astype(np.float32)
        del often
        self.rare_start = np.concatenate([[0], np.cumsum(np.where(self.place < 0, self.df, 0))])
        # the terms of each entry, to confirm by
        self.own_start = np.concatenate([[0], np.cumsum(np.bincount(self.entry, minlength=n))])
        self.own_term, self.own_weight = np.empty(len(w), np.int32), np.empty(len(w))
        for at in range(0, n, 2048):
            part = np.flatnonzero((self.entry >= at) & (self.entry < at + 2048))
            part = part[np.argsort(self.entry[part], kind="stable")]
            to = slice(self.own_start[at], self.own_start[at] + len(part))
            self.own_term[to], self.own_weight[to] = term[part], w[part]
        self.room, self.query = (np.empty(0, np.int64), np.empty(0)), np.zeros(len(self.df))

    def __getstate__(self) -> dict:
        """Small, for each executor keeps its copy on disk: what build() makes is made again."""
        state = {k: self.__dict__[k] for k in self.__dataclass_fields__}
        for k in ("entry", "tf"):
            if not len(state[k]) or state[k].max() < 1 << 16:
                state[k] = state[k].astype(np.uint16)
        packed = {k: (str(state[k].dtype), zlib.compress(state[k].tobytes(), 1)) for k in ("entry", "tf", "df")}
        return state | packed

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        for k in ("entry", "tf", "df"):
            kind, data = state[k]
            setattr(self, k, np.frombuffer(zlib.decompress(data), kind))
        self.build()
        self.entry = self.tf = np.zeros(0, np.int32)  # searching needs them no more

    def _partial(self, places: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Per entry the part of the cosine that comes from lists that are not common."""
        start, size = self.rare_start[places], self.df[places]
        total = int(size.sum())
        if total > len(self.room[0]):
            self.room = np.empty(2 * total, np.int64), np.empty(2 * total)
        (entry, weight), done = self.room, 0
        long = size >= 128
        if long.any():
            own, done = [slice(a, b) for a, b in zip(start[long].tolist(), (start + size)[long].tolist(), strict=True)], int(size[long].sum())
            np.concatenate([self.rare_entry[x] for x in own], out=entry[:done])
            np.concatenate([self.rare_weight[x] for x in own], out=weight[:done])
            weight[:done] *= np.repeat(q[long], size[long])
        start, size = start[~long], size[~long]  # short lists all at once
        at = np.arange(total - done) + np.repeat(start - np.cumsum(size) + size, size)
        entry[done:total] = self.rare_entry[at]
        weight[done:total] = self.rare_weight[at] * np.repeat(q[~long], size)
        return np.bincount(entry[:total], weight[:total], self.blocks * BLOCK)

    def _visit(self, score: np.ndarray, q: np.ndarray, which: np.ndarray) -> None:
        """Add the common lists' part to the scores [query, block, entry] of the (query, block) marked in `which`."""
        for b in np.flatnonzero(which.any(0)):
            rows = np.flatnonzero(which[:, b])
            if len(rows) == len(q):
                score[:, b] += q @ self.dense[b]
            else:
                score[rows, b] += q[rows] @ self.dense[b]

    def nearest(self, tfs: list[tuple[np.ndarray, np.ndarray]], k: int = K) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text the exact k nearest entries by cosine, ties by entry, and their similarities.

        Block-max search: lists of rarer terms are added up whole; common lists only in blocks whose best partial
        score and block maxima could reach the k-th best of the FIRST blocks.  That is done in single precision, and
        all entries within SLACK of the k-th best are then confirmed in double precision over their whole vectors.
        """
        out = []
        for at in range(0, len(tfs), BATCH):
            part = tfs[at : at + BATCH]
            vectors = [self.vector(tf) for tf in part]
            q = np.zeros((len(part), len(self.most)), np.float32)
            score = np.empty((len(part), self.blocks, BLOCK), np.float32)
            for i, (tf, v) in enumerate(zip(part, vectors, strict=True)):
                place = self.place[tf[0]]
                q[i, place[place >= 0]] = v[place >= 0]
                score[i] = self._partial(tf[0][place < 0], v[place < 0]).reshape(self.blocks, BLOCK)
            bound = score.max(2) + q @ self.most
            tops = np.argpartition(-bound, min(FIRST, self.blocks) - 1, axis=1)[:, :FIRST]
            first = np.zeros(bound.shape, bool)
            np.put_along_axis(first, tops, True, 1)
            self._visit(score, q, first)
            seen = np.take_along_axis(score, tops[:, :, None], 1).reshape(len(part), -1)
            least = np.partition(seen, -k, axis=1)[:, -k] if seen.shape[1] >= k else np.zeros(len(part))
            self._visit(score, q, ~first & (bound > 0) & (bound >= least[:, None] - SLACK))
            for tf, v, s, floor in zip(part, vectors, score.reshape(len(part), -1), least, strict=True):
                reach = s[s >= floor]  # the k best at least, where there are so many
                least = np.partition(reach, -k)[-k] if len(reach) > k else floor
                out.append(self._confirmed(np.flatnonzero((s > 0) & (s >= least - SLACK)), tf, v, k))
        return out

    def _confirmed(self, entries: np.ndarray, tf: tuple[np.ndarray, np.ndarray], v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        at = self.own_start[entries].tolist(), self.own_start[entries + 1].tolist()
        own = [slice(a, b) for a, b in zip(*at, strict=True)]
        if not own:
            return entries, np.zeros(0)
        self.query[tf[0]] = v
        parts = self.query[np.concatenate([self.own_term[x] for x in own])] * np.concatenate([self.own_weight[x] for x in own])
        self.query[tf[0]] = 0
        s = np.add.reduceat(parts, np.cumsum([0, *(x.stop - x.start for x in own[:-1])]))
        keep = np.lexsort((entries, -np.round(s, 12)))[:k]
        return entries[keep], s[keep]

    def votes(self, tfs: list[tuple[np.ndarray, np.ndarray]], without: list[tuple[int, float]] | None = None) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """For each text the weighted share of positive votes, and the nearest; `without` leaves one row (entry, label) out of each."""
        out = []
        for i, (e, s) in enumerate(self.nearest(tfs)):
            positive, count = self.positive[e], self.count[e]
            if without:
                own = e == without[i][0]
                positive, count = positive - own * without[i][1], count - own
            w = 1 / (np.maximum(1 - s, 0) + 0.05)
            out.append((float(((w * positive).sum() + self.prior) / ((w * count).sum() + 1)), e, s))
        return out

    def score(self, raw: float) -> float:
        """The calibrated probability; a little of the raw vote keeps its order within steps."""
        return float(0.98 * np.interp(raw, *self.knots) + 0.02 * raw)


class Scorer:
    """Scores texts by their terms alone: (score, evidence) of each; equal vectors are searched once."""

    def __init__(self, index: Index):
        self.index, self.memo = index, {}

    def __call__(self, texts: pa.Array) -> list[tuple[float, str]]:
        tfs = _tfs(Words(texts, _SEPARATORS), self.index.terms)
        keys = [_digest(_key(tf)) if len(tf[0]) else None for tf in tfs]
        if len(self.memo) > 50_000:
            self.memo.clear()
        new = {key: tf for key, tf in zip(keys, tfs, strict=True) if key and key not in self.memo}
        if len(self.index.count):
            for key, (raw, e, s) in zip(new, self.index.votes(list(new.values())), strict=True):
                it = self.index
                near = ",".join(f"{it.example[i]}:{x:.4f}:{it.positive[i]:.0f}/{it.count[i]:.0f}" for i, x in zip(e[:3], s[:3], strict=True))
                self.memo[key] = it.score(raw), near
        bare = (self.index.bare, "")
        return [self.memo.get(key, bare) if key else bare for key in keys]


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots of a rising step function through weighted points, as (x, mean y)."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # weight, sum of y, sum of x
    for i in order:
        pools.append([w[i], w[i] * y[i], w[i] * x[i]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    p = np.array(pools)
    return p[:, 2] / p[:, 0], p[:, 1] / p[:, 0]


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, held_out: int, sample: int) -> DataFrame:
    """(id, text, y) of the sampled training rows.  The sample has at most `sample` rows, so it is broadcast."""
    chosen = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")).filter("id IS NOT NULL AND y IS NOT NULL")
    chosen = chosen.filter(remainder(F.col("id"), held_out) != 0).orderBy(F.xxhash64("id"), "id", "y").limit(sample)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return written(rows.join(F.broadcast(chosen), "id"), "training")


def _chi2(p: Column, n: Column, positives: float, negatives: float) -> Column:
    """Of presence against the label, in a two by two table."""
    every, has = positives + negatives, p + n
    return F.try_divide(every * (p * (negatives - n) - n * (positives - p)) ** 2, F.lit(positives * negatives) * has * (every - has))


def choose_terms(rows: DataFrame, positives: float, negatives: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes of all terms, their document counts in the training rows, and their weights (1 or PLAIN)."""

    def presence(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(batch.column("text"), _SEPARATORS)
        y = batch.column("y").to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(y)), words.counts())
        order = np.lexsort((doc, words.hash))
        h, d = words.hash[order], doc[order]
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        h, p = h[first], y[d[first]]
        term, start = np.unique(h, return_index=True)
        n = np.diff(np.append(start, len(h)))
        p = np.add.reduceat(p, start) if len(start) else np.zeros(0)
        return pa.record_batch({"term": pa.array(term.view(np.int64)), "p": pa.array(p), "n": pa.array(n - p)})

    # equal texts count once
    distinct = rows.groupBy("text").agg(F.max("y").alias("y"))
    counts = mapped(distinct, presence, "term long, p double, n double").groupBy("term").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    counts = written(counts, "terms")
    every = counts.select("term", (F.col("p") + F.col("n")).cast("float").alias("df")).toArrow()  # the terms of at most `sample` rows
    terms, df = every["term"].to_numpy().view(np.uint64), every["df"].to_numpy()
    order = np.argsort(terms)
    terms, df = terms[order], df[order].astype(float)
    plain = np.full(len(terms), PLAIN)
    if not positives or not negatives:
        return terms, df, plain
    tried = counts.withColumn("chi2", _chi2(F.col("p"), F.col("n"), positives, negatives)).filter((F.col("p") + F.col("n") >= 5) & (F.col("chi2") >= LEAST_CHI2))
    tried = {r.term: r for r in tried.orderBy(F.desc("chi2"), "term").limit(TRIED).collect()}
    if not tried:
        return terms, df, plain
    wanted = np.sort(np.array(list(tried), np.int64).view(np.uint64))

    def around(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(batch.column("text"), _SEPARATORS)
        y = batch.column("y").to_numpy(zero_copy_only=False)
        hit = np.flatnonzero(np.isin(words.hash, wanted))
        doc = np.searchsorted(words.first, hit, "right") - 1
        padded = np.concatenate([[np.uint64(1)], words.hash, [np.uint64(1)]])
        before = np.where(hit > words.first[doc], padded[hit], np.uint64(1))
        after = np.where(hit + 1 < words.first[doc + 1], padded[hit + 2], np.uint64(1))
        pair = mix(before * np.uint64(3) + mix(after))
        return pa.record_batch({"term": pa.array(words.hash[hit].view(np.int64)), "pair": pa.array(pair.view(np.int64)), "y": pa.array(y[doc])})

    pairs = mapped(distinct, around, "term long, pair long, y double").groupBy("term").agg(F.count_distinct(F.when(F.col("y") > 0.5, F.col("pair"))).alias("p"), F.count_distinct(F.when(F.col("y") <= 0.5, F.col("pair"))).alias("n"))
    held = []
    every = positives + negatives
    for r in pairs.collect():  # at most TRIED rows
        p, n = min(r.p, tried[r.term].p), min(r.n, tried[r.term].n)
        chi2 = every * (p * (negatives - n) - n * (positives - p)) ** 2 / (positives * negatives * (p + n) * (every - p - n)) if 0 < p + n < every else 0
        if chi2 >= LEAST_CHI2:
            held.append((chi2, r.term))
    held = sorted(held, key=lambda x: (-x[0], x[1]))[:TERMS]
    plain[np.searchsorted(terms, np.array([x[1] for x in held], np.int64).view(np.uint64))] = 1.0
    return terms, df, plain


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out: int = 5, sample: int = SAMPLE) -> Index:
    rows = training_rows(docs, labels, id_col, text_col, label_col, held_out, sample)
    totals = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("p")).first()
    terms, df, share = choose_terms(rows, totals.p, totals.n - totals.p)
    index = Index(terms, (np.log((1 + totals.n) / (1 + df)) + 1) * share)
    sent_terms: Broadcast = rows.sparkSession.sparkContext.broadcast(terms)

    def vectors(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = [_key(tf) for tf in _tfs(Words(batch.column("text"), _SEPARATORS), sent_terms.value)]
        return pa.record_batch([pa.array(keys, pa.binary()), batch.column("y"), batch.column("id")], names=["key", "y", "id"])

    kind = docs.schema[id_col].dataType.simpleString()
    got = mapped(rows.select("id", "text", "y"), vectors, f"key binary, y double, id {kind}").groupBy("key").agg(F.sum("y").alias("p"), F.count("*").alias("n"), F.min("id").alias("id"))
    got = written(got, "entries")
    found = got.toArrow()  # at most `sample` rows
    entries = list(zip(*(found[c].to_pylist() for c in ("key", "p", "n", "id")), strict=True))
    index.prior = (totals.p + 0.5) / (totals.n + 2)
    bare = next((r for r in entries if not r[0]), (b"", 0.0, 0, None))
    index.bare = (bare[1] + index.prior) / (bare[2] + 1)
    entries = [r for r in entries if r[0]]
    del found

    def lead(key: bytes) -> list[int]:
        tf = _unkey(key)
        return tf[0][np.argsort(-index.vector(tf), kind="stable")[:4]].tolist()

    entries = [r for _, r in sorted(((lead(r[0]), r) for r in entries), key=lambda x: (x[0], x[1][0]))]  # like stands by like
    index.positive, index.count = np.array([r[1] for r in entries], float), np.array([r[2] for r in entries], float)
    index.example = [r[3] for r in entries]
    index.number = {_digest(r[0]): i for i, r in enumerate(entries)}
    lens, flat = np.array([len(r[0]) // 8 for r in entries], int), np.frombuffer(b"".join(r[0] for r in entries), np.int32).reshape(-1, 2)
    some = bool(entries)
    del entries
    index.add_flat(lens, flat[:, 0], flat[:, 1])
    del flat
    if some:
        sent: Broadcast = rows.sparkSession.sparkContext.broadcast(index)

        def left_out(batch: pa.RecordBatch) -> pa.RecordBatch:
            cases = []
            for key, p, n in zip(*(batch.column(c).to_pylist() for c in ("key", "p", "n")), strict=True):
                cases += [(_unkey(key), sent.value.number[_digest(key)], label, float(w)) for label, w in ((1.0, p), (0.0, n - p)) if key and w]
            raw = [r for r, *_ in sent.value.votes([c[0] for c in cases], [c[1:3] for c in cases])]
            cols = raw, [c[2] for c in cases], [c[3] for c in cases]
            return pa.record_batch([pa.array(c, pa.float64()) for c in cols], names=["raw", "y", "w"])

        votes = mapped(got.select("key", "p", "n").repartition(64), left_out, "raw double, y double, w double", text="key").toArrow()
        sent.destroy()
        raw, y, w = (votes[c].to_numpy() for c in ("raw", "y", "w"))
        order = np.lexsort((-y, raw))
        index.knots = isotonic(raw[order], y[order], w[order])
    return index


def _scorers(docs: DataFrame, index: Index) -> Callable[[], Scorer]:
    """What gives a task its scorer, made once for all batches of the task."""
    sent: Broadcast = docs.sparkSession.sparkContext.broadcast(index)
    made: list[Scorer] = []

    def scorer() -> Scorer:
        if not made:
            made.append(Scorer(sent.value))
        return made[0]

    return scorer


def scores(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text", held_out: int = 5) -> DataFrame:
    """(id, held_out, score, predicted, evidence); evidence: the three nearest entries as id:similarity:positive/count."""
    score_of = _scorers(docs, index)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = score_of()(batch.column("text"))
        score = np.array([g[0] for g in got], float)
        return pa.record_batch(
            [batch.column("id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array([g[1] for g in got], pa.string())],
            names=["id", "score", "predicted", "evidence"],
        )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = mapped(rows, each, f"id {kind}, score double, predicted int, evidence string")
    return out.select("id", (remainder(F.col("id"), held_out) == 0).alias("held_out"), "score", "predicted", "evidence")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out: int = 5, sample: int = SAMPLE) -> DataFrame:
    return scores(docs, fit(docs, labels, id_col, text_col, label_col, held_out, sample), id_col, text_col, held_out)


def without_toxic(docs: DataFrame, index: Index, text_col: str = "text") -> DataFrame:
    """The documents scored under 0.5, with all their columns, in one pass."""
    score_of = _scorers(docs, index)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([score < 0.5 for score, _ in score_of()(batch.column(text_col))], pa.bool_()))

    return mapped(docs, each, docs.schema, text=text_col)
