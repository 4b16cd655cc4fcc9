"""Secret scans: base patterns, and a character CNN in numpy over every candidate and its context.

One pass over the texts finds the base spans (assign, access, hex) and the candidates: maximal runs of 6 or more
of A-Z a-z 0-9 + / _ . = - that hold a digit, one of + / _ = or a small letter before a capital, so that words of
prose are none.  Each goes to the network whole, with LEFT characters before it and RIGHT after it, whatever its
length: one convolution, and maxima over all of it.

The findings are labelled by the base patterns themselves, as there are no others: a candidate that meets a base
span is a secret, the rest are not.  What the network adds is therefore what looks like base findings and stands
like them without matching a pattern; its recall is measured against those labels.  Distinct windows are dealt by a
hash of the candidate's own text, so that no value is on two sides: four eighths train, two calibrate, two set the
threshold.  Training reads all distinct windows of its folds, of any length: they are dealt by hash to shares of about
SHARE bytes, each share runs Adam over all of its windows, and the parameters are averaged, in ROUNDS rounds where there
is more than one share.  Calibration and threshold come from counts of all windows of their folds by logit, in cells of
1/256; the threshold is the highest start of a cell that keeps RECALL of the secrets there.
While training, the context of half of the examples is blanked, so that a value can also be told by its own characters.
Candidates at or over the threshold outside base spans are added as kind cnn.  Base spans are never dropped.

Defined results: null and empty texts have no spans; every row gets its own result, repeated or not; where the
findings hold fewer than LEAST of a label nothing is added; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import mapped, one_blas_thread, text_buffer, written

KINDS = ("assign", "access", "hex", "cnn")
SHARE = 1 << 20  # bytes of windows that a task trains on
ROUNDS = 3
LEAST = 20
RECALL = 0.98
LEFT, RIGHT = 24, 8  # characters seen before and after a candidate
TRAINED = 1024  # characters of what training goes over more than once
FILTERS, SPAN, DEPTH = 24, 5, 8
PIECE = 1 << 15  # places convolved at a time

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of HEX with 24 or more: a greedy run has no longer one around it
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")
TELLING = re.compile(r"[0-9+/_=]|[a-z][A-Z]")
_WORDS = (b"passw", b"secret", b"token", b"api")  # every assign match holds one of these, in either case
_RUN_BYTE, _HEX_BYTE, _TELLING_BYTE, _CAPITAL, _SMALL = np.zeros((5, 256), bool)
_RUN_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_.=-"]] = True
_HEX_BYTE[[*range(48, 58), *range(97, 103)]] = True
_TELLING_BYTE[[*range(48, 58), *b"+/_="]] = True
_CAPITAL[65:91], _SMALL[97:123] = True, True


def base_spans(text: str, low: bytes | None = None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans, sorted; code points, end exclusive."""
    low = text.encode().lower() if low is None else low
    out = []
    if any(w in low for w in _WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if b"akia" in low:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in RUN.finditer(text) if TELLING.search(m[0])]


def window(text: str, start: int, end: int) -> bytes:
    """The candidate with its context, padded with 0; a character outside ASCII is 1."""
    around = text[max(0, start - LEFT) : start].rjust(LEFT, "\0") + text[start:end] + text[end : end + RIGHT].ljust(RIGHT, "\0")
    return around.encode() if around.isascii() else bytes(ord(c) if ord(c) < 128 else 1 for c in around)


def _interesting(texts: pa.Array) -> np.ndarray:
    """Per text: whether it may hold a candidate or 24 hex digits (vectorised screen)."""
    data, off = text_buffer(texts)
    base = int(off[0])
    data, off = data[base : int(off[-1])], off - base
    flags = np.zeros(len(texts), bool)
    full = off[:-1] < off[1:]
    first, last = off[:-1][full], off[1:][full] - 1  # of each text; a run ends with its text
    told_by = np.concatenate([[0], np.cumsum(_TELLING_BYTE[data])])
    risen = np.concatenate([[0, 0], np.cumsum(_CAPITAL[data[1:]] & _SMALL[data[:-1]])])  # a small letter before a capital
    for mask, least, told in ((_RUN_BYTE[data], 6, True), (_HEX_BYTE[data], 24, False)):
        before, after = mask.copy(), mask.copy()
        before[1:] &= ~mask[:-1]
        after[:-1] &= ~mask[1:]
        before[first], after[last] = mask[first], mask[last]
        start, end = np.flatnonzero(before), np.flatnonzero(after) + 1
        keep = end - start >= least
        start, end = start[keep], end[keep]
        if told:
            keep = (told_by[end] > told_by[start]) | (risen[end] > risen[start + 1])
            start = start[keep]
        flags[np.searchsorted(off, start, "right") - 1] = True
    return flags


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base: (start, kind, end)[], cand: (start, end, window, secret)[]) per row."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    cand = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("window", pa.binary()), ("secret", pa.bool_())]))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(batch.column("text"), "")
        screen = _interesting(texts)
        base, cands = [], []
        for k in range(len(texts)):
            raw = texts[k].as_buffer().to_pybytes() if texts[k].as_buffer() is not None else b""
            low = raw.lower()
            if not screen[k] and b"akia" not in low and not any(w in low for w in _WORDS):
                base.append([])
                cands.append([])
                continue
            text = raw.decode()
            spans = base_spans(text, low)
            base.append([{"start": s, "kind": kind, "end": e} for s, kind, e in spans])
            cands.append([{"start": s, "end": e, "window": window(text, s, e), "secret": any(x < e and s < y for x, _, y in spans)} for s, e in candidates(text)])
        return pa.record_batch([batch.column("id"), pa.array(base, span), pa.array(cands, cand)], names=["id", "base", "cand"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    return mapped(rows, each, f"id {kind}, base array<struct<start:int,kind:int,end:int>>, cand array<struct<start:int,end:int,window:binary,secret:boolean>>")


# ---------------------------------------------------------------- the network


def _joined(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all windows, end to end, and where each starts, with the end."""
    return np.frombuffer(b"".join(windows), np.uint8), np.concatenate([[0], np.cumsum([len(w) for w in windows])]).astype(np.int64)


@dataclass
class CharCnn:
    """Embedding, one convolution, maxima over the whole window and over the candidate, logistic output."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    scale: tuple[float, float] = (1.0, 0.0)  # calibration: sigmoid(scale[0] * logit + scale[1])
    threshold: float = 2.0

    @classmethod
    def fresh(cls, r: np.random.Generator) -> CharCnn:
        return cls(r.normal(0, 0.3, (128, DEPTH)), r.normal(0, (2 / (SPAN * DEPTH)) ** 0.5, (SPAN * DEPTH, FILTERS)), np.zeros(FILTERS), r.normal(0, 0.1, 2 * FILTERS), 0.0)

    def convolved(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per place of x but the last SPAN - 1 the inputs and the outputs of the filters."""
        cols = np.lib.stride_tricks.sliding_window_view(self.embed[x], SPAN, axis=0).transpose(0, 2, 1).reshape(len(x) - SPAN + 1, SPAN * DEPTH)
        return cols, np.maximum(cols @ self.filters + self.bias, 0)

    def features(self, windows: list[bytes]) -> np.ndarray:
        x, start = _joined(windows)
        best = np.zeros((2, len(windows), FILTERS))
        # the places of each window, and those that touch the candidate
        for k, (a, b) in enumerate(((start[:-1], start[1:] - SPAN + 1), (start[:-1] + LEFT - 2, start[1:] - RIGHT))):
            for at in range(0, len(x) - SPAN + 1, PIECE):
                to = min(at + PIECE, len(x) - SPAN + 1)
                own = np.arange(np.searchsorted(b, at, "right"), np.searchsorted(a, to, "left"))
                if len(own):
                    _, h = self.convolved(x[at : to + SPAN - 1])
                    cuts = np.stack([a[own].clip(at) - at, b[own].clip(None, to) - at], 1).ravel()
                    h = np.concatenate([h, np.zeros((1, FILTERS))])  # so that a cut may be at the end
                    best[k, own] = np.maximum(best[k, own], np.maximum.reduceat(h, cuts)[::2])
        return np.concatenate([best[0], best[1]], 1)

    def logits(self, windows: list[bytes]) -> np.ndarray:
        return np.concatenate([self.features(windows[i : i + 512]) @ self.out + self.out_bias for i in range(0, len(windows), 512)]) if windows else np.zeros(0)

    def scores(self, windows: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * self.logits(windows) + self.scale[1], -40, 40)))


def _blanked(w: bytes) -> bytes:
    return bytes(LEFT) + w[LEFT : len(w) - RIGHT] + bytes(RIGHT)


def fold(w: bytes) -> int:
    """0 to 3 for training, 4 and 5 for calibration, 6 and 7 for the threshold; by the candidate without its context."""
    return zlib.crc32(w[LEFT : len(w) - RIGHT]) % 8


def peaks(net: CharCnn, x: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each filter is largest over each window and over its candidate (2, windows, FILTERS), and how large; PIECE places at a time."""
    where, best = np.zeros((2, len(start) - 1, FILTERS), np.int64), np.full((2, len(start) - 1, FILTERS), -1.0)
    for at in range(0, len(x) - SPAN + 1, PIECE):
        to = min(at + PIECE, len(x) - SPAN + 1)
        _, h = net.convolved(x[at : to + SPAN - 1])
        for i in range(np.searchsorted(start[1:] - SPAN + 1, at, "right"), np.searchsorted(start[:-1], to, "left")):
            for k, (a, b) in enumerate(((start[i], start[i + 1] - SPAN + 1), (start[i] + LEFT - 2, start[i + 1] - RIGHT))):
                a, b = max(a, at), min(b, to)
                if a < b:
                    top = h[a - at : b - at].argmax(0)
                    value = h[a - at + top, np.arange(FILTERS)]
                    more = value > best[k, i]
                    where[k, i, more], best[k, i, more] = a + top[more], value[more]
    return where, best


def _dealt(r: np.random.Generator, windows: list[bytes], own: np.ndarray, n: int) -> np.ndarray:
    """n of the label's windows: each once, then those of at most TRAINED characters (if there are any) over and over."""
    short = own[[len(windows[i]) <= TRAINED + LEFT + RIGHT for i in own]]
    return np.concatenate([r.permutation(own), np.resize(r.permutation(short if len(short) else own), max(n - len(own), 0))])[:n]


def descend(net: CharCnn, windows: list[bytes], y: np.ndarray, seed: list[int], steps: int = 400, rate: float = 0.01) -> CharCnn:
    """Adam on the log loss of both labels alike, over at least `steps` batches and every window once."""
    r = np.random.default_rng(seed)
    pos, neg = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    steps = max(steps, -(-max(len(pos), len(neg)) // 64))
    pos, neg = (_dealt(r, windows, own, steps * 64) for own in (pos, neg))
    net = replace(net)
    names = ("embed", "filters", "bias", "out", "out_bias")
    m, v = {n: 0.0 for n in names}, {n: 0.0 for n in names}
    for t in range(1, steps + 1):
        at = np.concatenate([pos[(t - 1) * 64 : t * 64], neg[(t - 1) * 64 : t * 64]])
        batch = [_blanked(windows[i]) if blank else windows[i] for i, blank in zip(at, r.random(len(at)) < 0.5, strict=True)]
        x, start = _joined(batch)
        where, best = peaks(net, x, start)
        feats = np.concatenate([best[0], best[1]], 1)
        d = (1 / (1 + np.exp(-np.clip(feats @ net.out + net.out_bias, -40, 40))) - y[at]) / len(at)
        g = {"out": feats.T @ d, "out_bias": d.sum(), "embed": np.zeros_like(net.embed), "filters": np.zeros_like(net.filters), "bias": np.zeros_like(net.bias)}
        df = d[:, None] * net.out * (feats > 0)
        for place, part in zip(where, (df[:, :FILTERS], df[:, FILTERS:]), strict=True):
            seen = x[place[:, :, None] + np.arange(SPAN)]
            g["filters"] += np.einsum("bfk,bf->kf", net.embed[seen].reshape(len(at), FILTERS, -1), part)
            g["bias"] += part.sum(0)
            back = part[:, :, None] * net.filters.T[None]
            np.add.at(g["embed"], seen.ravel(), back.reshape(-1, DEPTH))
        for n in names:
            m[n] = 0.9 * m[n] + 0.1 * g[n]
            v[n] = 0.999 * v[n] + 0.001 * g[n] ** 2
            setattr(net, n, getattr(net, n) - rate * (m[n] / (1 - 0.9**t)) / (np.sqrt(v[n] / (1 - 0.999**t)) + 1e-8))
    return net


def settle(net: CharCnn, z: np.ndarray, y: np.ndarray, n: np.ndarray, hits: np.ndarray, times: np.ndarray) -> CharCnn:
    """Calibrated on logits z of label y, each n times; the threshold is the greatest of the secrets' logits `hits`, each so many times, that keeps RECALL."""
    a, b = 1.0, 0.0
    for _ in range(200 if len(z) else 0):  # calibration by gradient steps on two numbers
        d = (1 / (1 + np.exp(-np.clip(a * z + b, -40, 40))) - y) * n / n.sum()
        a, b = a - 0.05 * float((d * z).sum()) - 1e-4 * (a - 1), b - 0.05 * float(d.sum())
    a = max(a, 1e-3)
    order = np.argsort(hits)
    least = hits[order][np.searchsorted(np.cumsum(times[order]), int((1 - RECALL) * times.sum()), "right")]
    # less by what the order of a sum may change
    return replace(net, scale=(a, b), threshold=float(1 / (1 + np.exp(-np.clip(a * least + b, -40, 40)))) * (1 - 1e-9))


def train(windows: list[bytes], y: np.ndarray, seed: int = 5, steps: int = 400, rate: float = 0.01) -> CharCnn | None:
    """One share alone; None where a label has no window to train on or to set the threshold by."""
    folds = np.array([fold(w) for w in windows])
    own, held, last = np.flatnonzero(folds < 4), np.flatnonzero((folds == 4) | (folds == 5)), np.flatnonzero((folds > 5) & (y == 1))
    if len(np.unique(y[own])) < 2 or not len(last):
        return None
    net = descend(CharCnn.fresh(np.random.default_rng(seed)), [windows[i] for i in own], y[own], [seed], steps, rate)
    z, hits = net.logits([windows[i] for i in held]), net.logits([windows[i] for i in last])
    return settle(net, z, y[held], np.ones(len(z)), hits, np.ones(len(hits)))


def _params(net: CharCnn) -> np.ndarray:
    return np.concatenate([np.ravel(x) for x in (net.embed, net.filters, net.bias, net.out, net.out_bias)])


def _with_params(net: CharCnn, flat: np.ndarray) -> CharCnn:
    parts = np.split(flat, np.cumsum([net.embed.size, net.filters.size, net.bias.size, net.out.size]))
    return replace(net, embed=parts[0].reshape(net.embed.shape), filters=parts[1].reshape(net.filters.shape), bias=parts[2], out=parts[3], out_bias=float(parts[4][0]))


def _round(rows: DataFrame, net: CharCnn, number: int) -> CharCnn | None:
    """The mean of what the shares (share, window, secret) make of the net, weighted by their windows; None where no share has both labels."""
    sent = rows.sparkSession.sparkContext.broadcast(net)

    def run(table: pa.Table) -> pa.Table:
        one_blas_thread()
        table = table.sort_by("window")  # rows of a shuffle come in any order
        y = table["secret"].to_numpy().astype(float)
        flat = np.zeros(0)
        if 0 < y.sum() < len(y):
            flat = _params(descend(sent.value, table["window"].to_pylist(), y, [5, number, table["share"][0].as_py()], rate=0.01 / (number + 1))) * len(y)
        return pa.table({"at": pa.array(np.arange(len(flat)), pa.int32()), "p": pa.array(flat), "n": pa.array(np.full(len(flat), len(y)))})

    means = rows.groupBy("share").applyInArrow(run, "at int, p double, n long").groupBy("at").agg(F.round(F.sum("p") / F.sum("n"), 9).alias("p"))
    got = means.toArrow().sort_by("at")  # a row for each parameter
    return _with_params(net, got["p"].to_numpy()) if got.num_rows else None


def fit(found: DataFrame) -> CharCnn | None:
    """Train on all distinct windows, in shares of about SHARE bytes; calibrate and set the threshold by counts of logits over all the others."""
    rows = found.select(F.explode("cand").alias("c")).select("c.window", "c.secret").groupBy("window").agg(F.max("secret").alias("secret"))
    own = F.expr(f"substring(window, {LEFT + 1}, length(window) - {LEFT + RIGHT})")
    rows = written(rows.withColumn("fold", F.pmod(F.crc32(own), F.lit(8)).cast("int")), "windows")
    size = rows.agg(F.count_if("secret").alias("pos"), F.count_if(~F.col("secret")).alias("neg"), F.sum(F.when(F.col("fold") < 4, F.length("window"))).alias("bytes")).first()
    if min(size.pos, size.neg) < LEAST or not size.bytes:
        return None
    shares = -(-size.bytes // SHARE)
    dealt = rows.filter("fold < 4").select(F.pmod(F.xxhash64("window"), F.lit(shares)).alias("share"), "window", "secret").repartition(min(shares, 4096), "share")
    net: CharCnn | None = CharCnn.fresh(np.random.default_rng(5))
    for number in range(ROUNDS if shares > 1 else 1):
        net = net and _round(dealt, net, number)
    if net is None:
        return None
    sent = found.sparkSession.sparkContext.broadcast(net)

    def logits(batch: pa.RecordBatch) -> pa.RecordBatch:
        z = sent.value.logits(batch.column("window").to_pylist())
        return pa.record_batch([batch.column("fold"), batch.column("secret"), pa.array(z)], names=["fold", "secret", "z"])

    cell = F.floor(F.greatest(F.least("z", F.lit(40.0)), F.lit(-40.0)) * 256)
    z = mapped(rows.filter("fold > 3"), logits, "fold int, secret boolean, z double", text="window")
    cells = z.groupBy((F.col("fold") > 5).alias("last"), "secret", cell.alias("cell")).agg(F.count("*").alias("n"), F.avg("z").alias("mean"), F.min("z").alias("least")).toArrow()
    last, y, n, mean, least = (cells[c].to_numpy().astype(float) for c in ("last", "secret", "n", "mean", "least"))
    hit = (last == 1) & (y == 1)
    return settle(net, mean[last == 0], y[last == 0], n[last == 0], least[hit], n[hit]) if hit.any() else None


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, n_cnn, base_sha256, spans) per row; spans as kind:start:end, comma-joined."""
    found = written(findings(docs, id_col, text_col), "findings")
    net = fit(found)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, cand = batch.column("base").to_pylist(), batch.column("cand").to_pylist()
        windows = [c["window"] for row in cand for c in row]
        score = net.scores(windows) if net else np.zeros(len(windows))
        out, at = [], 0
        for spans, own in zip(base, cand, strict=True):
            spans = [(s["start"], s["kind"], s["end"]) for s in spans]
            more = [(c["start"], 3, c["end"]) for c, p in zip(own, score[at : at + len(own)], strict=True) if net and p >= net.threshold and not c["secret"]]
            at += len(own)
            said = [",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in part) for part in (spans, sorted(spans + more))]
            out.append([*(sum(k == x for _, k, _ in spans) for x in range(3)), len(more), hashlib.sha256(said[0].encode()).hexdigest(), said[1]])
        cols = list(zip(*out, strict=True)) or [[]] * 6
        return pa.record_batch(
            [batch.column("id"), *(pa.array(c, pa.int64()) for c in cols[:4]), *(pa.array(c, pa.string()) for c in cols[4:])],
            names=["id", "n_assign", "n_access", "n_hex", "n_cnn", "base_sha256", "spans"],
        )

    kind = docs.schema[id_col].dataType.simpleString()
    return mapped(found, each, f"id {kind}, n_assign long, n_access long, n_hex long, n_cnn long, base_sha256 string, spans string", text=None)
