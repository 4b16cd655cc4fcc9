"""Cross-tokenizer alignment by an event sweep over token ends.

Each text is encoded by A (space and text, byte-level BPE) and by B (text, sentencepiece, which adds the space).  Tokens
become events, packed by side and by WINDOW bytes of the text into rows (document, window, side, ids): a token belongs to the
window that holds its end, and ends follow from the ids, for a token's bytes are fixed.  The events of both sides are united, dealt
by document and sorted by (document, window, side); a state machine reads the stream.  It keeps what lies after
the last common end, the digest of the groups, the counts, and the document's distinct id pairs.  Two tokens overlap in at most
one stretch between neighbouring ends of either side, so the united ends of a group list its links one by one.

How many documents hold an id pair is counted from arrays of distinct pairs, one for each slab of documents and bucket of A ids, summed
where they are made; a bucket's table is at most its A ids times the ids of B.  The tables then meet the same slabs, sorted before them in
SALTS parts of each bucket, and give n_best and count_sum; nothing is broadcast.

Texts are encoded by segments: a single space between two characters that are no white space starts a token in A's pattern, and no
piece of B holds a space behind another character (checked when the file is read), so segments encode alone as they do in
the text.  Encoded segments are kept in a bounded dictionary of the worker.

Defined results: a null or empty text, or one whose joined tokens differ from space and text in bytes, has no tokens: zeros and an
empty groups_sha256; repeated rows are documents of their own (rows are told apart by their place in the input, which
has to be a stored table for that); ties for the best count all count; other columns play no part; a long text takes
the memory of its distinct pairs and one window.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_slices, written

WINDOW = 1 << 14  # bytes of text in a row of events
SLAB = 1 << 19  # links after which a slab of documents is handed on
BUCKETS = 32  # of A ids
SALTS = 8
CACHED = 1 << 18  # segments a worker remembers
SAFE = re.compile(r"(?<=\S) (?=\S)")
PLAIN = 0x250  # below it the white space, letters and digits of all Unicode versions in use agree
BEYOND_PLAIN = re.compile(f"[^\\x00-{chr(PLAIN - 1)}]")


# ---------------------------------------------------------------- tokenizers


def byte_values() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable Latin-1 for themselves, the others from U+0100 on in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


def ranked(path: str):
    """The same vocabulary for the faster library, where its file of ranks stands beside it; used for characters below PLAIN only."""
    ranks = path.removesuffix(".json") + ".tiktoken"
    if path.endswith(".model") or not os.path.exists(ranks):
        return None
    import tiktoken

    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value: the vocabulary's pattern
    with open(ranks, "rb") as f:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})


class Side:
    """A tokenizer with the bytes of its ids: .json for the tokenizers library, .model for sentencepiece."""

    def __init__(self, path: str):
        self.model = path.endswith(".model")
        if self.model:
            import sentencepiece

            self.library = sentencepiece.SentencePieceProcessor(model_file=path)
            pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
            self.entries = [bytes([int(p[3:-1], 16)]) if self.library.is_byte(i) else b"" if self.library.is_control(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
            self.splits = not any("▁" in p.lstrip("▁") for p in pieces)
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(path)
            self.library.no_truncation()
            self.library.no_padding()
            self.library.encode_special_tokens = True
            values, vocabulary = byte_values(), self.library.get_vocab(with_added_tokens=True)
            special = {t.content for t in self.library.get_added_tokens_decoder().values()}
            self.entries = [b""] * (max(vocabulary.values()) + 1)
            for entry, i in vocabulary.items():
                self.entries[i] = entry.encode() if entry in special else bytes(values[c] for c in entry)
            self.splits = True
        self.fast = ranked(path)
        self.size = np.array([len(e) for e in self.entries], np.int64)

    def ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts without special tokens; for A a space is put before each."""
        if self.model:
            return self.library.encode(texts, num_threads=1)
        return [e.ids for e in self.library.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    def packed(self, texts: list[str], apart: bool = False) -> list[bytes | None]:
        """Ids of texts as 16-bit numbers; None where their bytes differ from space and text.

        apart: the texts have no white space at their ends, so one text of them all has the same tokens.
        """
        if not texts:
            return []
        joined = " " + " ".join(texts)
        if apart and self.fast is not None and not BEYOND_PLAIN.search(joined):
            flat = self.fast.encode_ordinary(joined)
            lengths = None
        else:
            each = self.ids(texts)
            flat, lengths = list(itertools.chain.from_iterable(each)), np.fromiter(map(len, each), np.int64, len(each))
        numbers = np.array(flat, np.uint16)
        size = np.fromiter((len(t.encode()) for t in texts), np.int64, len(texts)) + 1
        ends, due = np.concatenate([[0], np.cumsum(self.size[numbers])]), np.cumsum(size)
        cuts = np.searchsorted(ends, due) if lengths is None else np.cumsum(lengths)
        same = b"".join(map(self.entries.__getitem__, flat)) == joined.encode() and (ends[cuts] == due).all()
        if same:
            data, cuts = numbers.tobytes(), (2 * cuts).tolist()
            return [data[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]
        if len(texts) > 1:  # some text of them differs
            half = len(texts) // 2
            return self.packed(texts[:half], apart) + self.packed(texts[half:], apart)
        return [None]


class Pair:
    """Both tokenizers, with a dictionary of segments: their ids on both sides, None where bytes differ, False where white space stands at an end."""

    def __init__(self, path_a: str, path_b: str):
        self.sides = Side(path_a), Side(path_b)
        self.sizes = tuple(s.size for s in self.sides)
        self.splits = all(s.splits for s in self.sides)
        self.cache: dict[str, tuple[bytes, bytes] | bool | None] = {}

    def both(self, segments: list[str], apart: bool = False) -> list[tuple[bytes, bytes] | None]:
        return [None if a is None or b is None else (a, b) for a, b in zip(*(s.packed(segments, apart) for s in self.sides), strict=True)]

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """The ids of texts on both sides, or None where they do not give back a text's bytes; what segments of all texts are new is encoded at once."""
        if not self.splits:
            return self.both(texts)
        cut = [text.split(" ") for text in texts]
        if len(self.cache) > CACHED:
            self.cache.clear()
        known = self.cache
        new = list(set().union(*cut) - known.keys())
        fit = [s for s in new if s and not s[0].isspace() and not s[-1].isspace()]
        known.update(dict.fromkeys(new, False))
        known.update(zip(fit, self.both(fit, True), strict=True))
        out = []
        for text, parts in zip(texts, cut, strict=True):
            found = [known[s] for s in parts]
            if False in found:
                found = self.both(SAFE.split(text))
            out.append(None if None in found else tuple(map(b"".join, zip(*found, strict=True))))
        return out


@functools.cache
def pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


# ---------------------------------------------------------------- events


def events(docs: DataFrame, path_a: str, path_b: str, window: int = WINDOW) -> DataFrame:
    """Rows (doc, id, part, side, ids): the tokens of a side whose ends are in a window, 16 bits each; a document without tokens has one row with side -1."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(path_a, path_b)
        row = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        for whole in batches:
            for batch in text_slices(whole, "text", 1 << 21):
                texts = pc.fill_null(batch.column("text"), "")
                lengths = pc.add(pc.binary_length(texts), 1).to_pylist()
                found = both.encode(texts.to_pylist())
                doc, at, part, of, ids = [], [], [], [], []

                def put(n: int, w: int, which: int, packed: bytes, doc=doc, at=at, part=part, of=of, ids=ids, row=row) -> None:
                    doc.append(row + n), at.append(n), part.append(w), of.append(which), ids.append(packed)

                for n, (length, encoded) in enumerate(zip(lengths, found, strict=True)):
                    if length == 1 or encoded is None:
                        put(n, 0, -1, b"")
                        continue
                    for which, packed in enumerate(encoded):
                        if length <= window:
                            put(n, 0, which, packed)
                            continue
                        e = np.frombuffer(packed, np.uint16)
                        home = (np.cumsum(both.sizes[which][e]) - 1) // window
                        cuts = np.flatnonzero(np.diff(home)) + 1
                        for piece, w in zip(np.split(e, cuts), home[np.concatenate([[0], cuts])].tolist(), strict=True):
                            put(n, w, which, piece.tobytes())
                row += batch.num_rows
                yield pa.record_batch([pa.array(doc, pa.int64()), batch.column("id").take(pa.array(at, pa.int32())), pa.array(part, pa.int32()), pa.array(of, pa.int8()), pa.array(ids, pa.binary())], names=["doc", "id", "part", "side", "ids"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(each, f"doc long, id {kind}, part int, side tinyint, ids binary")


# ---------------------------------------------------------------- the sweep


class Decimals:
    """The decimal digits of numbers below 65,536 as bytes, to write many of them at once."""

    def __init__(self) -> None:
        n = np.arange(1 << 16)
        self.width = 1 + sum((n >= 10**k).astype(np.int64) for k in range(1, 5))
        self.digits = np.zeros((1 << 16, 6), np.uint8)
        for k in range(5):
            place = self.width - 1 - k
            fits = place >= 0
            self.digits[n[fits], k] = 48 + n[fits] // 10 ** place[fits] % 10

    def joined(self, ids: np.ndarray, after: np.ndarray) -> bytes:
        """Each id followed by its separator."""
        out, width = self.digits[ids], self.width[ids]
        out[np.arange(len(ids)), width] = after
        return out[np.arange(6) <= width[:, None]].tobytes()


@functools.cache
def decimals() -> Decimals:
    return Decimals()


class Sweep:
    """One document's events as they stream by; `open` holds, by side, ids and ends after the last common end."""

    def __init__(self, doc: int, ident, sizes: tuple[np.ndarray, np.ndarray]):
        self.doc, self.ident, self.sizes = doc, ident, sizes
        self.open = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(2)]
        self.end = [0, 0]
        self.n, self.groups, self.n_links = [0, 0], 0, 0
        self.digest = hashlib.sha256()
        self.pairs, self.times = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.fresh: list[np.ndarray] = []

    def add(self, of: int, ids: bytes) -> None:
        e = np.frombuffer(ids, np.uint16).astype(np.int64)
        ends = self.end[of] + np.cumsum(self.sizes[of][e])
        self.end[of] = int(ends[-1])
        self.n[of] += len(e)
        self.open[of] = (np.concatenate([self.open[of][0], e]), np.concatenate([self.open[of][1], ends]))

    def settle(self) -> None:
        """Write out the groups up to the last common end, when both sides of a window are there."""
        (a, a_end), (b, b_end) = self.open
        both = np.concatenate([a_end, b_end])
        order = np.argsort(both, kind="stable")  # merges two runs
        ends = both[order]
        new = np.ones(len(ends), bool)
        new[1:] = ends[1:] != ends[:-1]
        if new.all():
            return
        place = np.empty(len(ends), np.int64)  # of each token's end among the united ends
        place[order] = np.cumsum(new) - 1
        of_a, of_b = np.zeros(int(place.max()) + 1, bool), np.zeros(int(place.max()) + 1, bool)
        of_a[place[: len(a)]] = of_b[place[len(a) :]] = True
        common = np.flatnonzero(of_a & of_b)
        m = int(common[-1]) + 1
        upto_a, upto_b = np.cumsum(of_a[:m]), np.cumsum(of_b[:m])
        na, nb = int(upto_a[-1]), int(upto_b[-1])
        place_a, place_b = place[:na], place[len(a) : len(a) + nb]
        self.open = [(a[na:], a_end[na:]), (b[nb:], b_end[nb:])]
        a, b = a[:na], b[:nb]
        is_end = (of_a & of_b)[:m]
        group = np.cumsum(is_end) - is_end
        ends_a, ends_b = upto_a[common], upto_b[common]  # tokens up to each group's end
        text = np.empty(na + nb, np.int64)
        text[np.arange(na) + np.concatenate([[0], ends_b])[group[place_a]]] = a  # B's tokens of earlier groups stand before
        text[np.arange(nb) + ends_a[group[place_b]]] = b
        after = np.full(na + nb, ord(","), np.uint8)
        after[ends_a - 1 + np.concatenate([[0], ends_b[:-1]])] = ord("|")
        after[ends_a + ends_b - 1] = ord(";")
        written_out = decimals().joined(text, after)[:-1]
        self.digest.update(b";" + written_out if self.groups else written_out)
        self.groups += len(common)
        self.fresh.append((a[upto_a - of_a[:m]] << 16 | b[upto_b - of_b[:m]]).astype(np.uint32))
        self.n_links += m

    def merge(self) -> None:
        """Distinct pairs of the document, with how often each is linked."""
        fresh = np.sort(np.concatenate([np.zeros(0, np.uint32), *self.fresh]))
        starts = np.flatnonzero(np.concatenate([np.ones(min(len(fresh), 1), bool), fresh[1:] != fresh[:-1]]))
        pairs, times = fresh[starts], np.diff(np.append(starts, len(fresh)))
        if len(self.pairs):
            all_pairs, at = np.unique(np.concatenate([self.pairs, pairs]), return_inverse=True)
            pairs, times = all_pairs, np.bincount(at, np.concatenate([self.times, times]), len(all_pairs)).astype(np.int64)
        self.pairs, self.times, self.fresh = pairs, times, []


def buckets_of(pairs: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket by the A id, spread by a multiplier, so that neighbouring common ids part."""
    return ((pairs >> np.uint32(16)).astype(np.uint64) * np.uint64(2654435761) >> np.uint64(7)) % np.uint64(buckets)


SLAB_COLUMNS = [("bucket", pa.int32()), ("pairs", pa.binary()), ("holders", pa.binary()), ("docs", pa.binary()), ("links", pa.binary()), ("of", pa.binary()), ("times", pa.binary())]


def slab_rows(done: list[Sweep], buckets: int) -> list[tuple]:
    """Of some documents, for each bucket in use: the values of SLAB_COLUMNS."""
    docs = np.array([s.doc for s in done], np.int64)
    pairs, times = np.concatenate([s.pairs for s in done]), np.concatenate([s.times for s in done])
    owner = np.repeat(np.arange(len(done)), [len(s.pairs) for s in done])
    where = buckets_of(pairs, buckets).astype(np.int64)
    order = np.argsort(where, kind="stable")
    bounds = np.searchsorted(where[order], np.arange(buckets + 1))
    out = []
    for k in range(buckets):
        own = order[bounds[k] : bounds[k + 1]]
        if len(own):
            distinct, of, holders = np.unique(pairs[own], return_inverse=True, return_counts=True)
            here, links = np.unique(owner[own], return_counts=True)
            out.append((k, distinct.tobytes(), holders.astype(np.int64).tobytes(), docs[here].tobytes(), links.astype(np.int32).tobytes(), of.astype(np.int32).tobytes(), times[own].astype(np.int32).tobytes()))
    return out


def swept(found: DataFrame, path_a: str, path_b: str, buckets: int = BUCKETS, slab: int = SLAB) -> DataFrame:
    """The stream's output, of two kinds: a row for each document (bucket null), and rows of SLAB_COLUMNS for each slab and bucket.

    Of the second kind: pairs and holders (distinct pairs of the slab and in how many of its documents they are), and by document, in
    places, docs, links (its distinct pairs in the bucket) and of and times (each link's place in pairs, and how often it is linked).
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = pair(path_a, path_b).sizes
        at, part, done, held, schema = None, None, [], 0, None

        def finish(sweep: Sweep) -> tuple:
            sweep.settle()
            sweep.merge()
            if len(sweep.pairs):
                done.append(sweep)
            return sweep.doc, sweep.ident, *sweep.n, sweep.groups, sweep.n_links, sweep.digest.hexdigest() if sweep.groups else ""

        def batch_of(rows: list[tuple], first: int) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.record_batch([pa.array(columns[n - first], f.type) if 0 <= n - first < len(columns) else pa.nulls(len(rows), f.type) for n, f in enumerate(schema)], schema=schema)

        for batch in batches:
            schema = schema or pa.schema([("doc", pa.int64()), ("id", batch.schema.field("id").type), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", pa.string()), *SLAB_COLUMNS])
            rows = []
            for doc, ident, window, of, ids in zip(*[batch.column(c).to_pylist() for c in ("doc", "id", "part", "side", "ids")], strict=True):
                if at is None or doc != at.doc:
                    if at is not None:
                        rows.append(finish(at))
                        held += len(at.pairs)
                        if held > slab:
                            yield batch_of(slab_rows(done, buckets), 7)
                            held = 0
                            done.clear()
                    at = Sweep(doc, ident, sizes)
                elif window != part:
                    at.settle()
                    if sum(map(len, at.fresh)) > slab:
                        at.merge()
                part = window
                if of >= 0:
                    at.add(of, ids)
            if rows:
                yield batch_of(rows, 0)
        if at is not None:
            yield batch_of([finish(at)], 0)
        if done:
            yield batch_of(slab_rows(done, buckets), 7)

    kind = found.schema["id"].dataType.simpleString()
    kinds = f"doc long, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, bucket int, pairs binary, holders binary, docs binary, links binary, of binary, times binary"
    return found.repartition("doc").sortWithinPartitions("doc", "part", "side").mapInArrow(each, kinds)


# ---------------------------------------------------------------- corpus-wide counts


def merged(tables: DataFrame, keys: list[str], most: int = 1 << 21) -> DataFrame:
    """(keys, pairs, holders) with the holders of equal pairs summed for each key; rows stream by sorted by key, and are merged in runs of `most` pairs."""

    def total(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        pairs, at = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
        out = np.zeros(len(pairs), np.int64)
        np.add.at(out, at, np.concatenate([n for _, n in parts]))
        return pairs, out

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, held = None, [], 0

        def handed() -> pa.RecordBatch:
            pairs, holders = total(parts)
            return pa.record_batch([*[pa.array([k], pa.int32()) for k in now], pa.array([pairs.tobytes()], pa.binary()), pa.array([holders.tobytes()], pa.binary())], names=[*keys, "pairs", "holders"])

        for batch in batches:
            for *key, pairs, holders in zip(*[batch.column(c) for c in (*keys, "pairs", "holders")], strict=True):
                key = [k.as_py() for k in key]
                if key != now:
                    if parts:
                        yield handed()
                    now, parts, held = key, [], 0
                parts.append((np.frombuffer(pairs.as_py(), np.uint32), np.frombuffer(holders.as_py(), np.int64)))
                held += len(parts[-1][0])
                if held > max(most, 2 * len(parts[0][0])):
                    parts = [total(parts)]
                    held = len(parts[0][0])
        if parts:
            yield handed()

    return tables.select(*keys, "pairs", "holders").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(each, ", ".join(f"{k} int" for k in keys) + ", pairs binary, holders binary")


def doc_counts(slabs: DataFrame, salts: int = SALTS) -> DataFrame:
    """(doc, n_best, count_sum) from the slabs.

    Holders are summed in `salts` parts of each bucket, then for the bucket; then a bucket's table comes before its slabs in each of
    its parts.  Best is the highest count of an A id, all of whose pairs are in one bucket.
    """
    none = F.lit(None).cast("binary")
    asked = slabs.select("bucket", F.pmod(F.xxhash64("docs"), F.lit(salts)).cast("int").alias("salt"), F.lit(1).alias("kind"), "pairs", "holders", "docs", "links", "of", "times")
    tables = merged(merged(asked, ["bucket", "salt"]), ["bucket"])
    given = tables.select("bucket", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"), "pairs", "holders", none.alias("docs"), none.alias("links"), none.alias("of"), none.alias("times"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, count, best = None, None, None
        for batch in batches:
            for row in (batch.slice(n, 1) for n in range(batch.num_rows)):
                get = lambda name, kind, row=row: np.frombuffer(row.column(name)[0].as_py(), kind)
                if row.column("kind")[0].as_py() == 0:
                    pairs, count = get("pairs", np.uint32), get("holders", np.int64)
                    a = pairs >> np.uint32(16)
                    starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
                    best = count == np.repeat(np.maximum.reduceat(count, starts), np.diff(np.append(starts, len(a))))
                    continue
                at = np.searchsorted(pairs, get("pairs", np.uint32))[get("of", np.int32)]
                times, links = get("times", np.int32).astype(np.int64), get("links", np.int32)
                starts = np.concatenate([[0], np.cumsum(links)[:-1]])
                yield pa.record_batch([pa.array(get("docs", np.int64)), pa.array(np.add.reduceat(times * best[at], starts)), pa.array(np.add.reduceat(times * count[at], starts))], names=["doc", "n_best", "count_sum"])

    rows = given.unionByName(asked.withColumn("holders", none)).repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "kind")
    return rows.mapInArrow(each, "doc long, n_best long, count_sum long").groupBy("doc").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, buckets: int = BUCKETS, slab: int = SLAB, salts: int = SALTS) -> DataFrame:
    """A row for each row of docs: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    found = events(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), path_a, path_b, window)
    done = written(swept(found, path_a, path_b, buckets, slab), "alignment")
    counts = doc_counts(done.filter("bucket IS NOT NULL"), salts)
    rows = done.filter("bucket IS NULL").select("doc", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(counts, "doc", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
