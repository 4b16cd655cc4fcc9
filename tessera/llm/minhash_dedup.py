"""Near-duplicate documents by b-bit MinHash: bands for candidates, packed low bits for an estimate, full sets to confirm.

One pass over the texts makes, for each document, the digest of its shingle set, `PERMUTATIONS` minima, the
band keys (hashes of ROWS minima each) and a signature of the low 2 bits of the minima, packed into longs.
Documents with equal sets are one class from there on, under a number of its own, so copies are never paired.  In each band bucket the
member that shares most buckets is the leader; every other member is compared with it.  After components
are found over confirmed links, only members of one bucket that are still in different components are
compared, so a large group that has grown together costs nothing more.

Estimate: with 2 bits, unrelated minima agree in a quarter of the places, so J ~ (m - 1/4) / (3/4) for the
share m of agreeing places, counted by xor and bit_count.  Pairs below threshold - MARGIN (over four
standard deviations) are dropped; the rest are confirmed on the full sets of 64-bit shingle hashes.

In large buckets a bound that needs no estimate comes first: shingles that no other document of any large
bucket holds cannot be shared, so with u such shingles |x & y| <= min(|x| - ux, |y| - uy).  The members left are
dealt to blocks of BLOCK, and each pair of blocks is a group: the first pass over the groups tells which members
have a likely partner there by sizes and signatures, the second gets only those members' sets and reports a spanning
forest of the links, so neither one task nor the rows grow with the square of a bucket.

Chance of missing a link of similarity 0.85 in all bands: (1 - 0.85^5)^24, under 1e-6; at 0.8, 8e-5.

Defined results: one row per row.  Null, empty and blank texts have no shingles and are linked with nothing; texts of
fewer than five words are one shingle; rows with a null id are linked with nothing and have a null component; repeated
ids with equal sets are alike, with different sets they are documents of their own; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Words, components, lists, mapped, mix, written

PERMUTATIONS = 128
BANDS = 24
ROWS = 5
LOW_BITS = 2
LONGS = PERMUTATIONS * LOW_BITS // 64
MARGIN = 0.16
LARGE = 64  # members from which a bucket's unshared shingles are counted first
MOST_SENT = 16 << 20  # bytes of ids and digests that are sent to every executor
BLOCK = 512  # members of a large bucket in a block
_SEED = 20240501
_PAIRS_OF_BITS = 0x5555555555555555


def _family() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(_SEED)
    return r.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1), r.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def minima(grams: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(documents with shingles, PERMUTATIONS) minima of the permuted hashes; off: offsets without empty ranges."""
    a, b = _family()
    out = np.empty((len(off) - 1, PERMUTATIONS), np.uint64)
    for k in range(PERMUTATIONS):
        out[:, k] = np.minimum.reduceat(grams * a[k] + b[k], off[:-1])
    return out


def packed(mins: np.ndarray) -> np.ndarray:
    """The low bits of each minimum (after mixing), 32 to a long."""
    low = (mix(mins) & np.uint64((1 << LOW_BITS) - 1)).reshape(len(mins), LONGS, 64 // LOW_BITS)
    return np.bitwise_or.reduce(low << (np.arange(64 // LOW_BITS, dtype=np.uint64) * np.uint64(LOW_BITS)), axis=2)


def band_keys(mins: np.ndarray) -> np.ndarray:
    parts = mins[:, : BANDS * ROWS].reshape(len(mins), BANDS, ROWS)
    key = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), parts.shape[:2]).copy()
    for r in range(ROWS):
        key = mix(key * np.uint64(0x9FB21C651E98DF25) + parts[:, :, r])
    return key


def distinct_sets(words: Words) -> list[np.ndarray]:
    grams, off = words.grams()
    return [np.unique(grams[off[i] : off[i + 1]]) for i in range(len(off) - 1)]


def digests(sets: list[np.ndarray]) -> np.ndarray:
    return np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), np.int64).reshape(-1, 2)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, t, n, d0, d1, sig[], bands[]) per row; t: a hash of the text, n: distinct shingles, d0 and d1: the set's digest."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = distinct_sets(Words(batch.column("text")))
        n, digest = np.array([len(s) for s in sets], np.int64), digests(sets)
        full = np.flatnonzero(n)
        sig, keys = np.zeros((len(full), LONGS), np.uint64), np.zeros((len(full), BANDS), np.uint64)
        if len(full):
            mins = minima(np.concatenate(sets), np.concatenate([[0], np.cumsum(n[full])]))
            sig, keys = packed(mins), band_keys(mins)
        has = (n > 0).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(has)])
        return pa.record_batch(
            [batch.column("id"), batch.column("t"), pa.array(n), pa.array(digest[:, 0]), pa.array(digest[:, 1]), lists(sig.ravel().view(np.int64), offsets * LONGS, pa.int64()), lists(keys.ravel().view(np.int64), offsets * BANDS, pa.int64())],
            names=["id", "t", "n", "d0", "d1", "sig", "bands"],
        )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.selectExpr(f"`{id_col}` AS id", f"xxhash64(`{text_col}`) AS t", f"`{text_col}` AS text")
    return mapped(rows, each, f"id {kind}, t long, n long, d0 long, d1 long, sig array<long>, bands array<long>")


def _alike(x: str, y: str, threshold: float) -> str:
    """SQL: the estimate from two signatures reaches threshold - MARGIN."""
    differ = []
    for k in range(LONGS):
        bits = f"({x}.s{k} ^ {y}.s{k})"
        differ.append(f"bit_count(({bits} | shiftrightunsigned({bits}, 1)) & {_PAIRS_OF_BITS}L)")
    low = 1 / (1 << LOW_BITS)
    most = PERMUTATIONS * (1 - (low + (1 - low) * (threshold - MARGIN)))
    return f"{' + '.join(differ)} <= {most!r}D"


def _sized(x: str, y: str, percent: int) -> str:
    return f"100 * {x}.n >= {percent} * {y}.n AND 100 * {y}.n >= {percent} * {x}.n"


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union, from sets (id, grams)."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, y = batch.column("x"), batch.column("y")
        keep = []
        for k in range(batch.num_rows):
            p, q = x[k].values.to_numpy(), y[k].values.to_numpy()
            both = len(np.intersect1d(p, q, assume_unique=True))
            keep.append(100 * both >= percent * (len(p) + len(q) - both))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("grams").alias("y")), "b")
    return mapped(both.select("a", "b", "x", "y"), each, "a long, b long", text=None)


def shingle_sets(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, grams): the distinct shingle hashes of the classes (id, rep, d0, d1), from the document `rep` of each."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = distinct_sets(Words(batch.column("text")))
        found, want = digests(sets), np.stack([batch.column(c).to_numpy() for c in ("d0", "d1")], 1)
        own = np.flatnonzero((found == want).all(1))  # not so for other texts of a repeated id
        sets = [sets[i] for i in own]
        off = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)])
        grams = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
        return pa.record_batch([batch.column("id").take(pa.array(own)), lists(grams, off, pa.int64())], names=["id", "grams"])

    size = classes.agg(F.coalesce(F.sum(F.octet_length(F.col("rep").cast("string")) + 24), F.lit(0)).alias("n")).first().n
    rows = docs.selectExpr(f"`{id_col}` AS rep", f"`{text_col}` AS text")
    wanted = classes.select("id", "rep", "d0", "d1")
    if size <= MOST_SENT:  # the texts stay where they are read; beyond that they are shuffled by id
        wanted = F.broadcast(wanted)
    rows = rows.join(wanted, "rep")
    return mapped(rows.select("id", "d0", "d1", "text"), each, "id long, grams array<long>").dropDuplicates(["id"])


def labelled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """(id, t, n, component, root) per row; root: a number of the component, null where nothing can be linked; links need 100 * intersection >= percent * union."""
    threshold = percent / 100
    sigs = written(signatures(docs, id_col, text_col), "signatures")
    classes = sigs.filter("n > 0 AND id IS NOT NULL").groupBy("d0", "d1").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    classes = classes.select(F.monotonically_increasing_id().alias("id"), "d0", "d1", "rep", "n", *[F.col("sig")[k].alias(f"s{k}") for k in range(LONGS)], "bands")
    classes = written(classes, "classes")  # the numbers are fixed from here on
    light = classes.drop("bands")
    every = classes.select("id", F.explode("bands").alias("key"))
    buckets = written(every.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1"), "buckets")
    members = written(every.join(buckets, "key"), "members")
    # the leader of a bucket: the member that shares most buckets with others
    degree = members.groupBy("id").agg(F.sum("members").alias("degree"), F.max("members").alias("largest"))
    known = written(light.join(degree, "id"), "known")
    ranked = members.join(known.select("id", "degree"), "id")
    leaders = written(ranked.groupBy("key").agg(F.max_by("id", F.struct("degree", "id")).alias("leader")), "leaders")
    stars = members.join(leaders, "key").filter("id <> leader").select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct()
    stars = _likely(stars, known, percent, threshold)
    sets = written(shingle_sets(docs, known, id_col, text_col), "sets")
    links = written(confirmed(stars, sets, percent), "links")
    found = components(links)
    found = components(links.unionByName(_across(members, known, found, leaders, sets, percent, threshold)))
    least = written(classes.select("id", "rep").join(found, "id").groupBy("component").agg(F.min("rep").alias("least")), "least")
    roots = written(found.join(least, "component"), "roots")
    of_class = classes.select("id", "d0", "d1", "rep").join(roots, "id", "left")
    of_class = of_class.select("d0", "d1", F.coalesce("component", "id").alias("root"), F.coalesce("least", "rep").alias("component"))
    out = sigs.select("id", "t", "n", "d0", "d1").join(written(of_class, "classes"), ["d0", "d1"], "left")
    named = F.col("id").isNotNull()
    return out.select("id", "t", "n", F.when(named, F.coalesce("component", "id")).alias("component"), F.when(named, F.col("root")).alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row."""
    out = labelled(docs, id_col, text_col, percent)
    return out.select("id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """The first document of each component, once, with all columns; rows without an id stay."""
    first = labelled(docs, id_col, text_col, percent).filter("id = component")
    first = first.groupBy("id", F.coalesce("root", "t").alias("root")).agg(F.min("t").alias("t"))
    first = written(first.select(F.col("id").alias("kept_id"), F.col("t").alias("kept_t")).distinct(), "kept")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("join_id"), F.xxhash64(f"`{text_col}`").alias("join_t"))
    got = rows.join(first, F.expr("join_id = kept_id AND join_t = kept_t"), "left_semi").dropDuplicates(["join_id", "join_t"])
    return got.unionByName(rows.filter("join_id IS NULL")).select("row.*")


def _likely(pairs: DataFrame, known: DataFrame, percent: int, threshold: float) -> DataFrame:
    """Pairs whose sizes and signatures allow a link."""
    a, b = known.alias("p"), known.alias("q")
    out = pairs.join(a, F.col("a") == F.col("p.id")).join(b, (F.col("b") == F.col("q.id")) & F.expr(_sized("p", "q", percent)) & F.expr(_alike("p", "q", threshold)))
    return out.select("a", "b")


def _across(members: DataFrame, known: DataFrame, found: DataFrame, leaders: DataFrame, sets: DataFrame, percent: int, threshold: float) -> DataFrame:
    """Links within a bucket between different components; pairs with a leader have been tried.

    Pairs of small buckets are confirmed like the leaders' pairs.  Those of large buckets are confirmed where they are
    formed, so that a large group whose members are nearly but not quite linked makes no rows for its pairs.
    """
    label = known.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    rows = members.join(label, "id")
    mixed = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    mixed = written(mixed.select("key").join(leaders, "key"), "mixed")
    rows = written(rows.join(mixed, "key").filter("id <> leader").drop("leader", "degree", "largest"), "mixed")
    p, q = rows.filter(F.col("members") < LARGE).alias("p"), rows.filter(F.col("members") < LARGE).alias("q")
    likely = F.expr("p.key = q.key AND p.id < q.id AND p.component <> q.component") & F.expr(_sized("p", "q", percent)) & F.expr(_alike("p", "q", threshold))
    ends = F.col("p.id").alias("a"), F.col("q.id").alias("b")
    small = confirmed(p.join(q, likely).select(*ends).distinct(), sets, percent)
    large = rows.filter(F.col("members") >= LARGE)
    spare = _unshared(sets, large.select("id").distinct())
    able = large.join(spare, "id", "left").withColumn("spare", F.coalesce("spare", F.lit(0).cast("long"))).filter(f"100 * (n - spare) >= {percent} * n")
    return written(small.unionByName(_blocked(written(able, "able"), sets, percent, threshold)), "links")


def _blocked(able: DataFrame, sets: DataFrame, percent: int, threshold: float) -> DataFrame:
    """A spanning forest (a, b) of the links within the buckets of `able`, block by block, between different components."""
    sized = able.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    rows = able.join(written(sized, "blocks"), "key").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")))
    pair = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: F.struct(F.least("own", j).alias("i"), F.greatest("own", j).alias("j")))
    rows = rows.select("key", F.explode(pair).alias("pair"), "own", "id", "n", "spare", "component", *[f"s{k}" for k in range(LONGS)])
    low = 1 / (1 << LOW_BITS)
    most = PERMUTATIONS * (1 - (low + (1 - low) * (threshold - MARGIN)))

    def likely(part: pa.Table) -> np.ndarray:
        """(member, member): may be linked, are of different components, and are of different blocks where the pair of blocks has two."""
        n, spare, component, own = (part[c].to_numpy() for c in ("n", "spare", "component", "own"))
        sig = np.stack([part[f"s{k}"].to_numpy() for k in range(LONGS)], 1).view(np.uint64)
        both = np.minimum((n - spare)[:, None], (n - spare)[None])
        able = (100 * both >= percent * (n[:, None] + n[None] - both)) & (component[:, None] != component[None])
        able &= (own[:, None] != own[None]) | (own.min() == own.max())
        differ = np.zeros(able.shape, np.uint16)
        for k in range(LONGS):
            bits = sig[:, k, None] ^ sig[None, :, k]
            differ += np.bitwise_count((bits | (bits >> np.uint64(1))) & np.uint64(_PAIRS_OF_BITS))
        return able & (differ <= most)

    def tried(part: pa.Table) -> pa.Table:
        return part.filter(pa.array(likely(part).any(1)))

    def linked(part: pa.Table) -> pa.Table:
        pairs, ids, component = likely(part), part["id"].to_numpy(), part["component"].to_numpy()
        grams = part["grams"].combine_chunks()
        n = pc.list_value_length(grams).to_numpy()
        code = np.unique(grams.flatten().to_numpy(), return_inverse=True)[1]
        start, size = np.cumsum(n) - n, np.zeros(int(code.max(initial=-1)) + 1, bool)
        root: dict[int, int] = {}

        def find(v: int) -> int:
            while root.setdefault(v, v) != v:
                root[v] = root[root[v]]
                v = root[v]
            return v

        out = []
        for x in np.flatnonzero(pairs.any(1)):
            own = code[start[x] : start[x] + n[x]]
            size[own] = True
            both = np.add.reduceat(size[code], start, dtype=np.int64)
            size[own] = False
            for y in np.flatnonzero(pairs[x] & (100 * both >= percent * (n[x] + n - both))):
                p, q = find(int(component[x])), find(int(component[y]))
                if p != q:
                    root[p] = q
                    out.append((ids[x], ids[y]))
        a, b = np.array(out, np.int64).reshape(-1, 2).T
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    near = written(rows.groupBy("key", "pair").applyInArrow(tried, rows.schema), "near")
    return near.join(sets, "id").groupBy("key", "pair").applyInArrow(linked, "a long, b long").distinct()


def _unshared(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, spare): how many of a document's shingles no other document of `ids` holds."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        # counted before the shuffle: a shingle gives one row for all of its holders in the batch
        grams = batch.column("grams")
        gram, first, holders = np.unique(grams.flatten().to_numpy(), return_index=True, return_counts=True)
        owner = batch.column("id").take(pc.list_parent_indices(grams).take(pa.array(first)))
        return pa.record_batch([owner, pa.array(gram, pa.int64()), pa.array(holders, pa.int64())], names=["id", "gram", "holders"])

    grams = mapped(sets.join(ids, "id", "left_semi").select("id", "grams"), each, "id long, gram long, holders long", text=None)
    alone = grams.groupBy("gram").agg(F.min("id").alias("id"), F.sum("holders").alias("holders")).filter("holders = 1")
    return alone.groupBy("id").agg(F.count("*").alias("spare"))
