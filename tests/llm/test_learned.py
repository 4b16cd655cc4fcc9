import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import lm_scoring, toxicity
from tessera.llm.common import Words
from tessera.llm.queries import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
ODD = [(90001, None), (90002, ""), (90003, " \n\t"), (None, "some words"), (90004, "é" * 300), (90005, "same same"), (90005, "same same")]


def crc(i, by):
    return zlib.crc32(("" if i is None else str(i)).encode()) % by


def words(text):
    return bytes((text or "").encode()).lower().split()  # lowers A-Z and splits at space and 0x09-0x0D only


def test_language_model_base_matches_brute_force(spark):
    own = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    rows = [(i, t, 1, "clash", 2) for i, t in own + ODD]
    docs = spark.createDataFrame(rows, "doc_id long, text string, c int, word string, row int")
    got = lm_scoring.lm_scores(docs, PATH).collect()
    c = Counter()
    for i, t, *_ in rows:
        if crc(i, 7) != 2:
            c.update([*words(t), None])
    n, spread = sum(c.values()), sum(c.values()) + len(c) + 1
    want = {}
    for i, t, *_ in rows:
        tokens = [*words(t), None]
        want[i] = (crc(i, 7) == 2, len(tokens), sum(c[x] > 0 for x in tokens), n, sum(math.log10((c[x] + 1) / spread) for x in tokens))
    assert len(got) == len(rows)
    for g in got:
        held, k, known, train, base = want[g.id]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (held, k, known, train)
        assert math.isclose(g.base_score, base, rel_tol=1e-9, abs_tol=1e-9) and math.isfinite(g.score) and g.score < 0


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_language_model_beats_the_base_on_held_out_texts(spark, sf):
    """Where every word is known, on both sizes; on all held-out texts together where there is enough to learn from.

    The base gives every unseen word one count, which sums to more than one over all words, while the model pays for its spelling.
    """
    held = lm_scoring.lm_scores(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet"), PATH).filter("held_out").collect()
    known = [g for g in held if g.n_known == g.n_tokens]
    assert len(known) > 20 and sum(g.score for g in known) > sum(g.base_score for g in known)
    if sf == "sf0.1":
        assert sum(g.score > g.base_score for g in known) > 0.9 * len(known) > 100
        assert sum(g.score for g in held) > sum(g.base_score for g in held)


def test_language_model_of_empty_table(spark):
    assert lm_scoring.lm_scores(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_windows_score_each_position_once():
    lens = np.array([1, 15, 16, 17, 100])
    at, _ = lm_scoring.windows(lens, np.cumsum(lens) - lens)
    scored = at[:, lm_scoring.HALF :]
    assert sorted(scored[scored >= 0].tolist()) == list(range(lens.sum()))


def test_nearest_examples_are_exact():
    r = np.random.default_rng(5)
    terms = np.arange(40)
    tfs = []
    for _ in range(700):
        places = np.sort(r.choice(40, r.integers(1, 9), replace=False))
        tfs.append((places, r.integers(1, 5, len(places))))
    idf = r.uniform(0.5, 4, 40)
    index = toxicity.Index(terms.astype(np.uint64), idf)
    index.positive, index.count = np.zeros(700), np.ones(700)
    index.add(tfs)
    dense = np.zeros((700, 40))
    for k, tf in enumerate(tfs):
        dense[k, tf[0]] = index.vector(tf)
    for k in range(0, 700, 13):
        _, s = index.nearest([tfs[k]])[0]
        best = np.sort(dense @ dense[k])[::-1][: toxicity.K]
        assert np.allclose(np.sort(s)[::-1], best[: len(s)]) and (len(s) == toxicity.K or best[len(s)] < 1e-12)


def test_the_kth_best_is_sought_among_those_that_can_be_it(monkeypatch):
    r = np.random.default_rng(1)
    terms = np.arange(1, 401, dtype=np.uint64)
    tfs = [(np.sort(r.choice(400, 30, replace=False)), r.integers(1, 4, 30)) for _ in range(4000)]
    index = toxicity.Index(terms, np.ones(400))
    index.positive, index.count = np.zeros(4000), np.ones(4000)
    index.add(tfs)
    sizes, partition = [], np.partition
    monkeypatch.setattr(np, "partition", lambda a, k, **more: (sizes.append(a.size if a.ndim == 1 else 0), partition(a, k, **more))[1])
    found = index.nearest(tfs[:5])
    assert max(sizes) < 2000
    for tf, (e, s) in zip(tfs[:5], found, strict=True):
        every = np.array([sum(x * y for x, y in zip(index.vector(o)[np.isin(o[0], tf[0])], index.vector(tf)[np.isin(tf[0], o[0])], strict=True)) for o in tfs])
        best = np.lexsort((np.arange(4000), -np.round(every, 12)))[: toxicity.K]
        assert e.tolist() == best.tolist() and s == pytest.approx(every[best])


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    own = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in own + ODD], "doc_id long, text string, y int, key string")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(own) + len(ODD)
    assert all(0 <= g.score <= 1 and g.predicted == (g.score >= 0.5) and g.held_out == (crc(g.id, 5) == 0) for g in got)
    score = {g.id: g.score for g in got}
    assert score[90001] == score[90002] == score[90003]
    pairs = [(score[r.doc_id], r.toxic) for r in labels.collect() if r.toxic is not None and r.doc_id in score and crc(r.doc_id, 5) == 0]
    yes, no = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    rank = np.mean([(a > b) + (a == b) / 2 for a in yes for b in no])
    assert rank > 0.8, (rank, len(yes), len(no))


def test_toxicity_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (77, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.toxicity(docs, labels).collect()} == {0.25}
    assert toxicity.toxicity(docs.limit(0), labels.limit(0)).count() == 0


def test_terms_are_counted_per_document():
    terms = np.sort(Words(pa.array(["bad word"]), toxicity._SEPARATORS).hash)
    got = toxicity._tfs(Words(pa.array(["Bad, bad word!", None, "none"]), toxicity._SEPARATORS), terms)
    assert [int(c.sum()) for _, c in got] == [3, 0, 0]


def test_texts_without_telling_terms_are_compared_with_examples(spark):
    own = [(i, f"calm{i} quiet{i} plain{i % 9} words{i % 7}") for i in range(60)] + [(100 + i, f"harsh{i} bitter{i} sharp{i} plain{i}") for i in range(12)]
    docs = spark.createDataFrame([*own, (None, own[60][1])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in own], "doc_id long, toxic int")
    index = toxicity.fit(docs, labels)
    train = [(i, t) for i, t in own if crc(i, 5)]
    assert set(Words(pa.array([t for _, t in train]), toxicity._SEPARATORS).hash.tolist()) == set(index.terms.tolist())
    got = {r.id: r for r in toxicity.scores(docs, index).collect()}
    for i, _ in train:
        assert got[i].evidence.startswith(f"{i}:1.0000:{int(i >= 100)}/1")
    assert got[None].evidence == got[100].evidence or not crc(100, 5)


def test_language_model_counts_all_training_units(spark):
    texts = ["aa bb " * k + "zz%d qq" % k for k in range(120)] + ["", "w " * 48]
    docs = spark.createDataFrame([(i, i, t, i % 5 > 0) for i, t in enumerate(texts)], "row long, id long, text string, train boolean")
    own = [t for k, t in enumerate(texts) if k % 5 > 0]
    hashes = np.sort(Words(pa.array(["aa bb qq w"])).hash)
    units = lm_scoring.Units(hashes, np.arange(4), 4, len(lm_scoring.pieces(PATH)[1]), PATH)
    want = Counter({units.end: len(own)})
    for t in own:
        want.update(units.spell(Words(pa.array([t])))[0].tolist())
    table = lm_scoring.spelled_table(docs, units, hashes, np.array([5, 4, 3, 2]), 100.0, 10.0)
    n, _ = lm_scoring.describe(table.filter("train"), units)
    assert {int(u): int(n[u]) for u in np.flatnonzero(n)} == dict(want)


def test_spelling_is_the_tokenizers_own():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    units = lm_scoring.Units(np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, len(lm_scoring.pieces(PATH)[1]), PATH)
    text = "Plain words, ÉCLAIR über 日本語 don't x-y_z <|endoftext|> 12,345.67"
    u, n = units.spell(Words(pa.array([text])))
    want = [library.encode(" " + w.decode(), add_special_tokens=False).ids if w != b"<|endoftext|>" else None for w in words(text)]
    at = 0
    for k, ids in zip(n, want, strict=True):
        own = u[at : at + k]
        assert (own % 2).tolist() == [0] * (k - 1) + [1] and (ids is None or (own // 2).tolist() == ids)
        at += k
    assert units.word_ends(u).sum() == len(want) and not units.word_ends(np.array([units.end]))[0]


def small_model(n_units=60, seed=4):
    r = np.random.default_rng(seed)
    of = np.arange(n_units) % lm_scoring.CLASSES
    row = np.append(r.integers(0, lm_scoring.ROWS - 1, n_units), lm_scoring.ROWS - 1)
    share = r.uniform(1, 5, n_units)
    mass = np.bincount(of, share, lm_scoring.CLASSES)
    plain = r.uniform(1, 2, lm_scoring.CLASSES)
    params = lm_scoring.fresh(np.log(plain / plain.sum()))
    for n, x in params.items():
        params[n] = x + r.normal(0, 0.3, x.shape).astype(np.float32)
    return lm_scoring.Model(row, of, np.log10(share / mass[of]), plain / plain.sum(), params)


def plain_log10(model, seq, t):
    """log10 p of unit t of a sequence, in loops over the positions that its window holds."""
    p, half = model.params, lm_scoring.HALF
    start = t // half * half - half
    x = [p["x"][model.row[-1] if k == 0 else model.row[seq[k - 1]]].astype(float) for k in range(len(seq))]
    q = x[t] @ p["q"]
    logits = {k: q @ (x[k] @ p["k"]) * lm_scoring.DEPTH**-0.5 + p["near"][t % half, k - start] for k in range(max(start, 0), t + 1)}
    top = max(logits.values())
    weight = {k: math.exp(v - top) for k, v in logits.items()}
    h = sum(w * (x[k] @ p["v"]) for k, w in weight.items()) / sum(weight.values())
    z = h @ p["seen"] + x[t] @ p["last"] + p["bias"]
    z = np.exp(z - z.max())
    c = model.of[seq[t]]
    return math.log10((1 - lm_scoring.FLOOR) * z[c] / z.sum() + lm_scoring.FLOOR * model.share[c]) + model.log_share[seq[t]]


def test_attention_matches_plain_loops_and_sums_to_one():
    model, r = small_model(), np.random.default_rng(6)
    lens = np.array([1, 15, 16, 17, 50])
    u = r.integers(0, 60, lens.sum())
    got, _ = lm_scoring.score_units(model, u, lens)
    at = 0
    for n in lens:
        for t in range(n):
            assert math.isclose(got[at + t], plain_log10(model, u[at : at + n], t), rel_tol=1e-4, abs_tol=1e-5)
        at += n
    head = u[:40]
    total = sum(10 ** lm_scoring.score_units(model, np.append(head, k), np.array([41]))[0][-1] for k in range(60))
    assert abs(total - 1) < 1e-3


def test_gradients_match_differences():
    model, r = small_model(), np.random.default_rng(7)
    at, _ = lm_scoring.windows(np.array([40, 7]), np.array([0, 40]))
    rows = r.integers(0, lm_scoring.ROWS, 47)
    target = np.where(at[:, lm_scoring.HALF :] >= 0, r.integers(0, lm_scoring.CLASSES, (len(at), lm_scoring.HALF)), -1)
    p = {n: x.astype(np.float64) for n, x in model.params.items()}

    def loss(q):
        z, _, _ = lm_scoring.attend(q, lm_scoring.tables(q), rows[at], at < 0)
        i, j = np.nonzero(target >= 0)
        return -z[i, j, target[i, j]].mean()

    g = lm_scoring.gradients(p, rows[at], at < 0, target)
    for n in p:
        for _ in range(3):
            place = tuple(r.integers(0, d) for d in p[n].shape) if n != "x" else (rows[r.integers(47)], r.integers(lm_scoring.DEPTH))
            change = np.zeros_like(p[n])
            change[place] = 1e-4
            slope = (loss(p | {n: p[n] + change}) - loss(p | {n: p[n] - change})) / 2e-4
            assert math.isclose(slope, g[n][place], rel_tol=2e-2, abs_tol=2e-5), (n, slope, g[n][place])


def plain_terms(text):
    return Counter(re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))))


def test_toxicity_matches_brute_force(spark):
    """Terms, idf, cosines with every training text, votes and calibrated scores, all in plain Python but for the weights of telling terms."""
    sf = "/root/testdata/sf0.001"
    own = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    own += [(5000 + i, t) for i, t in enumerate(["idiot " * 3 + "x" * 50, own[3][1], own[3][1], "one", "İ ß É é", "never met before zzz", "the " * 120_000 + "idiot"])]
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.toxic is not None} | {5001: 1, 5002: 0, 5000: 1}
    docs = spark.createDataFrame(own, "doc_id long, text string")
    labels = spark.createDataFrame(list(label.items()), "doc_id long, toxic int")
    index = toxicity.fit(docs, labels)
    train = [(i, t, label[i]) for i, t in own if i in label and crc(i, 5)]
    df = Counter(w for t in {t for _, t, _ in train} for w in plain_terms(t))
    hashed = {w: int(Words(pa.array([w.decode()]), toxicity._SEPARATORS).hash[0]) for w in df}
    place = {h: k for k, h in enumerate(index.terms.tolist())}
    assert sorted(hashed.values()) == index.terms.tolist()
    n = len(train)
    factor = {w: index.idf[place[h]] / (math.log((1 + n) / (1 + df[w])) + 1) for w, h in hashed.items()}
    assert all(min(abs(x - 1), abs(x - toxicity.PLAIN)) < 1e-6 for x in factor.values())

    def vector(text):
        v = {w: (1 + math.log(c)) * index.idf[place[hashed[w]]] for w, c in plain_terms(text).items() if w in hashed}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    entries = {}
    for i, t, y in train:
        v = vector(t)
        e = entries.setdefault(tuple(sorted(plain_terms(t).items())), [v, 0, 0, i])
        e[1], e[2], e[3] = e[1] + y, e[2] + 1, min(e[3], i)

    def raw(text, without=None):
        v = vector(text)
        sims = sorted(((round(sum(x * e[0].get(w, 0) for w, x in v.items()), 12), e) for e in entries.values() if e[0]), key=lambda x: -x[0])
        near = [(s, e) for s, e in sims if s > 0][: toxicity.K]
        cut = near[-1][0] if len(near) == toxicity.K else 0
        tied = [e for s, e in sims if s == cut] if cut else []
        top = bottom = 0.0
        for s, e in near:
            p, c = e[1], e[2]
            if without and e is without[0]:
                p, c = p - without[1], c - 1
            w = 1 / (max(1 - s, 0) + 0.05)
            top, bottom = top + w * p, bottom + w * c
        return (top + index.prior) / (bottom + 1), len(tied) > 1

    got = {r.id: r.score for r in toxicity.scores(docs, index).collect()}
    checked = 0
    for i, t in own:
        if not vector(t):
            assert got[i] == index.bare
            continue
        vote, tie = raw(t)
        if not tie:  # of equal entries at the edge any may be the last
            checked += 1
            assert math.isclose(got[i], 0.98 * np.interp(vote, *index.knots) + 0.02 * vote, rel_tol=1e-6), i
    assert checked > 0.9 * len(own)
    x, y = index.knots
    assert (np.diff(x) >= 0).all() and (np.diff(y) >= 0).all()
    left_out = [(raw(t, (entries[tuple(sorted(plain_terms(t).items()))], lab))[0], lab) for _, t, lab in train if vector(t)]
    bx, by = toxicity.isotonic(np.array([v for v, _ in left_out]), np.array([float(lab) for _, lab in left_out]), np.ones(len(left_out)))
    assert abs(np.interp([v for v, _ in left_out], bx, by).mean() - np.interp([v for v, _ in left_out], x, y).mean()) < 0.05


def test_gradients_take_each_exponential_once(monkeypatch):
    r = np.random.default_rng(2)
    p = lm_scoring.fresh(np.zeros(lm_scoring.CLASSES))
    rows, calls, exp = r.integers(0, lm_scoring.ROWS, (5, 2 * lm_scoring.HALF)), [], np.exp
    monkeypatch.setattr(np, "exp", lambda *a, **more: (calls.append(1), exp(*a, **more))[1])
    lm_scoring.gradients(p, rows, np.zeros(rows.shape, bool), r.integers(0, lm_scoring.CLASSES, (5, lm_scoring.HALF)))
    assert len(calls) == 2  # of the attention, and of the classes


@pytest.mark.parametrize("kept", [0, 3, 1 << 18])
def test_words_spelled_in_a_batch_before_are_not_spelled_again(monkeypatch, kept):
    monkeypatch.setattr(lm_scoring, "REMEMBERED", kept)
    texts = [pa.array(t) for t in (["one twoish three", None, "fou$r one"], ["three fivé one one"], ["x", "six y twoish"], ["", " "], ["six one fivé"])]
    empty = lambda: lm_scoring.Units(np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, len(lm_scoring.pieces(PATH)[1]), PATH)
    units, spelled, plain = empty(), [], lm_scoring.Units._pieces
    for batch in texts:
        want = empty().spell(Words(batch))
        monkeypatch.setattr(lm_scoring.Units, "_pieces", lambda self, words, chosen: (spelled.append(len(chosen)), plain(self, words, chosen))[1])
        got = units.spell(Words(batch))
        monkeypatch.setattr(lm_scoring.Units, "_pieces", plain)
        assert all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))
    assert kept < 10 or spelled == [4, 1, 3]


def test_the_slower_tokenizer_is_given_only_words_with_characters_beyond_the_plain_ones(monkeypatch):
    slow, plain = lm_scoring.pieces(PATH)
    given = []

    class Spy:
        def encode_batch_fast(self, texts, **more):
            given.extend(w for t in texts for w in t.split(" ")[1:])
            return slow.encode_batch_fast(texts, **more)

    monkeypatch.setattr(lm_scoring, "pieces", lambda path: (Spy(), plain))
    units = lm_scoring.Units(np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, len(plain), PATH)
    text = "Abc 日本 it's zzqx9 ɐb fivé <|endoftext|> naïveſ ʃo x y \x85 Ãƀ 12,3"
    u, n = units.spell(Words(pa.array([text])))
    assert sorted(given) == sorted(["日本", "ɐb", "ʃo"])
    want = [slow.encode(" " + w, add_special_tokens=False).ids for w in re.split("[ \t-\r]+", text.translate({c: c + 32 for c in range(65, 91)}))]
    assert (u // 2).tolist() == [i for ids in want for i in ids] and n.tolist() == [len(ids) for ids in want]


@pytest.mark.parametrize("keys", [[], [0], [2**64 - 1], [0, 1, 2, 3, 2**63, 2**63 + 1, 2**64 - 2, 2**64 - 1], list(range(5, 400, 3)), None])
def test_hashes_are_found_in_their_places(keys):
    r = np.random.default_rng(1)
    keys = np.unique(r.integers(0, 2**64, 5000, np.uint64)) if keys is None else np.array(keys, np.uint64)
    asked = np.concatenate([keys, keys + np.uint64(1), keys - np.uint64(1), r.integers(0, 2**64, 1000, np.uint64)])
    met, at = lm_scoring.Places(keys)(asked)
    assert np.array_equal(met, np.isin(asked, keys)) and (keys[at[met]] == asked[met]).all()


def test_a_task_describes_a_unit_in_one_row(spark, monkeypatch):
    """However many batches it takes, and with the same sums."""
    hashes = np.sort(Words(pa.array(["aa bb cc dd"])).hash)
    units = lm_scoring.Units(hashes, np.arange(4), 4, len(lm_scoring.pieces(PATH)[1]), PATH)
    docs = spark.createDataFrame([(i, i, "aa bb cc dd " * 3 + "aa zz" * (i % 2), True) for i in range(30)], "row long, id long, text string, train boolean").coalesce(1)
    table = lm_scoring.spelled_table(docs, units, hashes, np.array([5, 4, 3, 2]), 100.0, 10.0).select("units")
    n, company = lm_scoring.describe(table, units)
    rows, plain = [], type(table).mapInArrow
    monkeypatch.setattr(type(table), "mapInArrow", lambda self, run, schema: (out := plain(self, run, schema), "n long" in schema and rows.append(out.count()))[0])
    monkeypatch.setattr(lm_scoring, "ROWS_AT_ONCE", 4)
    n4, company4 = lm_scoring.describe(table, units)
    assert np.array_equal(n, n4) and np.allclose(company, company4, atol=1e-5)
    assert rows == [np.count_nonzero(n)]


def test_logits_out_of_range_leave_probabilities_finite():
    model = small_model()
    model.params["near"] += 500 * np.sign(model.params["near"])
    model.params["bias"] -= 500
    got, enter = lm_scoring.score_units(model, np.arange(50) % 60, np.array([50]))
    assert np.isfinite(got).all() and np.isfinite(enter).all() and (got < 0).all()
    total = sum(10 ** lm_scoring.score_units(model, np.append(np.arange(40), k), np.array([41]))[0][-1] for k in range(60))
    assert abs(total - 1) < 1e-3
