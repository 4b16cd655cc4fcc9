import random

import numpy as np
import pytest

from tessera.llm import line_dedup, minhash_dedup
from tessera.llm.common import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows(texts):
    return [(i, t, "en", "s", len(t or "")) for i, t in texts]


def words(text):
    return (text or "").encode().lower().split()


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(pairs, ids):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    return label


def corpus(seed=1):
    r = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)]
    base = [[r.choice(vocabulary) for _ in range(r.randint(1, 90))] for _ in range(40)]
    texts = []
    for i in range(260):
        w = list(base[r.randrange(40)] if r.random() < 0.6 else [r.choice(vocabulary) for _ in range(r.randint(1, 60))])
        for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        texts.append((i, " ".join(w)))
    return texts + [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "One TWO"), (1004, "one\ttwo"), (5, texts[5][1])]


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_match_brute_force(spark, percent):
    texts = corpus(percent)
    got = {r.id: (r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows(texts), SCHEMA), percent=percent).collect()}
    sets = {i: shingles(t) for i, t in texts}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    label = brute_components(pairs, sets)
    assert got == {i: (len(s), label[i], label[i] == i) for i, s in sets.items()}


def test_large_group_of_near_copies(spark):
    r = random.Random(4)
    base = ["b%d" % i for i in range(150)]
    texts = []
    for i in range(150):
        w = list(base)
        for _ in range(r.randint(0, 12)):
            w[r.randrange(150)] = "x%d" % r.randrange(10**6)
        texts.append((i, " ".join(w)))
    got = {x.id: x.component_id for x in minhash_dedup.near_duplicates(spark.createDataFrame(rows(texts), SCHEMA), percent=85).collect()}
    sets = {i: shingles(t) for i, t in texts}
    pairs = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    assert got == brute_components(pairs, sets)


def test_blocks_of_large_buckets_match_brute_force(spark, monkeypatch):
    """Groups whose members are linked with some but not all others, in buckets dealt to many blocks."""
    monkeypatch.setattr(minhash_dedup, "LARGE", 3)
    monkeypatch.setattr(minhash_dedup, "BLOCK", 4)
    r = random.Random(9)
    texts = []
    for g in range(6):
        w = ["g%d_%d" % (g, i) for i in range(120)]
        for i in range(40):
            if r.random() < 0.5:  # drifts away from the first
                w[r.randrange(120)] = "y%d" % r.randrange(10**6)
            v = list(w)
            for _ in range(r.randint(0, 2)):
                v[r.randrange(120)] = "z%d" % r.randrange(10**6)
            texts.append((len(texts), " ".join(v)))
    got = {x.id: x.component_id for x in minhash_dedup.near_duplicates(spark.createDataFrame(rows(texts), SCHEMA), percent=85).collect()}
    sets = {i: shingles(t) for i, t in texts}
    pairs = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = brute_components(pairs, sets)
    assert got == want and 12 < len(set(want.values())) < 200


def test_repeated_ids_null_ids_and_other_columns(spark):
    p, q = line("p", 30), line("q", 30)
    docs = [(7, p, 1, "x"), (7, q, 1, "x"), (7, q, 2, "x"), (3, p + " end", 1, None), (4, q, 1, "x"), (None, p, 1, "x"), (None, None, 1, "x"), (9, " ", 1, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, t int, component string")
    got = sorted((x.id or 0, x.n_shingles, x.component_id or 0, x.kept) for x in minhash_dedup.near_duplicates(df, percent=85).collect())
    assert got == sorted([(7, 26, 3, False), (7, 26, 4, False), (7, 26, 4, False), (3, 27, 3, True), (4, 26, 4, True), (0, 26, 0, True), (0, 0, 0, True), (9, 0, 9, True)])
    kept = sorted((x.doc_id or 0, x.text or "") for x in minhash_dedup.deduplicated(df.filter("doc_id <> 4 OR doc_id IS NULL")).collect())
    assert kept == sorted([(0, ""), (0, p), (3, p + " end"), (7, q), (9, " ")])


def test_components_that_do_not_end_are_an_error(spark):
    with pytest.raises(RuntimeError):
        components(spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long"), rounds=1)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert minhash_dedup.near_duplicates(docs).count() == 0
    assert line_dedup.line_dedup(docs).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200), (None, 3), (201, 202), (202, 201)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 201: 201, 202: 201}


def brute_cuts(texts, min_words):
    """Every pair of documents, every run of lines of the later one: it goes if the earlier one has the same run and it has min_words words."""
    seq = {i: [(n, b" ".join(words(line)), len(words(line))) for n, line in enumerate((t or "").split("\n")) if words(line)] for i, t in texts}
    out = {}
    for b in seq:
        mine = [x for _, x, _ in seq[b]]
        for a in seq:
            theirs = [x for _, x, _ in seq[a]]
            if a >= b or not set(mine) & set(theirs):
                continue
            for i in range(len(mine)):
                for j in range(i + 1, len(mine) + 1):
                    whole = j - i == len(mine) and mine == theirs
                    if not any(theirs[k : k + j - i] == mine[i:j] for k in range(len(theirs))):
                        break
                    if whole or sum(n for _, _, n in seq[b][i:j]) >= min_words:
                        out.setdefault(b, set()).update(n for n, _, _ in seq[b][i:j])
    return out


def test_line_dedup_matches_all_pairs(spark):
    r = random.Random(2)
    pool = [" ".join(r.choice("abcdefghij") for _ in range(r.choice([2, 3, 8, 30]))) + " %d" % i for i in range(60)]
    texts = []
    for i in range(120):
        lines = [r.choice(pool) if r.random() < 0.5 else "own line %d %d" % (i, k) for k in range(r.randint(0, 9))]
        if i and r.random() < 0.3:
            lines += texts[r.randrange(i)][1].upper().split("\n")[1:]
        if r.random() < 0.2:
            lines.insert(0, "")
        texts.append((i, "\n".join(lines)))
    texts += [(500, None), (501, ""), (502, "  \n "), (503, texts[3][1]), (3, texts[3][1])]
    got = {x.doc_id: (set(x.cut), x.text, x.n_cut) for x in line_dedup.line_dedup(spark.createDataFrame(rows(texts), SCHEMA)).collect()}
    cuts = brute_cuts(texts, 20)
    assert len(cuts) > 20
    for i, t in texts:
        cut = cuts.get(i, set())
        left = "\n".join(line for n, line in enumerate((t or "").split("\n")) if n not in cut)
        want = t if not cut else left if left.split() else ""
        assert got[i] == (cut, want, len(cut))


def cut_of(spark, texts):
    got = line_dedup.line_dedup(spark.createDataFrame(rows(texts), SCHEMA)).collect()
    return sorted((x.doc_id, list(x.cut), x.text) for x in got)


def line(name, n=12):
    return " ".join(f"{name}{k}" for k in range(n))


def test_a_block_whose_lines_have_different_earliest_holders_is_cut(spark):
    x, y = line("x"), line("y")
    texts = [(1, f"{x}\nown one"), (2, f"{x}\n{y}\nown two"), (3, f"own\n{x}\n{y}\nown three")]
    assert cut_of(spark, texts) == [(1, [], texts[0][1]), (2, [], texts[1][1]), (3, [1, 2], "own\nown three")]


def test_short_lines_held_elsewhere_do_not_hide_a_passage(spark):
    lines = [line(f"q{k}") for k in range(5)]
    quotes = [(k, f"own {k}\n{lines[k]}") for k in range(5)]
    passage = "\n".join(lines)
    got = cut_of(spark, [*quotes, (10, f"{passage}\nend ten"), (11, f"start eleven\n{passage}")])
    assert [(i, cut) for i, cut, _ in got] == [*((k, []) for k in range(5)), (10, []), (11, [1, 2, 3, 4, 5])]


def test_repeated_and_crossed_passages_are_cut(spark):
    p, q, r = (line(c, 25) for c in "pqr")
    texts = [(1, f"a\n{p}\n{q}\n{r}"), (2, f"b\n{r}\nc\n{p}\nd\n{p}\ne"), (3, f"f\n{q}\n{p}")]
    assert [(i, cut) for i, cut, _ in cut_of(spark, texts)] == [(1, []), (2, [1, 3, 5]), (3, [1, 2])]


def test_tails_of_blocks_and_many_holders(spark):
    head, tail, menu = line("h", 20), line("t", 4), line("m", 3)
    texts = [(1, f"{head}\nother"), (2, f"{head}\n{tail}\nsecond"), (3, f"third\n{head}\n{tail}")] + [(10 + k, f"{menu}\nown {k}\n{head}") for k in range(40)]
    assert [(i, cut) for i, cut, _ in cut_of(spark, texts)] == [(1, []), (2, [0]), (3, [1, 2]), *((10 + k, [2]) for k in range(40))]


def test_rows_with_odd_ids_and_columns(spark):
    p = line("p", 30)
    docs = [(7, f"{p}\none", 1, "hash", 5), (7, f"{p}\ntwo", 1, "hash", 5), (7, f"{p}\ntwo", 2, None, 5), (None, p, 1, "x", 5), (9, f"z\n{p}", 1, "doc", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, n_cut int, doc string, d int")
    got = sorted((x.doc_id or 0, x.n_cut, x.doc or "", x.text) for x in line_dedup.line_dedup(df).collect())
    first, second = [(7, 0, "hash", f"{p}\none"), (7, 1, "", "two"), (7, 1, "hash", "two")], [(7, 0, "", f"{p}\ntwo"), (7, 0, "hash", f"{p}\ntwo"), (7, 1, "hash", "one")]
    assert got in [sorted([(0, 0, "x", p), (9, 1, "doc", "z"), *own]) for own in (first, second)]


def test_very_long_text_is_aligned_whole(spark):
    many = [line(f"l{k}x", 9) for k in range(4000)]
    texts = [(1, "\n".join(many)), (2, "\n".join([*many[:1000], "own", *many[1000:], "tail"]))]
    assert cut_of(spark, texts)[1][2] == "own\ntail"


def test_patience_aligns_moved_and_repeated_lines():
    a, b = np.array([1, 2, 3, 4, 5, 6]), np.array([9, 2, 3, 8, 5, 6])
    assert line_dedup.patience(a, b) == [(1, 1, 2), (4, 4, 2)]
    assert line_dedup.patience(a, a) == [(0, 0, 6)]
    assert line_dedup.patience(a, b[:0]) == []


def test_very_long_near_duplicates(spark):
    r = random.Random(12)
    w = ["v%d" % r.randrange(10**6) for _ in range(60_000)]
    v = list(w)
    for k in range(0, 60_000, 400):
        v[k] = "other"
    texts = [(1, " ".join(w)), (2, " ".join(v)), (3, " ".join(w[:30_000]))]
    got = sorted((x.id, x.n_shingles, x.component_id) for x in minhash_dedup.near_duplicates(spark.createDataFrame(rows(texts), SCHEMA), percent=85).collect())
    sets = {i: shingles(t) for i, t in texts}
    assert len(sets[1] & sets[2]) >= 0.85 * len(sets[1] | sets[2])
    assert got == [(1, len(sets[1]), 1), (2, len(sets[2]), 1), (3, len(sets[3]), 3)]


def test_alignment_decides_what_is_cut(monkeypatch):
    """Aligned, repeated and crossed passages are cut through the alignment, and nothing without it."""

    def sequence(codes):
        codes = np.array(codes)
        return line_dedup.Sequence(codes, codes * 7919, np.full(len(codes), 6), np.arange(len(codes)))

    a = sequence([1, 2, 3, 4, 10, 11, 12, 13, 20, 21, 22, 23])
    b = sequence([50, 10, 11, 12, 13, 51, 1, 2, 3, 4, 52, 10, 11, 12, 13, 53, 20, 21, 99, 22, 23])
    want = [*range(1, 5), *range(6, 10), *range(11, 15)]
    assert line_dedup.cut_lines(a, b, 20).tolist() == want
    monkeypatch.setattr(line_dedup, "patience", lambda x, y: [])
    assert line_dedup.cut_lines(a, b, 20).tolist() == []
