import zlib

import corpus_pipeline
from tessera.llm import decontamination, minhash_dedup, mixing, toxicity
from tests.llm.test_dedup import brute_components, brute_cuts, shingles, words

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def contained(text, items):
    s = shingles(text)
    return any(t and 100 * len(t & s) >= 80 * len(t) for t in items)


def test_stages_match_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [shingles(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [r.asDict() for r in docs.collect()]
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = [r.asDict() for r in docs.collect()]
        texts = [(r["doc_id"], r["text"]) for r in before]
        if k < 4:
            assert docs.columns == COLUMNS
        if name == "drop_toxic":
            index = toxicity.fit(spark.createDataFrame(before, docs.schema), spark.read.parquet(f"{SF}/labels.parquet"))
            score = {r.id: r.score for r in toxicity.scores(spark.createDataFrame(before, docs.schema), index).collect()}
            assert {r["doc_id"] for r in after} == {i for i, s in score.items() if s < 0.5}
        elif name == "dedup_lines":
            cuts = brute_cuts(texts, 20)
            want = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in cuts.get(i, ())) for i, t in texts}
            assert {r["doc_id"]: r["text"] for r in after} == {i: t for i, t in want.items() if i not in cuts or words(t)}
            assert all(r["n_chars"] == len(r["text"]) for r in after if r["doc_id"] in cuts)
        elif name == "drop_near_duplicates":
            sets = {i: shingles(t) for i, t in texts}
            pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
            label = brute_components(pairs, sets)
            assert {r["doc_id"] for r in after} == {i for i in sets if label[i] == i}
        elif name == "decontaminate":
            assert {r["doc_id"] for r in after} == {i for i, t in texts if not contained(t, items)}
        else:
            plan = {r.doc_id: r.copies for r in mixing.mixing_plan(spark.createDataFrame(before, corpus_schema(spark))).collect()}
            got = {}
            for r in after:
                got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
            assert got == {i: n for i, n in plan.items() if n}


def corpus_schema(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").schema


def test_mix_reaches_targets_and_survives_odd_rows(spark):
    rows = [(i, "a " * (i % 7), "en", "s%d" % (i % 5), 0) for i in range(4000)]
    rows += [(None, None, None, None, None), (7, "x y z", None, None, None), (7, "x y z", None, None, None), (9000, " \t", "en", "only blank", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    plan = mixing.mixing_plan(docs).collect()
    assert len(plan) == len(rows)
    taken, target = {}, {}
    for r in plan:
        taken[r.source_size, r.target] = taken.get((r.source_size, r.target), 0) + r.taken
        target[r.source_size, r.target] = r.target
        assert r.taken <= 3 * r.size and r.target <= 3 * r.source_size
    assert all(abs(taken[k] - target[k]) <= 0.1 * target[k] + 20 for k in taken)
    assert mixing.mixing_plan(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0
    assert {zlib.crc32(str(r.asDict()).encode()) for r in mixing.mixing_plan(docs.repartition(3)).collect()} == {zlib.crc32(str(r.asDict()).encode()) for r in plan}


def test_decontamination_of_odd_items(spark):
    docs = spark.createDataFrame([(1, "one two three four five six"), (None, "Alpha BETA gamma"), (2, None), (3, ""), (4, "alpha\tbeta"), (1, "one two three four five six")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta"), (1, "gamma"), (2, None), (3, " "), (4, "two three four five six"), (5, "one two three four five six"), (5, "one two three four five six")], "item_id long, text string")
    got = sorted((r.id or -1, r.item_id, r.n_found, r.n_item) for r in decontamination.contamination(docs, items, block=2).collect())
    assert got == [(-1, 1, 1, 1), (-1, 1, 1, 1), (1, 4, 1, 1), (1, 4, 1, 1), (1, 5, 2, 2), (1, 5, 2, 2), (4, 1, 1, 1)]
    assert sorted(r.doc_id for r in decontamination.decontaminated(docs, items, block=2).collect()) == [2, 3]
    assert decontamination.contamination(docs, items.limit(0)).count() == 0
    assert decontamination.contamination(docs.limit(0), items).count() == 0


def test_deduplicated_keeps_rows_without_ids(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b"), (None, None), (3, None)], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in minhash_dedup.deduplicated(docs).collect())
    assert got == [(False, 1, "a b c d e f"), (False, 3, ""), (True, 0, ""), (True, 0, "a b")]


def test_contamination_matches_brute_force_at_any_share(spark):
    r = __import__("random").Random(4)
    word = lambda: "w%d" % r.randrange(300)
    items = [(i, " ".join(word() for _ in range(r.choice([1, 3, 4, 5, 6, 8, 12, 40, 200])))) for i in range(60)]
    docs = []
    for i in range(80):
        parts = [word() for _ in range(r.randrange(200))]
        for _ in range(r.randrange(3)):
            own = r.choice(items)[1].split()
            for _ in range(r.choice([0, 0, 1, 2])):
                own[r.randrange(len(own))] = "x%d" % r.randrange(99)
            at = r.randrange(len(parts) + 1)
            parts[at:at] = own
        docs.append((i, " ".join(parts).upper(), "clash", 1))
    docs.append((900, "p " * 150_000 + items[5][1], "clash", 1))  # a very long text
    df, bench = spark.createDataFrame(docs, "doc_id long, text string, item_id string, n_found int"), spark.createDataFrame(items, "item_id long, text string")
    for percent in (80, 50):
        want = set()
        for i, t, *_ in docs:
            w = words(t)
            own = shingles(t)
            for j, x in items:
                v = words(x)
                s = shingles(x)
                n = len(s & own) if len(v) >= 5 else int(any(w[k : k + len(v)] == v for k in range(len(w) - len(v) + 1)))
                if 100 * n >= percent * len(s):
                    want.add((i, j, n, len(s)))
        got = {(g.id, g.item_id, g.n_found, g.n_item) for g in decontamination.contamination(df, bench, percent=percent, block=300).collect()}
        assert got == want and len(want) > 40


def test_mix_with_clashing_columns(spark):
    rows = [(i, "a b c", "s%d" % (i % 2), 9, "x", 1.5, i) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, target string, rate double, row int")
    plan = mixing.mixing_plan(docs).collect()
    assert len(plan) == 50 and all(r.size == 3 and r.source_size == 75 for r in plan)
    got = mixing.mix(docs).collect()
    assert all(r.row == r.doc_id and r.text == "a b c" for r in got) and len(got) == sum(r.copies for r in plan)
