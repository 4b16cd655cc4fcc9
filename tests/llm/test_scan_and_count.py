import functools
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import secret_scan, token_counts
from tessera.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
PATH = tokenizer_path(token_counts.TOKENIZER)
ODD = [None, "", " \t\n", "<|endoftext|> in <|endoftext|>text", "é" * 50, "a b  c\r\n\r\n d", "\U0001f600 x " * 9]


@functools.cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def library_count(text):
    return len(library().encode(text or "", add_special_tokens=False).ids)


def test_counts_match_the_library(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()] + ODD
    rows = [(i, t, 0, "clash") for i, t in enumerate(texts)] + [(None, "no id", 0, None), (3, texts[3], 0, None), (3, texts[3], 0, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, id string")
    for chunk, overlap in ((token_counts.CHUNK, token_counts.OVERLAP), (300, 40)):
        got = token_counts.token_counts(docs, PATH, chunk=chunk, overlap=overlap).collect()
        want = [(i, len((t or "").encode()), library_count(t), library_count(t) > 512) for i, t, *_ in rows]
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert token_counts.token_counts(docs.limit(0), PATH).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_splices_of_long_texts(seed):
    r = random.Random(seed)
    parts = ["word ", "12 34", "\n\n", "   ", "don't ", "x" * 90, "é à ", "...!? ", "\t", "日本語", "a b c d ", "<|endoftext|>"]
    text = "".join(r.choice(parts) for _ in range(900))
    tokenizer = token_counts.load(PATH)
    for s in (text, "z" * 5000, " " * 3000 + "end", text.replace(" ", "")):
        for chunk, overlap in ((64, 8), (500, 60)):
            assert token_counts.count_long(tokenizer, s, chunk, overlap) == library_count(s)


def plain_spans(text):
    text = text or ""
    out = []
    rules = [
        (0, r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
        (1, "AKIA[A-Z0-9]+", 0, 20),
        (2, "[0-9a-f]+", 0, 24),
    ]
    for kind, rule, group, least in rules:
        out += [(m.start(), kind, m.end()) for m in re.finditer(rule, text, re.ASCII) if len(m[group]) >= least]
    return sorted(out)


def joined(spans):
    return ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def test_base_spans_match_plain_patterns(spark):
    r = random.Random(6)
    secrets = ["password: hunter22", "API_KEY='abcdef0123456789abcdef01'", "token=short", "AKIA" + "ABCD1234" * 3, "AKIAabc", "0123456789abcdef" * 3, "secret = secret=abcdefg", "passwd\"  :  \"a.b-c/d+e="]
    texts = [" ".join(r.choice([*secrets, "plain", "é", "\n", "12345"]) for _ in range(r.randint(0, 12))) for _ in range(150)]
    texts += [x.text for x in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()] + ODD
    texts.append("x " * 200_000 + secrets[0])
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(None, secrets[1], None, None), (0, texts[0], None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base string, cand int")
    got = secret_scan.scan(docs).collect()
    assert len(got) == len(rows)
    want = sorted(repr((i, *(sum(k == x for _, k, _ in plain_spans(t)) for x in range(3)), hashlib.sha256(joined(plain_spans(t)).encode()).hexdigest())) for i, t, *_ in rows)
    assert sorted(repr((g.id, g.n_assign, g.n_access, g.n_hex, g.base_sha256)) for g in got) == want
    text = {i: t or "" for i, t, *_ in rows}
    for g in got:
        spans = [x.split(":") for x in g.spans.split(",") if x]
        more = [(int(s), int(e)) for k, s, e in spans if k == "cnn"]
        assert g.n_cnn == len(more) and {x for x in g.spans.split(",") if not x.startswith("cnn")} - {""} == set(joined(plain_spans(text[g.id])).split(",")) - {""}
        assert all((s, e) in secret_scan.candidates(text[g.id]) for s, e in more)
    assert secret_scan.scan(docs.limit(0)).count() == 0


def test_screen_flags_each_text_by_its_own_runs():
    texts = ["the cafe", "0123456789abcdef01234567", "bead is", "ends here.", "abcde1", "", "letters", None, "deadbeef0123", "456789abcdef", "a12", "hunterTwo", "a/long/path", "Capital", "beadfaceadefbeadfaceadef"]
    want = [bool(secret_scan.candidates(t or "") or secret_scan.LONG_HEX.search(t or "")) for t in texts]
    assert want == [False, True, False, False, True, False, False, False, True, True, False, True, True, False, True]
    array = pa.array(["front 0123456789abcdef", *texts])
    for screen in (secret_scan._interesting(pa.array(texts)), secret_scan._interesting(array[1:])):
        assert screen.tolist() == want


def test_a_run_between_texts_that_continue_it(spark):
    value = "0123456789abcdef" * 2
    docs = spark.createDataFrame([(0, "a"), (1, value), (2, "b")], "doc_id long, text string").coalesce(1)
    assert [(g.id, g.n_hex, g.spans) for g in secret_scan.scan(docs).orderBy("id").collect()] == [(0, 0, ""), (1, 1, "hex:0:32"), (2, 0, "")]


def plain_features(net, w):
    """Loops over places and filters."""
    e = net.embed[np.frombuffer(w, np.uint8)]
    h = [np.maximum(e[i : i + secret_scan.SPAN].ravel() @ net.filters + net.bias, 0) for i in range(len(w) - secret_scan.SPAN + 1)]
    return np.concatenate([np.max(h, 0), np.max(h[secret_scan.LEFT - 2 : len(w) - secret_scan.RIGHT], 0)])


def test_network_reads_whole_candidates(monkeypatch):
    r = random.Random(3)
    net = secret_scan.CharCnn.fresh(np.random.default_rng(2))
    windows = []
    for n in (6, 7, 40, 900, 6, 300, 12):
        value = "".join(r.choice("abcXYZ019+/_=") for _ in range(n))
        windows.append(secret_scan.window("some words é " + value + " after", 13, 13 + n))
    want = np.stack([plain_features(net, w) for w in windows])
    for piece in (1 << 15, 50, 7):
        monkeypatch.setattr(secret_scan, "PIECE", piece)
        assert np.allclose(net.features(windows), want)
    middle = bytearray(windows[3])
    middle[480:500] = b"}" * 20  # a character of no other window
    assert not np.allclose(net.features([bytes(middle)]), want[3])


def test_recall_on_windows_of_no_other_fold():
    r = random.Random(8)
    windows, y = [], []
    for k in range(1600):
        secret = k % 4 == 0
        value = "".join(r.choice("0123456789abcdef") for _ in range(r.randint(24, 40))) if secret else "".join(r.choice("etaoin") for _ in range(r.randint(6, 12))) + str(r.randint(0, 99))
        windows.append(secret_scan.window(f"and then {value} with more", 9, 9 + len(value)))
        y.append(float(secret))
    y = np.array(y)
    net = secret_scan.train(windows[:800], y[:800])
    score = net.scores(windows[800:])
    assert (score[y[800:] == 1] >= net.threshold).mean() > secret_scan.RECALL - 0.05 and (score[y[800:] == 0] >= net.threshold).mean() < 0.05
    last = [w for w, label in zip(windows[:800], y, strict=False) if label and secret_scan.fold(w) > 5]
    assert (net.scores(last) >= net.threshold).mean() >= secret_scan.RECALL
    assert secret_scan.train(windows[:800], np.zeros(800)) is None


def test_copies_of_a_window_are_one_example(spark):
    row = spark.createDataFrame([(1, "password: hunter22 and")] * 50 + [(2, "see v1.22.3 of")] * 50, "doc_id long, text string")
    assert secret_scan.fit(secret_scan.findings(row)) is None  # one window of either label, not fifty


def test_every_window_of_any_length_is_trained_on_and_counted(spark, monkeypatch):
    r = random.Random(4)
    word = lambda n, of: "".join(r.choice(of) for _ in range(n))
    texts = [f"see {word(30, '0123456789abcdef')} now" if k % 2 else f"a {word(8, 'etaoin')}{k} b" for k in range(700)] + ["long " + word(5000, "xyzXYZ019+/") + " end"]
    found = secret_scan.findings(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    monkeypatch.setattr(secret_scan, "SHARE", 12000)  # two shares, so several rounds
    monkeypatch.setattr(secret_scan, "ROUNDS", 2)
    rounds, settled = [], []
    one, settle = secret_scan._round, secret_scan.settle
    monkeypatch.setattr(secret_scan, "_round", lambda rows, net, number: (rounds.append((rows.select("window").distinct().count(), rows.select("share").distinct().count())), one(rows, net, number))[1])
    monkeypatch.setattr(secret_scan, "settle", lambda net, z, y, n, hits, times: (settled.append((n.sum(), times.sum())), settle(net, z, y, n, hits, times))[1])
    net = secret_scan.fit(found)
    windows = {bytes(c.window): c.secret for row in found.collect() for c in row.cand}
    folds = [(secret_scan.fold(w), secret) for w, secret in windows.items()]
    assert len(rounds) == secret_scan.ROUNDS and {n for n, _ in rounds} == {sum(f < 4 for f, _ in folds)} and rounds[0][1] > 1
    assert settled == [(sum(f in (4, 5) for f, _ in folds), sum(f > 5 and s for f, s in folds))]
    last = [w for w, secret in windows.items() if secret and secret_scan.fold(w) > 5]
    assert (net.scores(last) >= net.threshold).mean() >= secret_scan.RECALL


def test_each_window_is_dealt_once_before_any_is_again():
    windows = [bytes(40)] * 90 + [bytes(5000)] * 10
    at = secret_scan._dealt(np.random.default_rng(0), windows, np.arange(100), 400)
    assert sorted(at[:100]) == list(range(100)) and max(at[100:]) < 90 and len(at) == 400
