import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import token_alignment as T
from tessera.llm.queries import tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [None, "", " ", "  two  spaces ", " lead", "trail ", "a\n b\t c\r\n\r\nd", "<|endoftext|> in <|endoftext|>text <s> </s> <unk>", "é" * 50 + " naïve ﬁ ½", "日本語 テキスト",
       "\U0001f600 x " * 9, "don't 123 4567 ...!? ' s", "x" * 900, "\u2581 lower \u2581block", "a\u00a0b \u0085 c\u200b d", "\ufeffbom \ufffd", "ⅷ ㎏ Å"]


def plain(texts):
    """Whole texts through the libraries, and all pairs of overlapping tokens by plain loops."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    values = T.byte_values()
    out, holders = [], Counter()
    for text in texts:
        ia = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ib = b.encode(text or "")
        ta = [bytes(values[c] for c in a.id_to_token(i)) for i in ia]
        tb = [bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ib)]
        want = b" " + (text or "").encode()
        if not text or b"".join(ta) != want or b"".join(tb) != want:
            out.append(([], [], [], [], ""))
            continue
        spans = lambda tokens: [(sum(map(len, tokens[:i])), sum(map(len, tokens[: i + 1]))) for i in range(len(tokens))]
        sa, sb = spans(ta), spans(tb)
        common = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, last = [], 0
        for end in common:
            groups.append(",".join(str(i) for i, s in zip(ia, sa) if last <= s[0] < end) + "|" + ",".join(str(i) for i, s in zip(ib, sb) if last <= s[0] < end))
            last = end
        links = [(i, j) for i, s in zip(ia, sa) for j, t in zip(ib, sb) if s[0] < t[1] and t[0] < s[1]]
        holders.update(set(links))
        out.append((ia, ib, groups, links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (i, _), n in holders.items():
        best[i] = max(best[i], n)
    return [(len(ia), len(ib), len(g), len(ls), sum(holders[p] == best[p[0]] for p in ls), sum(holders[p] for p in ls), d) for ia, ib, g, ls, d in out]


@pytest.mark.parametrize("window,slab,buckets", [(T.WINDOW, T.SLAB, T.BUCKETS), (64, 300, 5)])
def test_equals_plain_loops(spark, window, slab, buckets):
    texts = [t[:600] for t in (r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(50).collect())] + ODD
    rows = [(i, t, "clash", 5) for i, t in enumerate(texts)] + [(None, texts[0], None, None), (3, texts[3], "", 0), (3, texts[3], "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a string, doc int").repartition(3)
    got = T.align(docs, A, B, window=window, slab=slab, buckets=buckets, salts=2).select(*COLUMNS).collect()
    want = [(i, *w) for (i, *_), w in zip(rows, plain([r[1] for r in rows]), strict=True)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_empty_table(spark):
    assert T.align(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_segments_and_the_faster_library(seed):
    """Ids of segments joined, by the cache, are those of whole texts by the library itself, over all characters below PLAIN."""
    import sentencepiece
    from tokenizers import Tokenizer

    r = random.Random(seed)
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    words = ["don't", "12 34", "\n\n", "   ", "x" * 40, "à", "日本", "a.b", "<|endoftext|>", "'s", "\t"]
    alone = [chr(c) for c in range(1, T.PLAIN)]
    texts = ["".join(r.choice(words) + r.choice(["", " ", " "]) for _ in range(60)) for _ in range(60)] + ["".join(r.choice(alone) + r.choice(["", " ", "a", "1"]) for _ in range(200)) for _ in range(60)]
    both = T.pair(A, B)
    for text, got in zip(texts, both.encode(texts), strict=True):
        for n, ids in enumerate((a.encode(" " + text, add_special_tokens=False).ids, b.encode(text))):
            if got is None:
                continue
            assert np.frombuffer(got[n], np.uint16).tolist() == ids
        if got is None:
            assert b.decode(b.encode(text)) != text
    assert sum(g is None for g in both.encode(texts)) < len(texts) / 2
