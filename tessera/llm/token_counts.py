"""Exact token counts of whole texts, with huge documents encoded in overlapping chunks.

A long text is cut into chunks that overlap.  Both encodings of an overlap carry offsets, and they are
spliced at a position where (1) a single space stands between two letters or digits and (2) both have a
token boundary.  Such a position is stable: the pre-tokenizer's patterns take a space only in front of what
follows it, so no token crosses it, and what follows is split without regard to what came before.  Where an
overlap holds no such position it is widened until one is found or the text ends.

Defined results: null counts as empty (0 tokens); repeated rows are counted each; other columns are ignored.
"""

from __future__ import annotations

import functools
import os

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tessera.llm.common import mapped, text_slices

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
CHUNK = 1 << 17  # characters
OVERLAP = 1 << 10


@functools.cache
def load(path: str):
    """The library's tokenizer for a file: tokenizers for .json, sentencepiece for .model."""
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def stable(text: str, lo: int, hi: int):
    """Positions p in [lo, hi), latest first, where text[p] is one space between two letters or digits."""
    p = text.rfind(" ", lo, hi)
    while p > 0:
        if p + 1 < len(text) and text[p - 1].isalnum() and text[p + 1].isalnum():
            yield p
        p = text.rfind(" ", lo, p)


def splice(left: list[tuple[int, int]], right: list[tuple[int, int]], at: int, text: str, lo: int, hi: int) -> tuple[int, int] | None:
    """(p, tokens of `left` before p): a stable p in [lo, hi) that is a boundary in both; offsets of right start at `at`."""
    starts = {at + s for s, _ in right}
    own = {s for s, _ in left}
    for p in stable(text, lo, hi):
        if (p in starts or p + 1 in starts) and (p in own or p + 1 in own):
            return p, sum(e <= p for _, e in left)
    return None


def count_long(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text of any length; at most two chunks are encoded at a time unless no boundary is found."""
    encode = lambda a, b: tokenizer.encode(text[a:b], add_special_tokens=False).offsets
    total, at, end = 0, 0, chunk
    spans = encode(0, end)
    while end < len(text):
        lap, cut, width = overlap, None, end
        while cut is None and end < len(text):
            nxt = max(at + 1, end - lap)
            following = encode(nxt, nxt + chunk)
            cut = splice([(at + s, at + e) for s, e in spans], following, nxt, text, nxt + 1, end - 1)
            if cut is None:  # widen: a longer left chunk, overlapping more of what follows
                lap, end = lap * 4, min(len(text), end + lap * 4)
                spans = encode(at, end)
        if cut is None:
            break
        p, before = cut
        total += before
        at, end = p, p + max(chunk, width - p)
        spans = encode(at, end)
    return total + len(spans)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row, in one pass without a shuffle."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokenizer = load(path)
        texts = pc.fill_null(batch.column("text"), "")
        size = pc.binary_length(texts)
        counts: list[int] = []
        for part in text_slices(pa.record_batch({"text": texts}), "text", 1 << 18):
            strings = part.column(0).to_pylist()
            if path.endswith(".model"):
                counts += map(len, tokenizer.encode(strings, num_threads=1))
                continue
            short = [len(s) <= chunk for s in strings]
            fast = iter(tokenizer.encode_batch_fast([s for s, k in zip(strings, short, strict=True) if k], add_special_tokens=False))
            counts += [len(next(fast)) if k else count_long(tokenizer, s, chunk, overlap) for s, k in zip(strings, short, strict=True)]
        n = pa.array(counts, pa.int64())
        return pa.record_batch([batch.column("id"), size.cast(pa.int64()), n, pc.greater(n, limit)], names=["id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    return mapped(rows, each, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)
