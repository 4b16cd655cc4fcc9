"""Name keys and name similarity: the two text functions without a built-in, as Arrow UDFs."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


@F.pandas_udf(StringType())
def name_key(names: pd.Series) -> pd.Series:
    """NFKC, casefolded, letters and digits only; null for null and for names without any."""
    return names.map(lambda x: None if x is None else "".join(c for c in unicodedata.normalize("NFKC", x).casefold() if c.isalnum()) or None)


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of the table held in the bits of one integer."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@F.pandas_udf(DoubleType())
def indel_similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    """2 * common subsequence / both lengths; two empty texts are equal, null is 0."""

    def one(a: str | None, b: str | None) -> float:
        if a is None or b is None:
            return 0.0
        both = len(a) + len(b)
        return 2 * common_length(a, b) / both if both else 1.0

    return pd.Series([one(a, b) for a, b in zip(left, right, strict=True)], dtype="float64")


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Compatibility forms, such as full-width digits and spaces, in their plain form."""
    return texts.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))
