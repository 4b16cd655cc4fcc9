import datetime as dt
import hashlib
import random
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.operators.digests import digest_tree, first_difference

SCHEMA = "k int, name string, x double, m decimal(9,2), d date, flag boolean, b binary, many array<string>"


def said(v):
    if v is None:
        return "n"
    if isinstance(v, bool):
        return f"b{int(v)}"
    if isinstance(v, int):
        return f"i{v}"
    if isinstance(v, float):
        return f"f{v + 0.0}"
    if isinstance(v, Decimal):
        return f"m{v:.2f}"
    if isinstance(v, dt.date):
        return f"d{v}"
    if isinstance(v, (bytes, bytearray)):
        return "x" + bytes(v).hex()
    if isinstance(v, list):
        return f"a{len(v)}[{','.join(map(said, v))}]"
    return f"s{len(v.encode())}:{v}"


def plain(rows, chunk):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    one = lambda r: sha(",".join(f"{n}={said(v)}" for n, v in sorted(zip(names, r, strict=True))))
    nodes = [(one(r), 1) for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, one(r)))]
    out, level = [], 0
    while nodes:
        nodes = [(sha(",".join(h for h, _ in nodes[i : i + chunk])), sum(n for _, n in nodes[i : i + chunk])) for i in range(0, len(nodes), chunk)]
        out += [(level, i, n, h) for i, (h, n) in enumerate(nodes)]
        if len(nodes) == 1:
            return out
        level += 1
    return out


def rows_of(n, seed=1):
    r = random.Random(seed)
    pick = lambda *v: r.choice(v)
    return [(pick(None, i, i // 2), pick(None, "", "é", "a,b=c"), pick(None, -0.0, 0.0, 1.5, -2.25), pick(None, Decimal("1.50")), pick(None, dt.date(2024, 1, 2)), pick(None, True, False), pick(None, b"\x00\xff"), pick(None, [], ["a", None, "b"])) for i in range(n)]


@pytest.mark.parametrize("chunk", [4, 64])
def test_tree_equals_plain_python_in_any_order(spark, chunk):
    rows = rows_of(150)
    for parts in (1, 7):
        got = digest_tree(spark.createDataFrame(rows, SCHEMA).repartition(parts), ["k"], chunk)
        assert sorted(map(tuple, got.select("level", "node", "n_rows", "digest").collect())) == plain(rows, chunk)
        rows = rows[::-1]
    assert digest_tree(spark.createDataFrame([], SCHEMA), ["k"], chunk).count() == 0


def test_first_difference_names_the_chunk(spark):
    rows = [(i, f"row {i}") for i in range(70)]
    tree = lambda r: digest_tree(spark.createDataFrame(r, "k int, v string"), ["k"], 4)
    base = tree(rows)
    assert first_difference(base, tree(rows[::-1]), 4) is None
    assert first_difference(base, tree([*rows[:41], (41, "other"), *rows[42:]]), 4) == 10
    assert first_difference(base, tree(rows[:66]), 4) == 16
    assert first_difference(base, base.filter("false"), 4) == 0
    with pytest.raises(PySparkException, match="not finite"):
        digest_tree(spark.range(3).select("id", F.lit(float("nan")).alias("x")), ["id"]).collect()
