import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.operators.latest import latest
from tessera.operators.quantiles import exact_quantiles

WANTED = {"a_half": ("a", 0.5), "a_low": ("a", 0.1), "a_most": ("a", 1.0), "b_third": ("b", 1 / 3)}


@pytest.mark.parametrize("cells", [4, 16, 4096])
def test_quantiles_of_groups_equal_numpy(spark, cells):
    r = random.Random(cells)
    pick = [lambda: float(r.randint(0, 9)), lambda: r.gauss(0, 1) * 10 ** r.randint(-9, 9), lambda: None, lambda: -0.0, lambda: 1e300, lambda: -1e300, lambda: 5e-324]
    rows = [(r.choice([None, "x", "y", "z"]), i % 2, r.choice(pick)(), r.choice([None, 1, 2, 3, 10**6])) for i in range(900)] + [("alone", 0, 2.5, None), ("none", 1, None, None)]
    df = spark.createDataFrame(rows, "k string, h long, a double, b long")
    got = {tuple(x)[:2]: tuple(x)[2:] for x in exact_quantiles(df, ["k", "h"], WANTED, cells).collect()}
    by: dict = {}
    for k, h, a, b in rows:
        by.setdefault((k, h), ([], []))
        for values, v in zip(by[k, h], (a, b), strict=True):
            values += [] if v is None else [float(v)]
    want = {k: tuple(float(np.quantile(v, f)) if v else None for v, f in ((a, 0.5), (a, 0.1), (a, 1.0), (b, 1 / 3))) for k, (a, b) in by.items() if a or b}
    assert got.keys() == want.keys()
    for k, values in want.items():
        assert [g is None for g in got[k]] == [v is None for v in values]
        assert [g for g in got[k] if g is not None] == pytest.approx([v for v in values if v is not None], rel=1e-9)


def test_infinities_and_no_keys(spark):
    rows = [(v,) for v in [float("inf"), float("-inf"), *map(float, range(101))]]
    df = spark.createDataFrame(rows, "a double")
    assert exact_quantiles(df, [], {"m": ("a", 0.5), "lo": ("a", 0.0), "hi": ("a", 1.0), "q": ("a", 0.25)}, 8).collect() == [(50.0, float("-inf"), float("inf"), 24.5)]
    assert exact_quantiles(df.limit(0), [], {"m": ("a", 0.5)}).count() == 0


def test_a_hot_group_makes_no_list_and_no_large_partition(spark):
    df = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("k"), (F.col("id") * 7919 % 199_999).cast("double").alias("a"))
    out = exact_quantiles(df, ["k"], {"m": ("a", 0.5), "p": ("a", 0.9)}, 256)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "collect_" not in plan and "Python" not in plan
    rows = {r.k: (r.m, r.p) for r in out.collect()}
    want = {r.k: (r.m, r.p) for r in df.groupBy("k").agg(F.median("a").alias("m"), F.percentile("a", F.lit(0.9)).alias("p")).collect()}
    assert rows == {k: pytest.approx(v) for k, v in want.items()}


def test_values_of_a_hot_group_are_not_brought_together(spark):
    df = spark.range(0, 60_000, 1, 8).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % 59_999).cast("double").alias("a"))
    out = exact_quantiles(df, ["k"], {"m": ("a", 0.5)}, 64)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert any("LeftAnti" in line for line in joins)
    assert sum("strategy=broadcast" in line for line in joins) == 2  # what drops the hot groups' values, and their last ranges
    assert out.collect() == [("hot", df.agg(F.median("a")).first()[0])]


def test_latest_reports_and_rejects_ties(spark):
    rows = [("a", 2, "x"), ("a", 2, "y"), ("a", 1, "z"), ("b", 3, "same"), ("b", 3, "same"), ("c", 1, None), (None, 5, "p"), (None, 5, "q"), (None, 5, "q")]
    df = spark.createDataFrame(rows, "k string, day int, v string")
    got = {tuple(r) for r in latest(df, ["k"], [F.desc("day")], ties="report").collect()}
    assert got == {("a", 2, "x", 2), ("b", 3, "same", 1), ("c", 1, None, 1), (None, 5, "p", 3)}
    with pytest.raises(PySparkException, match="rows tie for the latest of"):
        latest(df, ["k"], [F.desc("day")], ties="reject").collect()
    assert latest(df.filter("k IN ('b', 'c')"), ["k"], [F.desc("day")], ties="reject").count() == 2
    assert {r.v for r in latest(df, ["k"], [F.desc("day"), F.asc("v")], ties="reject").collect()} == {"x", "same", None, "p"}
