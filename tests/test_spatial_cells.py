import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import spatial


def plain(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            turn = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            if turn == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            odd ^= (y1 > y) != (y2 > y) and (turn > 0) == (y2 > y1)
    return odd


def shapes(r):
    """A star of many corners with a hole, a self-crossing ring, squares that share sides on cell borders, and a thin one."""
    star = [(50 + d * np.cos(t), 50 + d * np.sin(t)) for t in np.linspace(0, 6.28, 60, endpoint=False) for d in (r.choice([20, 33, 45]),)]
    hole = [(45.0, 45.0), (55.0, 45.0), (55.0, 58.0), (45.0, 58.0)]
    lattice = [(float(r.randint(0, 10) * 10), float(r.randint(0, 10) * 10)) for _ in range(9)]
    square = lambda a, b: [(a, b), (a + 10.0, b), (a + 10.0, b + 10.0), (a, b + 10.0)]
    out = {"star": [star, hole], "crossed": [lattice], "left": [square(20.0, 20.0)], "right": [square(30.0, 20.0)], "thin": [[(0.0, 95.0), (99.0, 96.0), (99.0, 96.5)]], "none": []}
    return {k: [[(float(x), float(y)) for x, y in ring] for ring in v] for k, v in out.items()}


@pytest.mark.parametrize("cell", [3.0, 10.0, 500.0])
def test_cells_equal_brute_force(spark, cell):
    r = random.Random(cell)
    rings = shapes(r)
    points = [(r.uniform(-5, 105), r.uniform(-5, 105)) for _ in range(300)] + [(float(r.randint(0, 20) * 5), float(r.randint(0, 20) * 5)) for _ in range(200)] + rings["star"][0][:10]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "n int, x double, y double")
    polygons = spark.createDataFrame([(k, [[{"x": x, "y": y} for x, y in ring] for ring in v]) for k, v in rings.items()], f"name string, rings {spatial.RING}")
    got = {(p.n, p.name) for p in spatial.points_in(df, polygons, cell).collect()}
    assert got == {(i, k) for i, (x, y) in enumerate(points) for k, v in rings.items() if plain(v, x, y)}


def test_cells_far_from_edges_hold_none(spark):
    square = [[{"x": 0.5, "y": 0.5}, {"x": 99.5, "y": 0.5}, {"x": 99.5, "y": 99.5}, {"x": 0.5, "y": 99.5}]]
    cells = spatial.polygon_cells(spark.createDataFrame([("s", square)], f"name string, rings {spatial.RING}"), 1.0)
    assert {tuple(r) for r in cells.groupBy((F.size("edges") > 0).alias("edge")).count().collect()} == {(False, 98 * 98), (True, 4 * 99)}
    assert cells.filter("size(edges) = 0 AND NOT odd").count() == 0 and cells.agg(F.max(F.size("edges"))).first()[0] == 2
