"""Ratings, coordinates and the 500 m grid.

Polygons are arrays of rings of (x, y); cells are squares, so a cell's share of a polygon comes from cutting each
ring at the cell's four sides.  Rings after the first are holes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.geo import CELL_M, cell_index, geographic, grid_id, projected
from tessera.functions.parsing import is_finite

RING = "array<array<struct<x:double,y:double>>>"
TIE = 1e-5
BOUNDARY_CELL = 0.02  # degrees, about 2 km


def room_rating(rooms: Column, quality: Column | None = None) -> Column:
    """Of a reported count above 0; without `quality` every count is taken as reported."""
    fit = is_finite(rooms.cast("double")) & (rooms > 0)
    if quality is not None:
        fit = fit & F.coalesce(quality.isin("good", "reported"), F.lit(False))
    return F.when(~fit, "unavailable").when(rooms <= 10, "high").when(rooms <= 20, "medium").otherwise("low")


def age_rating(years: Column, quality: Column | None = None, buildings: Column | None = None) -> Column:
    """Of a reported age of 0 or more, of a facility with exactly one building."""
    fit = is_finite(years.cast("double")) & (years >= 0)
    if quality is not None:
        fit = fit & F.coalesce(quality == "reported", F.lit(False))
    if buildings is not None:
        fit = fit & F.coalesce(buildings == 1, F.lit(False))
    return F.when(~fit, "unavailable").when(years >= 30, "high").when(years >= 20, "medium").otherwise("low")


def context_rating(demand: Column, supply: Column) -> Column:
    """High demand and low supply each count one: both high, one medium, none low; unclassified input is unavailable."""
    classes = ("low", "medium", "high")
    ones = (demand == "high").cast("int") + (supply == "low").cast("int")
    return F.when(demand.isin(*classes) & supply.isin(*classes), F.when(ones == 2, "high").when(ones == 1, "medium").otherwise("low")).otherwise("unavailable")


def rating_points(band: Column) -> Column:
    return F.when(band == "high", 2).when(band == "medium", 1).when(band == "low", 0)


def composite(*bands: Column) -> Column:
    """Struct (score, grade); a single missing component leaves no score."""
    score = sum((rating_points(b) for b in bands[1:]), rating_points(bands[0]))
    grade = F.when(score >= 5, "priority_1").when(score >= 3, "priority_2").when(score >= 1, "monitor").when(score >= 0, "general").otherwise("insufficient_evidence")
    return F.struct(score.alias("score"), grade.alias("grade"))


def resolve_points(df: DataFrame, boundary: DataFrame | None = None) -> DataFrame:
    """Adds lon_wgs, lat_wgs, x, y, grid_id and exception_code from coordinate_crs, longitude, latitude, projected_x, projected_y.

    The stated reference system decides which pair is read; nothing is guessed.  boundary: polygons (name, rings in degrees) of the city; a
    point that none of them covers is OUTSIDE_BUSAN, one on their edge is not.
    """
    crs = F.nullif(F.trim("coordinate_crs"), F.lit(""))
    geo, plane = crs == "EPSG:4326", crs == "EPSG:5174"
    a, b = F.when(geo, F.col("longitude")).when(plane, F.col("projected_x")), F.when(geo, F.col("latitude")).when(plane, F.col("projected_y"))
    other = F.when(geo, F.coalesce("projected_x", "projected_y")).when(plane, F.coalesce("longitude", "latitude"))
    finite = lambda v: ~F.isnan(v) & (F.abs(v) < 1e12)
    usable = a.isNotNull() & b.isNotNull() & finite(a) & finite(b)
    out = df.withColumn("_to", F.when(geo & usable, projected(a, b))).withColumn("_from", F.when(plane & usable, geographic(a, b)))
    out = out.withColumns({"lon_wgs": F.coalesce("_from.lon", F.when(geo, a)), "lat_wgs": F.coalesce("_from.lat", F.when(geo, b)), "x": F.coalesce("_to.x", F.when(plane, a)), "y": F.coalesce("_to.y", F.when(plane, b))})
    code = (
        F.when(crs.isNull() | ~crs.isin("EPSG:4326", "EPSG:5174"), "UNKNOWN_CRS")
        .when(a.isNull() & b.isNull() & other.isNotNull(), "CRS_MISMATCH")
        .when(a.isNull() & b.isNull(), "MISSING_COORDINATES")
        .when(~F.coalesce(usable, F.lit(False)), "INVALID_COORDINATES")
        .when(~(F.col("lon_wgs").between(124, 132) & F.col("lat_wgs").between(33, 39)), "OUTSIDE_SOUTH_KOREA")
    )
    out = out.withColumn("exception_code", code).drop("_to", "_from")
    if boundary is not None:
        spots = out.filter("exception_code IS NULL").select(F.col("lon_wgs").alias("x"), F.col("lat_wgs").alias("y")).distinct()
        inside = points_in(spots, boundary, BOUNDARY_CELL).select(F.col("x").alias("lon_wgs"), F.col("y").alias("lat_wgs"), F.lit(True).alias("_in")).distinct()
        outside = F.when(F.col("_in").isNull() & F.col("exception_code").isNull(), "OUTSIDE_BUSAN")
        out = out.join(inside, ["lon_wgs", "lat_wgs"], "left").withColumn("exception_code", F.coalesce("exception_code", outside)).drop("_in")
    return out.withColumn("grid_id", F.when(F.col("exception_code").isNull(), grid_id(F.col("x"), F.col("y"))))


def ring_arrays(value) -> list[np.ndarray]:
    """Rings as (points, 2) arrays."""
    return [np.array([(p["x"], p["y"]) for p in ring], float).reshape(-1, 2) for ring in value]


def covers(rings: list[np.ndarray], points: np.ndarray) -> np.ndarray:
    """Which of (n, 2) points a polygon covers: even-odd rule over all rings, edges included; all edges and points at once."""
    inside, edge = np.zeros(len(points), bool), np.zeros(len(points), bool)
    x, y = points[:, 0, None], points[:, 1, None]
    for ring in rings:
        (x1, y1), (x2, y2) = ring.T, np.roll(ring, -1, 0).T
        turn = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
        edge |= ((turn == 0) & (np.minimum(x1, x2) <= x) & (x <= np.maximum(x1, x2)) & (np.minimum(y1, y2) <= y) & (y <= np.maximum(y1, y2))).any(1)
        inside ^= (((y1 > y) != (y2 > y)) & ((turn > 0) == (y2 > y1))).sum(1) % 2 == 1
    return inside | edge


def cut(ring: np.ndarray, axis: int, bound: float, keep_above: bool) -> np.ndarray:
    """The part of a ring on one side of a line parallel to an axis."""
    after = np.roll(ring, -1, 0)
    sign = 1 if keep_above else -1
    dp, dq = sign * (ring[:, axis] - bound), sign * (after[:, axis] - bound)
    crosses = dp * dq < 0
    t = np.divide(dp, dp - dq, out=np.zeros(len(dp)), where=crosses)
    met = ring + t[:, None] * (after - ring)
    return np.stack([ring, met], 1).reshape(-1, 2)[np.stack([dp >= 0, crosses], 1).ravel()]


def area(ring: np.ndarray) -> float:
    x, y = ring.T
    return abs(float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum())) / 2


def area_in_square(rings: list[np.ndarray], west: float, south: float, side: float) -> float:
    total = 0.0
    for n, ring in enumerate(rings):
        for axis, low in ((0, west), (1, south)):
            if len(ring):
                ring = cut(ring, axis, low, True)
            if len(ring):
                ring = cut(ring, axis, low + side, False)
        total += area(ring) * (-1 if n else 1) if len(ring) else 0.0
    return total


def _column_cells(rings: list[np.ndarray], i: int) -> list[tuple[int, float]]:
    """(row of cells, area) of a polygon in one column of cells, cut to the column once."""
    strip = [cut(cut(r, 0, i * CELL_M, True), 0, (i + 1) * CELL_M, False) if len(r) else r for r in rings]
    ys = np.concatenate([r[:, 1] for r in strip if len(r)] or [np.zeros(0)])
    if not len(ys):
        return []
    rows = range(int(np.floor(ys.min() / CELL_M)), int(np.floor(ys.max() / CELL_M)) + 1)
    return [(j, area_in_square(strip, i * CELL_M, j * CELL_M, CELL_M)) for j in rows]


def _overlaps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(r.district, r.dong_code, r.dong_name, r.i, j, a) for r in b.itertuples() for j, a in _column_cells(ring_arrays(r.rings), r.i)]
        yield pd.DataFrame(rows, columns=["district", "dong_code", "dong_name", "i", "j", "area"])


def grid_cells(polygons: DataFrame) -> DataFrame:
    """Cells of polygons (district, dong_code, dong_name, rings in metres): each with its share inside, and the dong with most of it.

    Each polygon is first spread over the columns of cells it touches, which deals the cutting out.  Areas within TIE of
    the largest tie, and the least code then name wins.
    """
    x = F.transform(F.flatten("rings"), lambda p: p["x"])
    columns = polygons.select("district", "dong_code", "dong_name", "rings", F.explode(F.sequence(cell_index(F.array_min(x)), cell_index(F.array_max(x)))).alias("i"))
    cut = columns.repartition("dong_code", "i").mapInPandas(_overlaps, "district string, dong_code string, dong_name string, i long, j long, area double").filter("area > 0")
    by_cell = Window.partitionBy("i", "j")
    tied = F.when(F.col("area") >= F.max("area").over(by_cell) - TIE, 0).otherwise(1)
    place = F.row_number().over(by_cell.orderBy("_tied", "dong_code", "dong_name"))
    inside = F.sum("area").over(by_cell)
    return (
        cut.withColumn("_tied", tied)
        .withColumns({"inside_area": inside, "_place": place})
        .filter("_place = 1")
        .select(F.concat_ws("_", F.lit("g5174_500"), "i", "j").alias("grid_id"), "district", "dong_code", "dong_name", "inside_area", (F.col("inside_area") / CELL_M**2).alias("share"))
    )


def grid_problems(cells: DataFrame, expected: DataFrame, least: float = 1e-9) -> DataFrame:
    """(problem, district) of a grid: the cells' areas of each district must make up the area it should have (district, area), none more, none less."""
    got = cells.groupBy("district").agg(F.sum("inside_area").alias("covered"))
    both = expected.join(got, "district", "full_outer")
    share = F.coalesce(F.col("covered"), F.lit(0.0)) / F.col("area")
    kind = F.when(F.col("area").isNull(), "unknown_district").when(F.abs(share - 1) > least, "area_differs")
    return both.select(kind.alias("problem"), "district").filter("problem IS NOT NULL")


_EDGES = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def _cells_of_band(b: pd.DataFrame) -> pd.DataFrame:
    """The cells of one polygon in one row of cells, from its edges there in ring order, with their cell indexes.

    Edges left of a cell don't meet a ray to the right, and those over it are listed.  A chain of edges right of it is met oddly often by a ray at y
    exactly if one of its two ends lies above y; an end in another row does so for all y or for none, which goes into `odd`, and an end in this row is
    listed in `above`.
    """
    b = b.sort_values(["ring", "k"])
    y = b[["y1", "y2"]].to_numpy()
    row = b[["j1", "j2"]].to_numpy()
    low, high, j = b[["i1", "i2"]].min(axis=1).to_numpy(), b[["i1", "i2"]].max(axis=1).to_numpy(), int(b.j.iloc[0])
    follows = np.zeros(len(b), bool)
    follows[1:] = (np.diff(b.ring) == 0) & (np.diff(b.k) == 1)
    edges = b[["x1", "y1", "x2", "y2"]].to_dict("records")
    out = []
    for i in range(int(low.min()), int(high.max()) + 1):
        right, over = low > i, (low <= i) & (high >= i)
        start = np.flatnonzero(right & ~(follows & np.roll(right, 1)))
        last = np.flatnonzero(right & ~np.append(right[1:] & follows[1:], False))
        ends, rows = np.concatenate([y[start, 0], y[last, 1]]), np.concatenate([row[start, 0], row[last, 1]])
        odd, above = bool((rows > j).sum() % 2), ends[rows == j]
        if odd or over.any():
            out.append((b["name"].iloc[0], i, j, odd, above, [edges[k] for k in np.flatnonzero(over)]))
    return pd.DataFrame(out, columns=["name", "i", "j", "odd", "above", "edges"])


def polygon_cells(polygons: DataFrame, cell: float = CELL_M) -> DataFrame:
    """(name, i, j, odd, above, edges) of the cells that polygons (name, rings) touch or hold; a cell without edges is inside.

    Edges travel as rows, each to the rows of cells that it reaches; no task sees more of a polygon than one row of cells.
    """
    at = lambda c: F.floor(F.col(c) / F.lit(cell)).cast("bigint")
    numbered = polygons.select("name", "rings", F.monotonically_increasing_id().alias("polygon"))  # before the rings become rows
    rings = numbered.select("name", "polygon", F.posexplode("rings").alias("ring", "points")).filter(F.size("points") > 0)
    n = F.size("points")
    corner = rings.select("name", "polygon", "ring", n.alias("n"), "points", F.posexplode("points").alias("k", "p"))
    edges = corner.select("name", "polygon", "ring", "k", F.col("p.x").alias("x1"), F.col("p.y").alias("y1"), F.get("points", (F.col("k") + 1) % F.col("n")).alias("q"))
    edges = edges.select("name", "polygon", "ring", "k", "x1", "y1", F.col("q.x").alias("x2"), F.col("q.y").alias("y2"))
    edges = edges.withColumns({"i1": at("x1"), "i2": at("x2"), "j1": at("y1"), "j2": at("y2")})
    bands = edges.withColumn("j", F.explode(F.sequence(F.least("j1", "j2"), F.greatest("j1", "j2"))))
    kind = polygons.schema["name"].dataType.simpleString()
    return bands.groupBy("polygon", "j").applyInPandas(_cells_of_band, f"name {kind}, i long, j long, odd boolean, above array<double>, edges {_EDGES}")


def points_in(points: DataFrame, polygons: DataFrame, cell: float = CELL_M) -> DataFrame:
    """Points (any columns, x, y) with the polygons (name, rings) that cover them: even-odd rule over all rings, edges included.

    A point meets the edges over its own cell only, in expressions; points far from any edge meet none.
    """
    at = lambda c: F.floor(c / F.lit(cell)).cast("bigint")
    cells = polygon_cells(polygons, cell).withColumnsRenamed({"i": "_i", "j": "_j"})
    joined = points.withColumns({"_i": at(F.col("x")), "_j": at(F.col("y"))}).join(cells, ["_i", "_j"])
    x, y = F.col("x"), F.col("y")
    turn = lambda e: (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
    on = F.exists("edges", lambda e: (turn(e) == 0) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))
    met = F.size(F.filter("edges", lambda e: ((e["y1"] > y) != (e["y2"] > y)) & ((turn(e) > 0) == (e["y2"] > e["y1"]))))
    times = F.col("odd").cast("int") + F.size(F.filter("above", lambda t: t > y)) + met
    return joined.filter(on | (times % 2 == 1)).drop("_i", "_j", "odd", "above", "edges")


def grid_grades(facilities: DataFrame, coverage: DataFrame) -> DataFrame:
    """Cells from facilities (grid_id, district, rooms, age, context) and each district's coordinate coverage.

    A band comes from the median, and only if every facility of the cell has the value; under 0.8 coverage nothing is graded;
    a cell with a score of fewer than three has the grade small_sample.
    """
    whole = lambda c: F.when(F.count(c) == F.count(F.lit(1)), F.median(c))
    cells = facilities.groupBy("grid_id", "district").agg(F.count(F.lit(1)).alias("n_facilities"), whole("rooms").alias("rooms"), whole("age").alias("age"), F.min("context").alias("context"))
    graded = cells.join(coverage, "district", "left").withColumn("_c", composite(room_rating(F.col("rooms")), age_rating(F.col("age")), F.col("context")))
    enough = F.coalesce(F.col("coverage") >= 0.8, F.lit(False))
    score = F.when(enough, F.col("_c.score"))
    return graded.select(
        "grid_id", "district", "n_facilities", "rooms", "age", "coverage", score.alias("score"),
        F.when(~enough, "insufficient_evidence").when(score.isNotNull() & (F.col("n_facilities") < 3), "small_sample").otherwise(F.col("_c.grade")).alias("grade"),
    )


def quarantined(mapped: DataFrame, observed: DataFrame) -> DataFrame:
    """Districts in which more facilities were mapped than observed."""
    return mapped.join(observed, "district").filter("n_mapped > n_observed")
