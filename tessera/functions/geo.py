"""Distances, map projection and grid cells as column expressions.

The projection is the public transverse Mercator series on the Bessel 1841 ellipsoid with a seven-parameter
shift to WGS84 (position vector).  Other software may choose other shift parameters for EPSG:5174 and differ by
metres; `projected` and `geographic` agree with each other to a centimetre.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0
CELL_M = 500
# Fixed values of EPSG:5174 and of WGS84.
BESSEL_A, BESSEL_F = 6377397.155, 1 / 299.1528128
WGS_A, WGS_F = 6378137.0, 1 / 298.257223563
LAT0, LON0, FALSE_X, FALSE_Y = math.radians(38), math.radians(127.0028902777778), 200000.0, 500000.0
SHIFT = (-115.80, 474.99, 674.11)
TURN = tuple(math.radians(x / 3600) for x in (1.16, -2.31, -1.63))
SCALE = 1 + 6.43e-6


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Metres between points within 124..132 E and 33..39 N; null for others."""
    inside = F.lit(True)
    for lon, lat in ((lon1, lat1), (lon2, lat2)):
        inside = inside & lon.between(124, 132) & lat.between(33, 39)
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.when(inside, 2 * EARTH_RADIUS_M * F.asin(F.least(F.lit(1.0), F.sqrt(h))))


def cell_index(metres: Column) -> Column:
    """Half-open cells: a point on the west or south edge belongs to the cell that begins there."""
    return F.floor(metres / CELL_M).cast("bigint")


def grid_id(x: Column, y: Column) -> Column:
    return F.concat_ws("_", F.lit("g5174_500"), cell_index(x), cell_index(y))


def _meridian(f: float) -> tuple[float, ...]:
    n = f / (2 - f)
    return (1 + n**2 / 4 + n**4 / 64, 3 * n / 2 - 9 * n**3 / 16, 15 * n**2 / 16 - 15 * n**4 / 32, 35 * n**3 / 48, 315 * n**4 / 512)


def _arc(lat, sin) -> Column | float:
    """Length along the meridian from the equator."""
    c = _meridian(BESSEL_F)
    n = BESSEL_F / (2 - BESSEL_F)
    return BESSEL_A / (1 + n) * (lat * c[0] - sin(2 * lat) * c[1] + sin(4 * lat) * c[2] - sin(6 * lat) * c[3] + sin(8 * lat) * c[4])


def let(values: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """The body over a struct of values that are each computed once, where plain expressions would repeat them without end."""
    return F.element_at(F.transform(F.array(F.struct(*(v.alias(n) for n, v in values.items()))), body), 1)


def _to_space(lon: Column, lat: Column, a: float, f: float, then: Callable[[Column, Column, Column], Column]) -> Column:
    e2 = f * (2 - f)
    trig = {"slon": F.sin(lon), "clon": F.cos(lon), "s": F.sin(lat), "c": F.cos(lat)}
    return let(trig, lambda t: let({"n": F.lit(a) / F.sqrt(1 - e2 * t["s"] * t["s"]), "t": t}, lambda v: then(v["n"] * v["t"]["c"] * v["t"]["clon"], v["n"] * v["t"]["c"] * v["t"]["slon"], v["n"] * (1 - e2) * v["t"]["s"])))


def _from_space(x: Column, y: Column, z: Column, a: float, f: float, then: Callable[[Column, Column], Column]) -> Column:
    """Bowring's closed form, exact to far below a millimetre at the ground; `then` gets longitude and latitude."""
    e2, b = f * (2 - f), a * (1 - f)

    def turned(v: Column) -> Column:
        return let({"turn": F.atan2(v["z"] * a, v["p"] * b), "v": v}, lambda w: then(F.atan2(w["v"]["y"], w["v"]["x"]), F.atan2(w["v"]["z"] + e2 / (1 - e2) * b * F.pow(F.sin(w["turn"]), 3), w["v"]["p"] - e2 * a * F.pow(F.cos(w["turn"]), 3))))

    return let({"x": x, "y": y, "z": z}, lambda v: let({"p": F.sqrt(v["x"] * v["x"] + v["y"] * v["y"]), "x": v["x"], "y": v["y"], "z": v["z"]}, turned))


def projected(lon: Column, lat: Column) -> Column:
    """WGS84 degrees to struct (x, y) in metres of EPSG:5174."""
    rx, ry, rz = TURN
    e2 = BESSEL_F * (2 - BESSEL_F)
    second = e2 / (1 - e2)

    def shifted(x: Column, y: Column, z: Column) -> Column:
        moved = {n: (v - t) / SCALE for n, v, t in zip("xyz", (x, y, z), SHIFT, strict=True)}
        return let(moved, lambda m: _from_space(m["x"] + rz * m["y"] - ry * m["z"], m["y"] - rz * m["x"] + rx * m["z"], m["z"] + ry * m["x"] - rx * m["y"], BESSEL_A, BESSEL_F, flat))

    def flat(lon1: Column, lat1: Column) -> Column:
        return let({"lon": lon1, "lat": lat1}, lambda p: let({"sin": F.sin(p["lat"]), "cos": F.cos(p["lat"]), "tan": F.tan(p["lat"]), "p": p}, series))

    def series(v: Column) -> Column:
        made = {"n": F.lit(BESSEL_A) / F.sqrt(1 - e2 * v["sin"] * v["sin"]), "t": v["tan"] * v["tan"], "c": second * v["cos"] * v["cos"], "a": (v["p"]["lon"] - LON0) * v["cos"], "tan": v["tan"], "lat": v["p"]["lat"]}
        return let(made, placed)

    def placed(v: Column) -> Column:
        n, t, c, a = v["n"], v["t"], v["c"], v["a"]
        east = n * (a + (1 - t + c) * F.pow(a, 3) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * second) * F.pow(a, 5) / 120)
        north = _arc(v["lat"], F.sin) - _arc(LAT0, math.sin) + n * v["tan"] * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * F.pow(a, 4) / 24 + (61 - 58 * t + t * t + 600 * c - 330 * second) * F.pow(a, 6) / 720)
        return F.struct((east + FALSE_X).alias("x"), (north + FALSE_Y).alias("y"))

    return let({"lon": F.radians(lon), "lat": F.radians(lat)}, lambda p: _to_space(p["lon"], p["lat"], WGS_A, WGS_F, shifted))


def geographic(x: Column, y: Column) -> Column:
    """Metres of EPSG:5174 to struct (lon, lat) in WGS84 degrees."""
    e2, third = BESSEL_F * (2 - BESSEL_F), BESSEL_F / (2 - BESSEL_F)
    second = e2 / (1 - e2)
    rx, ry, rz = TURN

    def footed(m: Column) -> Column:
        mu = m["mu"]
        foot = mu + (3 * third / 2 - 27 * third**3 / 32) * F.sin(2 * mu) + (21 * third**2 / 16 - 55 * third**4 / 32) * F.sin(4 * mu) + 151 * third**3 / 96 * F.sin(6 * mu) + 1097 * third**4 / 512 * F.sin(8 * mu)
        return let({"foot": foot, "x": m["x"]}, lambda v: let({"sin": F.sin(v["foot"]), "cos": F.cos(v["foot"]), "tan": F.tan(v["foot"]), "foot": v["foot"], "x": v["x"]}, radii))

    def radii(v: Column) -> Column:
        return let({"w": 1 - e2 * v["sin"] * v["sin"], "v": v}, lambda u: let({"n": F.lit(BESSEL_A) / F.sqrt(u["w"]), "r": BESSEL_A * (1 - e2) / F.pow(u["w"], 1.5), "t": u["v"]["tan"] * u["v"]["tan"], "c": second * u["v"]["cos"] * u["v"]["cos"], "d": (u["v"]["x"] - FALSE_X) / (F.lit(BESSEL_A) / F.sqrt(u["w"])), "tan": u["v"]["tan"], "cos": u["v"]["cos"], "foot": u["v"]["foot"]}, inverse))

    def inverse(v: Column) -> Column:
        t, c, d = v["t"], v["c"], v["d"]
        lat1 = v["foot"] - v["n"] * v["tan"] / v["r"] * (d * d / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * second) * F.pow(d, 4) / 24 + (61 + 90 * t + 298 * c + 45 * t * t - 252 * second - 3 * c * c) * F.pow(d, 6) / 720)
        lon1 = LON0 + (d - (1 + 2 * t + c) * F.pow(d, 3) / 6 + (5 - 2 * c + 28 * t - 3 * c * c + 8 * second + 24 * t * t) * F.pow(d, 5) / 120) / v["cos"]
        return let({"lon": lon1, "lat": lat1}, lambda p: _to_space(p["lon"], p["lat"], BESSEL_A, BESSEL_F, shifted))

    def shifted(a: Column, b: Column, h: Column) -> Column:
        def back(p: Column) -> Column:
            moved = (p["a"] - rz * p["b"] + ry * p["h"], p["b"] + rz * p["a"] - rx * p["h"], p["h"] - ry * p["a"] + rx * p["b"])
            return _from_space(*(v * SCALE + s for v, s in zip(moved, SHIFT, strict=True)), WGS_A, WGS_F, lambda lon, lat: F.struct(F.degrees(lon).alias("lon"), F.degrees(lat).alias("lat")))

        return let({"a": a, "b": b, "h": h}, back)

    start = (y - FALSE_Y + _arc(LAT0, math.sin)) / (BESSEL_A / (1 + third) * _meridian(BESSEL_F)[0])
    return let({"mu": start, "x": x}, footed)
