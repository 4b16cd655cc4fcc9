"""File sources: discovery by name, delimited text of either encoding, place-name codes and boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.parsing import blank_to_null


def discover(spark: SparkSession, folder: str, provider: list[str], subject: list[str]) -> DataFrame:
    """Files (path, length, modificationTime) whose name holds a provider term and a subject term; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length", "modificationTime")
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    holds = lambda terms: F.exists(F.array(*(F.lit(t.lower()) for t in terms)), lambda t: F.contains(name, t))
    return files.filter(holds(provider) & holds(subject))


def file_date(name: Column) -> Column:
    """Struct (day, grain) of the date in a file name: day, month (its first day) or year; null and unknown without one."""
    part = lambda p: F.nullif(F.regexp_extract(name, p, 0), F.lit(""))
    digits = lambda c: F.regexp_replace(c, r"\D", "")
    day = F.try_to_timestamp(digits(part(r"(?<!\d)(19|20)\d{2}[-_.]?(0[1-9]|1[0-2])[-_.]?(0[1-9]|[12]\d|3[01])(?!\d)")), F.lit("yyyyMMdd")).cast("date")
    month = F.try_to_timestamp(F.concat(digits(part(r"(?<!\d)(19|20)\d{2}[-_.]?(0[1-9]|1[0-2])(?!\d)")), F.lit("01")), F.lit("yyyyMMdd")).cast("date")
    year = F.try_to_timestamp(F.concat(digits(part(r"(?<!\d)(19|20)\d{2}(?!\d)")), F.lit("0101")), F.lit("yyyyMMdd")).cast("date")
    grain = F.when(day.isNotNull(), "day").when(month.isNotNull(), "month").when(year.isNotNull(), "year").otherwise("unknown")
    return F.struct(F.coalesce(day, month, year).alias("day"), grain.alias("grain"))


def read_delimited(spark: SparkSession, folder: str, sep: str = ",") -> DataFrame:
    """CSV files with a header, each in UTF-8 or else CP949; headers must be filled and distinct.

    The contents are read once to tell encoding and header line; files that have both in common are one read, so that
    columns go by name, and a column that a file lacks is null there.  A folder without files is an error.  CP949 isn't
    among the charsets that Spark takes by itself, so a session that meets it has spark.sql.legacy.javaCharsets set.
    """
    files = spark.read.format("binaryFile").load(folder)
    text = F.col("content").cast("string")
    fine = F.is_valid_utf8(text)
    first = F.when(fine, F.split_part(text, F.lit("\n"), F.lit(1))).otherwise(F.hex(F.split_part(F.decode("content", "ISO-8859-1"), F.lit("\n"), F.lit(1))))
    kinds = files.select("path", fine.alias("utf8"), first.alias("header")).groupBy("utf8", "header").agg(F.array_sort(F.collect_list("path")).alias("paths")).orderBy("utf8", "header").collect()
    if not kinds:
        raise FileNotFoundError(f"no files in {folder}")
    if not all(kind.utf8 for kind in kinds):
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    out = None
    for kind in kinds:  # one for each encoding and header; paths are names, not contents
        part = spark.read.csv(kind.paths, header=True, sep=sep, encoding="UTF-8" if kind.utf8 else "x-windows-949", multiLine=True)
        part = part.withColumnsRenamed({c: c.lstrip("\ufeff") for c in part.columns if c.startswith("\ufeff")})
        if any(c.startswith("_c") and c[2:].isdigit() for c in part.columns) or len({c.lower() for c in part.columns}) < len(part.columns):
            raise ValueError(f"headers must be filled and distinct: {part.columns}")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


CLOSED_WORDS = ("폐지", "y", "true", "1")


def place_codes(rows: DataFrame, code: str, name: str, closed: str, prefix: str) -> DataFrame:
    """Active ten-digit codes with the prefix, one row a code; a status of any other word is active."""
    kept = rows.select(F.trim(code).alias("code"), F.trim(name).alias("name"), blank_to_null(F.col(closed)).alias("closed"))
    return kept.filter(F.col("code").rlike(rf"^{prefix}\d{{{10 - len(prefix)}}}$") & ~F.coalesce(F.lower("closed").isin(*CLOSED_WORDS), F.lit(False))).groupBy("code").agg(F.min("name").alias("name"))


_RINGS = "array<array<array<double>>>"
_FEATURES = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"


def boundaries(spark: SparkSession, path: str) -> DataFrame:
    """(district, dong_code, dong_name, rings of (x, y)) of a GeoJSON collection, closing points left out.

    A MultiPolygon is a row for each of its polygons; a geometry of another type is a row with null rings.
    """
    features = spark.read.schema(_FEATURES).json(path, multiLine=True).select(F.explode("features").alias("f"))
    said, kind = F.col("f.geometry.coordinates"), F.col("f.geometry.type")
    parts = F.when(kind == "Polygon", F.array(F.from_json(said, _RINGS))).when(kind == "MultiPolygon", F.from_json(said, f"array<{_RINGS}>"))
    ring = lambda r: F.transform(F.slice(r, 1, F.size(r) - 1), lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    flat = features.select(
        F.col("f.properties.district").alias("district"), F.col("f.properties.dong_code").alias("dong_code"), F.col("f.properties.dong_name").alias("dong_name"),
        F.explode_outer(parts).alias("part"),
    )
    return flat.select("district", "dong_code", "dong_name", F.transform("part", ring).alias("rings"))


def boundary_checks(polygons: DataFrame, districts: int, bounds: tuple[float, float, float, float]) -> DataFrame:
    """Quality rows: all districts there, rings of three points or more, within the bounds, codes distinct."""
    from tessera.operators.quality import Check, run_checks

    west, south, east, north = bounds
    points = F.flatten("rings")
    inside = F.forall(points, lambda p: p["x"].between(west, east) & p["y"].between(south, north))
    formed = F.forall("rings", lambda r: F.size(r) >= 3) & (F.size("rings") > 0)
    return run_checks(
        polygons,
        [
            Check("boundary_districts", F.count_distinct("district"), districts, districts),
            Check("boundary_rings", F.count_if(~F.coalesce(formed, F.lit(False))), most=0),
            Check("boundary_bounds", F.count_if(~F.coalesce(inside, F.lit(False))), most=0),
            Check("boundary_codes", F.count_distinct("dong_code", "district", "dong_name") - F.count_distinct("dong_code"), most=0),
        ],
    )
