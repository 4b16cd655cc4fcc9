"""Writing: raw artifacts, idempotent appends, replacing a run's rows, exports with a manifest, the published run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.aggregates import table_digest
from tessera.operators.latest import latest
from tessera.operators.quality import suite_hash


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _one_of_each(df: DataFrame, keys: Sequence[str], newest: Sequence[Column] = ()) -> DataFrame:
    rest = [F.to_json(F.struct(c), {"ignoreNullFields": "false"}) for c in df.columns if c not in keys]
    return latest(df, keys, [*newest, *rest]) if rest or newest else df.distinct()


def upsert(df: DataFrame, path: str, keys: Sequence[str], newest: Sequence[Column], part: str) -> None:
    """Rows by key, new ones over old: the partitions (by `part`, which follows from the key) that df touches are written anew.

    Of equal keys in df the first by `newest` counts.  Rows that only the store has stay.
    """
    fresh = _one_of_each(df, keys, newest)
    spark = df.sparkSession
    if exists(spark, path):
        old = spark.read.parquet(path).join(fresh.select(part).distinct(), part, "left_semi").join(fresh.select(*keys), list(keys), "left_anti")
        fresh = fresh.unionByName(old.select(*fresh.columns))
        staged = f"{path.rstrip('/')}_staged"
        fresh.write.mode("overwrite").parquet(staged)  # what is overwritten can't be read at the same time
        fresh = spark.read.schema(fresh.schema).parquet(staged)
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def append_new(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Appends rows whose key isn't there; of equal keys the least row by its other columns, so a second call adds nothing and reruns agree."""
    fresh = _one_of_each(df, keys)
    if exists(df.sparkSession, path):
        fresh = fresh.join(df.sparkSession.read.parquet(path).select(*keys), list(keys), "left_anti")
    fresh.write.mode("append").parquet(path)


def replace_run(df: DataFrame, path: str, run: str = "run_id") -> None:
    """Overwrites the partitions of the runs in df and no other."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(run).parquet(path)


def write_artifacts(pages: DataFrame, path: str, body: str = "body") -> None:
    """Raw bodies with their SHA-256, by source and day; the same body of a source and day is kept once."""
    hashed = pages.withColumns({"content_hash": F.sha2(F.col(body).cast("binary"), 256), "n_bytes": F.octet_length(body).cast("bigint")})
    keys = ["source_id", "ingest_date", "content_hash"]
    fresh = _one_of_each(hashed, keys)
    if exists(pages.sparkSession, path):
        fresh = fresh.join(pages.sparkSession.read.parquet(path).select(*keys), keys, "left_anti")
    fresh.write.mode("append").partitionBy("source_id", "ingest_date").parquet(path)


# What marks a name as secret, in its letters and digits.
SECRET_MARKS = ("servicekey", "apikey", "token", "auth", "secret", "password", "credential")


def redacted(df: DataFrame, column: str) -> DataFrame:
    """A map's values under secret-like keys replaced, also inside values that are JSON objects or arrays."""
    secret = lambda k: F.regexp_replace(F.lower(k), r"[^\p{L}\p{N}]", "").rlike("|".join(SECRET_MARKS))
    inner = lambda v: F.when(v.rlike(r"^\s*[\[{]"), redacted_json(v)).otherwise(v)
    return df.withColumn(column, F.transform_values(column, lambda k, v: F.when(secret(k), "[redacted]").otherwise(inner(v))))


def redacted_json(text: Column) -> Column:
    """JSON text with every value under a secret-like name replaced: strings, numbers, literals, and objects or arrays without others in them."""
    chars = r'(?:[^"\\]|\\.)*'
    marks = "|".join(r'[^\p{L}\p{N}"]*'.join(m) for m in SECRET_MARKS)
    name = rf'("{chars}(?i:{marks}){chars}"\s*:\s*)'
    for value in (r"(?:\{[^{}]*\}|\[[^\[\]]*\])", rf'(?:"{chars}"|[-+0-9.eE]+|true|false|null)'):
        text = F.regexp_replace(text, name + value, '$1"[redacted]"')
    return text


def checked_artifacts(spark: SparkSession, path: str, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(sound, quarantined) raw bodies: a body whose SHA-256 or size isn't what was recorded is set apart with the reason."""
    stored = spark.read.parquet(path)
    actual = F.sha2(F.col(body).cast("binary"), 256)
    reason = F.when(~actual.eqNullSafe(F.col("content_hash")), "hash_mismatch").when(~F.octet_length(body).eqNullSafe(F.col("n_bytes")), "size_mismatch")
    judged = stored.withColumn("reason", reason)
    return judged.filter("reason IS NULL").drop("reason"), judged.filter("reason IS NOT NULL")


def export_spatial(cells: DataFrame, facilities: DataFrame, folder: str, cell_geometry: str = "geometry") -> DataFrame:
    """The bundle of a spatial run: cells and facilities as GeoJSON features and CSV, cells as Parquet, then the manifest.

    facilities: with lon and lat, published to nine decimals.  Features are one a line, for a collection in one line would
    pass through one task.
    """
    lon, lat = (F.round(c, 9) for c in ("lon", "lat"))
    point = F.concat(F.lit('{"type":"Point","coordinates":['), lon, F.lit(","), lat, F.lit("]}"))
    parts = {"cells": (cells, F.col(cell_geometry), [c for c in cells.columns if c != cell_geometry]), "facilities": (facilities, point, [c for c in facilities.columns if c not in ("lon", "lat")])}
    for name, (df, geometry, properties) in parts.items():
        geojson_features(df.withColumn("_geometry", geometry), "_geometry", properties).write.text(f"{folder}/{name}.geojsonl")
    return export({name: df.select(*properties) for name, (df, _, properties) in parts.items()}, folder)


def export(tables: dict[str, DataFrame], folder: str) -> DataFrame:
    """Parquet and CSV of each table, then the manifest (name, n_rows, digest), written last so that it marks a whole export."""
    manifest = None
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
        stored = df.sparkSession.read.parquet(f"{folder}/{name}.parquet")
        stored.write.csv(f"{folder}/{name}.csv", header=True)
        row = table_digest(stored, sorted(stored.columns)).withColumn("name", F.lit(name))
        manifest = row if manifest is None else manifest.unionByName(row)
    manifest.write.json(f"{folder}/manifest")
    return manifest


def verify_export(spark: SparkSession, folder: str) -> DataFrame:
    """Each table of the manifest with status pass or fail, computed anew from its Parquet."""
    out = None
    for m in spark.read.json(f"{folder}/manifest").collect():  # one row a table
        stored = spark.read.parquet(f"{folder}/{m['name']}.parquet")
        row = table_digest(stored, sorted(stored.columns)).select(F.lit(m["name"]).alias("name"), F.when((F.col("digest") == m.digest) & (F.col("n_rows") == m.n_rows), "pass").otherwise("fail").alias("status"))
        out = row if out is None else out.unionByName(row)
    return out


def geojson_features(df: DataFrame, geometry: str, properties: Sequence[str]) -> DataFrame:
    """One GeoJSON feature a row; `geometry` holds GeoJSON text."""
    body = F.concat(F.lit('{"type":"Feature","geometry":'), F.col(geometry), F.lit(',"properties":'), F.to_json(F.struct(*properties), {"ignoreNullFields": "false"}), F.lit("}"))
    return df.select(body.alias("value"))


def publish(spark: SparkSession, path: str, run_id: str, as_of: str, gate: DataFrame, reason: str | None = None, suite: tuple[DataFrame, str] | None = None) -> None:
    """Appends to the publication log if the gate lets the run pass; an older date than the current one needs a reason.

    suite: the checks as they are now, and the hash under which they were recorded; checks that changed since block the run.
    The current run is the newest entry.  Two publishers at the same time aren't kept apart: that needs a table format
    with transactions.
    """
    if not gate.first().publishable:
        raise ValueError(f"run {run_id} is blocked by its quality gate")
    if suite is not None and suite_hash(suite[0]).first().suite_hash != suite[1]:
        raise ValueError(f"the checks of run {run_id} are not those that were recorded")
    n = 0
    if exists(spark, path):
        now = spark.read.parquet(path).orderBy(F.desc("sequence")).first()
        n = now.sequence + 1
        if as_of < now.as_of and not reason:
            raise ValueError(f"{as_of} is before the published {now.as_of}")
    spark.createDataFrame([(n, run_id, as_of, reason)], "sequence long, run_id string, as_of string, reason string").coalesce(1).write.mode("append").parquet(path)


def current_run(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).orderBy(F.desc("sequence")).limit(1)
