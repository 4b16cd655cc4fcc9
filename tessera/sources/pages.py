"""API pages (JSON or XML envelopes), their paging rules, and the newest revision of a catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.parsing import blank_to_null

# Fixed values of the portals' result codes.
AUTH_CODES = ("20", "30", "31")
QUOTA_CODES = ("22", "23")

ROW = "map<string,string>"


def json_rows(body: Column) -> Column:
    """Rows of a page as maps: `data`, `body.data` or `body.items.item` (with or without an outer `response`); one object counts as a list of one."""
    found = [F.get_json_object(body, f"$.{head}{path}") for head in ("", "response.") for path in ("data", "body.data", "body.items.item")]
    text = F.coalesce(*found)
    as_list = F.when(F.ltrim(text).startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    return F.coalesce(F.from_json(as_list, f"array<{ROW}>"), F.array().cast(f"array<{ROW}>"))


def json_total(body: Column) -> Column:
    names = ("totalCount", "body.totalCount", "response.body.totalCount")
    return F.coalesce(*(F.get_json_object(body, f"$.{n}").try_cast("bigint") for n in names))


def xml_rows(body: Column, fields: str) -> Column:
    """Items of an XML page; `fields` is the item's schema."""
    page = F.from_xml(body, f"body struct<items:struct<item:array<struct<{fields}>>>,totalCount:bigint>")
    return F.coalesce(page["body"]["items"]["item"], F.array().cast(f"array<struct<{fields}>>"))


def parsed_pages(pages: DataFrame, body: str) -> DataFrame:
    """Adds rows, received, total and state: ok, empty (a total of 0 says so), or malformed."""
    out = pages.withColumn("rows", json_rows(F.col(body))).withColumn("total", json_total(F.col(body)))
    received = F.size("rows")
    state = F.when(F.col("total").isNull(), "malformed").when((F.col("total") == 0) & (received == 0), "empty").when(received == 0, "malformed").otherwise("ok")
    return out.withColumns({"received": received.cast("bigint"), "state": state})


def exploded(pages: DataFrame, keep: list[str]) -> DataFrame:
    return pages.select(*keep, F.explode("rows").alias("row"))


def source_state(http_status: Column, result_code: Column, total: Column, resolved: Column | None = None) -> Column:
    """What a probe of a source says; resolved: whether its address is known at all."""
    return (
        F.when(F.lit(False) if resolved is None else ~F.coalesce(resolved, F.lit(False)), "SPEC_UNRESOLVED")
        .when(result_code.isin(*AUTH_CODES) | http_status.isin(401, 403), "AUTH_FAILED")
        .when(result_code.isin(*QUOTA_CODES) | (http_status == 429), "QUOTA_EXCEEDED")
        .when(http_status != 200, "HTTP_FAILED")
        .when(total.isNull(), "SCHEMA_CHANGED")
        .when(total == 0, "EMPTY")
        .otherwise("READY")
    )


def newest_catalogue(revisions: DataFrame, dataset: str) -> DataFrame:
    """Of (dataset, data_as_of, uddi): the newest date, then the greatest id; undated revisions are the oldest."""
    place = F.struct(F.coalesce("data_as_of", F.lit("0001-01-01").cast("date")), F.col("uddi"))
    return revisions.groupBy(dataset).agg(F.max_by("uddi", place).alias("uddi"), F.max("data_as_of").alias("data_as_of"))


def alias_key(name: str) -> str:
    return "".join(c for c in name.casefold() if c.isalnum())


def aliased(df: DataFrame, aliases: dict[str, tuple[str, ...]], row: str = "row") -> DataFrame:
    """Logical columns from a map of provider fields: names are compared without case and punctuation, the first filled alias
    of a column wins, and what no alias names is kept in `extra`."""
    plain = F.transform_keys(row, lambda k, _: F.regexp_replace(F.lower(k), r"[^\p{L}\p{N}]", ""))
    known = {alias_key(a) for names in aliases.values() for a in names}
    out = df.withColumn("_row", plain)
    picked = {
        column: blank_to_null(F.coalesce(*(F.nullif(F.try_element_at("_row", F.lit(alias_key(a))), F.lit("")) for a in names)))
        for column, names in aliases.items()
    }
    return out.withColumns(picked).withColumn("extra", F.map_filter("_row", lambda k, _: ~k.isin(*known))).drop("_row")
