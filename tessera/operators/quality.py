"""Quality checks as rows (name, status, actual, expected, severity), and gates that fail closed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLUMNS = ("check_name", "status", "actual", "expected", "severity")


@dataclass(frozen=True)
class Check:
    """An aggregate and what it must reach; a null aggregate fails."""

    name: str
    actual: Column
    least: float | None = None
    most: float | None = None
    severity: str = "required"


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks of a table in one pass over it."""
    measured = df.agg(*(c.actual.cast("double").alias(f"c{i}") for i, c in enumerate(checks)))

    def row(i: int, c: Check) -> Column:
        v = F.col(f"c{i}")
        good = F.lit(True)
        if c.least is not None:
            good = good & (v >= c.least)
        if c.most is not None:
            good = good & (v <= c.most)
        expected = " and ".join(x for x in (c.least is not None and f">={c.least:g}", c.most is not None and f"<={c.most:g}") if x)
        fine = F.coalesce(good & v.isNotNull(), F.lit(False))
        return F.struct(F.lit(c.name).alias("check_name"), F.when(fine, "pass").otherwise("warning" if c.severity == "warning" else "fail").alias("status"), v.alias("actual"), F.lit(expected).alias("expected"), F.lit(c.severity).alias("severity"))

    return measured.select(F.explode(F.array(*(row(i, c) for i, c in enumerate(checks)))).alias("c")).select("c.*")


def schema_fingerprint(rows: DataFrame, group: Sequence[str], payload: str) -> DataFrame:
    """SHA-256 of the sorted distinct field names of each group's JSON objects, with the number of fields."""
    names = rows.select(*group, F.explode(F.json_object_keys(payload)).alias("_field")).distinct()
    fields = F.array_sort(F.collect_list("_field"))
    return names.groupBy(*group).agg(F.count(F.lit(1)).alias("n_fields"), F.sha2(F.array_join(fields, ","), 256).alias("fingerprint"))


def fingerprint_check(observed: DataFrame, approved: DataFrame, group: Sequence[str]) -> DataFrame:
    """Each observed group passes only with exactly the approved fingerprint."""
    known = approved.select(*group, F.col("fingerprint").alias("approved"))
    return observed.join(known, list(group), "left").withColumn("status", F.when(F.col("fingerprint") == F.col("approved"), "pass").otherwise("fail"))


def page_completeness(pages: DataFrame, keys: Sequence[str], page: str, size: int, total: str, received: str) -> DataFrame:
    """Per partition: pages expected and seen, drift of the total, rows received; complete if all agree."""
    pages_due = F.greatest(F.lit(1), F.ceil(F.max(total) / F.lit(size))).cast("bigint")
    counted = pages.groupBy(*keys).agg(
        F.count_distinct(page).alias("pages_seen"), pages_due.alias("pages_due"), (F.min(total) == F.max(total)).alias("steady"),
        F.sum(received).alias("received"), F.max(total).alias("total"), F.max(page).alias("last_page"), F.count(F.lit(1)).alias("_rows"),
    )
    whole = F.col("steady") & (F.col("pages_seen") == F.col("pages_due")) & (F.col("last_page") == F.col("pages_due")) & (F.col("received") == F.col("total")) & (F.col("_rows") == F.col("pages_seen"))
    return counted.withColumn("complete", F.coalesce(whole, F.lit(False))).drop("_rows")


def content_hashes(files: DataFrame, recorded: DataFrame) -> DataFrame:
    """Files (path, content) against recorded (path, content_hash): pass only for the same bytes."""
    hashed = files.select("path", F.sha2("content", 256).alias("actual_hash"))
    return recorded.join(hashed, "path", "left").withColumn("status", F.when(F.col("actual_hash") == F.col("content_hash"), "pass").otherwise("fail"))


def freshness(df: DataFrame, keys: Sequence[str], day: str, as_of: str, most_days: int = 75) -> DataFrame:
    """Age in days of each key's newest row; a row from the future never passes."""
    age = F.datediff(F.lit(as_of).cast("date"), F.max(day).cast("date"))
    return df.groupBy(*keys).agg(age.alias("age_days"), F.when(age.between(0, most_days), "pass").otherwise("fail").alias("status"))


def suite_hash(checks: DataFrame) -> DataFrame:
    """One digest of the checks, in order of their names (a suite has tens of rows)."""
    line = F.to_json(F.struct(*COLUMNS), {"ignoreNullFields": "false"})
    return checks.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("suite_hash"), F.count(F.lit(1)).alias("n_checks"))


def gate(checks: DataFrame, canonical: Sequence[str]) -> DataFrame:
    """One row (publishable, n_missing, n_failed): every named check must be there, and no required one fail."""
    spark = checks.sparkSession
    due = spark.createDataFrame([(n,) for n in canonical], "check_name string")
    joined = due.join(checks, "check_name", "full_outer")
    failed = F.count_if((F.col("severity") == "required") & (F.col("status") != "pass"))
    absent = F.count_if(F.col("status").isNull())
    return joined.agg((absent + failed == 0).alias("publishable"), absent.alias("n_missing"), failed.alias("n_failed"))


def as_checks(df: DataFrame, name: str, actual: str, expected: str, severity: str = "warning", status: str = "status") -> DataFrame:
    """Rows with a status of their own (pass, warning, fail or skipped) in the shape of `run_checks`, for the suite and the gate."""
    return df.select(F.lit(name).alias("check_name"), F.col(status).alias("status"), F.col(actual).cast("double").alias("actual"), F.lit(expected).alias("expected"), F.lit(severity).alias("severity"))


def all_checks(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, (p.select(*COLUMNS) for p in parts))


# The authorities whose licences count, and the overall status codes.
AUTHORITIES = tuple(str(n) for n in range(3250000, 3410000, 10000))
STATUS_CODES = ("01", "02", "03", "04")


def register_coverage(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, and the parts of them with a known authority, all dates and a known status, by keys; each must be all of them.

    A closed or cancelled licence needs its closure date.
    """
    c = F.col
    parsed = lambda day: c(day).isNotNull() & (c(f"{day.removesuffix('_on')}_date_quality" if day.endswith("_on") else f"{day}_quality") == "parsed")
    dates = parsed("license_date") & parsed("source_modified_on") & parsed("data_updated_on")
    closed = ~c("status_code").isin("03", "04") | parsed("closure_date")
    status = c("status_code").isin(*STATUS_CODES) & (c("status_class") != "unknown") & c("detailed_status_code").isNotNull() & c("detailed_status_name").isNotNull() & closed
    n = F.count(F.lit(1))
    counts = [n.alias("n_rows"), *(F.count_if(x).alias(name) for name, x in (("jurisdiction", c("jurisdiction_code").isin(*AUTHORITIES)), ("dates", dates), ("status", status)))]
    out = records.groupBy(*keys).agg(*counts)
    whole = {f"{name}_coverage": F.try_divide(c(name), c("n_rows")) for name in ("jurisdiction", "dates", "status")}
    good = (c("n_rows") > 0) & (c("jurisdiction") == c("n_rows")) & (c("dates") == c("n_rows")) & (c("status") == c("n_rows"))
    return out.withColumns(whole).withColumn("status_of_check", F.when(good, "pass").otherwise("fail")).drop("jurisdiction", "dates", "status")


def designation_coverage(designations: DataFrame, linked: DataFrame, reviewed: DataFrame, key: str = "key") -> DataFrame:
    """One row: designations that are linked or explicitly under review, of all; none at all is skipped."""
    flag = lambda df, name: df.select(key, F.lit(True).alias(name)).distinct()
    j = designations.select(key).distinct().join(flag(linked, "_l"), key, "left").join(flag(reviewed, "_r"), key, "left")
    n, by_link = F.count(F.lit(1)), F.count("_l")
    explicit = F.count_if(F.col("_l").isNull() & F.col("_r").isNotNull())
    out = j.agg(n.alias("designations"), by_link.alias("linked"), explicit.alias("explicit_reviews"))
    coverage = F.try_divide(F.col("linked") + F.col("explicit_reviews"), F.col("designations"))
    return out.withColumn("coverage", coverage).withColumn("status", F.when(F.col("designations") == 0, "skipped").when(coverage < 1, "warning").otherwise("pass"))


def active_change(current: DataFrame, published: DataFrame, most: float = 0.20) -> DataFrame:
    """One row each (n): the change of the number of active facilities against the publication; none without one above 0."""
    both = current.select(F.col("n").alias("current")).crossJoin(published.filter("n > 0").select(F.col("n").alias("previous")))  # one row each
    change = F.abs(F.col("current") - F.col("previous")) / F.col("previous")
    return both.select("current", "previous", change.alias("change"), F.when(change <= most, "pass").otherwise("warning").alias("status"))


def calibration_notice(labelled: DataFrame) -> DataFrame:
    """Automatic merges stay for review until labelled pairs were evaluated: an informational row that says whether there are any."""
    return labelled.agg(F.count(F.lit(1)).alias("n_pairs")).select(
        F.lit("entity_auto_merge_calibration").alias("check_name"), F.when(F.col("n_pairs") == 0, "skipped").otherwise("available").alias("status"), "n_pairs", F.lit("informational").alias("severity")
    )


def preferred(df: DataFrame, keys: Sequence[str], choice: str, wanted: Column) -> DataFrame:
    """Of the rows whose `choice` is the wanted one or '*', one a key: the exact one before the general."""
    from tessera.operators.latest import latest

    return latest(df.filter((F.col(choice) == wanted) | (F.col(choice) == "*")), keys, [F.when(F.col(choice) == wanted, 0).otherwise(1)])


# What no published text may hold, namely drive and share paths, absolute paths, climbing paths, addresses and credentials.
UNSAFE = (
    r"(?:[A-Za-z]:[\\/]|\\\\[^\\/\s]+[\\/])",
    r"(?<![A-Za-z0-9])/(?:[A-Za-z0-9._~-]+(?:/|$))",
    r"(?:^|[\\/])\.\.(?:[\\/]|$)",
    r"(?i)(?:https?|ftp|file)://|\bwww\.",
    r"(?i)(?:password|passwd|secret|token|api[_-]?key|servicekey|authorization)\s*[:=]\s*\S+|\bbearer\s+[A-Za-z0-9._~+/=-]+|\b(?:sk|pk)_(?:live|test)_[A-Za-z0-9]+|\bgh[pousr]_[A-Za-z0-9]{20,255}\b|\bAKIA[0-9A-Z]{16}\b|\bsk-[A-Za-z0-9_-]{16,}\b|\bAIza[0-9A-Za-z_-]{30,}\b|\beyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]{8,}\b|\bglpat-[A-Za-z0-9_-]{8,}\b|\b(?:xox[a-z]?|xapp)-[A-Za-z0-9-]{8,}\b",
)


def public_text(text: Column) -> Column:
    """Whether a text may be published: not empty, and no path, address, climbing path or credential in it; null is not."""
    fine = F.length(text) > 0
    for pattern in UNSAFE:
        fine = fine & ~text.rlike(pattern)
    return F.coalesce(fine, F.lit(False))


def public_number(value: Column, most: float | None = None) -> Column:
    """Whether a number may be published: null, or finite, not negative and at most `most`."""
    v = value.cast("double")
    fine = ~F.isnan(v) & (F.abs(v) < float("inf")) & (v >= 0)
    if most is not None:
        fine = fine & (v <= most)
    return v.isNull() | fine


def public_position(lon: Column, lat: Column) -> Column:
    return F.coalesce(lon.between(-180, 180) & lat.between(-90, 90), F.lit(False))
