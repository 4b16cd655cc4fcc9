"""Dates, numbers, codes, periods and hashes as column expressions; what can't be parsed is null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.status import padded


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def first_filled(*columns: Column) -> Column:
    """The first of the aliases that is neither null nor blank."""
    return F.coalesce(*(blank_to_null(c.cast("string")) for c in columns))


def strict_date(text: Column) -> Column:
    """yyyyMMdd, with one of - . / or nothing between the parts; other text and impossible days are null."""
    digits = F.regexp_replace(F.trim(text), r"^(\d{4})[-./]?(\d{2})[-./]?(\d{2})$", "$1$2$3")
    return F.when(digits.rlike(r"^\d{8}$"), F.try_to_timestamp(digits, F.lit("yyyyMMdd")).cast("date"))


def date_quality(text: Column) -> Column:
    return F.when(blank_to_null(text).isNull(), "missing").when(strict_date(text).isNotNull(), "parsed").otherwise("invalid")


def lenient_date(text: Column) -> Column:
    """Of the first ten characters, so that a time behind a date is ignored, but not more digits behind eight."""
    return strict_date(F.substring(F.trim(text), 1, 10))


def whole_number(text: Column) -> Column:
    """Thousands commas are allowed; parts of a whole are not."""
    plain = F.regexp_replace(F.trim(text), ",", "")
    return F.when(plain.rlike(r"^[-+]?\d+(\.0+)?$"), plain.try_cast("decimal(38,10)").try_cast("bigint"))


def number(text: Column) -> Column:
    """Thousands commas are allowed; NaN and infinities aren't numbers."""
    plain = F.regexp_replace(F.trim(text), ",", "")
    return F.when(plain.rlike(r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"), plain.try_cast("double"))


def room_count(*parts: Column) -> Column:
    """Struct (rooms, quality) of the parts' sum; a negative part makes it unknown, none known is missing."""
    values = F.filter(F.array(*parts), lambda x: x.isNotNull())
    total = F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint"))
    negative = F.exists(values, lambda x: x < 0)
    rooms = F.when(~negative & (F.size(values) > 0), total)
    quality = (
        F.when(negative, "invalid_negative").when(F.size(values) == 0, "missing").when(total == 0, "reported_zero").otherwise("reported")
    )
    return F.struct(rooms.alias("rooms"), quality.alias("quality"))


def digit_code(text: Column, width: int) -> Column:
    plain = F.trim(text)
    return F.when(plain.rlike(r"^\d+$"), padded(plain, width))


def lot_number(text: Column) -> Column:
    """'산 12 - 3' to struct (mountain '1', main '0012', sub '0003'); null where there is more than that."""
    pattern = r"^(산)?\s*(\d+)(?:\s*-\s*(\d+))?$"
    found = F.trim(text).rlike(pattern)
    part = lambda n: F.regexp_extract(F.trim(text), pattern, n)
    return F.when(
        found,
        F.struct(
            F.when(part(1) == "산", "1").otherwise("0").alias("mountain"),
            padded(part(2), 4).alias("main"),
            padded(F.when(part(3) == "", "0").otherwise(part(3)), 4).alias("sub"),
        ),
    )


def unit_tokens(text: Column) -> Column:
    """The digits of an address's floors (up to 3) and then of its rooms (up to 5), as '3|301'; null without any."""
    tokens = [F.regexp_extract_all(text, F.lit(rf"(?<!\d)(\d{{1,{n}}})\s*{kind}"), F.lit(1)) for n, kind in ((3, "층"), (5, "호"))]
    return F.nullif(F.array_join(F.concat(*tokens), "|"), F.lit(""))


def phone_digits(text: Column) -> Column:
    return F.nullif(F.regexp_replace(text, r"\D", ""), F.lit(""))


def address_key(text: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit(""))


def in_city(text: Column, city: str = "부산") -> Column:
    """Whether an address names the city as a word, with or without its suffix."""
    return F.coalesce(address_key(text).rlike(rf"(?:^|\s){city}(?:광역시|시)?(?=\s|$)"), F.lit(False))


def district_token(text: Column, city: str = "부산") -> Column:
    """The first run of letters that ends as a district does, in addresses of the city only."""
    found = F.nullif(F.regexp_extract(address_key(text), r"([가-힣]+(?:구|군))", 1), F.lit(""))
    return F.when(in_city(text, city), found)


def slug(text: Column) -> Column:
    """Lower case, each character that is no letter or digit of any script as _, without _ at the ends."""
    return F.trim(F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]", "_")), F.lit("_"))


def period_month(text: Column) -> Column:
    """First day of the month of yyyyMM, yyyy-MM, yyyyMMdd or yyyy-MM-dd."""
    digits = F.regexp_replace(F.trim(text), r"[-./]", "")
    return F.when(digits.rlike(r"^\d{6}(\d{2})?$"), F.try_to_timestamp(F.concat(F.substring(digits, 1, 6), F.lit("01")), F.lit("yyyyMMdd")).cast("date"))


def period_months(text: Column) -> Column:
    """Array of the months of a period or of a range 'yyyy-MM..yyyy-MM'."""
    first, last = period_month(F.split_part(text, F.lit(".."), F.lit(1))), period_month(F.split_part(text, F.lit(".."), F.lit(2)))
    end = F.coalesce(last, first)
    return F.when(first <= end, F.sequence(first, end, F.expr("INTERVAL 1 MONTH")))


def month_index(day: Column) -> Column:
    """Months since year 0: neighbouring months differ by 1."""
    return (F.year(day) * 12 + F.month(day) - 1).cast("int")


def last_complete_month(as_of: Column) -> Column:
    return F.add_months(F.trunc(as_of, "month"), -1)


def expected_pages(total: Column, page_size: Column) -> Column:
    """At least one page, also of nothing."""
    return F.greatest(F.lit(1), F.ceil(total / page_size)).cast("bigint")


def in_month(day: Column, month: str) -> Column:
    """yyyy-MM as a half-open range, which reaches the Parquet scan."""
    start = F.to_timestamp_ntz(F.lit(f"{month}-01"))
    return (day >= start) & (day < F.add_months(start, 1).cast("timestamp_ntz"))


def canonical_json(entries: Column) -> Column:
    """A map as JSON with its keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(entries))))


def dimension_hash(entries: Column) -> Column:
    return F.sha2(canonical_json(entries), 256)


def observation_key(*parts: Column) -> Column:
    """SHA-256 of the parts joined by |; nulls count as empty."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256)


def name_uuid(namespace: str, name: Column) -> Column:
    """UUID version 5 of the name, without Python."""
    raw = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.conv(F.substring(raw, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)
    return F.concat_ws(
        "-",
        F.substring(raw, 1, 8),
        F.substring(raw, 9, 4),
        F.concat(F.lit("5"), F.substring(raw, 14, 3)),
        F.concat(F.lower(F.hex(variant)), F.substring(raw, 18, 3)),
        F.substring(raw, 21, 12),
    )


def rounded_position(value: Column) -> Column:
    """Nine decimals, in which a coordinate is published."""
    return F.round(value, 9)


def year_month(year: Column, month: Column) -> Column:
    """First day of the month of a year and a month in columns of their own; null unless both are numbers of a calendar."""
    y, m = whole_number(year.cast("string")), whole_number(month.cast("string"))
    return F.when(y.between(1, 9999) & m.between(1, 12), F.make_date(y.cast("int"), m.cast("int"), F.lit(1)))


def is_finite(value: Column) -> Column:
    """Neither null, NaN nor infinite."""
    return F.coalesce(~F.isnan(value) & (F.abs(value) < float("inf")), F.lit(False))


def close(a: Column, b: Column, relative: float = 1e-9, absolute: float = 0.0) -> Column:
    return F.abs(a - b) <= F.greatest(F.lit(absolute), F.lit(relative) * F.greatest(F.abs(a), F.abs(b)))


def relative_change(now: Column, before: Column) -> Column:
    return F.try_divide(F.abs(now - before), F.abs(before))
