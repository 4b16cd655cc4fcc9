"""Licence status as column expressions: active, explicitly inactive, or neither (unknown)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the public register.
ACTIVE_CODE = "01"
ACTIVE_NAMES = ("영업", "영업정상", "정상", "영업중")
INACTIVE_MARKERS = "폐업|휴업|취소|말소|정지|폐쇄"
CLASSES = {"01": "active", "02": "suspended", "03": "closed", "04": "cancelled_or_expired_or_stopped"}


def padded(code: Column, width: int) -> Column:
    """Left-padded with zeros, never cut."""
    text = F.trim(code.cast("string"))
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def _filled(value: Column) -> Column:
    return F.nullif(F.trim(value.cast("string")), F.lit(""))


def is_active(code: Column, name: Column, closed_on: Column, observed_on: Column) -> Column:
    """A closure date up to the observation decides first, then a code, then the name's letters and digits; blank is absent."""
    label = F.regexp_replace(name, r"[^0-9A-Za-z가-힣]", "")
    by_name = F.coalesce(~name.rlike(INACTIVE_MARKERS) & label.isin(*ACTIVE_NAMES), F.lit(False))
    return (
        F.when(F.coalesce(closed_on <= observed_on, F.lit(False)), False)
        .when(_filled(code).isNotNull(), padded(code, 2) == ACTIVE_CODE)
        .otherwise(by_name)
    )


def is_inactive(code: Column, name: Column, closed_on: Column, observed_on: Column) -> Column:
    """A closure date, an inactive code or an inactive name says so; neither this nor `is_active` holds for an unknown status."""
    said = [closed_on <= observed_on, padded(code, 2).isin("02", "03", "04"), name.rlike(INACTIVE_MARKERS)]
    a, b, c = (F.coalesce(x, F.lit(False)) for x in said)
    return a | b | c


def status_class(code: Column) -> Column:
    known = F.create_map(*(F.lit(x) for pair in CLASSES.items() for x in pair))
    return F.when(_filled(code).isNotNull(), F.coalesce(F.try_element_at(known, F.trim(code)), F.lit("unknown")))
