"""Column expressions shared by the finance jobs. All of them stay inside Catalyst."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

PASS, PASS_MINOR, REVIEW, FAIL = "PASS", "PASS_MINOR", "REVIEW", "FAIL"

# Upper limit (exclusive) of each band and its label. The last label also takes
# NULL. The labels read the sign the way the source system's reports do: below zero is "Over".
VARIANCE_BANDS: list[tuple[int | None, str]] = [
    (-20, "Over Budget >20%"),
    (-10, "Over Budget 10-20%"),
    (10, "On Target"),
    (20, "Under Budget 10-20%"),
    (None, "Under Budget >20%"),
]


def as_of_date(as_of: dt.date | None) -> Column:
    """The day a report is made for; today unless given."""
    return F.current_date() if as_of is None else F.lit(as_of)


def money(c: Column) -> Column:
    """Money is decimal before any sum, so that results do not depend on row order."""
    return c.cast("decimal(18,2)")


def ratio(num: Column, den: Column, scale: int = 2) -> Column:
    """``num / den`` rounded half up; NULL where ``den`` is zero (a bare ``/0`` raises)."""
    exact = num.cast("decimal(28,2)") / F.nullif(den.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(exact, scale).cast(f"decimal(18,{scale})")


def scaled(c: Column, unit: int, scale: int = 2) -> Column:
    """A sum shown in thousands or millions."""
    return F.round(c.cast("decimal(28,2)") / F.lit(unit), scale).cast(f"decimal(18,{scale})")


def safe_percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` rounded to 2, and 0 unless ``whole`` is positive."""
    pct = F.round(part.cast("decimal(20,2)") * 100 / F.when(whole > 0, whole.cast("decimal(18,2)")), 2)
    return F.when(whole > 0, pct).otherwise(F.lit(0)).cast("decimal(18,2)")


def variance_band(pct: Column, bands: list[tuple[int | None, str]] | None = None) -> Column:
    """Label a variance percentage; bands are half-open, the last one catches the rest."""
    bands = bands or VARIANCE_BANDS
    *limited, (_, rest) = bands
    expr = None
    for limit, label in limited:
        expr = F.when(pct < limit, label) if expr is None else expr.when(pct < limit, label)
    return expr.otherwise(rest)


def status_below(value: Column, passing, minor) -> Column:
    """PASS under ``passing``, PASS_MINOR under ``minor``, else (and for NULL) REVIEW."""
    return F.when(value < passing, PASS).when(value < minor, PASS_MINOR).otherwise(REVIEW)


def status_exact(actual: Column, expected: Column, tolerance: Column) -> Column:
    """PASS when equal, PASS_MINOR when closer than ``tolerance``, else REVIEW."""
    return (
        F.when(actual == expected, PASS)
        .when(F.abs(actual - expected) < tolerance, PASS_MINOR)
        .otherwise(REVIEW)
    )
