"""Column masking and row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hashed(c: Column) -> Column:
    return F.sha2(c.cast("string"), 256)


def partly_masked(c: Column, keep: int = 4) -> Column:
    """All but the last ``keep`` characters replaced by ``*``."""
    text = c.cast("string")
    return F.regexp_replace(text, rf".(?=.{{{keep}}})", "*")


def masked_view(df: DataFrame, hide: list[str] = (), hash_columns: list[str] = (), mask: dict[str, int] | None = None) -> DataFrame:
    """A view without the hidden columns, with others hashed or partly masked."""
    mask = mask or {}
    cols = []
    for c in df.columns:
        if c in hide:
            continue
        if c in hash_columns:
            cols.append(hashed(F.col(c)).alias(c))
        elif c in mask:
            cols.append(partly_masked(F.col(c), mask[c]).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def rows_for_user(df: DataFrame, entitlements: DataFrame, email: str, column: str) -> DataFrame:
    """Rows whose ``column`` value the user is entitled to. An unknown user sees none."""
    allowed = entitlements.where(F.col("email") == email).select(column).distinct()
    return df.join(allowed, column, "left_semi")
