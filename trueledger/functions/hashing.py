"""Row hashes.

``row_hash`` is the fast 64-bit hash for comparing two tables inside Spark. ``portable_hashes`` is
slower but written only with MD5 over canonical text, so any SQL engine can compute the same value
on its own side of a copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _exact_decimal(c: Column, mine: T.DecimalType, other: T.DataType | None) -> Column:
    """The value without loss, in a type that does not depend on its scale.

    With the other side's type known, that is the type wide enough for both where there is one; else
    the whole part and the rest, each as wide as a decimal can be.
    """
    if isinstance(other, T.DecimalType):
        scale = max(mine.scale, other.scale)
        precision = max(mine.precision - mine.scale, other.precision - other.scale) + scale
        if precision <= 38:
            return c.cast(T.DecimalType(precision, scale))
    one = F.lit(1).cast("decimal(1,0)")
    return F.struct(F.floor(c).cast("decimal(38,0)"), (c % one).cast("decimal(38,38)"))


def canonical(field: T.StructField, other: T.DataType | None = None) -> Column:
    """One spelling per value: decimals of any scale and integers of any width hash alike, -0.0 as 0.0."""
    c = F.col(field.name)
    if isinstance(field.dataType, T.DecimalType):
        return _exact_decimal(c, field.dataType, other)
    if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
        return c.cast("bigint")
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return F.when(c == 0, F.lit(0.0)).otherwise(c.cast("double"))
    return c


def row_hash(schema: T.StructType, columns: list[str], other: T.StructType | None = None) -> Column:
    """64-bit hash of a row. ``xxhash64`` skips NULLs, so the null flags are hashed as well.

    ``other`` is the schema of the table it is compared with; both sides must then name each other.
    """
    fields = [schema[name] for name in columns]
    types = [other[name].dataType if other is not None and name in other.names else None for name in columns]
    return F.xxhash64(F.lit(len(fields)), *[canonical(f, t) for f, t in zip(fields, types)], *[F.col(f.name).isNull() for f in fields])


def _portable_text(field: T.StructField) -> str:
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return f"date_format(`{field.name}`, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS `{field.name}`"
    return f"CAST(`{field.name}` AS STRING) AS `{field.name}`"


def portable_hashes(df: DataFrame, columns: list[str]) -> DataFrame:
    """``row_hash`` per row: the first 60 bits of MD5 over the length-prefixed text of every column.

    The prefix keeps two different rows from spelling the same text; a NULL is a dash.
    """
    texts = df.selectExpr(*[_portable_text(df.schema[name]) for name in columns])
    spelled = ", ".join(f"coalesce(concat(length(`{c}`), ':', `{c}`), '-')" for c in columns)
    digest = texts.selectExpr(f"md5(concat({spelled})) AS digest")
    return digest.selectExpr("CAST(conv(substring(digest, 1, 15), 16, 10) AS BIGINT) AS row_hash")
