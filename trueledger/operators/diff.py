"""Comparing two copies of a table: fingerprint, row-level diff, cell-level diff.

Only hashes are shuffled to find the keys that differ. Full rows are then picked out for those keys
alone: few keys are broadcast to both tables, many are merged with them. Repeats of a key are
combined map-side, so a key loaded many times is reported, never multiplied.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trueledger.functions.hashing import portable_hashes, row_hash
from trueledger.operators.statistical import both_sides
from trueledger.session import settled


def fingerprint(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """Rows and hash sum of a table. Independent of row order and partitioning; counts repeats.

    MD5 based, so another engine can compute the same number on its own copy.
    """
    total = F.coalesce(F.sum(F.col("row_hash").cast("decimal(28,0)")), F.lit(0)).cast("decimal(38,0)")
    hashes = portable_hashes(df, columns or df.columns)
    return hashes.agg(F.count(F.lit(1)).alias("row_count"), total.alias("hash_sum")).select(F.lit(table).alias("table_name"), "row_count", "hash_sum")


def fast_fingerprint(df: DataFrame, table: str, columns: list[str] | None = None, other: T.StructType | None = None) -> DataFrame:
    """The same idea with the 64-bit hash, for two copies that are both in Spark.

    Fingerprints made with the ``other`` side's schema are cheaper, and comparable with that side's only.
    """
    columns = columns or df.columns
    sums = df.select(row_hash(df.schema, columns, other).alias("_h")).agg(F.count(F.lit(1)).alias("row_count"), *_hash_sums(F.col("_h")))
    return sums.select(F.lit(table).alias("table_name"), "row_count", "hash_xor", "hash_high", "hash_low")


def same_content(source: DataFrame, target: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """One row saying whether two tables hold the same rows, in any order and partitioning."""
    columns = columns or source.columns
    sides = [
        fast_fingerprint(df, table, columns, other.schema).withColumn("is_source", F.lit(flag))
        for df, other, flag in ((source, target, True), (target, source, False))
    ]
    both = sides[0].unionByName(sides[1])
    hashes = F.struct("row_count", "hash_xor", "hash_high", "hash_low")
    value = lambda what, flag: F.max(F.when(F.col("is_source") == flag, what))
    return both.groupBy("table_name").agg(
        value(F.col("row_count"), True).alias("source_rows"),
        value(F.col("row_count"), False).alias("target_rows"),
        value(hashes, True).eqNullSafe(value(hashes, False)).alias("same"),
    )


def _hash_sums(h: Column) -> list[Column]:
    """XOR alone cancels equal pairs; two sums of 24-bit parts do not, and cannot overflow."""
    return [
        F.bit_xor(h).alias("hash_xor"),
        F.sum(F.shiftrightunsigned(h, 40)).alias("hash_high"),
        F.sum(F.shiftrightunsigned(h, 16).bitwiseAND(F.lit(0xFFFFFF))).alias("hash_low"),
    ]


def shared_columns(source: DataFrame, target: DataFrame, keys: list[str]) -> list[str]:
    """Columns to compare: those both sides have. Others are the schema check's business."""
    return [c for c in source.columns if c in target.columns and c not in keys]


def key_differences(
    source: DataFrame, target: DataFrame, keys: list[str], columns: list[str] | None = None, tolerance: dict[str, str] | None = None
) -> DataFrame:
    """Keys that are MISSING, EXTRA, CHANGED or DUPLICATE in the target, with rows per side.

    A key counts as DUPLICATE when either side holds it more than once and the sides differ. Columns
    with a ``tolerance`` stay out of the hash: their least and greatest value per side go through the
    same aggregate, and values within the tolerance of each other do not differ. That settles keys held
    once per side; rows of other keys are paired one by one (see ``_unpaired``) where their ends agree but
    their exact values do not.
    """
    columns = columns or shared_columns(source, target, keys)
    loose = [c for c in columns if c in (tolerance or {}) and isinstance(source.schema[c].dataType, T.NumericType)]
    strict = [c for c in columns if c not in loose]

    def hashed(df: DataFrame, other: DataFrame) -> DataFrame:
        exact = [row_hash(df.schema, columns, other.schema).alias("_f")] if loose else []
        return df.select(*keys, row_hash(df.schema, strict, other.schema).alias("_h"), *exact, *loose)

    rows = both_sides(hashed(source, target), hashed(target, source), [*keys, "_h", *(["_f"] if loose else []), *loose])
    mine, theirs = F.col("is_source"), ~F.col("is_source")
    ends = [
        end(F.when(side, F.col(c))).alias(f"_{p}_{c}")
        for c in loose
        for p, side, end in (("slo", mine, F.min), ("shi", mine, F.max), ("tlo", theirs, F.min), ("thi", theirs, F.max))
    ]
    nulls = [F.count_if(side & F.col(c).isNull()).alias(f"_{p}n_{c}") for c in loose for p, side in (("s", mine), ("t", theirs))]
    sums = lambda h, side: F.struct(*[F.coalesce(c, F.lit(0)) for c in _hash_sums(F.when(side, F.col(h)))])
    exact = [sums("_f", mine).alias("_sf"), sums("_f", theirs).alias("_tf")] if loose else []
    per_key = rows.groupBy(*keys).agg(
        F.count(F.when(mine, F.col("_h"))).alias("source_rows"),
        F.count(F.when(theirs, F.col("_h"))).alias("target_rows"),
        sums("_h", mine).alias("_s"),
        sums("_h", theirs).alias("_t"),
        *exact,
        *ends,
        *nulls,
    )
    kind = (
        F.when(F.col("target_rows") == 0, "MISSING")
        .when(F.col("source_rows") == 0, "EXTRA")
        .when((F.col("source_rows") > 1) | (F.col("target_rows") > 1), "DUPLICATE")
        .otherwise("CHANGED")
    )
    differs = (F.col("source_rows") != F.col("target_rows")) | (F.col("_s") != F.col("_t"))
    for c in loose:
        for end in ("lo", "hi"):
            differs |= _differs(F.col(f"_s{end}_{c}"), F.col(f"_t{end}_{c}"), source.schema[c].dataType, tolerance[c])
        differs |= F.col(f"_sn_{c}") != F.col(f"_tn_{c}")
    result = [*keys, "source_rows", "target_rows", kind.alias("difference")]
    if not loose:
        return per_key.where(differs).select(*result)
    # Few rows: what differs, and repeated keys whose values are not the very same on both sides.
    unsure = (F.col("source_rows") > 1) & (F.col("_sf") != F.col("_tf"))
    found = settled(per_key.where(differs | unsure).select(*result, differs.alias("_differs")), "differing-or-unsure-keys")
    repeated = _renamed(found.where("NOT _differs"), keys, [], "r_")
    kinds = {c: (source.schema[c].dataType, tolerance[c]) for c in loose}
    unpaired = _renamed(_unpaired(rows.join(repeated, _same_keys(keys, "r_"), "left_semi"), keys, kinds), keys, [], "u_")
    missed = found.where("NOT _differs").join(unpaired, _same_keys(keys, "u_"), "left_semi")
    return found.where("_differs").unionByName(missed).drop("_differs")


def _unpaired(rows: DataFrame, keys: list[str], tolerant: dict[str, tuple[T.DataType, str]]) -> DataFrame:
    """Keys whose rows cannot be paired, in order of their tolerant values, within the tolerances.

    Both sides have as many rows of each hash. For one column the order gives a pairing wherever there
    is one. With several, rows whose first values are within the tolerance of each other but not equal may
    be paired the wrong way: then a key is reported that could be paired otherwise, never the reverse.
    """
    order = Window.partitionBy(*keys, "_h", "is_source").orderBy(*tolerant)
    placed = rows.withColumn("_place", F.row_number().over(order))
    value = lambda c, side: F.max(F.when(F.col("is_source") == side, F.col(c)))
    pairs = placed.groupBy(*keys, "_h", "_place").agg(*[value(c, side).alias(f"_{p}_{c}") for c in tolerant for p, side in (("s", True), ("t", False))])
    apart = reduce(lambda a, b: a | b, [_differs(F.col(f"_s_{c}"), F.col(f"_t_{c}"), *kind) for c, kind in tolerant.items()])
    return pairs.where(apart).select(*keys).distinct()


def cell_differences(
    source: DataFrame,
    target: DataFrame,
    keys: list[str],
    columns: list[str] | None = None,
    tolerance: dict[str, str] | None = None,
) -> DataFrame:
    """One row per differing key, and for CHANGED keys one row per differing column.

    ``tolerance`` gives the largest numeric gap still taken as equal, per column.
    """
    columns = columns or shared_columns(source, target, keys)
    tolerance = tolerance or {}
    found = settled(key_differences(source, target, keys, columns, tolerance), "differing-keys")
    changed = _renamed(found.where("difference = 'CHANGED'"), keys, [], "c_")
    mine = source.join(changed, _same_keys(keys, "c_"), "left_semi").select(*keys, *[F.col(c).alias(f"s_{c}") for c in columns])
    theirs = _renamed(target.join(changed, _same_keys(keys, "c_"), "left_semi"), keys, columns, "t_")
    cells = (
        mine.join(theirs, _same_keys(keys, "t_"))
        .select(
            *keys,
            F.explode(
                F.array(
                    *[
                        F.struct(
                            F.lit(c).alias("column_name"),
                            F.col(f"s_{c}").cast("string").alias("source_value"),
                            F.col(f"t_{c}").cast("string").alias("target_value"),
                            _differs(F.col(f"s_{c}"), F.col(f"t_{c}"), source.schema[c].dataType, tolerance.get(c)).alias("differs"),
                        )
                        for c in columns
                    ]
                )
            ).alias("cell"),
        )
        .where("cell.differs")
        .select(*keys, F.lit("CHANGED").alias("difference"), "cell.column_name", "cell.source_value", "cell.target_value")
    )
    none = F.lit(None).cast("string")
    whole_rows = found.where("difference <> 'CHANGED'").select(
        *keys, "difference", none.alias("column_name"), none.alias("source_value"), none.alias("target_value")
    )
    return cells.unionByName(whole_rows)


def _renamed(df: DataFrame, keys: list[str], columns: list[str], prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in [*keys, *columns]])


def _same_keys(keys: list[str], prefix: str) -> Column:
    """Equal keys, a NULL equalling a NULL."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def _differs(a: Column, b: Column, dtype: T.DataType, tolerance: str | None) -> Column:
    if tolerance is None or not isinstance(dtype, T.NumericType):
        return ~a.eqNullSafe(b)
    digits = Decimal(tolerance).as_tuple()
    scale = max(0, -digits.exponent)
    close = F.abs(a - b) <= F.lit(tolerance).cast(T.DecimalType(max(len(digits.digits) + max(0, digits.exponent), scale, 1), scale))
    return ~F.coalesce(close, a.isNull() & b.isNull())


def value_mismatches(source: DataFrame, target: DataFrame, keys: list[str], tolerance: dict[str, str] | None = None) -> DataFrame:
    """Differing cells per column, values within ``tolerance`` taken as equal."""
    return (
        cell_differences(source, target, keys, tolerance=tolerance)
        .groupBy("difference", "column_name")
        .agg(F.count(F.lit(1)).alias("cells"))
    )
