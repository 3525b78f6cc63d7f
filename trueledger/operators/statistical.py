"""Statistical comparison of a source and its copy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trueledger.functions.finance import PASS, REVIEW
from trueledger.operators.integrity import null_counts


def _same(a: str, b: str) -> Column:
    return F.when(F.col(a).eqNullSafe(F.col(b)), PASS).otherwise(REVIEW)


def null_distribution(source: DataFrame, target: DataFrame, table: str) -> DataFrame:
    """NULLs per column on both sides."""
    keys = ["table_name", "column_name"]
    side = lambda df, p: null_counts(df, table, df.columns).select(
        *keys, F.col("null_rows").alias(f"{p}_nulls"), F.col("total_rows").alias(f"{p}_rows")
    )
    return side(source, "source").join(side(target, "target"), keys, "full_outer").withColumn(
        "status", _same("source_nulls", "target_nulls")
    )


def date_ranges(source: DataFrame, target: DataFrame, table: str) -> DataFrame:
    """First and last value of every date column on both sides."""
    columns = [f.name for f in source.schema.fields if isinstance(f.dataType, T.DateType)]

    def side(df: DataFrame, p: str) -> DataFrame:
        ends = df.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns])
        return ends.select(
            F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("r")) for c in columns])).alias("m")
        ).select("m.column_name", F.col("m.r.lo").alias(f"{p}_min"), F.col("m.r.hi").alias(f"{p}_max"))

    same = F.col("source_min").eqNullSafe(F.col("target_min")) & F.col("source_max").eqNullSafe(F.col("target_max"))
    return (
        side(source, "source")
        .join(side(target, "target"), "column_name", "full_outer")
        .select(F.lit(table).alias("table_name"), "*", F.when(same, PASS).otherwise(REVIEW).alias("status"))
    )


def both_sides(source: DataFrame, target: DataFrame, columns: list[str | Column]) -> DataFrame:
    """The rows of both sides in one relation, marked, so that one aggregate compares them."""
    return source.select(F.lit(True).alias("is_source"), *columns).unionByName(
        target.select(F.lit(False).alias("is_source"), *columns)
    )


def distribution_gap(source: DataFrame, target: DataFrame, category: str, limit: str = "1.00") -> DataFrame:
    """Share of each category on both sides, in percent, and the gap between them.

    The totals are a scalar subquery over the same counts, so any number of categories will do.
    """
    counts = (
        both_sides(source, target, [category])
        .groupBy(category)
        .agg(F.count_if("is_source").alias("source_count"), F.count_if(~F.col("is_source")).alias("target_count"))
    )
    totals = counts.agg(F.sum("source_count").alias("source_count"), F.sum("target_count").alias("target_count"))
    everything = totals.select(F.struct("source_count", "target_count").alias("t")).scalar()
    share = lambda n: F.round(
        F.col(n).cast("decimal(20,0)") * 100 / F.nullif(everything.getField(n), F.lit(0)), 4
    ).cast("decimal(9,4)")
    return (
        counts.withColumn("source_share", share("source_count"))
        .withColumn("target_share", share("target_count"))
        .withColumn("gap", F.abs(F.col("source_share") - F.col("target_share")).cast("decimal(9,4)"))
        .withColumn("status", F.when(F.col("gap") < F.lit(limit).cast("decimal(9,4)"), PASS).otherwise(REVIEW))
    )


def outlier_limits(df: DataFrame, column: str, k: float) -> DataFrame:
    """Mean plus and minus ``k`` sample deviations, from exact decimal sums in one pass."""
    x = F.col(column).cast("decimal(18,2)")
    s = df.agg(
        F.count(x).alias("n"),
        F.sum(x).cast("double").alias("s"),
        F.sum((x * x).cast("decimal(34,4)")).cast("double").alias("q"),
    )
    mean = F.col("s") / F.nullif(F.col("n"), F.lit(0))
    spread = F.sqrt((F.col("q") - F.col("s") * mean) / F.nullif(F.col("n") - 1, F.lit(0)))
    return s.select((mean - k * spread).alias("lo"), (mean + k * spread).alias("hi"))


def outliers(df: DataFrame, column: str, k: float = 3.0) -> DataFrame:
    """Rows whose value lies more than ``k`` deviations from the mean."""
    bounds = outlier_limits(df, column, k).select(F.struct("lo", "hi").alias("b")).scalar()
    value = F.col(column).cast("double")
    return df.where((value < bounds.getField("lo")) | (value > bounds.getField("hi")))


def numeric_precision(source: DataFrame, target: DataFrame) -> DataFrame:
    """Scale and sum of every decimal column on both sides; the sums are compared in one common type."""
    columns = [f.name for f in source.schema.fields if isinstance(f.dataType, T.DecimalType)]
    scales = [df.schema[c].dataType.scale for df in (source, target) for c in columns if isinstance(df.schema[c].dataType, T.DecimalType)]
    wide = T.DecimalType(38, max([6, *scales]))  # a sum too large for it raises, none is cut

    def side(df: DataFrame, p: str) -> DataFrame:
        sums = df.agg(*[F.sum(c).cast(wide).alias(c) for c in columns])
        rows = [
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(getattr(df.schema[c].dataType, "scale", None)).cast("int").alias("scale"),
                F.col(c).alias("total"),
            )
            for c in columns
        ]
        return sums.select(F.explode(F.array(*rows)).alias("m")).select(
            "m.column_name", F.col("m.scale").alias(f"{p}_scale"), F.col("m.total").alias(f"{p}_sum")
        )

    same = F.col("source_scale").eqNullSafe(F.col("target_scale")) & F.col("source_sum").eqNullSafe(F.col("target_sum"))
    return side(source, "source").join(side(target, "target"), "column_name", "full_outer").withColumn(
        "status", F.when(same, PASS).otherwise(REVIEW)
    )


def _with(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` beside the one row of ``other`` that has its keys, NULL equalling NULL."""
    right = other.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in other.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return df.join(right, same).drop(*[f"_k_{k}" for k in keys])


#: Relative error of the quantile sketch is one part in this many.
SKETCH_ACCURACY = 10_000


def percentile_bracket(df: DataFrame, keys: list[str], value: str, p: str, accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """``keys, _rows, _lo, _hi``: per group two doubles that the percentile lies between, from a mergeable sketch.

    About four parts in ``accuracy`` of a group's rows lie between them, whatever the values look like.
    """
    margin = 2 / accuracy
    ends = F.percentile_approx(F.col(value).cast("double"), F.array(F.lit(max(float(p) - margin, 0.0)), F.lit(min(float(p) + margin, 1.0))), F.lit(accuracy))
    sketch = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), ends.alias("_ends"))
    return sketch.select(*keys, "_rows", F.col("_ends")[0].alias("_lo"), F.col("_ends")[1].alias("_hi"))


def discrete_percentile(df: DataFrame, keys: list[str], value: str, p: str, name: str, accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Exact percentile per group: the smallest value that at least ``p`` of the rows do not exceed.

    Two steps, so that no task sees a group's distinct values together: a sketch brackets the percentile;
    rows below the bracket are only counted, and of those inside distinct values are put in order. Doubles
    keep the order of the values, so the bracket holds for values that they cannot hold exactly.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, value)
    near = F.col(value).cast("double")
    held = _with(rows, percentile_bracket(df, keys, value, p, accuracy), keys).where(near <= F.col("_hi"))
    # One row for all that is below the bracket, and one for each value inside it.
    inside = F.when(near >= F.col("_lo"), F.col(value)).alias(value)
    counts = held.groupBy(*keys, inside, "_rows").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*keys).orderBy(F.col(value).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rank = F.col("_rows") * F.lit(p).cast("decimal(6,4)")
    reached = F.when(F.sum("_n").over(upto).cast("decimal(20,0)") >= rank, F.struct(F.col(value).alias("v")))
    first = counts.withColumn("_reached", reached).groupBy(*keys).agg(F.min("_reached").alias("_first"))
    outside = F.raise_error(F.lit("the sketch did not bracket the percentile"))
    return first.select(*keys, F.when(F.col("_first.v").isNull(), outside.cast(df.schema[value].dataType)).otherwise(F.col("_first.v")).alias(name))
