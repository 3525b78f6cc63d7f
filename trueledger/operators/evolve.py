"""Schema evolution and type mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaEvolutionError(ValueError):
    """A change that is not purely additive."""


def check_additive(current: T.StructType, incoming: T.StructType) -> None:
    """Raise unless every column both sides have keeps its type."""
    known = {f.name: f.dataType for f in current.fields}
    for field in incoming.fields:
        if field.name in known and known[field.name] != field.dataType:
            raise SchemaEvolutionError(
                f"column {field.name}: {known[field.name].simpleString()} cannot become {field.dataType.simpleString()}"
            )


def evolve(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Append rows whose schema may have gained columns; older rows get NULL in those.

    Columns can only be added. A column whose type changes is refused, and one the incoming rows
    lack is NULL in them.
    """
    check_additive(current.schema, incoming.schema)
    return current.unionByName(incoming, allowMissingColumns=True)


# The source warehouse's type names and what each becomes. Lengths and precisions
# are kept where the name carries them.
TYPE_NAMES = {
    "NUMBER(38,0)": "bigint",
    "VARCHAR": "string",
    "DATE": "date",
    "TIMESTAMP_NTZ": "timestamp_ntz",
    "BOOLEAN": "boolean",
}
UNSUPPORTED = ("VARIANT", "GEOGRAPHY", "GEOMETRY")


class UnsupportedTypeError(ValueError):
    """A source type with no counterpart; load it as text instead."""


def target_type(source_type: str) -> str:
    """Spark type for a source type name."""
    name = source_type.upper().replace(" ", "")
    base = name.split("(")[0]
    if base in UNSUPPORTED:
        raise UnsupportedTypeError(f"{source_type} has no counterpart; load it as VARCHAR")
    if name in TYPE_NAMES:
        return TYPE_NAMES[name]
    if base == "NUMBER":
        return name.replace("NUMBER", "decimal").lower() if "(" in name else "bigint"
    if base in TYPE_NAMES:
        return TYPE_NAMES[base]
    raise UnsupportedTypeError(f"unknown type {source_type}")


def map_types(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Cast columns by name; a value that does not fit becomes NULL (count them with cast_losses)."""
    return df.select(*[F.col(c).try_cast(rules[c]).alias(c) if c in rules else F.col(c) for c in df.columns])


def _changed_by_cast(c: Column, dtype: T.DataType, rule: str) -> Column:
    return ~c.try_cast(rule).try_cast(dtype).eqNullSafe(c)


def cast_losses(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Per cast column: values present, values that do not fit, values the cast alters. One pass."""
    counts = df.agg(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(df.schema[name].dataType.simpleString()).alias("source_type"),
                F.lit(rule).alias("target_type"),
                F.count(name).alias("values"),
                F.count_if(F.col(name).isNotNull() & F.col(name).try_cast(rule).isNull()).alias("not_fitting"),
                F.count_if(
                    F.col(name).try_cast(rule).isNotNull() & _changed_by_cast(F.col(name), df.schema[name].dataType, rule)
                ).alias("altered"),
            ).alias(name)
            for name, rule in rules.items()
        ]
    )
    return counts.select(F.explode(F.array(*rules)).alias("m")).select("m.*")
