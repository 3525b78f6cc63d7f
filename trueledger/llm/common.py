"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trueledger.session import work_dir

Batches = Iterator[pa.RecordBatch]


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, safe from lost executors."""
    path = work_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    """16 bytes of SHA-256: equal for equal texts only, as far as any table can hold."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


def unused(df: DataFrame, name: str) -> str:
    """A column name made from ``name`` that ``df`` does not have, whatever the letters' case."""
    taken = {c.lower() for c in df.columns}
    out = f"_{name}"
    while out.lower() in taken:
        out += "_"
    return out


def hex_sha256(value: Column) -> Column:
    return F.sha2(value, 256)


def with_field(df: DataFrame, name: str, kind: str) -> T.StructType:
    """The schema of ``df`` with column ``name`` added, or replaced where it is there already."""
    fields = [f for f in df.schema.fields if f.name != name]
    return T.StructType([*fields, T.StructField(name, T._parse_datatype_string(kind))])


def add_column(df: DataFrame, source: str, name: str, kind: str, make: Callable[[], Callable[[pa.Array], pa.Array]]) -> DataFrame:
    """``df`` with column ``name`` computed by Arrow batches from column ``source``.

    ``make`` runs once in each task and returns the function that maps an array of a few hundred rows.
    """
    schema = with_field(df, name, kind)
    others = [f.name for f in schema.fields if f.name != name]

    def run(batches: Batches) -> Batches:
        fn = make()
        for batch in slices(batches):
            made = fn(batch.column(batch.schema.get_field_index(source)))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in others]
            yield pa.RecordBatch.from_arrays([*columns, made], names=[*others, name])

    return df.mapInArrow(run, schema)


def slices(batches: Batches, rows: int = 500) -> Batches:
    """The batches in smaller ones, so that what is made from each stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column; null is the empty text."""
    return [x or "" for x in column.to_pylist()]


def groups(batches: Batches, *keys: str) -> Iterator[pa.Table]:
    """The runs of rows with equal (non-null) keys, of batches sorted by them."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        if not table.num_rows:
            continue
        new = np.zeros(table.num_rows, bool)
        for k in keys:
            values = table.column(k).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        starts = [0, *np.flatnonzero(new).tolist()]
        for a, b in zip(starts, starts[1:], strict=False):
            yield table.slice(a, b - a)
        held = table.slice(starts[-1])
    if held is not None and held.num_rows:
        yield held
