"""Applying ordered change events to a table.

A state row is the last change seen for its key: payload, ``op`` and its place in the order
(``seq``, ``tie``). Applying a batch keeps, per key, the later of state and batch. That makes the
result independent of how changes are batched, and applying a batch twice changes nothing.
Deleted keys stay as tombstones, so a late update cannot revive them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trueledger.operators.evolve import check_additive

ORDER = ["seq", "tie"]
DELETE = "D"


def latest_changes(changes: DataFrame, keys: list[str], order: list[str] = ORDER) -> DataFrame:
    """The last change per key. Partial aggregation first: a hot key is one row per task."""
    rest = [c for c in changes.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return changes.groupBy(*keys).agg(last.alias("_last")).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def apply_changes(state: DataFrame | None, changes: DataFrame, keys: list[str]) -> DataFrame:
    """The state after ``changes``; ``None`` stands for an empty state."""
    latest = latest_changes(changes, keys)
    return latest if state is None else merge_latest(state, latest, keys)


def merge_latest(state: DataFrame, latest: DataFrame, keys: list[str]) -> DataFrame:
    """``state`` with one change per key merged in.

    Both sides are unique by key, so no key can be hot. A batch small enough to be broadcast leaves
    the state where it is: neither join shuffles it. A larger one is sort-merged with it. NULL is a key
    like any other. Changes may bring new columns; rows from before have NULL there.
    """
    check_additive(state.schema, latest.schema)
    rest = [c for c in state.columns if c not in keys]
    rest += [c for c in latest.columns if c not in keys and c not in rest]
    old = state.select(*keys, _row(state, latest, rest).alias("_old"))
    new = latest.select(*keys, _row(latest, state, rest).alias("_new"))
    other_keys = [F.col(k).alias(f"_other_{k}") for k in keys]
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_other_{k}")) for k in keys])
    place = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in ORDER])
    is_newer = F.col("_new").isNotNull() & (place("_new") > place("_old"))
    kept = F.when(is_newer, F.col("_new")).otherwise(F.col("_old"))
    updated = old.join(new.select(*other_keys, "_new"), same, "left").select(*keys, kept.alias("_kept"))
    known = state.select(*keys).join(latest.select(*other_keys), same, "left_semi")
    added = new.join(known.select(*other_keys), same, "left_anti").withColumnRenamed("_new", "_kept")
    return updated.unionByName(added).select(*keys, *[F.col(f"_kept.{c}").alias(c) for c in rest])


def _row(df: DataFrame, other: DataFrame, columns: list[str]) -> Column:
    """``columns`` as one struct, NULL of the other side's type where ``df`` has no such column."""
    return F.struct(
        *[F.col(c) if c in df.columns else F.lit(None).cast(other.schema[c].dataType).alias(c) for c in columns]
    )


def as_state(df: DataFrame, seq, tie=0) -> DataFrame:
    """A plain table as a state whose rows are older than every change after ``seq``."""
    return df.select("*", F.lit("I").alias("op"), F.lit(seq).alias("seq"), F.lit(tie).cast("bigint").alias("tie"))


def live_rows(state: DataFrame, keep_order: bool = False) -> DataFrame:
    """The table itself: tombstones and bookkeeping removed."""
    live = state.where(F.col("op") != DELETE)
    return live if keep_order else live.drop("op", *ORDER)


def purge_tombstones(state: DataFrame, before) -> DataFrame:
    """Forget deletions older than ``before``, once no older event can still arrive."""
    return state.where((F.col("op") != DELETE) | (F.col("seq") >= F.lit(before)))
