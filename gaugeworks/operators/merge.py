"""Insert-if-absent and insert-or-update by key on immutable tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.dedupe import first_per_key
from gaugeworks.operators.lookup import fits_broadcast


def to_target(df: DataFrame, target: dict[str, str]) -> DataFrame:
    """Project to the columns and types of a table; a missing column is NULL."""
    have = set(df.columns)
    return df.select(
        *(
            (F.col(c) if c in have else F.lit(None)).try_cast(kind).alias(c)
            for c, kind in target.items()
        )
    )


def without_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that no keyed load can take, since part of their key is NULL, for the caller to keep."""
    return rows.filter(reduce(or_, (F.col(k).isNull() for k in keys)))


def _held_keys(target: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``wanted`` that the target has.

    A small list of measured size is broadcast against a scan of the target's key
    columns, so the target is not shuffled.
    """
    if fits_broadcast(wanted):
        return target.select(*keys).join(F.broadcast(wanted), keys, "left_semi").distinct()
    return target.select(*keys)


def absent_rows(
    batch: DataFrame, target: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """Rows of the batch to append: the first of each key that the target does not hold.

    Rows with a NULL key are left to ``without_key``.
    """
    keys = list(keys)
    fresh = first_per_key(batch.dropna(subset=keys), keys, order)
    wanted = batch.select(*keys).dropna().distinct()
    return fresh.join(_held_keys(target, wanted, keys), keys, "left_anti")


def insert_if_absent(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """The target after the load. A second load of the same batch changes nothing."""
    return target.unionByName(absent_rows(batch, target, keys, order))


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """The target with updated and new rows; the first update of a key by ``order`` counts.

    Updates of measured small size are broadcast, so the target is not shuffled.
    Updates with a NULL key are left to ``without_key``.
    """
    keys = list(keys)
    chosen = first_per_key(updates.dropna(subset=keys), keys, order)
    replaced = chosen.select(*keys)
    if fits_broadcast(replaced):
        replaced = F.broadcast(replaced)
    return target.join(replaced, keys, "left_anti").unionByName(chosen.select(*target.columns))
