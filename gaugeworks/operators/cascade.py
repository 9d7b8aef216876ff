"""Removal of rows along declared foreign keys, to the end of every chain.

``cascade`` follows a graph of foreign keys from given removals: rows that refer to a removed row
go too (or lose the reference, or stop the removal), and those that refer to them. Only the keys
that were removed in a step are looked for in the next, and a row that is gone already is not
removed again, so cycles end. Each step is one join per edge; hot parents are split as in every
lookup.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.constraints import ConstraintError
from gaugeworks.operators.lookup import lookup_join
from gaugeworks.session import materialise


@dataclass(frozen=True)
class ForeignKey:
    """``child.column`` refers to ``parent.key``; ``on_delete`` is cascade, set null or restrict."""

    child: str
    column: str
    parent: str
    key: str
    on_delete: str = "cascade"


def _distinct(rows: DataFrame, column: str, kind) -> DataFrame:
    return rows.select(F.col(column).try_cast(kind).alias("__k")).dropna().distinct()


def cascade(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, str],
    edges: Sequence[ForeignKey],
    removed: Mapping[str, DataFrame],
    max_steps: int = 1000,
) -> dict[str, DataFrame]:
    """The tables after ``removed`` (rows by primary key, one column per table) and all that follows.

    ``keys`` names the primary key of every table, which is unique and not NULL. A NULL reference
    refers to nothing. A restrict edge with a surviving child raises ``ConstraintError``. Chains
    longer than ``max_steps`` raise instead of running on.
    """
    for edge in edges:
        if edge.on_delete not in ("cascade", "set null", "restrict"):
            raise ValueError(f"unknown action {edge.on_delete!r}")
    kinds = {t: df.schema[keys[t]].dataType for t, df in tables.items()}
    gone: dict[str, list[DataFrame]] = {t: [] for t in tables}
    front: dict[str, DataFrame] = {}
    for table, rows in removed.items():
        wanted = _distinct(rows, rows.columns[0], kinds[table])
        held = tables[table].select(F.col(keys[table]).alias("__k"))
        first = materialise(lookup_join(held, wanted, ["__k"], "left_semi"), "cascade")
        if not first.isEmpty():
            front[table] = first
    for _ in range(max_steps):
        if not front:
            break
        for table, rows in front.items():
            gone[table].append(rows)
        following: dict[str, list[DataFrame]] = {}
        for edge in edges:
            if edge.on_delete != "cascade" or edge.parent not in front:
                continue
            child = tables[edge.child].select(
                F.col(keys[edge.child]).alias("__pk"), _reference(tables, edge).alias("__k")
            )
            parents = _referred(tables, keys, edge, front[edge.parent])
            hit = lookup_join(child, parents, ["__k"], "left_semi")
            following.setdefault(edge.child, []).append(hit.select(F.col("__pk").alias("__k")))
        front = {}
        for table, parts in following.items():
            rows = reduce(DataFrame.unionByName, parts).distinct()
            for old in gone[table]:
                rows = lookup_join(rows, old, ["__k"], "left_anti")
            rows = materialise(rows, "cascade")
            if not rows.isEmpty():
                front[table] = rows
    if front:
        raise RuntimeError(f"a chain of references is longer than {max_steps}")
    lost = {t: reduce(DataFrame.unionByName, parts) for t, parts in gone.items() if parts}
    left = {t: _without(df, keys[t], lost.get(t)) for t, df in tables.items()}
    for edge in edges:
        if edge.parent not in lost or edge.on_delete == "cascade":
            continue
        parents = _referred(tables, keys, edge, lost[edge.parent])
        left[edge.child] = _released(left[edge.child], edge, parents, tables[edge.parent].schema[edge.key].dataType)
    return left


def _reference(tables: Mapping[str, DataFrame], edge: ForeignKey):
    return F.col(edge.column).try_cast(tables[edge.parent].schema[edge.key].dataType)


def _referred(tables, keys, edge: ForeignKey, rows: DataFrame) -> DataFrame:
    """What children of the removed rows hold: their primary keys or another unique column."""
    if edge.key == keys[edge.parent]:
        return rows
    parent = tables[edge.parent].select(F.col(keys[edge.parent]).alias("__k"), F.col(edge.key).alias("__other"))
    found = lookup_join(parent, rows, ["__k"], "left_semi")
    return found.select(F.col("__other").alias("__k")).dropna().distinct()


def _without(df: DataFrame, key: str, rows: DataFrame | None) -> DataFrame:
    if rows is None:
        return df
    return lookup_join(df.withColumn("__k", F.col(key)), rows, ["__k"], "left_anti").drop("__k").select(*df.columns)


def _released(df: DataFrame, edge: ForeignKey, parents: DataFrame, kind) -> DataFrame:
    """Children with their references to removed parents set to NULL, or an error."""
    marked = df.withColumn("__k", F.col(edge.column).try_cast(kind))
    joined = lookup_join(marked, parents.withColumn("__hit", F.lit(True)), ["__k"])
    if edge.on_delete == "restrict":
        if not joined.filter("__hit").isEmpty():
            raise ConstraintError(f"{edge.child}.{edge.column} refers to rows of {edge.parent} to be removed")
        return df
    value = F.when(F.col("__hit"), F.lit(None)).otherwise(F.col(edge.column))
    return joined.withColumn(edge.column, value).select(*df.columns)


def dangling(tables: Mapping[str, DataFrame], keys: Mapping[str, str], edges: Sequence[ForeignKey]) -> dict[str, DataFrame]:
    """Primary keys, per child table, of rows whose reference has no parent; NULL refers to nothing."""
    found: dict[str, list[DataFrame]] = {}
    for edge in edges:
        child = tables[edge.child].select(F.col(keys[edge.child]).alias("__pk"), _reference(tables, edge).alias("__k"))
        parents = tables[edge.parent].select(F.col(edge.key).alias("__k")).dropna().distinct()
        lost = lookup_join(child.dropna(subset=["__k"]), parents, ["__k"], "left_anti")
        found.setdefault(edge.child, []).append(lost.select(F.col("__pk").alias(keys[edge.child])))
    return {t: reduce(DataFrame.unionByName, parts).distinct() for t, parts in found.items()}
