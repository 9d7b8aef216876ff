"""Equi-join of a large table to a table with unique keys, safe for hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.session import materialise

# A table is broadcast only when a count shows that it stays below both.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024


def _width(field: T.StructField) -> Column:
    """Bytes of a value, never fewer than it takes in memory."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 8
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        # A digit and a comma of text stand for up to eight bytes.
        text = F.to_json(value) if not isinstance(field.dataType, T.MapType) else value.cast("string")
        return F.coalesce(F.octet_length(text), F.lit(0)) * 4 + 16
    if isinstance(field.dataType, T.AtomicType):
        return F.lit(16)
    return F.coalesce(F.octet_length(value.cast("string")), F.lit(0)) * 4 + 16


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a table, from one distributed aggregate."""
    width = sum((_width(f) for f in df.schema.fields), F.lit(0))
    row = df.agg(F.count("*").alias("n"), F.sum(width.cast("bigint")).alias("b")).first()
    return row["n"], row["b"] or 0


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    rows, size = measured_size(df)
    return rows <= max_rows and size <= max_bytes


def hot_keys(facts: DataFrame, on: Sequence[str], share: int | None = None) -> DataFrame | None:
    """Keys holding more than one ``share``-th of the rows with ``__parts``, or None.

    There are fewer than ``share`` of them, so the list is bounded whatever the
    data is. ``__parts`` says into how many parts of that size a key divides. The
    count is one pass over ``facts``, combined on the map side, so a hot key costs
    one row per task. NULL keys are left out: they never match.
    """
    spark = facts.sparkSession
    share = share or 4 * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    counts = facts.select(*on).groupBy(*on).agg(F.count("*").alias("__n"))
    counts = materialise(counts, "key-counts")
    total = counts.agg(F.sum("__n")).first()[0] or 0
    rows = counts.dropna(subset=list(on)).filter(F.col("__n") * share > total)
    rows = rows.withColumn("__parts", F.ceil(F.col("__n") * share / total).cast("int")).drop("__n")
    found = rows.collect()
    return spark.createDataFrame(found, rows.schema) if found else None


def lookup_join(
    facts: DataFrame,
    keyed: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    hot_share: int | None = None,
) -> DataFrame:
    """Join ``facts`` to ``keyed``, which has at most one row per key.

    ``keyed`` is broadcast when its measured size allows. Otherwise both sides
    shuffle on the key and a part number. Rows of a hot key are dealt over its
    parts at random, and its row of ``keyed`` is repeated for each part; rows with
    a NULL key are dealt over all partitions. ``facts`` is read once for the count
    of its keys and once for the join. ``how`` is inner, left, left_semi or
    left_anti.
    """
    on = list(on)
    if fits_broadcast(keyed, max_rows, max_bytes):
        return facts.join(F.broadcast(keyed), on, how)
    hot = hot_keys(facts, on, hot_share)
    spread = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    missing = reduce(or_, (F.col(c).isNull() for c in on))
    parts = F.when(missing, F.lit(spread))
    if hot is not None:
        facts = facts.join(F.broadcast(hot), on, "left")
        keyed = keyed.join(F.broadcast(hot), on, "left")
        parts = F.coalesce(parts, F.col("__parts"))
        copies = F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1)
        keyed = keyed.withColumn("__part", F.explode(copies)).drop("__parts")
    else:
        keyed = keyed.withColumn("__part", F.lit(0))
    dealt = F.floor(F.rand(17) * F.coalesce(parts, F.lit(1))).cast("int")
    facts = facts.withColumn("__part", dealt).drop("__parts")
    # Spark goes by the size of files, which may be far below that of the rows: it must not broadcast them.
    return facts.join(keyed.hint("merge"), [*on, "__part"], how).drop("__part")
