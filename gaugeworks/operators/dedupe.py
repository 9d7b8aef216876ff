"""One row per key, the same one on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row of each key by ``order``; remaining columns break ties.

    The ``row_number() = 1`` filter lets Spark drop all but one row per key in
    each task before the shuffle, so a hot key sends one row per task.
    """
    named = {c for c in order if isinstance(c, str)} | set(keys)
    ties = [F.col(f"`{c}`") for c in df.columns if c not in named]
    ordering = [F.col(c).asc() if isinstance(c, str) else c for c in order]
    window = Window.partitionBy(*keys).orderBy(*ordering, *ties)
    return df.withColumn("__rn", F.row_number().over(window)).filter("__rn = 1").drop("__rn")
