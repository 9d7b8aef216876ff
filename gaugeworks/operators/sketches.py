"""Column profiles from sketches that are stored per day and merged.

A day becomes one row per column: exact counts, exact extremes, and two sketches of fixed size, one of
the distinct values (HyperLogLog) and one of the quantiles of numbers (KLL). Profiles of any days,
and of the whole table, come from the stored rows alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions import blank_to_null, is_finite

#: Relative standard error of distinct counts is about 1.04 / sqrt(2^LG_K): 1.6 percent.
LG_K = 12
#: KLL parameter: ranks are off by about 1.3 percent.
KLL_K = 200
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def _numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.NumericType)


def _filled(df: DataFrame, c: str) -> Column:
    return blank_to_null(c) if isinstance(df.schema[c].dataType, T.StringType) else F.col(c)


def sketch_days(df: DataFrame, day: str | Column, columns: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """(day, column_name, rows, filled, min_value, max_value, distinct_sketch, quantile_sketch).

    One pass with a combine on the map side; a task holds one row of sketches per day it meets.
    Quantiles are those of finite numbers.
    """
    at = F.col(day) if isinstance(day, str) else day
    aggregates = [F.count("*").alias("rows")]
    for i, c in enumerate(columns):
        value = _filled(df, c)
        number = F.when(is_finite(c), F.col(c).cast("double")) if _numeric(df, c) else F.lit(None).cast("double")
        aggregates += [
            F.count(value).alias(f"filled{i}"),
            F.min(value).cast("string").alias(f"min{i}"),
            F.max(value).cast("string").alias(f"max{i}"),
            F.hll_sketch_agg(value.cast("string"), lg_k).alias(f"distinct{i}"),
            F.kll_sketch_agg_double(number, KLL_K).alias(f"quantile{i}"),
        ]
    lines = F.array(
        *(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("rows"),
                F.col(f"filled{i}").alias("filled"),
                F.col(f"min{i}").alias("min_value"),
                F.col(f"max{i}").alias("max_value"),
                F.col(f"distinct{i}").alias("distinct_sketch"),
                F.col(f"quantile{i}").alias("quantile_sketch"),
            )
            for i, c in enumerate(columns)
        )
    )
    days = df.groupBy(at.alias("day")).agg(*aggregates)
    return days.select("day", F.explode(lines).alias("line")).select("day", "line.*")


def profile_from_sketches(stored: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """(column_name, rows, filled, distinct_values, quantiles) over all stored rows.

    Counts are exact, distinct values and quantiles approximate. A column without finite numbers
    has no quantiles.
    """
    merged = stored.groupBy("column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("filled").alias("filled"),
        F.hll_union_agg("distinct_sketch", False).alias("distinct"),
        F.kll_merge_agg_double("quantile_sketch").alias("kll"),
    )
    ranks = F.array(*(F.lit(float(q)) for q in quantiles))
    known = F.coalesce(F.kll_sketch_get_n_double("kll"), F.lit(0)) > 0
    return merged.select(
        "column_name",
        "rows",
        "filled",
        F.hll_sketch_estimate("distinct").alias("distinct_values"),
        F.when(known, F.kll_sketch_get_quantile_double("kll", ranks)).alias("quantiles"),
    )
