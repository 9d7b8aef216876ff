"""Profiles, stage counts, latest rows and event rates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions import blank_to_null


def profile_columns(
    df: DataFrame,
    columns: Sequence[str],
    equal_to: dict[str, object] | None = None,
    approximate: bool = False,
) -> DataFrame:
    """Rows, filled, distinct, equal-to-value, minimum and maximum of each column.

    Blank text counts as not filled. Everything but the distinct counts comes
    from one pass without a shuffle.
    """
    equal_to = equal_to or {}
    kinds = dict(df.dtypes)

    def filled(c: str) -> Column:
        return blank_to_null(c) if kinds[c] == "string" else F.col(c)

    plain = [F.count("*").alias("rows")]
    for i, c in enumerate(columns):
        hit = F.count_if(F.col(c) == F.lit(equal_to[c])) if c in equal_to else F.lit(None)
        plain += [
            F.count(filled(c)).alias(f"filled{i}"),
            hit.cast("bigint").alias(f"equal{i}"),
            F.min(filled(c)).cast("string").alias(f"min{i}"),
            F.max(filled(c)).cast("string").alias(f"max{i}"),
        ]
        if approximate:
            plain.append(F.approx_count_distinct(filled(c)).alias(f"distinct{i}"))
    lines = df.agg(*plain).select(
        "rows",
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.col(f"filled{i}").alias("filled"),
                        F.col(f"equal{i}").alias("equal_to_value"),
                        F.col(f"min{i}").alias("min_value"),
                        F.col(f"max{i}").alias("max_value"),
                        *([F.col(f"distinct{i}").alias("distinct_values")] if approximate else []),
                    )
                    for i, c in enumerate(columns)
                )
            )
        ).alias("line"),
    ).select("rows", "line.*")
    if not approximate:
        # One pass for all columns: repeated values are combined before the shuffle.
        values = F.array(
            *(F.struct(F.lit(c).alias("column_name"), filled(c).cast("string").alias("v")) for c in columns)
        )
        counted = (
            df.select(F.explode(values).alias("x"))
            .select("x.*")
            .filter("v IS NOT NULL")
            .distinct()
            .groupBy("column_name")
            .agg(F.count("*").alias("distinct_values"))
        )
        lines = lines.join(counted, "column_name", "left").fillna(0, ["distinct_values"])
    return lines.select(
        "column_name", "rows", "filled", "distinct_values", "equal_to_value", "min_value", "max_value"
    )


def stage_counts(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(position, stage, rows, lost_vs_previous) for the stages of a flow, in order.

    The first stage has nothing before it and loses nothing.
    """
    counted = [df.agg(F.count("*").alias(f"n{i}")) for i, (_, df) in enumerate(stages)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counted)
    row = stacked.agg(*(F.max(f"n{i}").alias(f"n{i}") for i in range(len(stages))))
    lines = F.array(
        *(
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(name).alias("stage"),
                F.col(f"n{i}").alias("rows"),
                (F.col(f"n{max(i - 1, 0)}") - F.col(f"n{i}")).alias("lost_vs_previous"),
            )
            for i, (name, _) in enumerate(stages)
        )
    )
    return row.select(F.explode(lines).alias("line")).select("line.*")


def latest(df: DataFrame, time: str, n: int, ties: Sequence[str]) -> DataFrame:
    """The ``n`` newest rows; each task keeps at most ``n``."""
    return df.orderBy(F.col(time).desc(), *ties).limit(n)


def event_rate(
    events: DataFrame, time: str, window_seconds: int = 300, slide_seconds: int | None = None
) -> DataFrame:
    """Events and events per second in windows, empty windows left out.

    Sliding windows are summed from counts per slide, so an event is not copied
    into every window that holds it.
    """
    slide = slide_seconds or window_seconds
    if window_seconds % slide:
        raise ValueError("the window must be a multiple of the slide")
    seconds = F.unix_seconds(F.col(time).cast("timestamp"))
    counted = events.groupBy((seconds - F.pmod(seconds, F.lit(slide))).alias("at")).agg(
        F.count("*").alias("n")
    )
    starts = [F.col("at") - F.lit(back) for back in range(0, window_seconds, slide)]
    return (
        counted.filter("at IS NOT NULL")
        .select(F.explode(F.array(*starts)).alias("window_start"), "n")
        .groupBy("window_start")
        .agg(F.sum("n").alias("events"))
        .select(
            "window_start",
            (F.col("window_start") + window_seconds).alias("window_end"),
            "events",
            (F.col("events") / window_seconds).alias("events_per_second"),
        )
    )
