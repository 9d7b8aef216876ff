"""Which rows two stages of a flow do not share.

Each stage is folded into one row per bucket of its key: the number of rows and two sums of row
hashes, which do not depend on the order of the rows. Buckets whose folds agree hold the same rows
(up to hash collisions: two independent 64-bit hashes, summed exactly). Only the rows of buckets
that differ are read again, shuffled and compared. The folds take one pass per stage, combined on
the map side; what is broadcast is at most one number per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.session import materialise

BUCKETS = 4096
ROWS_PER_TASK = 250_000  # compared by one task, however many rows differ


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    """Hash of a row in which NULL differs from every value."""
    marks = [F.col(c).isNull() for c in columns]
    return F.xxhash64(F.lit(seed), *columns, *marks)


def bucket_folds(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """(bucket, rows, fold_a, fold_b): equal for equal multisets of rows."""
    columns = list(columns or df.columns)
    folds = [F.sum(_row_hash(columns, s).cast("decimal(38,0)")).alias(f"fold_{n}") for s, n in ((1, "a"), (2, "b"))]
    return df.groupBy(_bucket(keys, buckets).alias("bucket")).agg(F.count("*").alias("rows"), *folds)


def differing_buckets(before: DataFrame, after: DataFrame) -> DataFrame:
    """(bucket, rows_before, rows_after) of the folds that do not agree."""
    a = before.select("bucket", *(F.col(c).alias(f"{c}_before") for c in ("rows", "fold_a", "fold_b")))
    b = after.select("bucket", *(F.col(c).alias(f"{c}_after") for c in ("rows", "fold_a", "fold_b")))
    same = [F.col(f"{c}_before").eqNullSafe(F.col(f"{c}_after")) for c in ("rows", "fold_a", "fold_b")]
    return (
        a.join(b, "bucket", "full")
        .filter(~(same[0] & same[1] & same[2]))
        .select("bucket", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("rows_before", "rows_after")))
    )


def stage_difference(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(keys, change, rows_before, rows_after): one row per key that the stages do not share.

    ``change`` is lost (no row after), added (none before), fewer or more (some of its rows went
    or came, the others are the same), or changed (other values). ``columns`` are those that both stages have and that are
    compared; all common ones by default. A key of NULLs is a key.
    """
    keys = list(keys)
    columns = list(columns or [c for c in before.columns if c in set(after.columns)])
    columns = keys + [c for c in columns if c not in keys]
    before, after = before.select(*columns), after.select(*columns)
    folds = (bucket_folds(df, keys, columns, buckets) for df in (before, after))
    sizes = {r["bucket"]: r["rows_before"] + r["rows_after"] for r in differing_buckets(*folds).collect()}
    # A bucket far above the others has a key with many rows; those are counted on the map side.
    most = max(ROWS_PER_TASK, 4 * sum(sizes.values()) // buckets)
    heavy = [b for b, n in sizes.items() if n > most]
    light = [b for b, n in sizes.items() if n <= most]
    tasks = -(-sum(sizes[b] for b in light) // ROWS_PER_TASK)
    found = _compared(before, after, keys, columns, buckets, light, max(1, tasks))
    if heavy:
        found = found.unionByName(_compared(before, after, keys, columns, buckets, heavy, None))
    return found


def _compared(
    before: DataFrame,
    after: DataFrame,
    keys: list[str],
    columns: list[str],
    buckets: int,
    wanted: list[int],
    tasks: int | None,
) -> DataFrame:
    """The difference in the buckets ``wanted``, dealt by key over ``tasks`` if given."""
    spark = before.sparkSession
    listed = F.broadcast(spark.createDataFrame([(b,) for b in wanted], "__bucket int"))

    def rows(df: DataFrame, side: str) -> DataFrame:
        some = df.withColumn("__bucket", _bucket(keys, buckets)).join(listed, "__bucket", "left_semi")
        hashed = some.select(*keys, *(_row_hash(columns, s).alias(f"__h{s}") for s in (1, 2)))
        return hashed.withColumns({"__b": F.lit(int(side == "before")), "__a": F.lit(int(side == "after"))})

    both = rows(before, "before").unionByName(rows(after, "after"))
    if tasks:
        both = both.repartition(tasks, *keys)
    # Equal rows of both stages meet in one group: a key's rows are counted per different row first.
    per_row = both.groupBy(*keys, "__h1", "__h2").agg(F.sum("__b").alias("b"), F.sum("__a").alias("a"))
    per_key = per_row.groupBy(*keys).agg(
        F.sum("b").alias("rows_before"),
        F.sum("a").alias("rows_after"),
        F.count_if((F.col("b") > 0) & (F.col("a") == 0)).alias("__only_before"),
        F.count_if((F.col("a") > 0) & (F.col("b") == 0)).alias("__only_after"),
        F.count_if(F.col("a") != F.col("b")).alias("__uneven"),
    )
    change = (
        F.when(F.col("rows_after") == 0, "lost")
        .when(F.col("rows_before") == 0, "added")
        .when((F.col("__only_before") > 0) & (F.col("__only_after") > 0), "changed")
        .when(F.col("rows_after") < F.col("rows_before"), "fewer")
        .when(F.col("rows_after") > F.col("rows_before"), "more")
        .otherwise("changed")
    )
    return per_key.filter("__uneven > 0").select(*keys, change.alias("change"), "rows_before", "rows_after")


def stage_differences(
    stages: Sequence[tuple[str, DataFrame]], keys: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """``stage_difference`` of each stage and the next, with their names in front.

    A stage is read up to four times, so its compared columns are written first: what it takes to
    compute it is done once, in jobs of its own.
    """
    if len(stages) < 2:
        raise ValueError("a difference needs two stages")
    kept = []
    for i, (name, df) in enumerate(stages):
        near = [set(other.columns) for _, other in (*stages[max(0, i - 1) : i], *stages[i + 1 : i + 2])]
        compared = set(columns) if columns else set().union(*near)
        narrow = df.select(*(c for c in df.columns if c in compared or c in keys))
        kept.append((name, materialise(narrow, "stage")))
    found = None
    for (name, before), (following, after) in zip(kept, kept[1:]):
        step = stage_difference(before, after, keys, columns)
        step = step.select(F.lit(name).alias("stage"), F.lit(following).alias("next_stage"), "*")
        found = step if found is None else found.unionByName(step)
    return found
