"""Inventory CSV, JSON lines and nested payloads, all with a declared schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.schemas import EVENT, INVENTORY_RAW, PAYLOAD

CORRUPT = "_corrupt_record"


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_inventory(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str = INVENTORY_RAW,
    multi_line: bool = False,
) -> DataFrame:
    """Semicolon CSV with a header to all-text staging rows; empty fields are NULL.

    Columns are taken by position. A byte order mark is dropped and doubled quotes
    are an escaped quote. ``multi_line`` lets quoted values span lines; each file is
    then read by one task, so it is off unless asked for.
    """
    return (
        spark.read.schema(schema)
        .option("sep", ";")
        .option("header", True)
        .option("enforceSchema", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("multiLine", multi_line)
        .csv(path)
    )


def read_json_lines(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    """Typed rows plus the text of lines that do not parse. A missing path has no rows."""
    full = f"{schema}, {CORRUPT} STRING"
    try:
        return spark.read.schema(full).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    except AnalysisException as error:
        if not _missing(error):
            raise
        return spark.createDataFrame([], full)


def decode_events(df: DataFrame, value: str | Column = "value", schema: str = EVENT) -> DataFrame:
    """JSON text (a message value) to event columns; other columns stay in front.

    Works on a batch or a stream. Text that does not parse ends up in
    ``_corrupt_record`` with every event column NULL.
    """
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    keep = [c for c in df.columns if c != value]
    parsed = F.from_json(
        text,
        f"{schema}, {CORRUPT} STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    fields = T.StructType.fromDDL(schema).names
    rows = df.select(*keep, parsed.alias("__e"))
    bad = F.col(f"__e.{CORRUPT}")
    return rows.select(
        *keep,
        *(F.when(bad.isNull(), F.col(f"__e.`{f}`")).alias(f) for f in fields),
        bad.alias(CORRUPT),
    )


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable rows, unreadable lines)."""
    bad = F.col(CORRUPT).isNotNull()
    return df.filter(~bad).drop(CORRUPT), df.filter(bad).select(CORRUPT)


def flatten_payload(
    df: DataFrame,
    payload: str,
    *,
    latitude: float | str,
    longitude: float | str,
    source: str,
    event_id: Column | None = None,
    collected_at: Column | None = None,
) -> DataFrame:
    """Nested service response to flat events; absent measurements are NULL.

    ``latitude`` and ``longitude`` are constants or column names. The id is a
    random UUID and the collection time is now, unless given.
    """
    current = F.from_json(payload, PAYLOAD)["current"]
    utc_now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    now = F.date_format(utc_now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")

    def place(value: float | str) -> Column:
        return (F.col(value) if isinstance(value, str) else F.lit(value)).cast("double")

    return df.withColumn("__current", current).select(
        (event_id if event_id is not None else F.uuid()).alias("event_id"),
        (collected_at if collected_at is not None else now).alias("collected_at"),
        F.lit(source).alias("source"),
        place(latitude).alias("latitude"),
        place(longitude).alias("longitude"),
        F.col("__current.time").alias("observed_at"),
        F.col("__current.temperature_2m").alias("temperature_c"),
        F.col("__current.relative_humidity_2m").alias("humidity_pct"),
        F.col("__current.wind_speed_10m").alias("wind_speed_kmh"),
        F.col("__current.precipitation").alias("precipitation_mm"),
    )


def count_lines(spark: SparkSession, pattern: str) -> int:
    """Lines in all files of a path or glob; 0 when nothing matches."""
    try:
        return spark.read.text(pattern).count()
    except AnalysisException as error:
        if not _missing(error):
            raise
        return 0
