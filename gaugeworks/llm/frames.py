"""Column handling shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def added(df: DataFrame, fields: str) -> T.StructType:
    """Schema of ``df`` with the fields of a DDL string; a clashing column gives way."""
    new = T.StructType.fromDDL(fields)
    names = {f.name.lower() for f in new.fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in names]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in kept] + new.fields)


def map_texts(
    df: DataFrame, fields: str, job: Callable[[pa.RecordBatch], list[pa.Array]]
) -> DataFrame:
    """``df`` with new columns computed batch by batch, without a shuffle.

    ``job`` gets a record batch and returns one array per field.
    """
    schema = added(df, fields)
    new = T.StructType.fromDDL(fields).names
    kept = schema.names[: len(schema.names) - len(new)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, *job(batch)], [*kept, *new])

    return df.mapInArrow(run, schema)


def text_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator works on, under fixed names."""
    return df.select(df[id_col].alias("doc_id"), df[text_col].cast("string").alias("text"))
