"""One commit for all outputs of a batch, and the id of a checkpoint.

A batch writes its outputs to ``<output>/query_id=<id>/batch_id=<n>`` and then, last, one marker
with its counters. Readers take the outputs of batches that have a marker, so they never meet half
a batch, in one output or across several. A batch that comes again after its marker was written is
left alone; one that stopped before it writes all its outputs anew.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from gaugeworks import files
from gaugeworks.operators.lookup import lookup_join

MARKERS = "counters"
_ID = "query-id.txt"


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of a checkpoint: the same after every restart, another after the checkpoint was cleared.

    It lies inside the checkpoint and counts only as long as that has offsets: without them batches
    are numbered from 0 again and must not take the place of what the old id has written.
    """
    checkpoint = checkpoint.rstrip("/")
    path, beside = f"{checkpoint}/{_ID}", f"{checkpoint}-id"
    started = any(not n.startswith(".") for n in files.names(spark, f"{checkpoint}/offsets"))
    if started and files.exists(spark, path):
        return files.read_text(spark, path).strip()
    if started and files.exists(spark, beside):  # where ids were kept before
        name = spark.read.text(beside).first()[0]
    else:
        name = uuid.uuid4().hex
    files.write_text(spark, path, name)
    return name


def folder(path: str, query: str, batch_id: int) -> str:
    return f"{path}/query_id={query}/batch_id={batch_id}"


def _marker(out: str, query: str, batch_id: int) -> str:
    return f"{folder(f'{out}/{MARKERS}', query, batch_id)}/counters.json"


def is_committed(spark: SparkSession, out: str, query: str, batch_id: int) -> bool:
    return files.exists(spark, _marker(out, query, batch_id))


def commit(spark: SparkSession, out: str, query: str, batch_id: int, counts: dict[str, int]) -> None:
    """Make the outputs of a batch visible, with its counters as data beside them."""
    files.put_if_absent(spark, _marker(out, query, batch_id), json.dumps(counts) + "\n")


def land(df: DataFrame, path: str, query: str, batch_id: int, fmt: str) -> None:
    """Write one output of a batch, in place of what an attempt that stopped has left."""
    df.write.mode("overwrite").format(fmt).save(folder(path, query, batch_id))


_BATCH = "query_id STRING, batch_id BIGINT"


def committed_batches(spark: SparkSession, out: str) -> DataFrame:
    """(query_id, batch_id) of the batches that are visible under ``out``."""
    if not files.names(spark, f"{out}/{MARKERS}"):
        return spark.createDataFrame([], _BATCH)
    found = spark.read.schema(f"committed BOOLEAN, {_BATCH}").json(f"{out}/{MARKERS}")
    return found.select("query_id", "batch_id").distinct()


def read_committed(
    spark: SparkSession, out: str, name: str, schema: str, fmt: str = "parquet"
) -> DataFrame:
    """One output of the committed batches, with their query_id and batch_id.

    The batches are the join's keyed side, so folders of others are pruned before they are read.
    """
    full = f"{schema}, {_BATCH}"
    if not files.names(spark, f"{out}/{name}"):
        return spark.createDataFrame([], full)
    rows = spark.read.schema(full).format(fmt).load(f"{out}/{name}")
    return lookup_join(rows, committed_batches(spark, out), ["query_id", "batch_id"], "left_semi")
