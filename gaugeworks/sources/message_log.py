"""A partitioned log of messages on a shared file system, as a Spark stream source.

``append_messages`` writes text files by partition and then one manifest version that gives every
file its offsets: readers see whole appends, and appends at the same time follow one another.
The stream's position is one offset per partition, kept in the query's checkpoint, so a query that
stops goes on behind the last message of its last batch. Files are read by the tasks, one file per
input partition. Use it where there is no message broker; the rows are those of one
(partition, offset, value).

    register_message_log(spark)
    spark.readStream.format("message_log").option("path", root).load()
"""

from __future__ import annotations

import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from gaugeworks.sinks import manifest

SCHEMA = "partition INT, offset BIGINT, value STRING"
BATCH_ROWS = 10_000


def append_messages(
    df: DataFrame, root: str, partitions: int, key: Column | None = None, value: str = "value"
) -> manifest.Version:
    """Add one text per row; rows of one ``key`` go to one partition, all others are dealt.

    The number of partitions is the log's own from its first append on. Line breaks inside a text
    are written as blanks, NULL texts are left out.
    """
    spark = df.sparkSession
    run = f"data/run={uuid.uuid4().hex}"
    part = F.floor(F.rand() * partitions) if key is None else F.pmod(F.xxhash64(key), F.lit(partitions))
    rows = df.filter(F.col(value).isNotNull()).select(
        F.regexp_replace(F.col(value).cast("string"), "[\\r\\n]", " ").alias("value"), part.cast("int").alias("part")
    )
    rows.hint("rebalance", "part").write.partitionBy("part").text(f"{root}/{run}")
    counts: list = []
    if not rows.isEmpty():
        place = F.regexp_extract("_metadata.file_path", "(part=[^/]+/[^/]+)$", 1)
        written = spark.read.text(f"{root}/{run}").groupBy(place.alias("file")).agg(F.count("*").alias("n"))
        counts = sorted((r["file"], r["n"]) for r in written.collect())  # one row per file

    def change(base: manifest.Version | None) -> dict:
        if base and base.content["partitions"] != partitions:
            raise ValueError(f"{root} has {base.content['partitions']} partitions")
        ends = list(base.content["ends"]) if base else [0] * partitions
        files = []
        for name, n in counts:
            p = int(name.split("/")[0].split("=")[1])
            files.append([p, ends[p], n, f"{run}/{name}"])
            ends[p] += n
        return {"partitions": partitions, "ends": ends, "files": files}

    return manifest.extend(spark, f"{root}/manifest", change)


def _system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _versions(path: str, after: int, most: int | None = None) -> list[tuple[int, dict]]:
    """Versions of the log's manifest from ``after`` + 1 on, at most ``most`` of them."""
    system, place = _system(path)
    found, number = [], after + 1
    while most is None or len(found) < most:
        name = f"{place}/manifest/{number:020d}.json"
        if not system.get_file_info(name).is_file:
            break
        with system.open_input_stream(name) as stream:
            found.append((number, json.loads(stream.readall())))
        number += 1
    return found


@dataclass
class Stretch(InputPartition):
    """A file's messages from ``first`` on, ``count`` of them after ``skip`` lines."""

    partition: int
    first: int
    skip: int
    count: int
    file: str


def _position(version: int, ends) -> dict:
    return {"version": version, "ends": {str(p): n for p, n in dict(ends).items()}}


def _stretches(path: str, start: dict, end: dict) -> list[Stretch]:
    """What lies between two positions: version and offset of each partition, 0 if not named."""
    out = []
    for _, content in _versions(path, start["version"], end["version"] - start["version"]):
        for p, first, n, file in content["files"]:
            low = max(first, start["ends"].get(str(p), 0))
            high = min(first + n, end["ends"][str(p)])
            if low < high:
                out.append(Stretch(p, low, low - first, high - low, file))
    return out


def _read(path: str, stretch: Stretch) -> Iterator[pa.RecordBatch]:
    system, place = _system(path)
    rows: list[str] = []
    done = 0

    def batch() -> pa.RecordBatch:
        first = stretch.first + done - len(rows)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([stretch.partition] * len(rows), pa.int32()),
                pa.array(range(first, first + len(rows)), pa.int64()),
                pa.array(rows, pa.string()),
            ],
            ["partition", "offset", "value"],
        )

    with system.open_input_file(f"{place}/{stretch.file}") as file:
        for number, line in enumerate(io.BufferedReader(file)):
            if number < stretch.skip:
                continue
            if done == stretch.count:
                break
            rows.append(line.rstrip(b"\n").decode())
            done += 1
            if len(rows) == BATCH_ROWS:
                yield batch()
                rows = []
    if rows:
        yield batch()


class MessageLog(DataSource):
    """Options: path; startingOffsets (earliest or latest) of a query that has no checkpoint yet."""

    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _LogReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _LogStream(self.options)


class _LogReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path = options["path"]

    def partitions(self) -> list[Stretch]:
        found = _versions(self.path, 0)
        if not found:
            return [Stretch(0, 0, 0, 0, "")]
        end = _position(found[-1][0], enumerate(found[-1][1]["ends"]))
        return _stretches(self.path, _position(0, {}), end) or [Stretch(0, 0, 0, 0, "")]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition) if partition.file else iter(())


class _LogStream(DataSourceStreamReader):
    """Positions are the manifest's version and the next offset of every partition."""

    def __init__(self, options) -> None:
        self.path = options["path"]
        self.latest = options.get("startingOffsets", "earliest") == "latest"
        self.newest = _position(0, {})

    def initialOffset(self) -> dict:
        return self.latestOffset() if self.latest else _position(0, {})

    def latestOffset(self) -> dict:
        found = _versions(self.path, self.newest["version"])
        if found:
            self.newest = _position(found[-1][0], enumerate(found[-1][1]["ends"]))
        return self.newest

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        return _stretches(self.path, start, end)

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition)

    def commit(self, end: dict) -> None:
        pass


def register_message_log(spark: SparkSession) -> None:
    """Make ``format("message_log")`` known to a session."""
    spark.dataSource.register(MessageLog)


def message_log_stream(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """The messages of a log as they are appended."""
    register_message_log(spark)
    reader = spark.readStream.format("message_log").option("path", path)
    return reader.options(**{k: str(v) for k, v in options.items()}).load()
