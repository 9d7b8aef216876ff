"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SHARED: dict[str, str] = {}
_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def local_session(app: str = "gaugeworks", cpus: str = "*", **conf: str) -> SparkSession:
    """Session for tests and the bench. A cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one process, gets a
    temporary folder when the setting is missing.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SHARED:
        _LOCAL_SHARED[app] = tempfile.mkdtemp(prefix="gaugeworks-")
    return _LOCAL_SHARED[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has been written to."""
    return f"{shared_dir(spark)}/gaugeworks/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the shared folder once and go on from the table."""
    path = fresh_path(df.sparkSession, label)
    held = _SCRATCH.get()
    if held is not None:
        held.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def settled(spark: SparkSession, label: str, job: Callable[[], DataFrame]) -> DataFrame:
    """The result of ``job`` as a table; the tables that it wrote on its way are removed."""
    path = fresh_path(spark, label)
    with scratch(spark):
        job().write.parquet(path)
    held = _SCRATCH.get()
    if held is not None:
        held.append(path)
    return spark.read.parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialise`` writes inside are removed at the end.

    What is computed from them must have been written elsewhere by then.
    """
    paths: list[str] = []
    token = _SCRATCH.set(paths)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for path in paths:
            remove_path(spark, path)
