"""A log of numbered versions that several writers extend, one at a time.

Version n is one small file, made only if there is none by that name, so of two writers on the
same base one is first and the other goes on from the new base. All writers agree on one order and
no version is lost.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession

from gaugeworks import files

#: Where a reader starts to look; it may be behind, never ahead.
HINT = "_latest"


@dataclass(frozen=True)
class Version:
    number: int
    content: dict


def _path(log: str, number: int) -> str:
    return f"{log}/{number:020d}.json"


def _read(spark: SparkSession, log: str, number: int) -> Version:
    return Version(number, json.loads(files.read_text(spark, _path(log, number))))


def newest(spark: SparkSession, log: str) -> Version | None:
    """The last version, found from the hint by a few probes, or None for an empty log."""
    number = 0
    if files.exists(spark, f"{log}/{HINT}"):
        text = files.read_text(spark, f"{log}/{HINT}").strip()
        number = int(text) if text.isdigit() else 0
    while files.exists(spark, _path(log, number + 1)):
        number += 1
    return _read(spark, log, number) if number else None


def history(spark: SparkSession, log: str) -> Iterator[Version]:
    """All versions from the last to the first."""
    last = newest(spark, log)
    for number in range(last.number if last else 0, 0, -1):
        yield _read(spark, log, number)


def extend(
    spark: SparkSession, log: str, change: Callable[[Version | None], dict], attempts: int = 100
) -> Version:
    """Add the version that ``change`` makes of the newest one.

    When another writer is first, ``change`` is called again with what that one wrote; it
    raises to give up.
    """
    for _ in range(attempts):
        base = newest(spark, log)
        content = change(base)
        number = base.number + 1 if base else 1
        if files.put_if_absent(spark, _path(log, number), json.dumps(content)):
            files.write_text(spark, f"{log}/{HINT}", str(number))
            return Version(number, content)
    raise RuntimeError(f"{log}: {attempts} times another writer was first")
