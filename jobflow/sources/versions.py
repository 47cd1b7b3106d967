"""Versioned datasets (A18, and the state of K2 and N3): write aside, then move a pointer.

A dataset is a folder: ``root/dados-<id>/<table>`` holds the Parquet tables of one version, and an empty file
``root/_versoes/<number>.<id>`` makes that version visible.  Creating one empty file is atomic on every
store, and all tables of a version become visible with it, so a reader sees either the whole old version or the
whole new one.  A reader keeps the folder it has resolved: a later publish does not touch it, and
``keep`` versions stay before the oldest is removed.

One writer per dataset is assumed; ``expected`` turns a lost update into an error.  Publishing a number that
is already visible changes nothing, so a replayed batch is idempotent.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

POINTERS, DATA = "_versoes", "dados-"
ORPHAN_SECONDS = 24 * 3600


class StaleVersionError(RuntimeError):
    """Another writer has published since the caller read the dataset."""


def handle(spark: SparkSession, path: str):
    """A path and its file system, whatever the store."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def listing(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Names in a folder with their modification times in seconds; none if it does not exist."""
    p, fs = handle(spark, path)
    if not fs.exists(p):
        return []
    return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in fs.listStatus(p)]


def versions(spark: SparkSession, root: str) -> dict[int, str]:
    """Visible versions: number -> folder, in order."""
    found = {}
    for name, _ in sorted(listing(spark, f"{root.rstrip('/')}/{POINTERS}")):
        number, _, folder = name.partition(".")
        if number.isdigit() and folder:
            found[int(number)] = f"{root.rstrip('/')}/{DATA}{folder}"
    return dict(sorted(found.items()))


def current(spark: SparkSession, root: str) -> int | None:
    """The highest visible version, None before the first."""
    return max(versions(spark, root), default=None)


def publish(spark: SparkSession, root: str, tables: Mapping[str, DataFrame], *, version: int | None = None,
            expected: int | None = None, keep: int = 3) -> int:
    """Write ``tables`` as the next (or the given) version and make it visible; returns its number.

    The tables may read the version that is current now.  ``expected`` is the version that the caller has
    read (-1: none); if another is current when the pointer is due, StaleVersionError is raised.
    """
    root, seen = root.rstrip("/"), versions(spark, root)
    if version is not None and version in seen:
        return version
    number = version if version is not None else max(seen, default=-1) + 1
    name = uuid.uuid4().hex
    for table, df in tables.items():
        df.write.parquet(f"{root}/{DATA}{name}/{table}")
    if expected is not None and (now := current(spark, root)) != (None if expected < 0 else expected):
        raise StaleVersionError(f"{root}: version {now} is current, {expected} was read")
    pointer, fs = handle(spark, f"{root}/{POINTERS}/{number:012d}.{name}")
    fs.create(pointer, False).close()
    expire(spark, root, keep=keep)
    return number


def expire(spark: SparkSession, root: str, *, keep: int, orphan_seconds: float = ORPHAN_SECONDS) -> list[int]:
    """Remove all but the last ``keep`` versions, and folders of failed writers older than ``orphan_seconds``."""
    root, seen = root.rstrip("/"), versions(spark, root)
    old = list(seen)[:-keep] if keep > 0 else []
    for number in old:  # data first: a crash in between leaves a pointer to remove again, not a lost folder
        for path in (seen[number], f"{root}/{POINTERS}/{number:012d}.{seen[number].rpartition(DATA)[2]}"):
            p, fs = handle(spark, path)
            fs.delete(p, True)
    for name, changed in listing(spark, root):
        if name.startswith(DATA) and f"{root}/{name}" not in seen.values() and changed < time.time() - orphan_seconds:
            p, fs = handle(spark, f"{root}/{name}")
            fs.delete(p, True)
    return old


def read(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    """A table of the current (or the given) version; the frame stays on that version."""
    seen = versions(spark, root)
    number = max(seen, default=None) if version is None else version
    if number not in seen:
        raise FileNotFoundError(f"{root}: no version {'yet' if number is None else number}")
    return spark.read.parquet(f"{seen[number]}/{table}")
