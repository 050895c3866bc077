"""Commit log of a folder: numbered entries, each published whole or not at all.

``root/_log/<version>.json`` holds entry ``version``. A writer first writes its data under names of its own, then its entry
to a temporary file, and then takes the version with one exclusive rename. Of two writers that want the same version one
succeeds and the other is told; a writer that dies earlier leaves files that no entry names. Readers see the entries that
are there and the data that these name, so they see all of a commit or none of it.

The rename is the file system's own: ``rename`` to a name that is taken fails on HDFS and the stores that keep its
contract; local folders (tests) use a hard link, as a local rename would replace the file. A store without an atomic
rename needs a catalog for this instead.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

LOG = "_log"


def _path(spark: SparkSession, *parts: str) -> tuple[Any, Any]:
    """(file system, path) of a location."""
    path = spark._jvm.org.apache.hadoop.fs.Path("/".join([parts[0].rstrip("/"), *parts[1:]]))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, root: str) -> list[int]:
    """The committed versions, ascending."""
    fs, log = _path(spark, root, LOG)
    if not fs.exists(log):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(log)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_entry(spark: SparkSession, root: str, version: int) -> dict:
    fs, path = _path(spark, root, LOG, f"{version:020d}.json")
    stream = fs.open(path)
    try:
        return json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
    finally:
        stream.close()


def try_commit(spark: SparkSession, root: str, version: int, entry: dict) -> bool:
    """Publish ``entry`` as ``version``; false if the version is taken."""
    fs, taken = _path(spark, root, LOG, f"{version:020d}.json")
    _, draft = _path(spark, root, LOG, f".{uuid.uuid4().hex}.tmp")
    stream = fs.create(draft, False)
    stream.write(json.dumps(entry, sort_keys=True).encode())
    stream.close()
    try:
        if fs.getScheme() == "file":
            local = [p.toUri().getPath() for p in (draft, taken)]
            try:
                os.link(*local)
            except FileExistsError:
                return False
            return True
        return not fs.exists(taken) and fs.rename(draft, taken)
    finally:
        fs.delete(draft, False)


def commit_next(spark: SparkSession, root: str, make: Callable[[int, dict | None], dict], attempts: int = 100) -> tuple[int, dict]:
    """Commit ``make(version, entry before)`` as the next version, again whenever another writer was faster: ``make`` sees
    what that writer left. The first version is 1 and has no entry before it."""
    for _ in range(attempts):
        have = versions(spark, root)
        last = have[-1] if have else 0
        entry = make(last + 1, read_entry(spark, root, last) if last else None)
        if try_commit(spark, root, last + 1, entry):
            return last + 1, entry
    raise RuntimeError(f"{root}: other writers were faster {attempts} times")
