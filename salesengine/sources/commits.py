"""A log of commits beside the data: what is listed there is visible, all else is not.

A folder holds data folders and ``_log``, in which entry 1, 2, 3 … names the data folder
that it adds. An entry is created only where none is, so of two writers one gets the number
and the other sees it and decides again. Data of a writer that fails is never listed.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from ..session import located

LOG = "_log"
#: How often an entry that is just being written is read again, a tenth of a second apart.
PATIENCE = 50


@dataclass(frozen=True)
class Commit:
    """An entry: its number, its data folder, and what the writer noted."""

    number: int
    data: str
    note: dict[str, Any]


def commits(spark: SparkSession, folder: str, after: int = 0) -> list[Commit]:
    """The entries in order, those behind number ``after``."""
    files, log = located(spark, f"{folder}/{LOG}")
    if not files.exists(log):
        return []
    numbers = sorted(int(s.getPath().getName()) for s in files.listStatus(log))
    return [_read(spark, folder, n) for n in numbers if n > after]


def plain_files(spark: SparkSession, folder: str) -> str | None:
    """The data files of a table that has been written without a log, as one path."""
    files, pattern = located(spark, f"{folder}/part-*")
    return f"{folder}/part-*" if files.globStatus(pattern) else None


def last_commit(spark: SparkSession, folder: str) -> Commit | None:
    files, log = located(spark, f"{folder}/{LOG}")
    if not files.exists(log):
        return None
    numbers = [int(s.getPath().getName()) for s in files.listStatus(log)]
    return _read(spark, folder, max(numbers)) if numbers else None


def _entry(folder: str, number: int) -> str:
    return f"{folder}/{LOG}/{number:012d}"


def _read(spark: SparkSession, folder: str, number: int) -> Commit:
    files, path = located(spark, _entry(folder, number))
    for _ in range(PATIENCE):
        stream = files.open(path)
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        if text.endswith("\n"):  # written to its end
            found = json.loads(text)
            return Commit(number, found["data"], found["note"])
        time.sleep(0.1)
    raise OSError(f"{_entry(folder, number)} is not complete")


def new_data(folder: str) -> str:
    """A data folder that nobody sees before its commit."""
    return f"{folder}/data-{uuid.uuid4().hex}"


def try_commit(spark: SparkSession, folder: str, number: int, data: str, **note: Any) -> bool:
    """Create entry ``number``, or leave the one that is there and return False."""
    files, path = located(spark, _entry(folder, number))
    if files.exists(path):
        return False
    try:
        stream = files.create(path, False)
    except Py4JJavaError:
        if files.exists(path):  # another writer was first
            return False
        raise
    try:
        stream.write(bytearray(json.dumps({"data": data, "note": note}).encode() + b"\n"))
    finally:
        stream.close()
    return True


def sweep(spark: SparkSession, folder: str, keep: int) -> None:
    """Delete all entries and their data but the ``keep`` newest; readers of those go on."""
    for old in commits(spark, folder)[:-keep]:
        for path in (_entry(folder, old.number), old.data):
            files, location = located(spark, path)
            files.delete(location, True)
