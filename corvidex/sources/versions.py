"""Snapshots of a folder of tables: numbered manifests, each switched to by one rename.

A manifest is a JSON file that names all a snapshot consists of.  A writer puts its new files into folders no manifest names yet, then
renames the next manifest into place; the rename fails if another writer was there first.  So a reader sees a whole snapshot, the old one or the new,
and a writer that fails leaves nothing but folders that :func:`vacuum` removes.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

DIGITS = 12


class Conflict(RuntimeError):
    """Another writer switched to this number first."""


class Folder:
    """A folder in any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self._path(f"{self.path}/{name}")

    def names(self, name: str) -> list[str]:
        where = self.at(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(where)) if self.fs.exists(where) else []

    def read(self, name: str) -> str:
        source = self.fs.open(self.at(name))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def write(self, name: str, text: str) -> None:
        target = self.fs.create(self.at(name), False)
        try:
            target.write(bytearray(text.encode()))
        finally:
            target.close()


def numbers(folder: Folder) -> list[int]:
    """The snapshots there are, in ascending order."""
    return [int(n[: -len(".json")]) for n in folder.names("manifests") if n.endswith(".json") and n[: -len(".json")].isdigit()]


def manifest(folder: Folder, number: int | None = None) -> tuple[int, dict]:
    """(number, content) of a snapshot, the latest if none is named; (0, {}) before the first."""
    there = numbers(folder)
    number = number if number is not None else there[-1] if there else 0
    return (number, json.loads(folder.read(f"manifests/{number:0{DIGITS}d}.json"))) if number else (0, {})


def switch(folder: Folder, number: int, content: dict) -> int:
    """Make ``content`` the snapshot after ``number``; ``Conflict`` if there is one already."""
    target = f"manifests/{number + 1:0{DIGITS}d}.json"
    own = f"manifests/.{uuid.uuid4().hex}"
    folder.fs.mkdirs(folder.at("manifests"))
    if folder.fs.exists(folder.at(target)):
        raise Conflict(target)
    folder.write(own, json.dumps(content, sort_keys=True))
    try:
        done = folder.fs.rename(folder.at(own), folder.at(target)) and not folder.fs.exists(folder.at(own))
    except Exception as e:  # some file systems raise where others say no
        if not folder.fs.exists(folder.at(target)):
            raise
        raise Conflict(target) from e
    if not done:
        folder.fs.delete(folder.at(own), False)
        raise Conflict(target)
    return number + 1


def vacuum(folder: Folder, data: str, used_by, keep: int = 2) -> list[str]:
    """Drop all manifests but the last ``keep``, and the folders under ``data`` that none of those names (``used_by(content)``); gives the folders."""
    there = numbers(folder)
    kept = there[-keep:]
    used = {name for n in kept for name in used_by(manifest(folder, n)[1])}
    for n in there[: -keep or None]:
        folder.fs.delete(folder.at(f"manifests/{n:0{DIGITS}d}.json"), False)
    gone = [name for name in folder.names(data) if name not in used]
    for name in gone:
        folder.fs.delete(folder.at(f"{data}/{name}"), True)
    return gone
