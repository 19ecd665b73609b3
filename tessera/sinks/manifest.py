"""Versioned manifests: which files of a dataset readers see.

A manifest is a small JSON document, ``_manifest/<version>.json`` below the dataset's root, that appears by one
rename. Readers take the greatest version, so they see the set before a change or the set after it, never a
mixture, wherever a writer stopped. Folders whose names begin with ``_`` are not data for Spark's own readers.
Works on any file system that Spark's Hadoop client reaches. One writer at a time: a version that is
already there is not replaced but refused.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

FOLDER = "_manifest"


class Conflict(RuntimeError):
    """Another writer has made this version of the manifest."""


class Files:
    """The file system that holds ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self.root = root.rstrip("/")
        self._fs = self.path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        """Names in one folder (empty where there is none), ascending."""
        path = self.path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def size(self, folder: str) -> int:
        return self._fs.getContentSummary(self.path(folder)).getLength()

    def exists(self, name: str) -> bool:
        return self._fs.exists(self.path(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)

    def move(self, name: str, to: str) -> None:
        if not self._fs.rename(self.path(name), self.path(to)):
            raise OSError(f"{self.root}/{name} could not be moved to {to}")

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Write a file that appears whole or not at all, and is never replaced."""
        draft = f"{name}.{uuid.uuid4().hex}.draft"
        stream = self._fs.create(self.path(draft), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.exists(name) or not self._fs.rename(self.path(draft), self.path(name)):
            self.delete(draft)
            raise Conflict(f"{self.root}/{name} is there already")


def versions(files: Files) -> list[int]:
    return [int(n[:-5]) for n in files.names(FOLDER) if n.endswith(".json")]


def _name(version: int) -> str:
    return f"{FOLDER}/{version:010d}.json"


def load(files: Files, version: int | None = None) -> tuple[int, dict]:
    """The latest (or given) manifest and its version; version 0 is the empty one."""
    version = max(versions(files), default=0) if version is None else version
    return version, json.loads(files.read(_name(version))) if version else {}


def commit(files: Files, version: int, content: dict) -> int:
    """Publish ``content`` as the version after ``version``."""
    files.publish(_name(version + 1), json.dumps(content, indent=1, sort_keys=True))
    return version + 1


def forget(files: Files, keep: int) -> None:
    """Delete all but the latest ``keep`` versions, and drafts of writers that stopped."""
    for v in versions(files)[:-keep]:
        files.delete(_name(v))
    for n in files.names(FOLDER):
        if n.endswith(".draft"):
            files.delete(f"{FOLDER}/{n}")
