"""Published versions of stored tables.

A table is never written over: each build writes a folder of its own, and counts only
once a small manifest names that folder. A run that dies before leaves the last published
version as it was, and nothing else to be seen. Manifests are numbered files that are
created and never changed, so they need no rename, which object stores do not have; one
that was cut short is not read, and the one before it counts.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Manifest:
    """``folder`` holds the version; ``build`` is shared by all tables that one build of a
    stage made; ``inputs`` are the builds or fingerprints it was made from, by name."""

    build: str
    folder: str
    stage: str = ""
    settings: str = ""
    inputs: dict = field(default_factory=dict)
    found: dict = field(default_factory=dict)


class Files:
    """What is needed of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession):
        self.jvm = spark.sparkContext._jvm
        self.settings = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        target = self.jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.settings), target

    def exists(self, path: str) -> bool:
        files, target = self._at(path)
        return files.exists(target)

    def names(self, path: str) -> list[str]:
        files, target = self._at(path)
        return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []

    def read(self, path: str) -> str:
        files, target = self._at(path)
        stream = files.open(target)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """A new file; an error if there is one already."""
        files, target = self._at(path)
        stream = files.create(target, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        files, target = self._at(path)
        files.delete(target, True)

    def fingerprint(self, path: str) -> str:
        """Of the names, sizes and times of all files below a path, or matching it."""
        files, target = self._at(path)
        digest = hashlib.sha256()
        for found in files.globStatus(target) or []:
            below = files.listFiles(found.getPath(), True)
            listed = []
            while below.hasNext():
                status = below.next()
                listed.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}\n")
            digest.update("".join(sorted(listed)).encode())
        return digest.hexdigest()


class Versions:
    """The manifests of the tables of one store, in a folder beside them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.files, self.folder = Files(spark), f"{folder.rstrip('/')}/_published"

    def _numbers(self, table: str) -> list[int]:
        names = self.files.names(f"{self.folder}/{table}")
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def history(self, table: str) -> list[Manifest]:
        """Readable manifests, the latest first."""
        found = []
        for number in reversed(self._numbers(table)):
            try:
                found.append(Manifest(**json.loads(self.files.read(f"{self.folder}/{table}/{number}.json"))))
            except (ValueError, TypeError):
                continue  # cut short
        return found

    def latest(self, table: str) -> Manifest | None:
        for manifest in self.history(table):
            return manifest if manifest.build else None
        return None

    def publish(self, table: str, manifest: Manifest) -> None:
        number = max(self._numbers(table), default=0) + 1
        self.files.create(f"{self.folder}/{table}/{number}.json", json.dumps(asdict(manifest)))

    def retract(self, table: str) -> None:
        """From now on there is no such table."""
        if self.latest(table) is not None:
            self.publish(table, Manifest("", ""))


def new_build() -> str:
    return uuid.uuid4().hex


def with_numbers(found):
    """JSON has no whole numbers as keys; reports do."""
    if isinstance(found, dict):
        return {int(k) if k.isdigit() else k: with_numbers(v) for k, v in found.items()}
    return found
