"""Versions of stored tables: written aside, made current by one small file.

A writer puts its files into a folder of its own and then creates the next numbered
manifest, which names the folder of every table or partition. Creating fails if the number
is taken, so two writers never share one, and a manifest counts only when its last line is
there. Readers use the newest such manifest. Whatever moment a writer stops at, readers see
the version before it, whole; a table of many partitions names old folders for those that did
not change. Old versions are removed by ``retain``, which never touches a folder that a kept
manifest names, nor a young one that a writer may still be filling.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

END = "end of manifest"
#: Age in milliseconds from which folders that no kept manifest names are removed.
GRACE = 7 * 24 * 3600 * 1000


class Conflict(RuntimeError):
    """Another writer has made a version since this one began."""


@dataclass(frozen=True)
class Version:
    number: int = 0
    paths: dict[str, str] = field(default_factory=dict)
    notes: dict[str, str] = field(default_factory=dict)


class Versions:
    """The versions below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def begin(self) -> str:
        """A folder of its own for the files of a new version."""
        return f"{self.root}/data/{int(time.time() * 1000)}-{uuid.uuid4().hex}"

    def _numbers(self) -> list[int]:
        folder = self._path(f"{self.root}/manifests")
        if not self._system.exists(folder):
            return []
        return sorted(int(s.getPath().getName()) for s in self._system.listStatus(folder) if s.getPath().getName().isdigit())

    def _read(self, number: int) -> Version | None:
        """The manifest, or None where its writer did not finish it."""
        stream = self._system.open(self._path(self._manifest(number)))
        try:
            text = bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()
        lines = text.splitlines()
        if not lines or lines[-1] != END:
            return None
        made = json.loads(lines[0])
        return Version(number, made["paths"], made["notes"])

    def _manifest(self, number: int) -> str:
        return f"{self.root}/manifests/{number:012d}"

    def current(self) -> Version:
        """The newest complete version; number 0 and no paths before the first."""
        for number in reversed(self._numbers()):
            version = self._read(number)
            if version is not None:
                return version
        return Version()

    def commit(self, paths: dict[str, str], notes: dict[str, str] | None = None, after: Version | None = None) -> Version:
        """Makes ``paths`` the current version.

        With ``after``, the version they build upon, it is a conflict if another has come since.
        """
        if after is not None and self.current().number != after.number:
            raise Conflict(f"{self.root}: version {self.current().number} has come after {after.number}")
        number = max(self._numbers(), default=0) + 1
        try:
            stream = self._system.create(self._path(self._manifest(number)), False)
        except Exception as error:
            if "FileAlreadyExists" not in str(error):
                raise
            if after is not None:
                raise Conflict(f"{self.root}: version {number} is being written") from error
            return self.commit(paths, notes)
        made = Version(number, dict(paths), dict(notes or {}))
        try:
            self._write(stream, json.dumps({"paths": made.paths, "notes": made.notes}, sort_keys=True) + "\n" + END + "\n")
        finally:
            stream.close()
        return made

    def _write(self, stream, text: str) -> None:
        stream.write(bytearray(text.encode("utf-8")))

    def retain(self, versions: int = 2, grace: int = GRACE) -> list[str]:
        """Keeps the newest complete ``versions``; removes older manifests and folders nobody names."""
        complete = [v for v in map(self._read, self._numbers()) if v is not None]
        kept = complete[-versions:]
        named = {path for v in kept for path in v.paths.values()}
        for number in self._numbers():
            if kept and number < kept[0].number:
                self._system.delete(self._path(self._manifest(number)), False)
        removed = []
        data = self._path(f"{self.root}/data")
        for status in self._system.listStatus(data) if self._system.exists(data) else []:
            name = status.getPath().getName()
            folder = f"{self.root}/data/{name}"
            young = int(name.split("-")[0]) > time.time() * 1000 - grace
            if not young and not any(path == folder or path.startswith(folder + "/") for path in named):
                self._system.delete(status.getPath(), True)
                removed.append(folder)
        return removed

    def folders(self, path: str, prefix: str) -> dict[str, str]:
        """The partition folders of a table just written: value -> path, from the file system."""
        place = self._path(path)
        names = [s.getPath().getName() for s in self._system.listStatus(place)] if self._system.exists(place) else []
        return {n[len(prefix):]: f"{path}/{n}" for n in names if n.startswith(prefix)}
