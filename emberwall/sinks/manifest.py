"""Which parts of a folder belong together, told by one small file at a time.

Writers put data into places that nobody reads yet and then publish the next version of
the manifest, a file that names all the data there is. Readers take the latest version,
so they see all of a change or nothing of it. A version is published by renaming a file
that is complete to a name that must be free, so two writers can't publish the same one:
on HDFS the file system sees to that; a store that renames by copying can't.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has published a version since this one was read."""


class Manifest:
    """The versions in ``folder``; contents are dictionaries that JSON can hold."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder.rstrip("/")
        self._jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        place = self._path(self.folder)
        self._files = place.getFileSystem(conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._files.getUri(), conf
        )
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        self._no_overwriting = spark._sc._gateway.new_array(rename, 0)
        self._files.mkdirs(place)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _numbers(self, pattern: str) -> list[int]:
        names = [f.getPath().getName() for f in self._files.listStatus(self._path(self.folder))]
        return sorted(int(m[1]) for name in names if (m := re.fullmatch(pattern, name)))

    def versions(self) -> list[int]:
        return self._numbers(r"v(\d+)\.json")

    def _file(self, version: int) -> str:
        return f"{self.folder}/v{version:08d}.json"

    def read(self, version: int | None = None) -> tuple[int, dict]:
        """A version, by default the latest, and its contents; 0 and nothing if there is
        none."""
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return 0, {}
        stream = self._files.open(self._path(self._file(version)))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return version, json.loads(text)

    def publish(self, after: int, contents: dict) -> int:
        """Make ``contents`` the version that follows ``after``."""
        made = f"{self.folder}/_{uuid.uuid4().hex}"
        stream = self._files.create(self._path(made), False)
        stream.write(bytearray(json.dumps(contents, indent=1).encode()))
        stream.close()
        try:
            self._context.rename(
                self._path(made), self._path(self._file(after + 1)), self._no_overwriting
            )
        except Exception as error:
            self._files.delete(self._path(made), False)
            if self._files.exists(self._path(self._file(after + 1))):
                raise Conflict(f"version {after + 1} of {self.folder} is another writer's") from error
            raise
        return after + 1

    def claim(self, least: int = 1) -> int:
        """A number that no other writer gets, now or later, and not below ``least``."""
        number = max([least, *(n + 1 for n in self.claimed())])
        while not self._files.createNewFile(self._path(f"{self.folder}/claim-{number:08d}")):
            number += 1
        return number

    def claimed(self) -> list[int]:
        """All numbers that were claimed."""
        return self._numbers(r"claim-(\d+)")

    def claimed_before(self, number: int, seconds: float) -> bool:
        """Whether the number was claimed at least so many seconds ago."""
        return self._age(f"{self.folder}/claim-{number:08d}") >= seconds

    def published_before(self, version: int, seconds: float) -> bool:
        return self._age(self._file(version)) >= seconds

    def _age(self, name: str) -> float:
        written = self._files.getFileStatus(self._path(name)).getModificationTime()
        return (self._jvm.java.lang.System.currentTimeMillis() - written) / 1000

    def forget(self, version: int) -> None:
        """Remove an old version."""
        self._files.delete(self._path(self._file(version)), False)
