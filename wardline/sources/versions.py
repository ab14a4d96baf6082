"""A small state that changes as a whole: one JSON file a version, the newest one counts.

A version is written beside its place and renamed into it, and the rename fails if that version exists. So a reader sees
the state before or after, never between, and of two writers that began at the same version one is refused. Hadoop's file
systems do the renaming, wherever the folder is. Old versions beyond KEEP are removed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

KEEP = 5
_DIGITS = 12


class ConflictError(RuntimeError):
    """Another writer has published since this one began."""


@dataclass(frozen=True)
class Versions:
    spark: SparkSession
    folder: str

    def _hadoop(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        return jvm, path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _file(self, number: int) -> str:
        return f"{number:0{_DIGITS}d}.json"

    def numbers(self) -> list[int]:
        """Versions that are there, oldest first."""
        _, path, system = self._hadoop()
        if not system.exists(path):
            return []
        names = [status.getPath().getName() for status in system.listStatus(path)]
        return sorted(int(name[:_DIGITS]) for name in names if len(name) == _DIGITS + 5 and name[:_DIGITS].isdigit())

    def read(self, number: int) -> dict:
        jvm, path, system = self._hadoop()
        stream = system.open(jvm.org.apache.hadoop.fs.Path(path, self._file(number)))
        try:
            return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def newest(self) -> tuple[int, dict]:
        """(version, state); version 0 with an empty state before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, {})

    def publish(self, expected: int, state: dict) -> int:
        """Make state the next version. ConflictError if expected is not the newest one any more."""
        jvm, path, system = self._hadoop()
        fs = jvm.org.apache.hadoop.fs
        if self.numbers()[-1:] not in ([], [expected]) or (expected and not self.numbers()):
            raise ConflictError(f"version {expected} of {self.folder} is not the newest one")
        system.mkdirs(path)
        beside = fs.Path(path, f"_{uuid.uuid4().hex}")
        stream = system.create(beside, False)
        stream.write(bytearray(json.dumps(state, sort_keys=True).encode()))
        stream.close()
        context = fs.FileContext.getFileContext(system.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        kind = getattr(fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        try:
            context.rename(beside, fs.Path(path, self._file(expected + 1)), options)
        except Py4JJavaError as error:
            system.delete(beside, False)
            if "FileAlreadyExists" in str(error.java_exception):
                raise ConflictError(f"version {expected + 1} of {self.folder} is another writer's") from error
            raise
        return expected + 1

    def outdated(self, keep: int = KEEP) -> list[int]:
        return self.numbers()[:-keep]

    def forget(self, number: int) -> None:
        jvm, path, system = self._hadoop()
        system.delete(jvm.org.apache.hadoop.fs.Path(path, self._file(number)), False)
