"""A small versioned record of which files of a table are current, kept beside them in the shared folder.

Writers put new files down first and then name them in the next version; readers take the newest version. A
crash in between leaves files that no version names, so nothing is lost and nothing counts twice.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import SparkSession

_NAME = re.compile(r"manifest-(\d{12})\.json")


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of the shared folder, if it is there."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


class Manifest:
    """Versions 1, 2, ... of a JSON object below ``path``; one writer at a time."""

    #: Older versions kept, for readers that began before the newest.
    KEEP = 3

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path.rstrip("/")

    def _versions(self) -> list[int]:
        fs, folder = _file_system(self._spark, self._path)
        if not fs.exists(folder):
            return []
        found = (_NAME.fullmatch(s.getPath().getName()) for s in fs.listStatus(folder))
        return sorted(int(m[1]) for m in found if m)

    def _file(self, version: int) -> str:
        return f"{self._path}/manifest-{version:012d}.json"

    def read(self) -> tuple[int, dict]:
        """The newest version and what it says; (0, {}) if there is none."""
        versions = self._versions()
        if not versions:
            return 0, {}
        fs, file = _file_system(self._spark, self._file(versions[-1]))
        stream = fs.open(file)
        try:
            return versions[-1], json.loads(self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def replace(self, version: int, state: dict) -> None:
        """Make ``state`` the version after ``version``, which must be the newest.

        The file is written under another name and renamed, so no reader sees half of it. If
        another writer was faster, the rename fails and the newest version stays.
        """
        jvm, number = self._spark._jvm, version + 1
        fs, target = _file_system(self._spark, self._file(number))
        if fs.exists(target):
            raise RuntimeError(f"version {number} of {self._path} was written by somebody else")
        hidden = jvm.org.apache.hadoop.fs.Path(f"{self._path}/_{number:012d}-{jvm.java.util.UUID.randomUUID()}")
        out = fs.create(hidden, True)
        out.write(json.dumps(state).encode())
        out.close()
        if not fs.rename(hidden, target):
            fs.delete(hidden, True)
            raise RuntimeError(f"version {number} of {self._path} was written by somebody else")
        for old in self._versions()[:-self.KEEP]:
            delete(self._spark, self._file(old))
