"""Small files beside tables: records and listings, on whatever store the path names."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A folder reached through the session's own file systems, so any URI will do."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._at().getFileSystem(self._conf)

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """Names of what lies in a folder, in order; none if it is not there."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name)))

    def matching(self, pattern: str) -> list[str]:
        """Paths below the folder that match a glob pattern, in order; in one listing."""
        found = self._fs.globStatus(self._at(pattern)) or []
        depth = pattern.count("/") + 1
        return sorted("/".join(s.getPath().toString().rsplit("/", depth)[1:]) for s in found)

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """The whole text under a name that is free; False if it is taken, and nothing is done.

        The text is written aside and moved by a rename that never replaces a file.
        """
        aside = self._at(f"{name}.{uuid.uuid4().hex[:8]}.part")
        stream = self._fs.create(aside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        target = self._fs.makeQualified(self._at(name))
        hadoop = self._jvm.org.apache.hadoop.fs
        never_over = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            hadoop.FileContext.getFileContext(target.toUri(), self._conf).rename(
                self._fs.makeQualified(aside), target, never_over
            )
        except Py4JJavaError as err:
            self._fs.delete(aside, False)
            if "FileAlreadyExistsException" in err.java_exception.getClass().getName():
                return False
            raise
        return True

    def date(self, name: str, milliseconds: int) -> None:
        """Sets a file's modification time."""
        self._fs.setTimes(self._at(name), milliseconds, -1)

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)


# Characters that a partition folder's name writes as their hexadecimal number.
_ESCAPED = {chr(n) for n in range(1, 32)} | set("\"#%'*/:=?\\\x7f{[]^")
_NOTHING = "__HIVE_DEFAULT_PARTITION__"


def folder_name(match_type: str | None, year: int | None) -> str:
    """The folder ``match_type=…/year=…`` that Spark's writer makes for these values."""
    kind = "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in match_type or "") or _NOTHING
    return f"match_type={kind}/year={_NOTHING if year is None else year}"


def newest(names: list[str]) -> str | None:
    """The highest of names that are zero-padded numbers; others don't count."""
    return max((n for n in names if n.isdigit()), default=None)


class Conflict(RuntimeError):
    """Another writer has committed the same number."""


class Records:
    """Numbered JSON records in a folder, of which the highest counts.

    A commit is one new file that must not exist yet: readers see the record before or the one
    after, a writer that ends anywhere else leaves what was, and of two writers one is told.
    """

    #: Records that stay, for readers that have just opened one.
    KEPT = 3

    def __init__(self, folder: Folder, name: str):
        self._folder, self._name = folder, name

    def latest(self, default: dict) -> tuple[int, dict]:
        """Number and content of the record that counts; -1 and ``default`` without any."""
        last = newest(self._folder.names(self._name))
        return (-1, default) if last is None else (int(last), json.loads(self._folder.read(f"{self._name}/{last}")))

    def commit(self, after: int, content: dict) -> int:
        """Writes the record that follows number ``after``."""
        number = after + 1
        if not self._folder.create(f"{self._name}/{number:012d}", json.dumps(content)):
            raise Conflict(f"{self._folder.path}/{self._name}/{number:012d}")
        for name in self._folder.names(self._name):
            if name.isdigit() and int(name) <= number - self.KEPT:
                self._folder.delete(f"{self._name}/{name}")
        return number


def retried(action: Callable[[], None], times: int = 10) -> None:
    """Runs ``action`` again when another writer was first."""
    for attempt in range(times):
        try:
            return action()
        except Conflict:
            if attempt == times - 1:
                raise
