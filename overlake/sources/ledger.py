"""Which files of a folder have been loaded, by path, size and time.

A window of modification times misses a file that arrives late with an old time, and loads
again what lies within the window.  The ledger remembers every file instead: what it does not
hold, or holds with another size or time, is new.  Spark lists the folder, in tasks where it has
many folders, and an anti-join finds what is new.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from overlake.session import fresh_path
from overlake.sources.files import Folder, Records

LEDGER = "path string, length long, modificationTime timestamp"
#: Parts that are folded into one.
FOLD = 16


class FileLedger:
    """The ledger's parts are tables below ``path``; a numbered record names those that count."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._folder = Folder(spark, self.path)
        self._records = Records(self._folder, "state")

    def _held(self, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(*[f"{self.path}/{p}" for p in parts])

    def held(self) -> DataFrame:
        """(path, length, modificationTime) of every version of a file that was loaded."""
        return self._held(self._records.latest({"parts": []})[1]["parts"])

    def unseen(self, folder: str, pattern: str = "*.json") -> DataFrame:
        """(path, length, modificationTime) of the files below ``folder`` that are new; none is opened."""
        listed = (
            self.spark.read.format("binaryFile")
            .option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true")
            .load(folder)
            .select("path", "length", "modificationTime")
        )
        return listed.join(self.held(), ["path", "length", "modificationTime"], "left_anti")

    def take(self, folder: str, load: Callable[[list[str]], object], pattern: str = "*.json") -> int:
        """Calls ``load`` with the new files, if any, and then notes them; their number.

        A run that ends before the files are noted loads them again, so ``load`` must not mind,
        as :func:`overlake.sources.write_silver` in incremental mode.  The list of new files
        is shorter than the listing that Spark's own driver holds.
        """
        number, state = self._records.latest({"parts": []})
        new = fresh_path(self.spark, "unseen")
        self.unseen(folder, pattern).write.parquet(new)
        found = self.spark.read.schema(LEDGER).parquet(new)
        paths = [r.path for r in found.select("path").toLocalIterator()]
        if paths:
            # A reader takes paths for patterns.
            load([re.sub(r"([*?{}\[\]\\])", r"\\\1", p) for p in paths])
            parts, rows = state["parts"], found
            if len(parts) + 1 >= FOLD:
                parts, rows = [], found.unionByName(self._held(state["parts"])).distinct()
            part = f"part-{number + 1:012d}-{uuid.uuid4().hex[:8]}"
            rows.write.parquet(f"{self.path}/{part}")
            self._records.commit(number, {"parts": [*parts, part], "gone": state["parts"] if not parts else []})
            for old in state.get("gone", []):
                self._folder.delete(old)
        Folder(self.spark, new).delete()
        return len(paths)
