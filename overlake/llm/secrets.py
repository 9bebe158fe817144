"""Secret scans over an incremental blob ledger; built-in functions only.

A blob is one historical version of a text, addressed by the SHA-256 of its content.  A rule
has a kind and a version.  ``BlobLedger.advance`` scans only pairs of blob and rule version
that the ledger has not seen, whichever and however many paths hold the blob, and appends
what it found; ``BlobLedger.on_paths`` joins findings back to every path.

Spans count code points, end exclusive.  A null text is an empty one.  Rows may repeat: each
gives a row of the result.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A pattern whose ``group`` must have ``minimum`` characters, after matching.

    ``hints`` are lower-case texts of which one is in any lower-cased text that matches.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    minimum: int = 1
    hints: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base kinds.
BASE_RULES = (
    Rule(
        "assign",
        1,
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
        ("password", "passwd", "secret", "token", "api_key", "apikey"),
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, ("akia",)),
    # Runs are maximal, so the length can be part of the pattern.
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)
#: Kinds that the scan adds to the base ones.
MORE_RULES = (
    Rule("private_key", 1, r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", hints=("private key-----",)),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hints=("eyj",)),
)
RULES = BASE_RULES + MORE_RULES

SPAN = "struct<start:int,rank:int,end:int,kind:string>"
LEDGER = f"blob binary, rules array<string>, found array<{SPAN}>"


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """All leftmost non-overlapping matches of a rule, as an array of spans.

    The text between matches and the matches themselves alternate, so running lengths of
    both give each match's place.
    """
    pattern = F.lit(rule.pattern)
    parts = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length).alias("size"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length).alias("secret"),
    )

    def place(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + F.coalesce(part["size"], F.lit(0))
        span = F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind")
        )
        kept = F.coalesce(part["secret"] >= rule.minimum, F.lit(False))
        return F.struct(
            end.alias("at"), F.when(kept, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out")
        )

    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast(f"array<{SPAN}>").alias("out"))
    start = start.withField("out", F.array().cast(f"array<{SPAN}>"))
    found = F.aggregate(parts, start, place, lambda state: state["out"])
    if rule.hints:
        low = F.lower(text)
        may = F.lit(False)
        for hint in rule.hints:
            may = may | low.contains(hint)
    else:
        may = text.rlike(rule.pattern)
    return F.when(may, found).otherwise(F.array().cast(f"array<{SPAN}>"))


def address(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


class BlobLedger:
    """Findings by blob and rule version, kept as Parquet at ``path``."""

    def __init__(self, spark: SparkSession, path: str, rules: Sequence[Rule] = RULES):
        self.spark, self.path, self.rules = spark, path, tuple(rules)

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(LEDGER).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LEDGER)

    def unseen(self, versions: DataFrame, text: str = "text") -> DataFrame:
        """(blob, text, todo): each distinct blob with the names of the rules not yet applied to it.

        Copies meet in a partial aggregate before the shuffle: a blob on a third of all
        paths leaves each task once.
        """
        content = F.coalesce(F.col(text), F.lit(""))
        blobs = (
            versions.select(content.alias("text"))
            .select(address(F.col("text")).alias("blob"), "text")
            .groupBy("blob")
            .agg(F.first("text").alias("text"))
        )
        seen = self.read().groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("done"))
        names = F.array(*[F.lit(r.name) for r in self.rules])
        return (
            blobs.join(seen, "blob", "left")
            .select("blob", "text", F.array_except(names, F.coalesce("done", F.array().cast("array<string>"))).alias("todo"))
            .where("size(todo) > 0")
        )

    def advance(self, versions: DataFrame, text: str = "text") -> None:
        """Scans what is unseen among ``versions`` and appends one ledger row per blob scanned."""
        none = F.array().cast(f"array<{SPAN}>")
        found = [
            F.when(F.array_contains("todo", r.name), spans(F.col("text"), r, i)).otherwise(none)
            for i, r in enumerate(self.rules)
        ]
        (
            self.unseen(versions, text)
            .select("blob", F.col("todo").alias("rules"), F.concat(*found).alias("found"))
            .write.mode("append")
            .parquet(self.path)
        )

    def findings(self) -> DataFrame:
        """(blob, found): all spans of each blob that has any, under the ledger's current rules."""
        current = [r.name for r in self.rules]
        kinds = [r.kind for r in self.rules]
        # A blob has few ledger rows: one per change of the rules.  A row's spans of a kind
        # count only where the row was scanned with the kind's current version.
        names = F.create_map(*[F.lit(x) for pair in zip(kinds, current, strict=True) for x in pair])
        valid = F.filter("found", lambda s: F.array_contains(F.col("rules"), names[s["kind"]]))
        return (
            self.read()
            .where("size(found) > 0")
            .select("blob", valid.alias("found"))
            .where("size(found) > 0")
            .groupBy("blob")
            .agg(F.array_sort(F.flatten(F.collect_list("found"))).alias("found"))
        )

    def on_paths(self, paths: DataFrame, key: str, text: str = "text") -> DataFrame:
        """(key, found) of every row of ``paths``; ``found`` is sorted by start, then rule."""
        held = paths.select(F.col(key), address(F.col(text)).alias("blob"))
        return held.join(self.findings(), "blob", "left").select(
            key, F.coalesce("found", F.array().cast(f"array<{SPAN}>")).alias("found")
        )


def written(found: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts, hash and text of the spans of each row of ``BlobLedger.on_paths``."""
    base = [r.kind for r in BASE_RULES]

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in base]
    own = F.filter("found", lambda s: s["kind"].isin(base))
    return found.select(
        key, *counts, F.sha2(written(own), 256).alias("base_sha256"), written(F.col("found")).alias("spans")
    )
