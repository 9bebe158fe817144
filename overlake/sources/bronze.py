"""Bronze layer: raw documents kept per revision.

A batch is named by its feed and number.  Every attempt to apply it writes a *part* of its own,
a folder that no other attempt has: accepted documents, unreadable ones, a report, and index
rows.  One new state record then makes the part count and, in the same file, notes the batch's
digest.  So a run that ends anywhere changes either nothing or everything, and the same
batch again finds its digest and changes nothing, whether the run before ended early or not.
The same name with other content is refused.  Of two writers that commit at once one is told
so and starts again from the other's state.

The index has one narrow row per accepted document and lies in ranges of the match id's hash.
A batch reads the ranges that its matches fall into and no others.  A range that has been
written ``FOLD`` times is folded into the new part, one row per match, so a range costs about
one row per match; folded rows are deleted once a later commit has made them unreachable.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from overlake.functions import to_int
from overlake.operators.versions import classify_revisions, latest_by
from overlake.schemas import CORRUPT
from overlake.session import fresh_path
from overlake.sources.files import Conflict, Folder, Records, retried
from overlake.sources.raw import match_id_from, match_type_key, year_key

_HEAD = f"meta struct<revision variant>, info struct<match_type string, dates string>, {CORRUPT} string"

# ``part`` is the folder that holds a row; ``of`` the part whose documents an index row stands for.
_ORIGIN = "feed string, batch long"
BRONZE = f"match_id string, revision int, content string, status string, {_ORIGIN}, part string, match_type string, year string"
INDEX = f"match_id string, revision int, {_ORIGIN}, of string, part string, range int"
ERRORS = f"match_id string, reason string, content string, {_ORIGIN}, part string"
REPORT = "match_type string, year string, status string, matches long, part string"
APPLIED = f"{_ORIGIN}, digest string, of string, part string"
_KINDS = ("documents", "errors", "report", "index", "applied")
#: Times that a range is written before it is folded, and batches that a state record names itself.
FOLD = 16
#: Ranges of a new store's index; a larger store wants more, so that a batch touches few.
RANGES = 64
UNREADABLE = "not a JSON document"


def bronze_rows(texts: DataFrame, name: str = "name", content: str = "content") -> DataFrame:
    """(name, content) -> match_id, match_type, year, revision, content, error.

    Only the few leaves that route a document are parsed.  A column ``error`` of the input,
    as archive members have, is carried on; a document of which nothing can be read gets one.
    """
    head = F.from_json(F.col(content), _HEAD, {"columnNameOfCorruptRecord": CORRUPT})
    known = F.col("error") if "error" in texts.columns else F.lit(None).cast("string")
    opened = texts.select(
        match_id_from(name).alias("match_id"),
        F.col(content).alias("content"),
        known.alias("known"),
        F.inline(F.array(head)),
    )
    broken = f"meta IS NULL AND info IS NULL AND ({CORRUPT} IS NOT NULL OR trim(coalesce(content, '')) = '')"
    return opened.select(
        "match_id",
        match_type_key().alias("match_type"),
        year_key().alias("year"),
        F.coalesce(to_int("meta.revision"), F.lit(1)).alias("revision"),
        "content",
        F.coalesce("known", F.when(F.expr(broken), F.lit(UNREADABLE))).alias("error"),
    )


def taken_rows(rows: DataFrame, accepted: DataFrame) -> DataFrame:
    """The rows of a batch that are accepted, one per match, with their status.

    A match has one accepted revision and text, so the join is by match alone and places the
    texts where one of equal copies is chosen: they are exchanged once.  What else must agree is
    written without an equality of two columns, which would become a key of the join.
    """
    renamed = {c: f"__{c}" for c in ("revision", "h1", "h2")}
    same = " AND ".join(f"({c} ^ {other}) = 0" for c, other in renamed.items())
    joined = rows.join(accepted.withColumnsRenamed(renamed), "match_id").filter(same).drop(*renamed.values())
    # Copies of an accepted document agree in all columns: any one of them will do.
    return latest_by(joined, ["match_id"], ["h1"])


class BronzeStore:
    def __init__(self, spark: SparkSession, path: str, ranges: int | None = None):
        self.spark, self.path, self._ranges = spark, path.rstrip("/"), ranges or RANGES
        self._folder = Folder(spark, self.path)
        self._records = Records(self._folder, "state")

    # state -----------------------------------------------------------------------

    def _state(self) -> tuple[int, dict]:
        """Number and content of the record that counts.

        ``index`` has the parts of each range, oldest first; ``recent`` the digest and part of the
        batches since the table of applied batches, whose part is ``applied``, was last written;
        ``gone`` the folders that this record is the first not to need.
        """
        return self._records.latest({"ranges": self._ranges, "index": {}, "recent": {}, "applied": None, "gone": []})

    def _about_to(self, write: str) -> None:
        """Called before everything that is written; a test ends the run here."""

    def _read(self, schema: str, kind: str, parts: list[str] | None = None) -> DataFrame:
        """A kind of table, of the given parts or of all; an empty one if nothing is there."""
        base = f"{self.path}/{kind}"
        paths = [base] if parts is None else [f"{base}/part={p}" for p in parts]
        try:
            if paths:
                return self.spark.read.schema(schema).option("basePath", base).parquet(*paths)
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
        return self.spark.createDataFrame([], schema)

    def _index(self, state: dict, ranges: list[str] | None = None) -> DataFrame:
        """Newest row of each match; of the given ranges only, whose folders alone are opened."""
        wanted = state["index"] if ranges is None else ranges
        parts = sorted({p for r in wanted for p in state["index"].get(r, ())})
        rows = self._read(INDEX, "index", parts)
        if ranges is not None:
            rows = rows.filter(F.col("range").isin([int(r) for r in ranges]))
        newest_ = F.max(F.struct("revision", "batch", "feed", "of")).alias("n")
        return rows.groupBy("match_id").agg(newest_, F.max("range").alias("range")).select("match_id", "n.*", "range")

    def index(self) -> DataFrame:
        """(match_id, revision, feed, batch, part) of the newest stored document of each match."""
        return self._index(self._state()[1]).drop("range").withColumnRenamed("of", "part")

    def _applied(self, state: dict) -> DataFrame:
        """(feed, batch, digest, of) of every batch that counts: one row per batch."""
        rows = [(*n.rsplit("/", 1), *known) for n, known in state["recent"].items()]
        recent = self.spark.createDataFrame([(f, int(b), d, p) for f, b, d, p in rows], f"{_ORIGIN}, digest string, of string")
        older = [] if state["applied"] is None else [state["applied"]]
        return recent.unionByName(self._read(APPLIED, "applied", older).drop("part"))

    def _known(self, state: dict, feed: str, batch_id: int) -> tuple[str, str] | None:
        """Digest and part of a batch, if it was applied."""
        known = state["recent"].get(f"{feed}/{batch_id}")
        if known is None and state["applied"] is not None:
            known = self._applied(state).filter((F.col("feed") == feed) & (F.col("batch") == batch_id)).select("digest", "of").first()
        return None if known is None else tuple(known)

    # writing ---------------------------------------------------------------------

    def apply(self, batch: DataFrame, batch_id: int, feed: str = "main") -> None:
        """Store the documents that are new or carry a higher revision; keep unreadable ones apart.

        ``batch`` is computed once: its rows are written to the scratch folder, and what
        follows reads the narrow columns of that, and the text of accepted documents alone.
        """
        scratch = fresh_path(self.spark, "bronze-batch")
        columns = ("match_id", "match_type", "year", "revision", "content", "error")
        text = F.coalesce(F.col("content"), F.lit(""))
        # Two hashes of the text order equal revisions; the text itself is never sorted.
        batch.select(*columns, F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2")).write.parquet(scratch)
        rows = self.spark.read.parquet(scratch)
        digest = rows.agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum(F.xxhash64("match_id", "revision", "h1", "error").cast("decimal(38,0)")), F.lit(0)).alias("h"),
        ).first()
        retried(lambda: self._apply(rows, f"{digest.n} {digest.h}", batch_id, feed))
        Folder(self.spark, scratch).delete()

    def _apply(self, rows: DataFrame, digest: str, batch_id: int, feed: str) -> None:
        number, state = self._state()
        known = self._known(state, feed, batch_id)
        if known is not None:
            if known[0] != digest:
                raise ValueError(f"batch {batch_id} of feed {feed!r} is already stored with other content")
            return
        part = f"{number + 1:012d}-{uuid.uuid4().hex[:8]}"
        place = F.pmod(F.xxhash64("match_id"), F.lit(state["ranges"])).cast("int").alias("range")
        origin = (F.lit(feed).alias("feed"), F.lit(batch_id).cast("long").alias("batch"))
        narrow = rows.filter("error IS NULL").select("match_id", "match_type", "year", "revision", "h1", "h2")
        # At most as many numbers as the index has ranges.
        touched = [str(r.range) for r in narrow.select(place).distinct().collect()]
        newest_ = latest_by(narrow, ["match_id"], ["revision DESC NULLS LAST", "h1", "h2"])
        classified = classify_revisions(self._index(state, touched), newest_)
        accepted = classified.filter("status <> 'skipped'").select("match_id", "revision", "h1", "h2", "status")
        taken = taken_rows(rows.filter("error IS NULL"), accepted)
        self._about_to("documents")
        (
            taken.select("match_id", "revision", "content", "status", *origin, "match_type", "year")
            .hint("rebalance", "match_type", "year")
            .write.partitionBy("match_type", "year")
            .parquet(f"{self.path}/documents/part={part}")
        )
        self._about_to("errors")
        errors = rows.filter("error IS NOT NULL").select("match_id", F.col("error").alias("reason"), "content", *origin)
        errors.write.parquet(f"{self.path}/errors/part={part}")
        self._about_to("report")
        report = classified.groupBy("match_type", "year", "status").agg(F.count("*").alias("matches"))
        unreadable = errors.groupBy().agg(F.count("*").alias("matches")).filter("matches > 0")
        none = F.lit(None).cast("string")
        unreadable = unreadable.select(none.alias("match_type"), none.alias("year"), F.lit("unreadable").alias("status"), "matches")
        report.unionByName(unreadable).coalesce(1).write.parquet(f"{self.path}/report/part={part}")
        self._about_to("index")
        full = [r for r in touched if len(state["index"].get(r, ())) + 1 >= FOLD]
        index = self._read(BRONZE, "documents", [part]).select("match_id", "revision", *origin, F.lit(part).alias("of"), place)
        if full:
            # Accepted rows stand above what they replace, so the newest of both is the folded range.
            newest_ = F.max(F.struct("revision", "batch", "feed", "of")).alias("n")
            both = index.unionByName(self._index(state, full)).groupBy("match_id").agg(newest_, F.max("range").alias("range"))
            index = both.select("match_id", "n.*", "range")
        index.hint("rebalance", "range").write.partitionBy("range").parquet(f"{self.path}/index/part={part}")
        written = [n.partition("=")[2] for n in self._folder.names(f"index/part={part}") if n.startswith("range=")]
        after = self._followed(state, part, written, full) | {"recent": {**state["recent"], f"{feed}/{batch_id}": [digest, part]}}
        if len(after["recent"]) >= FOLD:
            self._about_to("applied")
            self._applied(after).coalesce(1).write.parquet(f"{self.path}/applied/part={part}")
            after["gone"] += [f"applied/part={state['applied']}"] if state["applied"] else []
            after |= {"applied": part, "recent": {}}
        self._about_to("cleaning")
        # The record that stands needs none of these, nor will the next.
        for folder in state["gone"]:
            self._folder.delete(folder)
        self._about_to("state")
        try:
            self._records.commit(number, after)
        except Conflict:
            for kind in _KINDS:
                self._folder.delete(f"{kind}/part={part}")
            raise
        self._about_to("end")

    def _followed(self, state: dict, part: str, written: list[str], full: list[str]) -> dict:
        """The state after a part that wrote the given ranges, the full ones as a whole."""
        index = {r: [] if r in full else list(parts) for r, parts in state["index"].items()}
        for r in written:
            index.setdefault(r, []).append(part)
        gone = [f"index/part={p}/range={r}" for r in full for p in state["index"].get(r, ())]
        live = {p for parts in index.values() for p in parts}
        gone += [f"index/part={p}" for p in sorted({p for parts in state["index"].values() for p in parts} - live)]
        return {**state, "index": index, "gone": gone}

    def vacuum(self) -> list[str]:
        """Deletes documents that newer revisions replaced throughout a part, and what attempts
        that ended early have left.  Parts of the last few records stay, as writers may be at them."""
        number, state = self._state()
        # One name per batch.
        live = {r.part for r in self.index().select("part").distinct().collect()}
        counted = {r.of for r in self._applied(state).select("of").collect()} | {state["applied"]}
        counted |= {p for parts in state["index"].values() for p in parts}
        deleted = []
        for kind in _KINDS:
            for name in self._folder.names(kind):
                part = name.partition("=")[2]
                settled = part.partition("-")[0].isdigit() and int(part.partition("-")[0]) <= number - Records.KEPT
                if settled and part not in (live if kind == "documents" else counted):
                    self._folder.delete(f"{kind}/{name}")
                    deleted.append(f"{kind}/{name}")
        return deleted

    # reading ---------------------------------------------------------------------

    def stats(self, batch_id: int, feed: str = "main") -> DataFrame:
        """(match_type, year, status, matches) of one batch; unreadable documents have no folder."""
        known = self._known(self._state()[1], feed, batch_id)
        return self._read(REPORT, "report", [] if known is None else [known[1]]).drop("part")

    def errors(self) -> DataFrame:
        """Every unreadable document with its reason and batch."""
        counted = self._applied(self._state()[1]).select(F.col("of").alias("part"))
        return self._read(ERRORS, "errors").join(F.broadcast(counted), "part", "left_semi").drop("part")

    def current(self) -> DataFrame:
        """Latest stored document per match; only parts that still hold such are opened."""
        index = self.index()
        # One name per batch that has not been replaced as a whole.
        live = sorted(r.part for r in index.select("part").distinct().collect())
        docs = self._read(BRONZE, "documents", live)
        return docs.join(index.select("match_id", "part"), ["match_id", "part"], "left_semi").drop("status", "part")
