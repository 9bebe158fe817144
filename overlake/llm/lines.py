"""Line dedup by a suffix array over line sequences; built-in functions only.

The non-blank lines of all distinct texts form one long sequence of line ids, a terminator
after each text.  Prefix doubling ranks every position by its first 1, 2, 4, ... lines:
positions of equal rank are an interval of the suffix array whose common prefix has at least
that length.  Positions alone in their interval drop out, so each round works on what still
repeats, and the rounds end when nothing does.  Ranks keep the order of the keys they replace,
so the last ranks order the suffixes.

Each interval knows its earliest position.  A later position of an interval of ``MIN_LINES``
lines is a copied run; every longer repeated run is a chain of such.  Lines in copied runs are
deleted, as is a later copy of a single line of ``MIN_CHARS`` characters or more.  The first
occurrence of any line stays.

Lines are compared without surrounding white space.  Blank lines are no part of runs and stay,
unless nothing else is left: then the text is empty.  Texts are ordered by key (nulls last),
then by a hash of the text; rows that agree in both are one document and get the same result.
Null texts stay null.  Copies of a whole text are found by hash and take no part in the rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from overlake.llm.tables import stored

#: Repeated runs of so many lines are deleted; a power of two.
MIN_LINES = 2
#: A single repeated line is deleted if it has so many characters.
MIN_CHARS = 30

STATS = "struct<n_lines:int,n_deleted:int,n_runs:int,longest_copy:long>"


def _lines(text: Column) -> Column:
    """Place, two hashes and length of each non-blank line."""
    whole = F.transform(F.split(text, "\n", -1), lambda l: F.trim(l))
    line = F.transform(
        whole,
        lambda l, i: F.struct(
            i.alias("place"),
            F.xxhash64(l).alias("h1"),
            F.xxhash64(F.lit(7), l).alias("h2"),
            F.length(l).alias("size"),
        ),
    )
    return F.filter(line, lambda x: x["size"] > 0)


def _content(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("c1"), F.xxhash64(F.lit(7), text).alias("c2")]


def contents(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Each distinct text once: its hashes, its earliest key and its lines.

    Copies meet in a partial aggregate, so a text on a third of all rows is no hot group.
    """
    rows = docs.where(F.col(text).isNotNull()).select(
        *_content(F.col(text)),
        F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key")).alias("owner"),
        _lines(F.col(text)).alias("lines"),
    )
    return rows.groupBy("c1", "c2").agg(F.min("owner").alias("owner"), F.first("lines").alias("lines"))


def positions(texts: DataFrame) -> DataFrame:
    """(pos, c1, c2, place, h1, h2, size): lines in text order, numbered so that neighbours differ by one.

    A terminator without hashes follows each text: no run crosses it.
    """
    line = "struct<place:int,h1:long,h2:long,size:int>"
    return (
        texts.orderBy("owner", "c1", "c2")
        .select("c1", "c2", F.explode(F.concat("lines", F.array(F.lit(None).cast(line)))).alias("line"))
        .select(F.monotonically_increasing_id().alias("pos"), "c1", "c2", "line.*")
    )


def _ranked(rows: DataFrame, by: list[str], label: str) -> tuple[DataFrame, bool]:
    """(pos, rank, first) of rows whose key repeats, in the keys' order; whether there are any."""
    keys = (
        rows.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
        .where("n > 1")
        .orderBy(*by)
        .select(*by, "first", F.monotonically_increasing_id().alias("rank"))
    )
    keys = stored(keys, f"{label}-keys")
    if keys.isEmpty():
        return rows.sparkSession.createDataFrame([], "pos long, rank long, first long"), False
    return stored(rows.join(keys, by).select("pos", "rank", "first"), label), True


def intervals(lines: DataFrame) -> list[DataFrame]:
    """For runs of 1, 2, 4, ... lines: (pos, rank, first) of every position whose run repeats."""
    level, some = _ranked(lines.where("h1 is not null").select("pos", "h1", "h2"), ["h1", "h2"], "lines-0")
    levels = []
    while some:
        levels.append(level)
        step = 2 ** (len(levels) - 1)
        after = level.select((F.col("pos") - step).alias("pos"), F.col("rank").alias("next"))
        pairs = level.select("pos", F.col("rank").alias("here")).join(after, "pos")
        level, some = _ranked(pairs, ["here", "next"], f"lines-{len(levels)}")
    return levels


def _deleted(lines: DataFrame, levels: list[DataFrame], min_lines: int, min_chars: int) -> DataFrame:
    """(c1, c2, places, longest) of each distinct text with lines in later copies."""
    none = lines.sparkSession.createDataFrame([], "pos long, longest long")
    later = [x.where("first < pos").select("pos") for x in levels]
    if not later:
        marked = none
    else:
        single = lines.where(F.col("size") >= min_chars).select("pos").join(later[0], "pos").select("pos")
        marked = single.select("pos", F.lit(1).cast("long").alias("longest"))
        for k, level in enumerate(later):
            if 2**k >= min_lines:
                # Every longer run is a chain of runs of ``min_lines``; the others tell its length.
                span = F.explode(F.sequence(F.col("pos"), F.col("pos") + min_lines - 1)) if 2**k == min_lines else F.col("pos")
                marked = marked.unionByName(level.select(span.alias("pos"), F.lit(2**k).cast("long").alias("longest")))
    return (
        marked.groupBy("pos")
        .agg(F.max("longest").alias("longest"))
        .join(lines, "pos")
        .groupBy("c1", "c2")
        .agg(F.array_sort(F.collect_list("place")).alias("places"), F.max("longest").alias("longest"))
    )


def _starts(places: Column) -> Column:
    return F.filter(places, lambda p, i: (i == 0) | (F.get(places, i - 1) != p - 1))


def _ends(places: Column) -> Column:
    return F.filter(places, lambda p, i: (i == F.size(places) - 1) | (F.get(places, i + 1) != p + 1))


def _without(lines: Column, places: Column) -> Column:
    """The lines between deleted runs, as slices: no search per line."""
    begin = F.concat(F.array(F.lit(0)), F.transform(_ends(places), lambda e: e + 1))
    end = F.concat(_starts(places), F.array(F.size(lines)))
    kept = F.transform(F.arrays_zip(begin.alias("s"), end.alias("e")), lambda r: F.slice(lines, r["s"] + 1, r["e"] - r["s"]))
    return F.flatten(kept)


def dedupe(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    stats: str = "line_stats",
    min_lines: int = MIN_LINES,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """``docs`` with lines in later copies deleted from ``text``, and a struct column ``stats``.

    ``stats`` has n_lines (non-blank), n_deleted, n_runs (deleted runs in a row) and
    longest_copy: the largest power of two of lines that occur earlier in one piece, 0 if none.
    """
    if min_lines < 1 or min_lines & (min_lines - 1):
        raise ValueError("min_lines must be a power of two")
    texts = stored(contents(docs, key, text), "line-texts")
    lines = stored(positions(texts), "line-positions")
    deleted = _deleted(lines, intervals(lines), min_lines, min_chars)
    about = texts.join(deleted, ["c1", "c2"], "left").select(
        "c1",
        "c2",
        F.col("owner.key").alias("owner"),
        F.size("lines").alias("n_lines"),
        # What another copy of the whole text loses: it is a run of its own, if long enough.
        F.transform(
            F.filter("lines", lambda l: (F.size("lines") >= min_lines) | (l["size"] >= min_chars)), lambda l: l["place"]
        ).alias("all"),
        F.coalesce("places", F.array().cast("array<int>")).alias("places"),
        F.coalesce("longest", F.lit(0).cast("long")).alias("longest"),
    )
    about = about.select(F.struct("*").alias("_about"))
    columns = docs.columns
    a = F.col("_about")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"))
    body, own_key = F.col("_row")[text], F.col("_row")[key]
    joined = rows.join(about, (F.xxhash64(body) == a["c1"]) & (F.xxhash64(F.lit(7), body) == a["c2"]) & body.isNotNull(), "left")
    copy = ~own_key.eqNullSafe(a["owner"]) & (F.size(a["all"]) > 0)
    size = a["n_lines"]
    run = F.when(size >= min_lines, size).otherwise(F.lit(1))
    power = F.pow(F.lit(2.0), F.floor(F.log2(run.cast("double")))).cast("long")
    places = F.when(copy, a["all"]).otherwise(a["places"])
    split = F.split(body, "\n", -1)
    kept = (
        F.when(F.size("_places") == 0, body)
        .when(F.size("_places") == size, F.lit(""))
        .otherwise(F.array_join(_without(split, F.col("_places")), "\n"))
    )
    counted = F.struct(
        F.coalesce(size, F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("_places"), F.lit(0)).alias("n_deleted"),
        F.coalesce(F.size(_starts(F.col("_places"))), F.lit(0)).alias("n_runs"),
        F.coalesce(F.when(copy, power).otherwise(a["longest"]), F.lit(0).cast("long")).alias("longest_copy"),
    ).cast(STATS)
    out = joined.withColumn("_places", places).withColumn("_kept", kept).withColumn("_stats", counted)
    return out.select(
        *[F.col("_kept").alias(c) if c == text else F.col("_row")[c].alias(c) for c in columns if c != stats],
        F.col("_stats").alias(stats),
    )
