"""Members of zip archives as rows.

Archives that lie in files are read by ranges, whatever their size: tasks read the directory at
each archive's end, one narrow row per member; the rows are dealt out by ranges of the archive;
and every task reads the bytes of its ranges, a few megabytes at a time, and unpacks them.  No
task holds an archive, and a large one is read by many.  The files are opened through Arrow's
file systems (local and mounted paths, HDFS, S3, GCS), or by a function of the caller's.

Archives that are column values already are cut by the task that holds them, and their packed
members are spread over all tasks and unpacked there; Spark limits such a value to 2 GiB.
"""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

MEMBERS = "archive string, name string, content string, error string"
_PACKED = "archive string, name string, method int, flags int, crc long, data binary, error string"
_PLACED = "archive string, name string, method int, flags int, crc long, size long, start long, stop long, error string"
#: Bytes of an archive that are dealt to a task together, and that a task reads at once.
RANGE_BYTES, READ_BYTES = 64 << 20, 8 << 20
_FLUSH_BYTES = 16 << 20
_FLUSH_ROWS = 2_000

# Fixed values of the format: length of a member's own header, and its place of two lengths.
_HEADER, _LENGTHS = 30, struct.Struct("<26xHH")
_ENCRYPTED = 1


def _wanted(name: str) -> bool:
    return name.endswith(".json") and not name.startswith("__")


def _reason(err: Exception) -> str:
    return f"{type(err).__name__}: {err}"


def _cut(archive: str, blob: bytes) -> Iterator[tuple]:
    """Packed members of an archive; whatever is wrong becomes a row with the reason."""
    try:
        entries = zipfile.ZipFile(io.BytesIO(blob)).infolist()
    except Exception as err:  # whatever a damaged file provokes, the others must go on
        yield archive, None, None, None, None, None, _reason(err)
        return
    for e in entries:
        if not _wanted(e.filename):
            continue
        try:
            if blob[e.header_offset : e.header_offset + 4] != b"PK\x03\x04":
                raise zipfile.BadZipFile("no member where the directory has one")
            start = e.header_offset + _HEADER + sum(_LENGTHS.unpack_from(blob, e.header_offset))
            data = blob[start : start + e.compress_size]
            yield archive, e.filename, e.compress_type, e.flag_bits, e.CRC, data, None
        except Exception as err:
            yield archive, e.filename, None, None, None, None, _reason(err)


def _unpacked(method: int, flags: int, crc: int, data: bytes) -> str:
    if int(flags) & _ENCRYPTED:
        raise RuntimeError("the member is encrypted")
    if method == zipfile.ZIP_DEFLATED:
        stream = zlib.decompressobj(-zlib.MAX_WBITS)
        whole = stream.decompress(data) + stream.flush()
        if not stream.eof:
            raise zipfile.BadZipFile("the member is cut short")
    elif method == zipfile.ZIP_STORED:
        whole = data
    else:
        raise NotImplementedError(f"compression method {int(method)}")
    if zlib.crc32(whole) != int(crc):
        raise zipfile.BadZipFile("the checksum does not match")
    return whole.decode("utf-8")


def _frames(rows: Iterator[tuple], columns: list[str], size_of: int) -> Iterator[pd.DataFrame]:
    """Frames of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[size_of] or "")
        if size >= _FLUSH_BYTES or len(held) >= _FLUSH_ROWS:
            yield pd.DataFrame(held, columns=columns)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=columns)


def _cut_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["archive", "name", "method", "flags", "crc", "data", "error"]
    for batch in batches:
        rows = (row for path, blob in zip(batch["path"], batch["content"]) for row in _cut(path, bytes(blob)))
        yield from _frames(rows, columns, 5)


def _unpack_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows(batch: pd.DataFrame) -> Iterator[tuple]:
        for m in batch.itertuples(index=False):
            if m.error is not None:
                yield m.archive, m.name, None, m.error
                continue
            try:
                yield m.archive, m.name, _unpacked(m.method, m.flags, m.crc, bytes(m.data)), None
            except Exception as err:  # as above: one member never takes the others with it
                yield m.archive, m.name, None, _reason(err)

    for batch in batches:
        yield from _frames(rows(batch), ["archive", "name", "content", "error"], 2)


def explode_members(archives: DataFrame) -> DataFrame:
    """(path, content) of archives -> one row per JSON member.

    Members named ``__*`` are left out.  A member that cannot be read (damaged, cut short,
    encrypted, packed in an unknown way, not UTF-8) becomes a row with ``error`` set, and the
    rest of the archive is still read.  A file that is no archive is one such row.
    """
    packed = archives.select("path", "content").mapInPandas(_cut_all, _PACKED)
    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return packed.repartition(tasks, "archive", "name").mapInPandas(_unpack_all, MEMBERS)


def open_file(path: str):
    """A file that can be read at any place, by its URI as Spark writes it."""
    from pyarrow import fs

    if re.match("file:|/", path):
        return fs.LocalFileSystem().open_input_file(re.sub("^file:/*", "/", path))
    scheme, _, rest = path.partition("://")
    files, at = fs.FileSystem.from_uri(f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme) }://{quote(rest)}")
    return files.open_input_file(at)


def placed_members(archive: str, opener: Callable = open_file) -> Iterator[tuple]:
    """Rows of ``_PLACED``: where each wanted member of an archive lies, from the directory at its end."""
    try:
        with opener(archive) as file:
            directory = zipfile.ZipFile(file)
            entries = sorted(directory.infolist(), key=lambda e: e.header_offset)
            stops = [*[e.header_offset for e in entries[1:]], directory.start_dir]
    except Exception as err:  # whatever a damaged file provokes, the others must go on
        yield archive, None, None, None, None, None, None, None, _reason(err)
        return
    for e, stop in zip(entries, stops, strict=True):
        if _wanted(e.filename):
            yield archive, e.filename, e.compress_type, e.flag_bits, e.CRC, e.compress_size, e.header_offset, stop, None


def _runs(rows: Iterator) -> Iterator[list]:
    """Rows that lie close behind each other in one archive, while they are small enough to be read at once."""
    run: list = []
    for m in rows:
        if run and not (run[-1].archive == m.archive and run[-1].stop <= m.start and m.stop - run[0].start <= READ_BYTES):
            yield run
            run = []
        run.append(m)
    if run:
        yield run


def read_members(rows: Iterator, opener: Callable = open_file) -> Iterator[tuple]:
    """Rows of ``MEMBERS`` from placed members, sorted by archive and place; whatever is wrong becomes a row."""
    name, file = None, None
    try:
        for run in _runs(rows):
            try:
                if run[0].archive != name:
                    if file is not None:
                        file.close()
                    name, file = None, None
                    file = opener(run[0].archive)
                    name = run[0].archive
                file.seek(int(run[0].start))
                blob, first = file.read(int(run[-1].stop - run[0].start)), int(run[0].start)
            except Exception as err:
                yield from ((m.archive, m.name, None, _reason(err)) for m in run)
                continue
            for m in run:
                try:
                    at = int(m.start) - first
                    if blob[at : at + 4] != b"PK\x03\x04":
                        raise zipfile.BadZipFile("no member where the directory has one")
                    data = at + _HEADER + sum(_LENGTHS.unpack_from(blob, at))
                    yield m.archive, m.name, _unpacked(m.method, m.flags, m.crc, blob[data : data + int(m.size)]), None
                except Exception as err:  # one member never takes the others with it
                    yield m.archive, m.name, None, _reason(err)
    finally:
        if file is not None:
            file.close()


def archive_ranges(paths: DataFrame, range_bytes: int = RANGE_BYTES, opener: Callable = open_file) -> DataFrame:
    """(path) of archives -> one row per JSON member, as :func:`explode_members` gives.

    The directories are read by tasks, a range of an archive is a key, and the ranges
    are spread over as many tasks as the session's shuffles have.
    """
    columns = [c.split()[0] for c in _PLACED.split(", ")]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = (row for path in batch["path"] for row in placed_members(path, opener))
            for frame in _frames(rows, columns, 1):
                whole = {c: "Int64" for c in ("method", "flags", "crc", "size", "start", "stop")}
                yield frame.astype(whole)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lost = batch[batch["start"].isna()]
            yield pd.DataFrame({"archive": lost["archive"], "name": lost["name"], "content": None, "error": lost["error"]})
            rows = read_members(batch[batch["start"].notna()].itertuples(index=False), opener)
            yield from _frames(rows, ["archive", "name", "content", "error"], 2)

    spark = paths.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Paths alone are a few bytes each, so naming the number keeps them apart.
    placed = paths.select("path").repartition(tasks, "path").mapInPandas(place, _PLACED)
    dealt = placed.withColumn("range", F.expr(f"start div {range_bytes}")).repartition(tasks, "archive", "range")
    return dealt.sortWithinPartitions("archive", "start").drop("range").mapInPandas(read, MEMBERS)


def explode_archives(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Members of all ``*.zip`` files below a folder; Spark lists the files and does not open them."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
    return archive_ranges(files.select("path"), range_bytes)


def member_stem(name: str = "name"):
    return F.regexp_extract(name, r"([^/]+)[.]json$", 1)
