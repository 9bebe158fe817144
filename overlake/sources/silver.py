"""Silver layer: four flat Parquet tables partitioned by match_type and year."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from overlake.schemas import SILVER
from overlake.sources.archives import open_file
from overlake.sources.files import Folder

PARTITIONS = ("match_type", "year")


def write_silver(
    df: DataFrame,
    root: str,
    name: str,
    mode: str = "full",
    max_records_per_file: int = 5_000_000,
    row_group_rows: int = 100_000,
) -> None:
    """Write one silver table; ``full`` replaces it, ``incremental`` appends the revisions
    of matches that it does not hold yet, so a load that is repeated adds nothing.

    Rows are always cast to the fixed schema, so a column that happens to be empty in
    one load keeps its type.  Rebalancing by the partition columns gives few files per
    folder and splits a folder that holds much of the data over several tasks.
    """
    if mode not in ("full", "incremental"):
        raise ValueError(f"unknown mode {mode!r}")
    schema = SILVER[name]
    typed = df.select(*[F.col(f.name).cast(f.dataType) for f in schema])
    if mode == "incremental" and Folder(df.sparkSession, root).exists(name):
        # The folder columns are part of the key, so only folders of the load are looked at.
        held = read_silver(df.sparkSession, root, name).select(*PARTITIONS, "match_id", "revision").distinct()
        same = [typed[c].eqNullSafe(held[c]) if c == "revision" else typed[c] == held[c] for c in held.columns]
        typed = typed.join(held, same, "left_anti")
    (
        typed.hint("rebalance", *PARTITIONS)
        .write.mode("overwrite" if mode == "full" else "append")
        .option("compression", "zstd")
        .option("parquet.block.row.count.limit", row_group_rows)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*PARTITIONS)
        .parquet(f"{root.rstrip('/')}/{name}")
    )


def read_silver(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read one silver table under the fixed schema; columns that older files lack are
    NULL, and the partition columns come from the folder names as text."""
    return spark.read.schema(SILVER[name]).parquet(f"{root.rstrip('/')}/{name}")


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The schema in each file's footer, as Spark writes schemas; a column without type is stored as whole numbers."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_schema

    def typed(kind: pa.DataType) -> pa.DataType:
        return pa.int32() if pa.types.is_null(kind) else pa.list_(typed(kind.value_type)) if pa.types.is_list(kind) else kind

    for batch in batches:
        out = []
        for path in batch["path"]:
            with open_file(path) as file:
                held = pq.read_schema(file)
            fields = [pa.field(f.name, typed(f.type)) for f in held if f.name not in PARTITIONS]
            out.append(from_arrow_schema(pa.schema(fields)).json())
        yield pd.DataFrame({"path": batch["path"], "schema": out})


def adopt_silver(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read a silver table whose files were written batch by batch with inferred types.

    In such files a column without values has no type, and the same column may be whole
    numbers in one file and fractions in the next, which no single read schema covers.
    Tasks read the footers and group files by their schema; Spark reads each group under its own
    schema and casts it to the fixed one.  Columns that files lack are NULL.  Meant to be
    passed on to :func:`write_silver` once.
    """
    base = f"{root.rstrip('/')}/{name}"
    reader = spark.read.option("basePath", base).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    footers = listed.load(base).select("path").repartition(tasks, "path").mapInPandas(_footers, "path string, schema string")
    # A path and its schema's text per file: less than the listing that Spark's driver holds.
    groups: dict[str, list[str]] = {}
    for row in footers.toLocalIterator():
        groups.setdefault(row.schema, []).append(row.path)
    out = spark.createDataFrame([], SILVER[name])
    for text, paths in sorted(groups.items()):
        schema = T.StructType.fromJson(json.loads(text))
        rows = reader.schema(schema).parquet(*paths).withColumn("__path", F.col("_metadata.file_path"))
        held = {f.name: f.dataType for f in rows.schema}
        columns = []
        for f in SILVER[name]:
            if f.name in PARTITIONS:
                value = F.regexp_extract("__path", f"/{f.name}=([^/]*)/", 1)
            elif f.name not in held or isinstance(f.dataType, T.ArrayType) and not isinstance(held[f.name], T.ArrayType):
                value = F.lit(None)
            else:
                value = F.col(f.name)
            columns.append(value.cast(f.dataType).alias(f.name))
        out = out.unionByName(rows.select(*columns))
    return out
