"""Small maintained maps: team names, venues, excluded matches."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from overlake.schemas import EXCLUDED_MATCHES, TEAM_NAMES, VENUE_NAMES

# The maps every standard build uses.
TEAM_MAP = [
    ("Delhi Daredevils", "Delhi Capitals"),
    ("Kings XI Punjab", "Punjab Kings"),
    ("Rising Pune Supergiant", "Rising Pune Supergiants"),
    ("Deccan Chargers", "Sunrisers Hyderabad"),
]
VENUE_MAP = [
    ("Eden Gardens", "Eden Gardens", "Kolkata"),
    ("Wankhede Stadium", "Wankhede Stadium", "Mumbai"),
    ("M Chinnaswamy Stadium", "M. Chinnaswamy Stadium", "Bengaluru"),
    ("M. Chinnaswamy Stadium", "M. Chinnaswamy Stadium", "Bengaluru"),
    ("Feroz Shah Kotla", "Arun Jaitley Stadium", "Delhi"),
    ("Arun Jaitley Stadium", "Arun Jaitley Stadium", "Delhi"),
    ("Punjab Cricket Association Stadium", "Punjab Cricket Association IS Bindra Stadium", "Mohali"),
    ("Punjab Cricket Association IS Bindra Stadium", "Punjab Cricket Association IS Bindra Stadium", "Mohali"),
]
EXCLUDED = [
    ("1473495", "abandoned before minimum overs — PBKS vs DC 2025-05-08 Dharamsala does not count for official stats"),
]

SEED_SCHEMAS = {
    "team_name_map": TEAM_NAMES,
    "venue_map": VENUE_NAMES,
    "excluded_matches": EXCLUDED_MATCHES,
}
SEED_ROWS = {
    "team_name_map": TEAM_MAP,
    "venue_map": VENUE_MAP,
    "excluded_matches": EXCLUDED,
}


def seed_frame(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A small literal table.  Built through Arrow it is a local relation of known
    size, so the planner itself decides to broadcast it."""
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrow = to_arrow_schema(schema)
    table = pa.table(
        [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)], schema=arrow
    )
    return spark.createDataFrame(table, schema)


def read_seed(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """Seed by name: from a CSV file with header where ``path`` is given, else the
    standard rows.  ``match_id`` stays text."""
    schema = SEED_SCHEMAS[name]
    if path is None:
        return seed_frame(spark, SEED_ROWS[name], schema)
    return spark.read.schema(schema).option("header", "true").csv(path)
