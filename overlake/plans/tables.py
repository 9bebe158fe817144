"""The model chain as one object: each table is a lazy plan, optionally stored."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from overlake.plans import enrich, innings as inn, marts, staging
from overlake.plans.flatten import FLATTEN
from overlake.plans.rules import row_conditions
from overlake.schemas import BALL_BY_BALL, BATTING_INNINGS, BOWLING_INNINGS
from overlake.sources.files import Folder, Records, folder_name
from overlake.sources.seeds import read_seed
from overlake.sources.silver import read_silver

# Tables written in folders by these columns, and sorted within files by those.
_FOLDERED = {
    "stg_innings", "stg_deliveries", "stg_players", "ball_by_ball", "overs", "wickets", "powerplay_batters",
    "participation", "bowling_innings", "batting_parts", "bowling_parts", "player_parts", "player_ids",
}
_LAYOUT = ("match_type", "year")
_VERSION = "v"
_SORT = {
    "ball_by_ball": ["match_id", "innings_number", "over_number", "ball_in_over"],
    "overs": ["match_id", "innings_number", "over_number"],
    "wickets": ["match_id", "innings_number", "over_number", "ball_in_over"],
    # A player's rows lie together, so a query on one reads few row groups.
    "powerplay_batters": ["player_name", "match_id"],
    "participation": ["player_name", "match_id"],
    "bowling_innings": ["player_name", "match_id"],
}

# Stored tables and the attribute each is reached by.
_KEPT = {
    "stg_matches": "stg_matches",
    "stg_innings": "stg_innings",
    "stg_deliveries": "stg_deliveries",
    "stg_players": "stg_players",
    "ball_by_ball": "balls",
    "overs": "overs",
    "wickets": "wickets",
    "powerplay_batters": "powerplay_batters",
    "participation": "took_part",
    "bowling_innings": "bowling",
    "match_results": "match_results",
    "player_parts": "player_parts",
    "player_ids": "player_ids",
    "batting_parts": "batting_parts",
    "bowling_parts": "bowling_parts",
    "dim_players": "dim_players",
    "batting_career": "batting_career",
    "bowling_career": "bowling_career",
}
_SEEDS = ("team_map", "venue_map", "excluded")


@dataclass
class Silver:
    matches: DataFrame
    innings: DataFrame
    deliveries: DataFrame
    players: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, root: str) -> "Silver":
        return cls(**{name: read_silver(spark, root, name) for name in FLATTEN})

    @classmethod
    def from_documents(cls, docs: DataFrame) -> "Silver":
        return cls(**{name: flatten(docs) for name, flatten in FLATTEN.items()})


@dataclass
class Seeds:
    team_map: DataFrame
    venue_map: DataFrame
    excluded: DataFrame

    @classmethod
    def standard(cls, spark: SparkSession) -> "Seeds":
        return cls(
            read_seed(spark, "team_name_map"),
            read_seed(spark, "venue_map"),
            read_seed(spark, "excluded_matches"),
        )


def _same(a: DataFrame, b: DataFrame) -> bool:
    return a.schema.simpleString() == b.schema.simpleString() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def changed_folders(before: DataFrame, after: DataFrame) -> list[tuple[str | None, int | None]]:
    """(match_type, year) folders of all matches that are new, gone or not as they were.

    Both tables have one row per match.  A match that moved counts for both its folders; no
    more rows return than there are folders.
    """
    both = [df.select("match_id", *_LAYOUT, F.struct(*before.columns).alias("row")) for df in (before, after)]
    x, y = both[0].alias("x"), both[1].alias("y")
    pairs = x.join(y, "match_id", "full").filter("NOT x.row <=> y.row")
    sides = [pairs.filter(f"{s}.row IS NOT NULL").select(*[f"{s}.{c}" for c in _LAYOUT]) for s in ("x", "y")]
    return [tuple(r) for r in sides[0].union(sides[1]).distinct().collect()]


class MatchTables:
    """Staging, intermediate and mart tables over a silver layer.

    Without ``store`` all tables are plans over silver.  With it, the tables that many
    queries share are written as Parquet below that folder when first asked for, and
    read back, so a query scans a pruned table in place of repeating the chain.

    Tables of ball, innings and player grain lie in (match_type, year) folders, and every
    folder in versions: ``<table>/match_type=…/year=…/v=…``.  ``build`` writes all tables and then
    commits one record that names the version of each folder, so readers see all of one build or
    all of another, and a build that ends early leaves the store as it was.  A match lies in
    one folder, so ``refresh`` writes only the folders of matches that have changed; the
    record goes on naming the older versions of the others.  Careers are merged from sums per
    folder, which do not read other folders' innings again.

    Rows that break a rule of their table are counted while they are written, by the tasks that write
    them, and the record keeps the counts.
    """

    def __init__(self, silver: Silver | None, seeds: Seeds, store: str | None = None, version: str | None = None):
        self.silver, self.seeds, self.store = silver, seeds, store and store.rstrip("/")
        self._version = version or f"v-{uuid.uuid4().hex}"
        self._locks = {name: threading.RLock() for name in _KEPT}
        self._stored: dict[str, DataFrame] = {}
        self._folders: dict[tuple[str, str | None], list[tuple[str, int | None]]] = {}
        #: Number and content of the record that this build follows, and the folders it rewrites: all, if None.
        self._before: tuple[int, dict] | None = None
        self._touched: list[tuple[str | None, int | None]] | None = None
        #: Of each table its versions: by folder, or under "" for a table without folders.
        self._placed: dict[str, dict[str, str]] = {}
        self._schemas: dict[str, T.StructType] = {}
        #: Of each table its rows that break each rule: None, if older folders would have to be read to tell.
        self._broken: dict[str, dict[str, int | None]] = {}

    @classmethod
    def load(cls, spark: SparkSession, store: str) -> "MatchTables":
        """All tables and seeds of the newest finished :meth:`build`; nothing is written."""
        number, record = Records(Folder(spark, store), "state").latest({})
        if number < 0:
            raise ValueError(f"no finished build at {store}")
        root = store.rstrip("/")
        seeds = Seeds(**{name: spark.read.parquet(f"{root}/seeds/{name}/{_VERSION}={record['seeds']}") for name in _SEEDS})
        tables = cls(None, seeds, root, record["version"])
        for name, placed in record["tables"].items():
            tables._schemas[name] = T.StructType.fromJson(record["schemas"][name])
            tables._placed[name] = placed
            tables._stored[name] = tables._read(spark, name)
        tables._broken = record.get("broken", {})
        return tables

    @classmethod
    def refresh(
        cls, silver: Silver, seeds: Seeds, store: str, also: Sequence[tuple[str | None, int | None]] = ()
    ) -> "MatchTables":
        """Brings the store up to date with silver, rewriting only the folders of changed matches.

        A match has changed when its row in ``stg_matches`` is new, gone or different; silver
        writes that row last.  ``also`` names folders to rewrite besides, as when rows of a revision
        were repaired by hand.  Without a finished build, and when a seed has changed, everything is built.
        """
        spark = silver.matches.sparkSession
        number, record = Records(Folder(spark, store), "state").latest({})
        if number < 0:
            return cls(silver, seeds, store).build()
        before = cls.load(spark, store)
        tables = cls(silver, seeds, store)
        if all(_same(getattr(before.seeds, name), getattr(seeds, name)) for name in _SEEDS):
            found = changed_folders(before.stg_matches, tables.stg_matches)
            tables._touched = sorted({*found, *also}, key=repr)
            if not tables._touched:
                Folder(spark, f"{tables.store}/stg_matches").delete(f"{_VERSION}={tables._version}")
                return before
            tables._before = number, record
        return tables.build()

    def build(self) -> "MatchTables":
        """Write every shared table now, those that do not need each other at once, so
        that one's last tasks leave no cores idle; then commit what was written."""
        if self.silver is None:
            raise ValueError("loaded tables are built already")
        spark = self.silver.matches.sparkSession
        first = ("stg_matches",)
        chains = (
            ("stg_deliveries", "balls", "took_part", "batting_parts", "batting_career"),
            ("stg_deliveries", "balls", "overs", "bowling", "bowling_parts", "bowling_career"),
            ("stg_deliveries", "balls", "wickets", "powerplay_batters"),
            ("stg_innings", "match_results"),
            ("stg_players", "player_parts", "player_ids", "dim_players"),
        )
        records = self.store and Records(Folder(spark, self.store), "state")
        if records and self._before is None:
            self._before = records.latest({})

        def write(chain: tuple[str, ...]) -> None:
            for attribute in chain:
                getattr(self, attribute)

        write(first)
        with ThreadPoolExecutor(len(chains)) as pool:
            in_session = inheritable_thread_target(spark)
            for done in [pool.submit(in_session(write), chain) for chain in chains]:
                done.result()
        if records:
            for name in _SEEDS:
                getattr(self.seeds, name).write.mode("overwrite").parquet(f"{self.store}/seeds/{name}/{_VERSION}={self._version}")
            record = {
                "version": self._version,
                "tables": self._placed,
                "schemas": {name: schema.jsonValue() for name, schema in self._schemas.items()},
                "seeds": self._version,
                "broken": self._broken,
            }
            number, before = self._before
            records.commit(number, record)
            self._clean(spark, record, before)
        return self

    def _clean(self, spark: SparkSession, *records: dict) -> None:
        """Deletes versions, in the folders that this build was about, that none of the records names.

        The record before is among them, as readers may still be on it.
        """
        folder = Folder(spark, self.store)
        for name in self._placed:
            known = {(f, v) for r in records for f, v in r.get("tables", {}).get(name, {}).items()}
            if self._touched is None or name not in _FOLDERED:
                places = self._places(spark, name)
            else:
                places = [folder_name(*f) for f in self._touched]
            for place in places:
                for entry in folder.names(f"{name}/{place}"):
                    if entry.startswith(f"{_VERSION}=") and (place, entry.partition("=")[2]) not in known:
                        folder.delete("/".join(filter(None, (name, place, entry))))

    def _places(self, spark: SparkSession, name: str, version: str = "*") -> list[str]:
        """Folders of a table that have the version."""
        if name not in _FOLDERED:
            return [""]
        found = Folder(spark, f"{self.store}/{name}").matching(f"{_LAYOUT[0]}=*/{_LAYOUT[1]}=*/{_VERSION}={version}")
        return sorted({place.rpartition("/")[0] for place in found})

    def _kept(self, name: str, plan) -> DataFrame:
        with self._locks[name]:
            if name not in self._stored:
                df = plan()
                self._stored[name] = df if self.store is None else self._write(name, df)
            return self._stored[name]

    def _write(self, name: str, df: DataFrame) -> DataFrame:
        spark, root = df.sparkSession, f"{self.store}/{name}"
        self._schemas[name] = df.schema
        conditions = row_conditions(name)
        counts = Observation()

        def counted(rows: DataFrame) -> DataFrame:
            """In the stage that writes, whose tasks report once, also if executors are lost."""
            return rows.observe(counts, *[F.expr(f"count_if({c})").alias(n) for n, c in conditions.items()]) if conditions else rows

        if name not in _FOLDERED:
            counted(df).write.option("compression", "zstd").parquet(f"{root}/{_VERSION}={self._version}")
            self._placed[name] = {"": self._version}
            self._broken[name] = counts.get if conditions else {}
            return self._read(spark, name)
        rows = counted(df.hint("rebalance", *_LAYOUT).withColumn(_VERSION, F.lit(self._version)))
        if name in _SORT:
            rows = rows.sortWithinPartitions(*_LAYOUT, *_SORT[name])
        rows.write.mode("append").option("compression", "zstd").partitionBy(*_LAYOUT, _VERSION).parquet(root)
        written = {place: self._version for place in self._places(spark, name, self._version)}
        older = {} if self._touched is None else self._before[1]["tables"][name]
        mine = {folder_name(*f) for f in self._touched or ()}
        self._placed[name] = {p: v for p, v in older.items() if p not in mine} | written
        found = counts.get if conditions else {}
        if self._touched is not None:
            # Where no row was broken before, none is in the folders that stay.
            before = self._before[1].get("broken", {}).get(name, {})
            found = {n: count if before.get(n) == 0 else None for n, count in found.items()}
        self._broken[name] = found
        return self._read(spark, name)

    def broken_rows(self, name: str) -> dict[str, int]:
        """How many rows of a stored table break each of its rules, where that is known without reading it."""
        if self.store is None or name not in _KEPT:
            return {}
        getattr(self, _KEPT[name])
        return {rule: n for rule, n in self._broken.get(name, {}).items() if n is not None}

    def _read(self, spark: SparkSession, name: str) -> DataFrame:
        """A stored table, from the version of each folder that counts."""
        schema, root = self._schemas[name], f"{self.store}/{name}"
        paths = [f"{root}/{place}/{_VERSION}={v}".replace("//v", "/v") for place, v in sorted(self._placed[name].items())]
        if not paths:
            return spark.createDataFrame([], schema)
        typed = T.StructType([*schema.fields, T.StructField(_VERSION, T.StringType())])
        return spark.read.schema(typed).option("basePath", root).parquet(*paths).select(*[f.name for f in schema])

    def _changed(self, rows: DataFrame) -> DataFrame:
        """The rows in the folders that this build writes; folder names are all that is looked at."""
        if self._touched is None:
            return rows
        here = F.lit(False)
        for match_type, year in self._touched:
            here = here | (F.col("match_type").eqNullSafe(match_type) & F.expr("try_cast(year AS int)").eqNullSafe(F.lit(year)))
        return rows.filter(here)

    def folders(self, league: str, season: str | None) -> list[tuple[str, int | None]] | None:
        """The (match_type, year) folders that hold matches of a league and season.

        Looked up once in the match table, of which one row per folder returns; None where
        tables are not stored, so there is nothing to prune.
        """
        if self.store is None:
            return None
        key = (league, season)
        if key not in self._folders:
            rows = self.match_results.filter(F.col("event_name").ilike(league))
            if season is not None:
                rows = rows.filter(F.col("season") == season)
            self._folders[key] = [tuple(r) for r in rows.select(*_LAYOUT).distinct().collect()]
        return self._folders[key]

    # staging -----------------------------------------------------------------

    @property
    def stg_matches(self) -> DataFrame:
        return self._kept("stg_matches", lambda: staging.stage_matches(self.silver.matches))

    @property
    def stg_innings(self) -> DataFrame:
        return self._kept("stg_innings", lambda: staging.stage_innings(self._changed(self.silver.innings), self.stg_matches))

    @property
    def stg_deliveries(self) -> DataFrame:
        return self._kept("stg_deliveries", lambda: staging.stage_deliveries(self._changed(self.silver.deliveries), self.stg_matches))

    @property
    def stg_players(self) -> DataFrame:
        return self._kept("stg_players", lambda: staging.stage_players(self._changed(self.silver.players), self.stg_matches))

    # intermediate ------------------------------------------------------------

    @cached_property
    def match_innings(self) -> DataFrame:
        return enrich.match_innings(
            self._changed(self.stg_innings),
            self.stg_matches,
            self.seeds.team_map,
            self.seeds.venue_map,
            self.seeds.excluded,
        )

    @property
    def balls(self) -> DataFrame:
        """Ball table with the extra columns the queries use."""
        return self._kept(
            "ball_by_ball",
            lambda: enrich.ball_by_ball(self._changed(self.stg_deliveries), self.match_innings),
        )

    @property
    def ball_by_ball(self) -> DataFrame:
        return self.balls.select(*BALL_BY_BALL)

    @property
    def fct_deliveries(self) -> DataFrame:
        return self.ball_by_ball

    @property
    def overs(self) -> DataFrame:
        """Additive figures per over and bowler."""
        return self._kept("overs", lambda: inn.over_figures(self._changed(self.balls)))

    @property
    def wickets(self) -> DataFrame:
        """Balls with a wicket."""
        return self._kept("wickets", lambda: inn.wickets(self._changed(self.balls)))

    @property
    def powerplay_batters(self) -> DataFrame:
        """Who faced a ball in the powerplay of an innings."""
        return self._kept("powerplay_batters", lambda: inn.powerplay_batters(self._changed(self.balls)))

    @property
    def took_part(self) -> DataFrame:
        """Every player and innings, batting innings or not."""
        return self._kept("participation", lambda: inn.participation(self._changed(self.balls)))

    @property
    def batting(self) -> DataFrame:
        return inn.batting_innings(self.took_part)

    @property
    def batting_innings(self) -> DataFrame:
        return self.batting.select(*BATTING_INNINGS)

    @property
    def bowling(self) -> DataFrame:
        return self._kept("bowling_innings", lambda: inn.bowling_innings(self._changed(self.overs)))

    @property
    def bowling_innings(self) -> DataFrame:
        return self.bowling.select(*BOWLING_INNINGS)

    # marts -------------------------------------------------------------------

    @property
    def match_results(self) -> DataFrame:
        return self._kept(
            "match_results",
            lambda: enrich.match_results(
                self.stg_matches, self.seeds.team_map, self.seeds.venue_map
            ),
        )

    @property
    def player_parts(self) -> DataFrame:
        """What each player's row in the dimension is put together from, per folder and team."""
        return self._kept("player_parts", lambda: marts.player_parts(self._changed(self.stg_players)))

    @property
    def player_ids(self) -> DataFrame:
        """How often each player has each id, per folder."""
        return self._kept("player_ids", lambda: marts.player_ids(self._changed(self.stg_players)))

    @property
    def batting_parts(self) -> DataFrame:
        """Career sums per folder."""
        return self._kept("batting_parts", lambda: marts.batting_parts(self._changed(self.batting)))

    @property
    def bowling_parts(self) -> DataFrame:
        """Career sums per folder."""
        return self._kept("bowling_parts", lambda: marts.bowling_parts(self._changed(self.bowling)))

    @property
    def dim_players(self) -> DataFrame:
        return self._kept("dim_players", lambda: marts.dim_players(self.player_parts, self.player_ids))

    @property
    def batting_career(self) -> DataFrame:
        return self._kept("batting_career", lambda: marts.batting_career(self.batting_parts))

    @property
    def bowling_career(self) -> DataFrame:
        return self._kept("bowling_career", lambda: marts.bowling_career(self.bowling_parts))
