"""Registered queries over a folder of star-schema Parquet tables.

The match tables are derived from orders and line items once per session and folder,
stored in the session's scratch folder, and shared by the catalogue queries.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from datetime import date
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from overlake.functions import named, ratio
from overlake.operators import (
    accepted_values,
    canonicalize,
    dedupe,
    latest_by,
    mode_of,
    null_counts,
    phase_pivot,
    relationships,
    rule,
    top_k_share,
    unique,
    upsert_by_revision,
)
from overlake.plans import flatten, innings as inn
from overlake.plans.catalogue import audit, coverage, leaders, matches, player, season, sql_functions, team
from overlake.plans.tables import MatchTables, Silver
from overlake.schemas import BATTING_INNINGS
from overlake.session import configure, fresh_path
from overlake.sources import driver_tables as dt
from overlake.sources.archives import explode_archives, explode_members, member_stem
from overlake.sources.bronze import BronzeStore, bronze_rows
from overlake.sources.inventory import inventory_of, partition_inventory
from overlake.sources.publish import publish
from overlake.sources.raw import parse_documents, quarantine, read_raw, read_raw_texts, well_formed
from overlake.sources.seeds import read_seed, seed_frame
from overlake.sources.ledger import FileLedger
from overlake.sources.silver import adopt_silver, read_silver, write_silver
from overlake.streaming import follow_changes, ingest_available

Query = Callable[[SparkSession, str], DataFrame]

_kept: dict[tuple[str, str, str], object] = {}
_lock = threading.RLock()


def _once(spark: SparkSession, sf_dir: str, what: str, build: Callable[[], object]):
    """Value of ``build``, made once per application and source folder."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), what)
    with _lock:
        if key not in _kept:
            _kept[key] = build()
        return _kept[key]


def match_tables(spark: SparkSession, sf_dir: str) -> MatchTables:
    configure(spark)

    def build():
        return MatchTables(
            dt.silver(spark, sf_dir), dt.seeds(spark), fresh_path(spark, "tables")
        )

    return _once(spark, sf_dir, "tables", build)


def portable(df: DataFrame) -> DataFrame:
    """Dates as ISO text, so that results compare across engines."""
    dates = {
        f.name: F.date_format(F.col(f"`{f.name}`"), "yyyy-MM-dd")
        for f in df.schema
        if isinstance(f.dataType, T.DateType)
    }
    return df.withColumns(dates) if dates else df


def on_tables(plan: Callable[..., DataFrame], **params) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(plan(match_tables(spark, sf_dir), **params))

    return run


def in_sql(call: str, **params) -> Query:
    """A call of a table function of the catalogue by ``spark.sql``."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with _lock:  # The functions' views are the session's.
            sql_functions.register_functions(match_tables(spark, sf_dir), call.partition("(")[0])
            return portable(spark.sql(f"SELECT * FROM {call}", args=params))

    return run


def on_source(plan: Callable[[SparkSession, str], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return portable(plan(spark, sf_dir))

    return run


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# parameters of the registered queries ------------------------------------------

PLAYER = "NATION_2_P7"
KEEPER = "NATION_2_P10"
TEAMS = ("NATION_1", "NATION_16")
TEAM = ("NATION_2",)
SEASON = "2010"
EXPECTED_BATTING = [
    ("NATION_2_P7", 1000, 1, 5, "first"),
    ("NATION_1_P3", 500, 0, 3, "second"),
    ("NATION_4_P1", None, None, None, "no figures"),
]
EXPECTED_BOWLING = [("NATION_2_P7", 40, "first"), ("NATION_5_P8", 60, "second")]


# Calls of table functions, by the query of which they are the SQL form.
_OF_PLAYER, _OF_TEAMS = {"player": PLAYER}, {"names": list(TEAMS)}
_OF_SEASON, _OF_TEAM = {"season": SEASON}, {"names": list(TEAM), "season": SEASON}
SQL_CALLS: dict[str, tuple[str, dict]] = {
    "c1_matches_by_type": ("matches_by_type()", {}),
    "c2_matches_by_year": ("matches_by_year(last_n => 4, as_of => DATE'2014-06-01')", {}),
    "c3_recent_matches": ("recent_matches()", {}),
    "c5_freshness": ("freshness()", {}),
    "l01_top_run_scorers": ("top_run_scorers(min_inns => 10)", {}),
    "l05_highest_scores": ("highest_scores()", {}),
    "l07_average_trend": ("average_trend(:player)", _OF_PLAYER),
    "l09_best_economy": ("best_economy(min_inns => 10)", {}),
    "l13_economy_by_over_strict": ("economy_by_over(strict => true)", {}),
    "m1_team_record": ("team_record('NATION_0')", {}),
    "m2_head_to_head": ("head_to_head('NATION_2', 'NATION_3')", {}),
    "m6_venue_counts": ("venue_counts()", {}),
    "p02_player_batting_by_season": ("player_batting_by_season(:player)", _OF_PLAYER),
    "p07_player_bowling": ("player_bowling(:player)", _OF_PLAYER),
    "p09_player_best_bowling": ("player_best_bowling(:player)", _OF_PLAYER),
    "p12_player_fielding": ("player_fielding(:player)", {"player": KEEPER}),
    "t01_team_seasons": ("team_seasons(:names)", _OF_TEAMS),
    "t07_team_highest_totals": ("team_highest_totals(:names)", _OF_TEAMS),
    "t09_team_bowling_seasons": ("team_bowling_seasons(:names)", _OF_TEAMS),
    "t11_team_top_batters": ("team_top_batters(:names)", _OF_TEAMS),
    "s01_season_results": ("season_results(:names, :season)", _OF_TEAM),
    "s04_batting_dominance": ("batting_dominance(:season, 12.0D)", _OF_SEASON),
    "s07_batting_phases": ("batting_phases(:season)", _OF_SEASON),
    "s08_bowling_profile": ("bowling_profile(:season)", _OF_SEASON),
}


# generic operators on the source tables ------------------------------------------


def latest_lineitem(spark, sf_dir):
    items = _read(spark, sf_dir, "lineitem")
    order = ["l_shipdate DESC", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    latest = latest_by(items, ["l_orderkey", "l_linenumber"], order)
    return latest.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


def canonical_nations(spark, sf_dir):
    names = [("NATION_1", "First"), ("NATION_2", "Second"), ("NATION_3", "Second"), ("NATION_99", "None")]
    mapping = seed_frame(spark, names, T.StructType([T.StructField(c, T.StringType()) for c in ("raw", "canonical")]))
    nations = _read(spark, sf_dir, "nation")
    suppliers = _read(spark, sf_dir, "supplier")
    named = canonicalize(nations, "n_name", mapping, "raw", {"name": "canonical"})
    joined = suppliers.join(named, suppliers["s_nationkey"] == named["n_nationkey"])
    return joined.groupBy("name").agg(F.count("*").alias("suppliers"))


def orders_without_items(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders")
    items = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return orders.join(items, "o_orderkey", "left_anti").select("o_orderkey", "o_custkey")


def ratios_by_flag(spark, sf_dir):
    items = _read(spark, sf_dir, "lineitem")
    large = "sum(CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END)"
    return items.groupBy("l_returnflag").agg(
        *named(large=large, items="count(*)"),
        ratio(large, "count(*)", 2, times=100).alias("large_pct"),
        ratio("sum(l_quantity)", "count(*)", 3).alias("mean_quantity"),
    )


def quantity_bands(spark, sf_dir):
    items = _read(spark, sf_dir, "lineitem")
    bands = {"low": (1, 2), "mid": (3, 5), "high": (6, 7)}
    measures = {"quantity": "cast(l_quantity AS bigint)", "items": "1"}
    cells = phase_pivot("l_linenumber", bands, measures)
    return items.groupBy("l_suppkey").agg(*cells)


def supplier_shares(spark, sf_dir):
    items = _read(spark, sf_dir, "lineitem")
    per_supplier = items.groupBy("l_suppkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    suppliers = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    rows = per_supplier.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return top_k_share(rows.select("s_nationkey", "s_name", "quantity"), "s_nationkey", "s_name", "quantity", 2)


def usual_priority(spark, sf_dir):
    return mode_of(_read(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", "priority")


def _versions(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders")

    def rows(df, revision):
        return df.select(
            F.col("o_orderkey").cast("string").alias("match_id"),
            F.expr(revision).cast("int").alias("revision"),
            F.expr(f"concat(o_orderpriority, '/', {revision})").alias("payload"),
        )

    stored = rows(orders.filter("o_orderstatus <> 'P'"), "1 + o_custkey % 2")
    return stored, rows(orders, "1 + o_custkey % 3")


def upsert_merged(spark, sf_dir):
    return upsert_by_revision(*_versions(spark, sf_dir))[0]


def upsert_counts(spark, sf_dir):
    return upsert_by_revision(*_versions(spark, sf_dir))[1]


def duplicate_items(spark, sf_dir):
    return unique(_read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def unlisted_priorities(spark, sf_dir):
    listed = ("1-URGENT", "2-HIGH", "3-MEDIUM")
    bad = accepted_values(_read(spark, sf_dir, "orders"), "o_orderpriority", listed)
    return bad.select("o_orderkey", "o_orderpriority")


def childless_orders(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders").select("o_orderkey")
    items = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return relationships(orders, items, "o_orderkey")


def heavy_discounts(spark, sf_dir):
    bad = rule(_read(spark, sf_dir, "lineitem"), F.col("l_discount") < 0.095)
    return bad.groupBy("l_returnflag").agg(F.count("*").alias("items"))


def missing_values(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").join(_read(spark, sf_dir, "labels"), "doc_id", "left")
    return null_counts(docs, ["text", "lang", "quality", "toxic"])


# ingestion on documents derived from the source tables -----------------------------


def _documents(spark, sf_dir):
    """The derived documents, one per order, stored once per session."""

    def build():
        path = fresh_path(spark, "documents")
        dt.documents(spark, sf_dir).write.parquet(path)
        return spark.read.parquet(path)

    return _once(spark, sf_dir, "documents", build)


def _delivered(spark, sf_dir):
    """The documents as they might arrive: those of low priority lack their last brace."""
    cut = "if(o_orderpriority = '5-LOW', substr(content, 1, length(content) - 1), content)"
    return _documents(spark, sf_dir).withColumn("content", F.expr(cut))


def flattened(table: str):
    def run(spark, sf_dir):
        docs = parse_documents(_documents(spark, sf_dir), parts=flatten.PARTS[table])
        return flatten.FLATTEN[table](well_formed(docs)).drop("wicket_fielders_arr")

    return run


def quarantined(spark, sf_dir):
    return quarantine(parse_documents(_delivered(spark, sf_dir))).select("match_id")


def archive_members(spark, sf_dir):
    members = explode_members(dt.archives(spark, sf_dir, _documents(spark, sf_dir)))
    return members.select(
        F.when(F.col("name").isNull(), F.col("archive")).alias("unreadable"),
        member_stem().alias("match_id"),
        F.col("error").isNull().alias("whole"),
        F.get_json_object("content", "$.info.venue").alias("venue"),
    )


def archives_by_ranges(spark, sf_dir):
    """As :func:`archive_members`, from files of which every task reads a few kilobytes at a time."""
    folder = fresh_path(spark, "archives")
    dt.archive_files(spark, sf_dir, _documents(spark, sf_dir), folder)
    members = explode_archives(spark, folder, range_bytes=64 << 10)
    stem = F.regexp_extract("archive", "([^/]+)[.]zip$", 1)
    return members.select(
        F.when(F.col("name").isNull(), stem).alias("unreadable"),
        member_stem().alias("match_id"),
        F.col("error").isNull().alias("whole"),
        F.get_json_object("content", "$.info.venue").alias("venue"),
    )


def odd_leaves(spark, sf_dir):
    """Documents in which some leaves have another type than usual: every match is in all
    four tables, and only the odd leaves are missing or read as what they say."""
    odd = F.col("content")
    for usual, other in (
        ('"player_of_match":["P3"]', '"player_of_match":"P3"'),
        ('"declared":true', '"declared":"yes"'),
        ('"umpires_call":true', '"umpires_call":1'),
        ('"season":', '"gender":{"odd":1},"season":'),
    ):
        odd = F.replace(odd, F.lit(usual), F.lit(other))
    parsed = parse_documents(_documents(spark, sf_dir).withColumn("content", odd))
    # Parsed once, as a load does; each table reads its own leaves of that.
    path = fresh_path(spark, "odd-leaves")
    parsed.write.parquet(path)
    docs = well_formed(spark.read.schema(parsed.schema).parquet(path))
    m = flatten.flatten_matches(docs).select("match_id", "player_of_match", "overs", "season")
    i = flatten.flatten_innings(docs).groupBy("match_id").agg(F.count("*").alias("innings"), F.count("declared").alias("declared"))
    d = flatten.flatten_deliveries(docs).groupBy("match_id").agg(
        F.count("*").alias("balls"), F.count("review_umpires_call").alias("calls"), F.count("review_by").alias("reviews")
    )
    p = flatten.flatten_players(docs).groupBy("match_id").agg(F.count("*").alias("players"))
    # Every side has a row per match, which sizes guessed from packed text do not tell: none may be broadcast.
    return m.join(i.hint("merge"), "match_id").join(d.hint("merge"), "match_id").join(p.hint("merge"), "match_id")


def _raw_tree(spark, sf_dir):
    """A folder of document files, written once per session."""

    def build():
        path = fresh_path(spark, "raw-tree")
        dt.raw_files(spark, sf_dir, path)
        return path

    return _once(spark, sf_dir, "raw tree", build)


def raw_files(spark, sf_dir):
    innings = flatten.flatten_innings(well_formed(read_raw(spark, _raw_tree(spark, sf_dir))))
    return innings.groupBy("match_type", "year", "revision").agg(
        F.count_distinct("match_id").alias("matches"), F.count("*").alias("innings"), F.count_if("declared").alias("declared")
    )


def raw_since(spark, sf_dir):
    """Files changed within a day, and files that will change after tomorrow."""
    tree = _raw_tree(spark, sf_dir)
    counts = [
        read_raw_texts(spark, tree, days).agg(F.lit(label).alias("changed"), F.count("*").alias("files"))
        for label, days in (("today", 1), ("not yet", -2))
    ]
    return counts[0].unionByName(counts[1])


def file_ledger(spark, sf_dir):
    """Files per load: a folder first, then everything, with files among it that are dated before the first
    load, then nothing new."""
    tree = fresh_path(spark, "ledger-tree")
    dt.raw_files(spark, sf_dir, tree)
    dt.date_back(spark, f"{tree}/match_type=odi")
    ledger = FileLedger(spark, fresh_path(spark, "ledger"))
    out = []
    for number, folder in enumerate((f"{tree}/match_type=t20", tree, tree), 1):

        def load(paths, number=number):
            docs = well_formed(read_raw(spark, paths))
            out.append(docs.select(F.lit(number).alias("load"), "match_type", F.size("innings").alias("n")))

        ledger.take(folder, load)
    read = out[0]
    for more in out[1:]:
        read = read.unionByName(more)
    return read.groupBy("load", "match_type").agg(F.count("*").alias("files"), F.sum("n").alias("innings"))


def adopted_silver(spark, sf_dir):
    """Silver whose files were written with the types that their values suggested, read under the fixed schema."""
    root = fresh_path(spark, "foreign-silver")
    rows = dt.innings(spark, sf_dir)
    shapes = (
        ("match_id % 3 = 0", ["CAST(NULL AS string) AS declared", "CAST(target_runs AS double) AS target_runs"]),
        ("match_id % 3 = 1", ["declared", "CAST(target_runs AS bigint) AS target_runs", "target_overs"]),
        ("match_id % 3 = 2", ["CAST(declared AS string) AS declared", "CAST(target_runs AS string) AS target_runs"]),
    )
    key = ["match_id", "match_type", "year", "innings_number", "batting_team", "super_over"]
    for where, columns in shapes:
        part = rows.filter(where).selectExpr(*key, *columns)
        part.write.mode("append").partitionBy("match_type", "year").parquet(f"{root}/innings")
    adopted = adopt_silver(spark, root, "innings")
    return adopted.groupBy("match_type", "year").agg(
        *named(
            innings="count(*)", declared="count_if(declared)", super_overs="count_if(super_over)",
            target="sum(target_runs)", overs="sum(target_overs)", revisions="count(revision)",
        )
    )


def file_inventory(spark, sf_dir):
    return partition_inventory(spark, _raw_tree(spark, sf_dir))


def csv_seeds(spark, sf_dir):
    """Team names through a map that lies in a CSV file."""
    path = fresh_path(spark, "seed")
    nations = _read(spark, sf_dir, "nation")
    names = nations.selectExpr("n_name AS raw_name", "concat('Region ', n_regionkey) AS canonical_name")
    names.filter("canonical_name <> 'Region 4'").write.option("header", "true").csv(path)
    mapping = read_seed(spark, "team_name_map", path)
    named = canonicalize(nations, "n_name", mapping, "raw_name", {"name": "canonical_name"})
    joined = _read(spark, sf_dir, "customer").join(named, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("name").agg(F.count("*").alias("customers"))


def published_table(spark, sf_dir):
    """A model as a catalogue table, in folders by format and year, and read by its name."""
    layer = "overlake_" + spark.sparkContext.applicationId.replace("-", "_")
    overs = match_tables(spark, sf_dir).overs
    stored = publish(overs, layer, f"overs_{uuid.uuid4().hex[:8]}", False, ("match_type", "year"), ("match_id",))
    return stored.groupBy("match_type", "year").agg(F.sum("deliveries").alias("balls"), F.sum("runs").alias("runs"))


def inventory(spark, sf_dir):
    """Paths the documents would have; unreadable ones lie above the folders."""
    rows = bronze_rows(_delivered(spark, sf_dir))
    folders = F.concat(F.lit("match_type="), "match_type", F.lit("/year="), "year", F.lit("/"))
    prefix = F.when(F.col("error").isNull(), folders).otherwise("")
    path = F.concat(prefix, "match_id", F.lit(".json"))
    return inventory_of(rows.select(path.alias("path")))


def _opened(spark, sf_dir):
    """The delivered documents as bronze rows, parsed once per session: batches are cut from these.
    ``settled`` marks those of orders that are known not to be open."""

    def build():
        path = fresh_path(spark, "bronze-rows")
        docs, settled = _delivered(spark, sf_dir), "coalesce(o_orderstatus <> 'P', false)"
        parts = [
            bronze_rows(docs.filter(f"{settled} = {known}")).withColumn("settled", F.lit(known)) for known in (False, True)
        ]
        rows = parts[0].unionByName(parts[1])
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    return _once(spark, sf_dir, "bronze rows", build)


def bronze_state(spark, sf_dir):
    """Two batches into a fresh store: settled orders at revision 1, then all at theirs."""
    store = BronzeStore(spark, fresh_path(spark, "bronze"))
    rows = _opened(spark, sf_dir)
    store.apply(rows.filter("settled").withColumn("revision", F.lit(1)), 0)
    store.apply(rows, 1)
    return store.current().select("match_id", "match_type", "year", "revision", "batch")


def bronze_two_feeds(spark, sf_dir):
    """Two feeds that number their batches alike: nothing is lost."""
    store = BronzeStore(spark, fresh_path(spark, "bronze"))
    docs = _delivered(spark, sf_dir)
    store.apply(bronze_rows(docs.filter("o_orderstatus = 'P'")), 0, "first")
    store.apply(bronze_rows(docs.filter("o_orderstatus <> 'P'")), 0, "second")
    return store.current().select("match_id", "revision", "feed", "batch")


def bronze_replay(spark, sf_dir):
    """A batch that is applied again changes nothing; a lower revision is skipped."""
    store = BronzeStore(spark, fresh_path(spark, "bronze"))
    rows = _opened(spark, sf_dir)
    store.apply(rows, 0)
    store.apply(rows, 0)
    store.apply(rows.withColumn("revision", F.lit(0)), 1)
    found = store.current().groupBy("batch").agg(F.count("*").alias("matches"), F.sum("revision").alias("revisions"))
    reports = store.stats(0).withColumn("of", F.lit(0)).unionByName(store.stats(1).withColumn("of", F.lit(1)))
    counts = reports.groupBy("of").agg(
        *[F.sum(F.when(F.col("status") == s, F.col("matches")).otherwise(0)).alias(s) for s in ("new", "updated", "skipped", "unreadable")]
    )
    return counts.join(found, counts["of"] == found["batch"], "left").drop("batch")


def bronze_errors(spark, sf_dir):
    """One row per unreadable document, with its text, which lacks the last brace."""
    store = BronzeStore(spark, fresh_path(spark, "bronze"))
    store.apply(bronze_rows(_delivered(spark, sf_dir)), 3)
    kept = store.errors().filter("startswith(content, '{') AND NOT endswith(content, '}}')")
    return kept.select("match_id", "reason", "batch")


class _Ended(Exception):
    """Stands for a run that is lost."""


class _EndingStore(BronzeStore):
    """A store whose run ends before one of its writes."""

    ends_at: str | None = None

    def _about_to(self, write: str) -> None:
        if write == self.ends_at:
            raise _Ended(write)


def bronze_interrupted(spark, sf_dir):
    """Batches that end before or after their commit and are repeated: none is lost, none counts twice."""
    path = fresh_path(spark, "bronze")
    rows = _opened(spark, sf_dir)
    for number, end in enumerate(("documents", "index", "state", "end")):
        batch = rows.filter(F.expr(f"cast(match_id AS bigint) % 4 = {number}"))
        lost = _EndingStore(spark, path)
        lost.ends_at = end
        try:
            lost.apply(batch, number)
        except _Ended:
            pass
        BronzeStore(spark, path).apply(batch, number)
    return BronzeStore(spark, path).current().select("match_id", "match_type", "year", "revision", "feed", "batch")


#: Remainders, by 35, of the numbers of matches that are new, corrected and removed below; 35 folders.
_NEW, _CORRECTED, _REMOVED = 3, 10, 24


def _silver_before(spark, sf_dir):
    """Silver as it was: some matches missing, some in older revisions only, some that are gone now."""
    now = dt.silver(spark, sf_dir)
    number = "cast(match_id AS bigint)"

    def older(rows: DataFrame) -> DataFrame:
        known = rows.filter(f"{number} % 35 <> {_NEW} OR {number} % 2 = 1")
        known = known.filter(f"{number} % 35 <> {_CORRECTED} OR {number} % 3 = 0 OR coalesce(revision, 1) < {number} % 3 + 1")
        gone = rows.filter(f"{number} % 35 = {_REMOVED}").withColumn("match_id", F.concat(F.lit("gone-"), "match_id"))
        return known.unionByName(gone)

    return Silver(older(now.matches), older(now.innings), older(now.deliveries), older(now.players))


def _refreshed(spark, sf_dir):
    """A store built from silver as it was, brought up to date, once per session."""

    def build():
        store, seeds = fresh_path(spark, "incremental"), dt.seeds(spark)
        MatchTables(_silver_before(spark, sf_dir), seeds, store).build()
        return MatchTables.refresh(dt.silver(spark, sf_dir), seeds, store)

    return _once(spark, sf_dir, "refreshed", build)


def incremental_build(spark, sf_dir):
    """Every career after new, corrected and removed matches."""
    t = _refreshed(spark, sf_dir)
    bowled = t.bowling_career.select("player_name", "match_type", "total_wickets", F.col("matches").alias("bowled_in"))
    known = t.dim_players.select("player_name", "cricsheet_id", "total_matches", "teams")
    return t.batting_career.join(bowled, ["player_name", "match_type"], "left").join(known, "player_name", "left")


def incremental_folders(spark, sf_dir):
    """Every folder's balls, innings, wickets and results after the same changes."""
    t, keys = _refreshed(spark, sf_dir), ["match_type", "year"]
    balls = t.balls.groupBy(*keys).agg(*named(balls="count(*)", runs="sum(runs_total)", matches="count(DISTINCT match_id)"))
    bat = t.batting.groupBy(*keys).agg(*named(innings="count(*)", bat_runs="sum(runs)"))
    bowl = t.bowling.groupBy(*keys).agg(*named(spells="count(*)", credited="sum(wickets_credited)"))
    fell = t.wickets.groupBy(*keys).agg(*named(wickets="count(*)"))
    results = t.match_results.groupBy(*keys).agg(*named(results="count(*)", won="count(outcome_winner)"))
    out = results
    for part in (balls, bat, bowl, fell):
        out = out.join(part, keys, "left")
    return out


def streamed_state(spark, sf_dir):
    """Events as versioned records of their user, streamed from where they lie."""
    schema = _read(spark, sf_dir, "events").schema
    # A pattern, since a streamed path that is no pattern has to be a folder.
    source = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    store = BronzeStore(spark, fresh_path(spark, "bronze"))

    def to_bronze(batch):
        return batch.select(
            F.col("user_id").cast("string").alias("match_id"),
            F.col("event_type").alias("match_type"),
            F.year("ts").cast("string").alias("year"),
            F.get_json_object("props", "$.k").cast("int").alias("revision"),
            F.col("props").alias("content"),
            F.lit(None).cast("string").alias("error"),
        )

    ingest_available(source, store, fresh_path(spark, "progress"), to_bronze)
    return store.current().select("match_id", "revision")


# As text, the way the items bring them.
_BALL = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("innings_number", "over_number", "ball_in_over", "runs_total", "is_wicket")]
)


def streamed_changes(spark, sf_dir):
    """Documents in several revisions, late, repeated and corrected, as a stream of changed balls; summed per match.

    First come the newest revisions of even matches and the older ones of odd matches, then all
    revisions of all matches.
    """
    configure(spark)
    key = ["match_id", "revision", "innings_number", "over_number", "ball_in_over"]
    balls = dt.silver(spark, sf_dir).deliveries.drop("match_type", "year", "wicket_fielders_arr")
    # A document is a revision of a match: its balls meet in one exchange and are summed up there.
    balls = dedupe(balls, key, place=["match_id", "revision"])
    items = F.to_json(F.array_sort(F.collect_list(F.array(*[F.col(c).cast("string") for c in _BALL.names]))))
    made = balls.groupBy("match_id", "revision").agg(items.alias("items"))
    # Made once, delivered twice.
    path = fresh_path(spark, "changes-documents")
    made.write.parquet(path)
    docs = spark.read.schema(made.schema).parquet(path)
    newest = "revision = cast(match_id AS bigint) % 3 + 1"
    older = f"cast(match_id AS bigint) % 2 = 1 AND cast(match_id AS bigint) % 3 > 0 AND NOT {newest}"
    first = docs.filter(f"cast(match_id AS bigint) % 2 = 0 AND {newest} OR {older}")
    landing, table, progress = (fresh_path(spark, f"changes-{n}") for n in ("landing", "table", "progress"))
    for arriving in (first, docs):
        arriving.write.mode("append").parquet(landing)
        source = spark.readStream.schema(docs.schema).parquet(landing)
        follow_changes(source, _BALL, table, progress)
    changed = spark.read.parquet(table)
    return changed.groupBy("match_id").agg(
        F.max("revision").alias("revision"),
        F.sum("change").alias("balls"),
        F.sum(F.col("change") * F.col("runs_total").cast("int")).alias("runs"),
        F.sum(F.when(F.col("is_wicket") == "true", F.col("change")).otherwise(0)).alias("wickets"),
        (F.min("change") < 0).alias("corrected"),
    )


def silver_rerun(spark, sf_dir):
    """An incremental load that is repeated adds nothing; new revisions are added."""
    root = fresh_path(spark, "silver")
    balls = dt.deliveries(spark, sf_dir)
    write_silver(balls, root, "deliveries", "full")
    for _ in range(2):
        write_silver(balls, root, "deliveries", "incremental")
        write_silver(balls.filter("over_number = 0").withColumn("revision", F.lit(9)), root, "deliveries", "incremental")
    return read_silver(spark, root, "deliveries").groupBy("revision").agg(F.count("*").alias("balls"))


def silver_round_trip(spark, sf_dir):
    root = fresh_path(spark, "silver")
    write_silver(dt.deliveries(spark, sf_dir), root, "deliveries", "full")
    write_silver(dt.deliveries(spark, sf_dir), root, "deliveries", "incremental")
    back = read_silver(spark, root, "deliveries")
    return back.groupBy("match_type", "year").agg(
        F.count("*").alias("balls"), F.sum("runs_total").alias("runs")
    )


def delivery_view(spark, sf_dir):
    view = publish(match_tables(spark, sf_dir).fct_deliveries, "marts", "fct_deliveries", as_view=True)
    return view.groupBy("batting_team", "bowling_team").agg(
        F.count("*").alias("balls"), F.sum("runs_total").alias("runs")
    )


def broken(t: MatchTables) -> SimpleNamespace:
    """The tables with failures of every kind.

    The j-th required column of a table is empty in every (2j + 7)-th match, or player by the
    length of the name; besides, keys repeat, children lose their match, and row rules are broken.
    """
    out = {}
    for table, required in audit.REQUIRED.items():
        rows = getattr(t, table)
        number = "cast(match_id AS int)" if "match_id" in rows.columns else "length(player_name)"
        rows = rows.withColumn("n", F.expr(number))
        if table in audit.UNIQUE:
            rows = rows.unionByName(rows.filter("n % 5 = 2"))
        change = {c: f"CASE WHEN n % {2 * j + 7} = 1 THEN NULL ELSE {c} END" for j, c in enumerate(required)}
        if table in audit.CHILDREN:
            change["match_id"] = f"CASE WHEN n % 29 = 1 THEN 'none' ELSE {change['match_id']} END"
        if table == "stg_matches":
            change["match_type"] = f"CASE WHEN n % 13 = 5 THEN 'club' ELSE {change['match_type']} END"
        if table == "stg_innings":
            change["batting_team"] = "CASE WHEN n % 31 = 3 THEN 'Nobody' WHEN n % 11 = 1 THEN NULL ELSE batting_team END"
        if table == "ball_by_ball":
            change["runs_total"] = "CASE WHEN n % 13 = 1 THEN NULL WHEN n % 17 = 2 THEN runs_total + 1 ELSE runs_total END"
        if table == "match_results":
            change["outcome_winner"] = "CASE WHEN n % 19 = 3 THEN 'Nobody' ELSE outcome_winner END"
        out[table] = rows.withColumns({c: F.expr(e) for c, e in change.items()})
    return SimpleNamespace(**out)


def _table(name):
    return on_tables(lambda t: getattr(t, name))


def queries() -> dict[str, Query]:
    p, s = {"player": PLAYER}, {"season": SEASON}
    ts, t1 = {"names": TEAMS}, {"names": TEAM, "season": SEASON}
    p1 = {"player": PLAYER, **t1}
    return {
        # models
        "stg_matches": _table("stg_matches"),
        "stg_innings": _table("stg_innings"),
        "stg_deliveries": on_tables(lambda t: t.stg_deliveries.drop("wicket_fielders_arr")),
        "stg_players": _table("stg_players"),
        "ball_by_ball": _table("ball_by_ball"),
        "fct_deliveries": on_source(delivery_view),
        "match_results": _table("match_results"),
        "batting_innings": _table("batting_innings"),
        "bowling_innings": _table("bowling_innings"),
        "dismissals": on_tables(lambda t: inn.dismissals(t.took_part)),
        "match_batters": on_tables(lambda t: inn.match_batters(t.took_part)),
        "zero_ball_dismissals": on_tables(lambda t: inn.zero_ball_dismissals(t.took_part).select(*BATTING_INNINGS)),
        "non_striker_only": on_tables(lambda t: inn.non_striker_only(t.took_part).select(*BATTING_INNINGS)),
        "over_figures": _table("overs"),
        "dim_players": _table("dim_players"),
        "batting_career": _table("batting_career"),
        "bowling_career": _table("bowling_career"),
        # coverage
        "c1_matches_by_type": on_tables(coverage.matches_by_type),
        "c2_matches_by_year": on_tables(coverage.matches_by_year, last_n=4, as_of=date(2014, 6, 1)),
        "c3_recent_matches": on_tables(coverage.recent_matches),
        "c4_deliveries_by_type": on_tables(coverage.deliveries_by_type),
        "c5_freshness": on_tables(coverage.freshness),
        # leaders
        "l01_top_run_scorers": on_tables(leaders.top_run_scorers, min_inns=10),
        "l02_top_strike_rates": on_tables(leaders.top_strike_rates, min_inns=10),
        "l03_most_centuries": on_tables(leaders.most_centuries),
        "l04_player_formats": on_tables(leaders.player_formats, **p),
        "l05_highest_scores": on_tables(leaders.highest_scores),
        "l06_most_sixes_innings": on_tables(leaders.most_sixes_innings),
        "l07_average_trend": on_tables(leaders.average_trend, **p),
        "l08_top_wicket_takers": on_tables(leaders.top_wicket_takers, min_inns=10),
        "l09_best_economy": on_tables(leaders.best_economy, min_inns=10),
        "l10_most_five_wicket_hauls": on_tables(leaders.most_five_wicket_hauls),
        "l11_best_bowling_innings": on_tables(leaders.best_bowling_innings),
        "l12_wicket_kinds": on_tables(leaders.wicket_kinds),
        "l13_economy_by_over": on_tables(leaders.economy_by_over),
        "l13_economy_by_over_strict": on_tables(leaders.economy_by_over, strict=True),
        # matches
        "m1_team_record": on_tables(matches.team_record, team="NATION_0"),
        "m2_head_to_head": on_tables(matches.head_to_head, team_a="NATION_2", team_b="NATION_3"),
        "m3_toss_advantage": on_tables(matches.toss_advantage),
        "m4_biggest_run_margins": on_tables(matches.biggest_run_margins),
        "m5_player_of_match_awards": on_tables(matches.player_of_match_awards),
        "m6_venue_counts": on_tables(matches.venue_counts),
        # one player
        "p01_player_batting": on_tables(player.player_batting, **p),
        "p01_player_batting_career": on_tables(player.player_batting_career, **p),
        "p02_player_batting_by_season": on_tables(player.player_batting_by_season, **p),
        "p02_player_batting_trend": on_tables(player.player_batting_trend, **p),
        "p03_player_top_innings": on_tables(player.player_top_innings, **p),
        "p04_player_innings_log": on_tables(player.player_innings_log, **p),
        "p05_player_dismissals_by_season": on_tables(player.player_dismissals_by_season, **p),
        "p06_player_innings_diagnostic": on_tables(player.player_innings_diagnostic, **p),
        "p07_player_bowling": on_tables(player.player_bowling, **p),
        "p08_player_bowling_by_season": on_tables(player.player_bowling_by_season, **p),
        "p09_player_best_bowling": on_tables(player.player_best_bowling, **p),
        "p10_player_bowling_log": on_tables(player.player_bowling_log, **p, **s),
        "p11_player_bowling_diagnostic": on_tables(player.player_bowling_diagnostic, **p, **s),
        "p12_player_fielding": on_tables(player.player_fielding, player=KEEPER),
        "p12_player_fielding_like": on_tables(player.player_fielding, player="NATION_2_P1", legacy_like=True),
        "p13_player_fielding_by_season": on_tables(player.player_fielding_by_season, player=KEEPER),
        # one team, all time
        "t01_team_seasons": on_tables(team.team_seasons, **ts),
        "t02_team_by_stage": on_tables(team.team_by_stage, **ts),
        "t03_team_vs_opponents": on_tables(team.team_vs_opponents, **ts),
        "t04_team_toss": on_tables(team.team_toss, **ts),
        "t05_team_toss_decision": on_tables(team.team_toss_decision, **ts),
        "t06_team_batting_seasons": on_tables(team.team_batting_seasons, **ts),
        "t07_team_highest_totals": on_tables(team.team_highest_totals, **ts),
        "t08_team_lowest_totals": on_tables(team.team_lowest_totals, **ts),
        "t09_team_bowling_seasons": on_tables(team.team_bowling_seasons, **ts),
        "t10_team_lowest_conceded": on_tables(team.team_lowest_conceded, **ts),
        "t11_team_top_batters": on_tables(team.team_top_batters, **ts),
        "t12_team_top_bowlers": on_tables(team.team_top_bowlers, **ts),
        "t13_won_by_runs": on_tables(team.team_margins, **ts, side="won", unit="runs"),
        "t14_won_by_wickets": on_tables(team.team_margins, **ts, side="won", unit="wickets"),
        "t15_lost_by_runs": on_tables(team.team_margins, **ts, side="lost", unit="runs"),
        "t16_lost_by_wickets": on_tables(team.team_margins, **ts, side="lost", unit="wickets"),
        # one season
        "s01_season_results": on_tables(season.season_results, **t1),
        "s02_season_summary": on_tables(season.season_summary, **t1),
        "s03_batting_concentration": on_tables(season.batting_concentration, **s),
        "s04_batting_dominance": on_tables(season.batting_dominance, **s, pct=12.0),
        "s05_bowling_concentration": on_tables(season.bowling_concentration, **s),
        "s06_batting_profile": on_tables(season.batting_profile, **s),
        "s07_batting_phases": on_tables(season.batting_phases, **s),
        "s08_bowling_profile": on_tables(season.bowling_profile, **s),
        "s09_bowling_phases": on_tables(season.bowling_phases, **s),
        "s10_phase_split_by_result": on_tables(season.phase_split_by_result, **s),
        "s10_phase_split_swapped": on_tables(season.phase_split_by_result, **s, swapped_bowling=True),
        "s11_season_batters": on_tables(season.season_batters, **t1),
        "s12_season_batter_share": on_tables(season.season_batter_share, **t1),
        "s13_season_batting_profile": on_tables(season.season_batting_profile, **t1),
        "s14_season_batting_phases": on_tables(season.season_batting_phases, **t1),
        "s15_season_bowlers": on_tables(season.season_bowlers, **t1),
        "s16_season_bowler_share": on_tables(season.season_bowler_share, **t1),
        "s17_season_bowling_profile": on_tables(season.season_bowling_profile, **t1),
        "s18_season_bowling_phases": on_tables(season.season_bowling_phases, **t1),
        "s19_season_win_loss": on_tables(season.season_win_loss, **t1),
        "s20_season_player_batting_log": on_tables(season.season_player_batting_log, **p1),
        "s21_season_player_batting": on_tables(season.season_player_batting, **p1),
        "s22_season_player_bowling_log": on_tables(season.season_player_bowling_log, **p1),
        "s23_powerplay_impact": on_tables(season.powerplay_impact, player=KEEPER, names=TEAM, season="2009"),
        # the catalogue's table functions, called in SQL
        **{f"sql_{name}": in_sql(call, **params) for name, (call, params) in SQL_CALLS.items()},
        # reconciliation and checks
        "v1_reconcile_batting": on_tables(audit.reconcile_batting, expected=EXPECTED_BATTING),
        "v2_reconcile_bowling": on_tables(audit.reconcile_bowling, expected=EXPECTED_BOWLING),
        "check_report": on_tables(audit.check_report),
        "check_report_broken": on_tables(lambda t: audit.check_report(broken(t))),
        "check_unique": on_source(duplicate_items),
        "check_accepted_values": on_source(unlisted_priorities),
        "check_relationships": on_source(childless_orders),
        "check_rule": on_source(heavy_discounts),
        "check_null_counts": on_source(missing_values),
        # generic operators
        "latest_by": on_source(latest_lineitem),
        "canonicalize": on_source(canonical_nations),
        "anti": on_source(orders_without_items),
        "ratio": on_source(ratios_by_flag),
        "phase_pivot": on_source(quantity_bands),
        "top_k_share": on_source(supplier_shares),
        "mode_of": on_source(usual_priority),
        "upsert_merged": on_source(upsert_merged),
        "upsert_counts": on_source(upsert_counts),
        # ingestion
        "flatten_matches": on_source(flattened("matches")),
        "flatten_innings": on_source(flattened("innings")),
        "flatten_deliveries": on_source(flattened("deliveries")),
        "flatten_players": on_source(flattened("players")),
        "flatten_odd_leaves": on_source(odd_leaves),
        "raw_files": on_source(raw_files),
        "raw_since": on_source(raw_since),
        "file_inventory": on_source(file_inventory),
        "file_ledger": on_source(file_ledger),
        "adopted_silver": on_source(adopted_silver),
        "csv_seeds": on_source(csv_seeds),
        "published_table": on_source(published_table),
        "quarantine": on_source(quarantined),
        "archive_members": on_source(archive_members),
        "archive_ranges": on_source(archives_by_ranges),
        "partition_inventory": on_source(inventory),
        "bronze_state": on_source(bronze_state),
        "bronze_two_feeds": on_source(bronze_two_feeds),
        "bronze_replay": on_source(bronze_replay),
        "bronze_errors": on_source(bronze_errors),
        "bronze_interrupted": on_source(bronze_interrupted),
        "incremental_build": on_source(incremental_build),
        "incremental_folders": on_source(incremental_folders),
        "silver_rerun": on_source(silver_rerun),
        "streamed_state": on_source(streamed_state),
        "streamed_changes": on_source(streamed_changes),
        "silver_round_trip": on_source(silver_round_trip),
    }
