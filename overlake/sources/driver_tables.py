"""Match tables derived from a star schema of orders and line items.

Fifty consecutive orders make a match, an order is an over and a line item a ball, so
every row of both tables takes part.  Line items that repeat (order, line) are
repeated records of the same ball, which staging has to resolve.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from overlake.plans.tables import Seeds, Silver
from overlake.schemas import EXCLUDED_MATCHES, SILVER, TEAM_NAMES, VENUE_NAMES
from overlake.sources.files import Folder
from overlake.sources.seeds import seed_frame

ORDERS_PER_MATCH = 50

TEAM_MAP = [("NATION_6", "NATION_16"), ("NATION_7", "NATION_17")]
VENUE_MAP = [("Venue_7", "Ground_7", "Town_7"), ("Venue_8", "Ground_7", "Town_7")]
EXCLUDED = [("3", "not counted"), ("17", "not counted")]


def seeds(spark: SparkSession) -> Seeds:
    return Seeds(
        seed_frame(spark, TEAM_MAP, TEAM_NAMES),
        seed_frame(spark, VENUE_MAP, VENUE_NAMES),
        seed_frame(spark, EXCLUDED, EXCLUDED_MATCHES),
    )


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _exprs(df: DataFrame, **columns: str) -> DataFrame:
    return df.withColumns({n: F.expr(e) for n, e in columns.items()})


def _placed(df: DataFrame, key: str) -> DataFrame:
    """Match number, position of the over, teams and partition keys, from the key."""
    numbered = _exprs(df, mn=f"{key} div {ORDERS_PER_MATCH}", blk=f"{key} % {ORDERS_PER_MATCH}")
    return _exprs(
        numbered,
        match_id="cast(mn as string)",
        t1="mn % 8",
        t2="(mn % 8 + 1 + (mn div 8) % 7) % 8",
        match_type="element_at(array('t20', 'odi', 'test', 'it20', 'odm'), cast(mn % 5 + 1 as int))",
        year="cast(2008 + mn % 7 as string)",
        # Two innings of 24 overs, then two of one over.
        innings_number="cast(case when blk < 24 then 1 when blk < 48 then 2 else blk - 45 end as int)",
        over_number="cast(case when blk < 48 then blk % 24 else 0 end as int)",
        # Matches come in one to three revisions; this is the newest.
        revision="cast(mn % 3 + 1 as int)",
    )


def _silver(df: DataFrame, table: str) -> DataFrame:
    """To the silver columns; those the source has nothing for are NULL."""
    present = set(df.columns)
    return df.selectExpr(
        *[
            f"cast({f.name if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in SILVER[table]
        ]
    )


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _placed(_table(spark, sf_dir, "orders"), "o_orderkey")
    keys = ["mn", "match_id", "match_type", "year", "t1", "t2", "revision"]
    sums = orders.groupBy(*keys).agg(
        F.sum("o_custkey").alias("s"),
        F.expr("sum(datediff(o_orderdate, date'1995-01-01'))").alias("d"),
        F.expr("count_if(o_orderstatus = 'F')").alias("f"),
    )
    decided = _exprs(sums, w="(f * 3 + s) % 8")
    return _silver(
        _exprs(
            decided,
            match_date="cast(date_add(make_date(cast(year as int), 1, 1), cast(d % 365 as int)) as string)",
            season="year",
            venue="concat('Venue_', s % 9)",
            city="concat('City_', s % 9)",
            gender="'male'",
            team_type="'international'",
            team_1="concat('NATION_', t1)",
            team_2="concat('NATION_', t2)",
            toss_winner="concat('NATION_', if(d % 2 = 0, t1, t2))",
            toss_decision="if(f % 2 = 0, 'bat', 'field')",
            # Some ties have a winner all the same.
            outcome_winner="case when w < 3 or w = 6 and s % 3 = 0 then concat('NATION_', t1) when w < 6 then concat('NATION_', t2) end",
            outcome_method="case when w < 6 and s % 5 = 0 then 'D/L' end",
            outcome_result="case when w = 6 then 'tie' when w = 7 then if(s % 2 = 0, 'no result', 'draw') end",
            outcome_eliminator="case when w = 6 then concat('NATION_', t1) end",
            outcome_by_runs="case when w < 3 then s % 90 + 1 end",
            outcome_by_wickets="case when w >= 3 and w < 6 then s % 10 + 1 end",
            player_of_match="case when w < 6 then concat('NATION_', if(w < 3, t1, t2), '_P', s % 11) end",
            event_name="if(d % 4 < 3, 'Indian Premier League', 'Other Cup')",
            event_stage="case s % 17 when 0 then 'Final' when 1 then 'Qualifier' end",
            balls_per_over="6",
            overs="24",
        ),
        "matches",
    )


def innings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _placed(_table(spark, sf_dir, "orders"), "o_orderkey")
    keys = ["match_id", "match_type", "year", "innings_number", "mn", "t1", "t2", "revision"]
    sums = orders.groupBy(*keys).agg(F.sum("o_custkey").alias("s"))
    return _silver(
        _exprs(
            sums,
            batting_team="concat('NATION_', if(innings_number % 2 = 1, t1, t2))",
            declared="case when s % 7 = 0 then true end",
            super_over="case when innings_number > 2 and mn % 4 <> 0 then true end",
            target_runs="case when innings_number = 2 then s % 200 end",
            target_overs="case when innings_number = 2 then 20.0 end",
        ),
        "innings",
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _placed(_table(spark, sf_dir, "lineitem"), "l_orderkey")
    at_crease = _exprs(
        items,
        ball_in_over="l_linenumber",
        bat="if(innings_number % 2 = 1, t1, t2)",
        bowl="if(innings_number % 2 = 1, t2, t1)",
        # Three players face, up to three more only stand at the other end; in some matches one
        # faces nearly all balls, and one bowls most of them.
        i="(if(mn % 6 = 1 and over_number % 8 <> 7, 0, l_partkey % 3) + mn) % 11",
        quiet="(mn + over_number) % 7 = 0",
        kind="l_suppkey % 8",
    )
    extras = _exprs(
        at_crease,
        batter="concat('NATION_', bat, '_P', i)",
        non_striker="concat('NATION_', bat, '_P', (i + 1 + l_linenumber % 3) % 11)",
        bowler="concat('NATION_', bowl, '_P', (if(mn % 6 = 2 and over_number % 8 <> 7, 0, over_number * 3) + mn) % 5 + 6)",
        extras_wides="case when quiet or l_tax < 0.075 then 0 when l_suppkey % 10 = 0 then 5 else 1 end",
        extras_noballs="if(not quiet and l_tax < 0.005 and l_discount < 0.015, 1, 0)",
        extras_byes="if(not quiet and l_discount > 0.085 and l_discount < 0.095 and l_suppkey % 5 = 0, 1, 0)",
        extras_legbyes="if(not quiet and l_discount > 0.095, 1, 0)",
        extras_penalty="0",
        is_wicket="l_returnflag = 'R' and (l_partkey % 4 = 1 or mn % 6 = 2 and l_partkey % 4 = 3) and not (mn % 12 = 1 and over_number % 8 <> 7)",
    )
    scored = _exprs(
        extras,
        runs_batter="if(quiet or extras_wides > 0, 0, cast(l_quantity as int) % 7)",
        runs_extras="extras_wides + extras_noballs + extras_byes + extras_legbyes",
        wicket_count="if(is_wicket, if(l_suppkey % 50 = 0, 2, 1), 0)",
        wicket_kind="if(is_wicket, element_at(array('run out', 'caught', 'bowled', 'stumped', 'retired hurt', "
        "'caught and bowled', 'lbw', 'obstructing the field'), cast(kind + 1 as int)), null)",
        wicket_player_out="if(is_wicket, if(kind = 0 and l_linenumber % 2 = 0, non_striker, batter), null)",
        wicket_fielders_arr="case when not is_wicket then null "
        "when kind = 0 then array(concat('NATION_', bowl, '_P', cast(l_quantity as int) % 11), concat('NATION_', bowl, '_P', l_partkey % 11)) "
        "when kind = 1 then array(concat('NATION_', bowl, '_P', l_partkey % 11)) "
        "when kind = 3 then array(concat('NATION_', bowl, '_P', l_partkey % 3 + 8)) end",
        review_by="if(l_suppkey % 29 = 0, concat('NATION_', bat), null)",
        review_decision="if(l_suppkey % 29 = 0, if(l_partkey % 2 = 0, 'upheld', 'struck down'), null)",
    )
    return _silver(
        _exprs(
            scored,
            runs_total="runs_batter + runs_extras",
            runs_non_boundary="case when runs_batter in (4, 6) and l_suppkey % 13 = 0 then true end",
            wicket_fielders="array_join(wicket_fielders_arr, ', ')",
        ),
        "deliveries",
    )


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _placed(_table(spark, sf_dir, "orders"), "o_orderkey")
    return _silver(
        _exprs(
            orders,
            team="concat('NATION_', if(blk < 25, t1, t2))",
            player_name="concat(team, '_P', o_custkey % 11)",
            cricsheet_id="if(o_custkey % 6 = 0, null, concat(md5(player_name), '-', o_custkey % 4))",
        ),
        "players",
    )


# What an older revision said, as SQL by column: all of it is wrong.
_STALE = {
    "matches": {"venue": "'Stale'", "season": "'1900'", "outcome_winner": "'Stale'", "event_name": "'Stale'"},
    "innings": {"batting_team": "'Stale'", "super_over": "true"},
    # Other figures for the same balls, and as many balls that the correction removed.
    "deliveries": {"runs_batter": "runs_batter + 100", "runs_total": "runs_total + 100", "batter": "'Stale'"},
    "players": {"player_name": "concat('Stale ', player_name)"},
}


def _with_history(rows: DataFrame, table: str) -> DataFrame:
    """The rows, and those of an older revision of every match that has one."""
    stale = _exprs(rows.filter("revision > 1"), revision="revision - 1", **_STALE[table])
    out = rows.unionByName(stale)
    if table == "deliveries":
        out = out.unionByName(_exprs(stale, ball_in_over="ball_in_over + 50"))
    if table == "innings":
        # The same innings recorded twice; the other record sorts behind.
        out = out.unionByName(_exprs(rows.filter("innings_number = 1"), batting_team="concat('~', batting_team)"))
    return out


def silver(spark: SparkSession, sf_dir: str) -> Silver:
    tables = {"matches": matches, "innings": innings, "deliveries": deliveries, "players": players}
    return Silver(**{name: _with_history(make(spark, sf_dir), name) for name, make in tables.items()})


# documents and archives --------------------------------------------------------

_TEAMS = "array(concat('NATION_', o_custkey % 8), concat('NATION_', (o_custkey + 1) % 8))"

_DELIVERY = """
named_struct(
  'batter', concat('P', x % 11), 'bowler', concat('Q', x % 5), 'non_striker', concat('P', (x + 1) % 11),
  'runs', named_struct('batter', x % 7, 'extras', if(x % 4 = 0, 1, 0), 'total', x % 7 + if(x % 4 = 0, 1, 0),
                       'non_boundary', if(x % 13 = 0, true, null)),
  'extras', if(x % 4 = 0, named_struct('wides', 1), null),
  'wickets', case when x % 12 = 0 then array(
                 named_struct('kind', 'caught', 'player_out', concat('P', x % 11),
                              'fielders', array(named_struct('name', 'Q1'), named_struct('name', ''), named_struct('name', 'Q2'))),
                 named_struct('kind', 'run out', 'player_out', concat('P', (x + 1) % 11),
                              'fielders', cast(null as array<struct<name: string>>)))
               when x % 6 = 0 then array(
                 named_struct('kind', 'bowled', 'player_out', concat('P', x % 11),
                              'fielders', cast(null as array<struct<name: string>>))) end,
  'review', if(x % 9 = 0, named_struct('by', 'NATION_1', 'decision', 'upheld', 'umpires_call', x % 2 = 0), null))
"""


def _spread(rows: DataFrame, key: str) -> DataFrame:
    """Rows over as many tasks as the session's shuffles have; naming the number keeps
    them apart although they are small, for work that is heavy per row."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, key)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested match document per order as (match_id, name, content); every leaf
    follows from the order.  Optional parts are absent in some documents.

    Building a document costs far more than moving an order, so the narrow rows are
    spread first."""
    orders = _spread(_table(spark, sf_dir, "orders"), "o_orderkey")
    # x numbers a ball by order, innings, over and ball, without any grouping.
    deliveries = f"transform(sequence(1, 2), b -> transform(array(o_orderkey + n * 7 + v * 3 + b), x -> {_DELIVERY})[0])"
    overs = f"transform(sequence(0L, o_orderkey % 2), v -> named_struct('over', v, 'deliveries', {deliveries}))"
    docs = _exprs(
        orders,
        meta="if(o_custkey % 3 = 0, null, named_struct('revision', o_custkey % 3))",
        info=f"""named_struct(
            'match_type', if(o_custkey % 7 = 0, null, 'ODI'),
            'season', year(o_orderdate),
            'venue', concat('Venue_', o_custkey % 9),
            'dates', if(o_custkey % 11 = 0, null, array(date_format(o_orderdate, 'yyyy-MM-dd'))),
            'teams', {_TEAMS},
            'toss', named_struct('winner', concat('NATION_', o_custkey % 8), 'decision', 'bat'),
            'outcome', if(o_orderstatus = 'P', named_struct('result', 'draw', 'winner', null, 'by', null),
                          named_struct('result', null, 'winner', concat('NATION_', o_custkey % 8),
                                       'by', named_struct('runs', o_custkey % 90))),
            'player_of_match', case o_custkey % 3 when 0 then array('P1', 'P2') when 1 then array('P3') else cast(array() as array<string>) end,
            'event', named_struct('name', 'Cup', 'match_number', if(o_custkey % 5 = 0, 'x', cast(o_custkey % 5 as string))),
            'balls_per_over', 6,
            'overs', if(o_custkey % 2 = 0, '20', '12.7'),
            'players', map(element_at({_TEAMS}, 1), array('P1', 'P2', 'P3'), element_at({_TEAMS}, 2), array('Q1')),
            'registry', named_struct('people', map('P1', 'id-p1', 'Q1', 'id-q1')))""",
        innings=f"""transform(sequence(1L, o_custkey % 3 + 1), n -> named_struct(
            'team', concat('NATION_', (o_custkey + n) % 8),
            'declared', if(n = 2, true, null),
            'super_over', if(n = 3, true, null),
            'target', if(n = 2, named_struct('runs', o_custkey % 300, 'overs', 19.5D), null),
            'overs', {overs}))""",
    )
    return docs.select(
        F.col("o_orderkey").cast("string").alias("match_id"),
        F.expr("concat('bronze/', o_orderkey, '.json')").alias("name"),
        F.to_json(F.struct("meta", "info", "innings")).alias("content"),
        "o_orderstatus",
        "o_orderpriority",
    )


ORDERS_PER_FILE = 500


def raw_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Documents as a tree of files ``match_type=.../year=.../*.json``, one document each:
    five hundred consecutive orders are a match, an order an innings of it."""
    orders = _table(spark, sf_dir, "orders").withColumn("g", F.expr(f"o_orderkey div {ORDERS_PER_FILE}"))
    grouped = orders.groupBy("g").agg(F.expr("array_sort(collect_list(struct(o_orderkey, o_custkey)))").alias("own"))
    docs = _exprs(
        grouped,
        match_type="element_at(array('T20', 'ODI', 'Test'), cast(g % 3 + 1 as int))",
        year="cast(2008 + g % 7 as string)",
        meta="named_struct('revision', 1 + g % 3)",
        info="named_struct('match_type', match_type, 'dates', array(concat(year, '-01-01')), 'teams', array('A', 'B'))",
        innings="transform(own, x -> named_struct('team', concat('NATION_', x.o_custkey % 8), 'declared', x.o_custkey % 5 = 0))",
    )
    (
        docs.select(F.lower("match_type").alias("match_type"), "year", "meta", "info", "innings")
        .write.partitionBy("match_type", "year")
        .option("maxRecordsPerFile", 1)
        .json(path)
    )


def date_back(spark: SparkSession, folder: str, to: int = 946_684_800_000) -> None:
    """Gives the files two folders below an old time, as copies of old files have."""
    files = Folder(spark, folder)
    for path in files.matching("*/*.json"):
        files.date(path, to)


def _zipped(batches):
    import io
    import zipfile

    import pandas as pd

    for batch in batches:
        docs = list(batch.itertuples(index=False))
        for start in range(0, len(docs), 500):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as zf:
                zf.writestr("__index.json", "{}")
                zf.writestr("README.txt", "not a document")
                for d in docs[start : start + 500]:
                    zf.writestr(f"matches/{d.key}.json", d.content)
                entries = zf.infolist()
            blob = bytearray(buffer.getvalue())
            by_name = {e.filename: e for e in entries}
            for d in docs[start : start + 500]:
                entry = by_name[f"matches/{d.key}.json"]
                first = entry.header_offset + 30 + len(entry.filename)
                if d.harm == "damaged":
                    # The first block of the packed text gets a type that does not exist.
                    blob[first] |= 6
                elif d.harm == "encrypted":
                    # The flag in the directory at the end of the archive.
                    at = blob.rindex(entry.filename.encode()) - 46
                    blob[at + 8] |= 1
            yield pd.DataFrame([(f"archive-of-{docs[start].key}", bytes(blob))], columns=["path", "content"])
        broken = batch.loc[batch["harm"] == "no archive", "key"].tolist()
        yield pd.DataFrame([(f"archive-{k}", b"not an archive") for k in broken], columns=["path", "content"])


def archives(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """Zip archives of the derived documents, as (path, content).

    Members of low priority are damaged or encrypted, by their order; one order in a hundred
    also brings a file that is no archive.
    """
    harm = """CASE WHEN cast(match_id AS bigint) % 100 = 7 THEN 'no archive' WHEN o_orderpriority <> '5-LOW' THEN 'none'
        WHEN cast(match_id AS bigint) % 2 = 0 THEN 'damaged' ELSE 'encrypted' END"""
    rows = docs.select(F.col("match_id").alias("key"), "content", F.expr(harm).alias("harm"))
    return _spread(rows, "key").mapInPandas(_zipped, "path string, content binary")


def archive_files(spark: SparkSession, sf_dir: str, docs: DataFrame, folder: str) -> None:
    """The same archives as files ``<name>.zip``, each written by the task that made it."""
    spark.createDataFrame([], "x int").write.parquet(folder)

    def write(batches):
        from pyarrow import fs

        files = fs.LocalFileSystem()
        for batch in batches:
            for name, blob in zip(batch["path"], batch["content"], strict=True):
                with files.open_output_stream(f"{folder.removeprefix('file:')}/{name}.zip") as out:
                    out.write(bytes(blob))
            yield batch[["path"]]

    archives(spark, sf_dir, docs).mapInPandas(write, "path string").write.format("noop").mode("overwrite").save()
