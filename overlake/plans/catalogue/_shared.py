from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from overlake.functions import named, ratio_sql

# The league the queries look at and the innings without super overs.
LEAGUE = "%indian premier league%"
REGULAR = (1, 2)


def up(name: str) -> Column:
    return F.asc_nulls_last(name)


def down(name: str) -> Column:
    return F.desc_nulls_last(name)


def in_league(league: str) -> Column:
    return F.col("event_name").ilike(league)


def regular() -> Column:
    return F.expr(f"innings_number IN {REGULAR}")


def league_rows(t, rows: DataFrame, league: str, season: str | None = None) -> DataFrame:
    """Balls, overs or innings of the league, super overs left out.

    Neither the league's name nor the season is a folder, so the folders that hold such
    matches are looked up and named: the scan opens no others.
    """
    out = rows.filter(in_league(league) & regular())
    if season is not None:
        out = out.filter(F.col("season") == season)
    folders = t.folders(league, season)
    return out if folders is None else out.filter(_in_folders(folders))


def _in_folders(folders: Sequence[tuple[str, int | None]]) -> Column:
    """A condition on the partition columns alone."""
    years: dict[str, list[int | None]] = {}
    for match_type, year in folders:
        years.setdefault(match_type, []).append(year)
    out = F.lit(False)
    for match_type, found in sorted(years.items(), key=lambda f: str(f[0])):
        own = F.col("year").isin(*sorted(y for y in found if y is not None))
        if None in found:
            own = own | F.col("year").isNull()
        out = out | (F.col("match_type").eqNullSafe(F.lit(match_type)) & own)
    return out


def league_matches(
    t, league: str, names: Sequence[str] | None = None, season: str | None = None
) -> DataFrame:
    m = t.match_results.filter(in_league(league))
    if season is not None:
        m = m.filter(F.col("season") == season)
    if names is not None:
        m = m.filter(F.col("team_1").isin(*names) | F.col("team_2").isin(*names))
    return m


def league_innings(t, innings: DataFrame, league: str, season: str | None = None) -> DataFrame:
    """Batting or bowling innings of the league, super overs left out."""
    return league_rows(t, innings, league, season).filter("NOT super_over")


def opponent(names: Sequence[str]) -> Column:
    return F.when(F.col("team_1").isin(*names), F.col("team_2")).otherwise(F.col("team_1"))


def won(names: Sequence[str]) -> Column:
    return F.col("outcome_winner").isin(*names)


def lost(names: Sequence[str]) -> Column:
    return F.col("has_result") & ~won(names)


def with_outcome(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Adds ``won`` and ``lost`` as seen by the named team."""
    return rows.withColumns({"won": won(names), "lost": lost(names)})


_WINS = "sum(CASE WHEN won THEN 1 ELSE 0 END)"


RECORD = {
    "played": "count(*)",
    "won": _WINS,
    "lost": "sum(CASE WHEN lost THEN 1 ELSE 0 END)",
    "tied": "sum(cast(is_tie AS int))",
    "nr": "sum(cast(is_no_result AS int))",
    "win_pct": ratio_sql(_WINS, "sum(cast(has_result AS int))", 1, times=100),
}


def record() -> list[Column]:
    """played, won, lost, tied, nr, win_pct over rows of :func:`with_outcome`."""
    return named(**RECORD)


def result_code(names: Sequence[str]) -> Column:
    """W, NR, T, and L for all the rest, a draw included."""
    rest = F.expr("CASE WHEN is_no_result THEN 'NR' WHEN is_tie THEN 'T' ELSE 'L' END")
    return F.when(won(names), "W").otherwise(rest)
