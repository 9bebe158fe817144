from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def publish(
    df: DataFrame,
    layer: str,
    name: str,
    as_view: bool = False,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Expose a model as ``<layer>.<name>``, or as a session view ``<layer>_<name>``.

    There are no indexes; ``partition_by`` and ``sort_by`` give directory pruning and
    tight column statistics instead.
    """
    spark = df.sparkSession
    if as_view:
        df.createOrReplaceTempView(f"{layer}_{name}")
        return spark.table(f"{layer}_{name}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(f"{layer}.{name}")
    return spark.table(f"{layer}.{name}")


# Model names by layer, the attribute that holds each, and its layout.
MODELS = {
    "staging": {
        "stg_matches": "stg_matches",
        "stg_innings": "stg_innings",
        "stg_deliveries": "stg_deliveries",
        "stg_players": "stg_players",
    },
    "intermediate": {
        "int_ball_by_ball": "ball_by_ball",
        "int_batting_by_innings": "batting_innings",
        "int_bowling_by_innings": "bowling_innings",
    },
    "marts": {
        "fct_deliveries": "fct_deliveries",
        "fct_match_results": "match_results",
        "dim_players": "dim_players",
        "mart_batting_career": "batting_career",
        "mart_bowling_career": "bowling_career",
    },
}
SEEDS = {
    "seed_team_name_map": "team_map",
    "seed_venue_map": "venue_map",
    "seed_excluded_matches": "excluded",
}


def register_views(tables) -> list[str]:
    """Every model and seed as a session view under its plain name, for queries in SQL."""
    names = []
    for models in MODELS.values():
        for name, attribute in models.items():
            getattr(tables, attribute).createOrReplaceTempView(name)
            names.append(name)
    for name, attribute in SEEDS.items():
        getattr(tables.seeds, attribute).createOrReplaceTempView(name)
        names.append(name)
    return names


def publish_models(tables, prefix: str = "main_") -> list[str]:
    """Every model as a table ``<prefix><layer>.<name>``; the ball fact in the marts is
    a view over the intermediate table, stored once."""
    layout = ("match_type", "year")
    done = []
    for layer, models in MODELS.items():
        for name, attribute in models.items():
            target = f"{prefix}{layer}"
            if name == "fct_deliveries":
                source = f"`{prefix}intermediate`.int_ball_by_ball"
                spark = tables.ball_by_ball.sparkSession
                spark.sql(f"CREATE DATABASE IF NOT EXISTS `{target}`")
                spark.sql(f"CREATE OR REPLACE VIEW `{target}`.{name} AS SELECT * FROM {source}")
            elif layer == "intermediate":
                sort = ("match_id", "innings_number", "over_number", "ball_in_over")
                if name != "int_ball_by_ball":
                    sort = ("player_name", "match_id")
                publish(getattr(tables, attribute), target, name, False, layout, sort)
            else:
                publish(getattr(tables, attribute), target, name)
            done.append(f"{target}.{name}")
    return done
