"""Keyed upserts, insert-if-absent and load audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statspark.operators.transform import fixed_columns
from statspark.schemas import FACT
from statspark.sources.landed import day


def last_wins(updates: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """One row per key: the last in ``order``; without an order, keys that occur twice are an error when they are read."""
    if order is None:
        once = updates.groupBy(*keys).agg(F.first(F.struct(*updates.columns)).alias("row"), F.count(F.lit(1)).alias("n"))
        safe = F.when(F.col("n") == 1, F.col("row")).otherwise(F.raise_error(F.lit("keys occur twice and no order is given")))
        return once.select(safe.alias("row")).select("row.*")
    rest = [c for c in updates.columns if c not in (*keys, order)]
    best = updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("row"))
    return best.select(*keys, "row.*")


def upsert(
    existing: DataFrame, updates: DataFrame, keys: list[str], order: str | None = None, keep_old: tuple[str, ...] = ()
) -> DataFrame:
    """Rows of ``updates`` replace those of equal keys, nulls included; columns in ``keep_old`` keep an old row's value.

    Both sides meet in one window by key, so each is read and shuffled once, and rows pass through it as they are. Of updates
    with equal keys the last in ``order`` counts; without an order they are an error. Keys are not null and occur once in
    ``existing``.
    """
    given = [c for c in updates.columns if c != order]
    columns = [*existing.columns, *(c for c in given if c not in existing.columns)]
    place = F.lit(None).cast("long") if order is None else F.col(order)
    new = updates.select(*given, F.lit(True).alias("_new"), place.alias("_order"))
    both = existing.withColumn("_new", F.lit(False)).unionByName(new, allowMissingColumns=True)
    best_first = Window.partitionBy(*keys).orderBy(F.desc("_new"), F.desc_nulls_last("_order"))
    found = {"_place": F.row_number().over(best_first), "_next": F.lead("_new").over(best_first)}
    if keep_old:
        whole = best_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        found["_old"] = F.first(F.when(~F.col("_new"), F.struct(*keep_old)), ignorenulls=True).over(whole)
    best = both.withColumns(found).where(F.col("_place") == 1)
    if order is None:
        twice = F.raise_error(F.lit("keys occur twice and no order is given")).cast("boolean")
        best = best.where(F.when(F.col("_new") & F.coalesce("_next", F.lit(False)), twice).otherwise(True))
    value = {c: F.when(F.col("_old").isNotNull(), F.col(f"_old.{c}")).otherwise(F.col(c)) for c in keep_old}
    return best.select(*(value.get(c, F.col(c)).alias(c) for c in columns))


def insert_absent(existing: DataFrame, offered: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows, and offered ones whose keys are new."""
    new = offered.dropDuplicates(keys).join(existing, keys, "left_anti")
    return existing.unionByName(new, allowMissingColumns=True)


def team_pairs(games: DataFrame, order: str) -> DataFrame:
    """team_id, name, ord: distinct pairs of home and away teams; a pair's place is where it is first seen."""
    home = games.select(F.col("home_team_id").alias("team_id"), F.col("home_team").alias("name"), (2 * F.col(order)).alias("ord"))
    away = games.select(F.col("away_team_id").alias("team_id"), F.col("away_team").alias("name"), (2 * F.col(order) + 1).alias("ord"))
    return home.union(away).groupBy("team_id", "name").agg(F.min("ord").alias("ord"))


def upsert_teams(teams: DataFrame, games: DataFrame, order: str = "game_pk") -> DataFrame:
    """A team renamed within a batch ends with the name that comes last; abbreviations are left alone."""
    return upsert(teams, team_pairs(games, order), ["team_id"], "ord", tuple(c for c in teams.columns if c == "abbreviation"))


def insert_players(players: DataFrame, rows: DataFrame) -> DataFrame:
    """New player ids get the name 'Unknown'; known ones stay as they are."""
    offered = rows.select("player_id").where("player_id is not null").distinct().withColumn("full_name", F.lit("Unknown"))
    return insert_absent(players, offered, ["player_id"])


def upsert_games(stored: DataFrame, games: DataFrame, order: str | None = None) -> DataFrame:
    """Dates are normalised and an empty winner is null."""
    new = games.withColumn("game_date", day(F.col("game_date").cast("string"))).withColumn(
        "winning_team", F.nullif("winning_team", F.lit(""))
    )
    kept = [c for c in new.columns if c in stored.columns or c == order]
    return upsert(stored, new.select(*kept), ["game_pk"], order)


def upsert_fact(fact: DataFrame, rows: DataFrame) -> DataFrame:
    """The fact table's columns, whatever else ``rows`` have or lack."""
    more = [c for c in fact.columns if c not in FACT and c in rows.columns]
    return upsert(fact, fixed_columns(rows, [*FACT, *more]), ["game_pk", "player_id"])


def replace_dates(stored: DataFrame, rows: DataFrame, dates: list, column: str) -> DataFrame:
    """Rows of some dates, which are all there are of them, in place of what was stored; no shuffle."""
    return stored.where(~F.col(column).isin(dates)).unionByName(rows, allowMissingColumns=True)


def upsert_rolling(rolling: DataFrame, rows: DataFrame) -> DataFrame:
    return upsert(rolling, rows, ["player_id", "as_of_date", "window_days"])


def upsert_predictions(stored: DataFrame, rows: DataFrame) -> DataFrame:
    return upsert(stored, rows, ["game_pk", "player_id"], keep_old=("created_at",))


def upsert_constants(stored: DataFrame, rows: DataFrame) -> DataFrame:
    return upsert(stored, rows, ["season"])


def load_counts(games: DataFrame, fact_rows: DataFrame) -> DataFrame:
    """One row: teams, players, games, fact_rows that a load offers."""
    def counted(name: str, of: DataFrame, n) -> DataFrame:
        return of.agg(n.alias("n")).select(F.lit(name).alias("target"), "n")

    rows = F.count(F.lit(1))
    parts = counted("teams", team_pairs(games, "game_pk"), rows).union(counted("games", games, rows))
    parts = parts.union(counted("players", fact_rows, F.count_distinct("player_id"))).union(counted("fact_rows", fact_rows, rows))
    return parts.agg(*(F.max(F.when(F.col("target") == t, F.col("n"))).alias(t) for t in ("teams", "players", "games", "fact_rows")))


def audit_row(spark: SparkSession, name: str, loaded_at: str, load_date: str | None = None) -> DataFrame:
    """A row of the load audit, for appending."""
    return spark.range(1).select(
        F.lit(name).alias("pipeline_name"), F.lit(load_date).cast("date").alias("load_date"), F.lit(loaded_at).cast("timestamp").alias("loaded_at")
    )
