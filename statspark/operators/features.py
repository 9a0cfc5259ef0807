"""Wide features, training sets and rosters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statspark.operators.rolling import games_of
from statspark.schemas import BATTER, PITCHER, WINDOWS, feature_names


def wide(rolling: DataFrame, columns: list[str]) -> DataFrame:
    """One row per player and date with <column>_<window>; one shuffle, a window without a row gives nulls.

    Rows that are wide already (``rolling.wide_all_dates``) stay as they are.
    """
    if "window_days" not in rolling.columns:
        return rolling.select("player_id", "as_of_date", *feature_names(columns))
    value = [F.max(F.when(F.col("window_days") == n, F.col(c))).alias(f"{c}_{n}") for n in WINDOWS for c in columns]
    known = rolling.where(F.col("window_days").isin(list(WINDOWS)))
    return known.groupBy("player_id", "as_of_date").agg(*value)


def _between(rolling: DataFrame, first: str, last: str) -> DataFrame:
    return rolling.where(F.col("as_of_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def batter_features(rolling: DataFrame, first: str, last: str | None = None) -> DataFrame:
    """Features of one date, or of a closed range."""
    return wide(_between(rolling, first, last or first), BATTER)


def pitcher_features(rolling: DataFrame, first: str, last: str | None = None) -> DataFrame:
    return wide(_between(rolling, first, last or first), PITCHER)


def latest_before(targets: DataFrame, found: DataFrame, at: str = "game_date", of: str = "as_of_date", key: str = "player_id") -> DataFrame:
    """Targets with the row of ``found`` that has the same key and the latest date strictly before theirs, if there is one.

    An as-of join by union: both sides meet in one shuffle and one sort by key and date, and each target takes the last
    row of ``found`` above it. Rows of ``found`` are told apart by key and date.
    """
    rest = [c for c in found.columns if c != key]
    empty = found.select(F.struct(*rest).alias("f")).schema["f"].dataType
    own = targets.select(F.col(key), F.col(at).alias("at"), F.lit(0).alias("kind"), F.struct(*targets.columns).alias("target"), F.lit(None).cast(empty).alias("found"))
    theirs = found.select(F.col(key), F.col(of).alias("at"), F.lit(1).alias("kind"), F.lit(None).cast(own.schema["target"].dataType).alias("target"), F.struct(*rest).alias("found"))
    above = Window.partitionBy(key).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, -1)
    met = own.unionByName(theirs).withColumn("found", F.last("found", ignorenulls=True).over(above))
    return met.where("target is not null and found is not null").select("target.*", "found.*")


def _targets(fact: DataFrame, games: DataFrame, first: str, last: str, label: str, activity: str) -> DataFrame:
    days = games.where(F.col("game_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    rows = games_of(fact, days).where((F.coalesce(F.col(activity), F.lit(0)) > 0) & F.col(label).isNotNull())
    return rows.select("player_id", "game_date", F.col(label).alias("label"))


def _training(
    fact: DataFrame, games: DataFrame, rolling: DataFrame, first: str, last: str, label: str, activity: str, columns: list[str], latest: bool
) -> DataFrame:
    targets = _targets(fact, games, first, last, label, activity)
    end = F.date_sub(F.lit(last).cast("date"), 1)
    if latest:
        return latest_before(targets, wide(rolling.where(F.col("as_of_date") <= end), columns))
    targets = targets.withColumn("as_of_date", F.date_sub("game_date", 1))
    # The join's dates lie one day before the targets', so the range reaches the scan of the features.
    before = F.date_sub(F.lit(first).cast("date"), 1)
    features = wide(rolling.where(F.col("as_of_date").between(before, end)), columns)
    return targets.join(features, ["player_id", "as_of_date"]).drop("as_of_date")


def batter_training(fact: DataFrame, games: DataFrame, rolling: DataFrame, first: str, last: str, latest: bool = False) -> DataFrame:
    """player_id, game_date, label (wOBA of a game) and the batter's features of exactly the day before.

    ``latest``: of the latest date before the game instead, given as as_of_date, however long ago it is.
    """
    return _training(fact, games, rolling, first, last, "bat_woba", "bat_plate_appearances", BATTER, latest)


def pitcher_training(fact: DataFrame, games: DataFrame, rolling: DataFrame, first: str, last: str, latest: bool = False) -> DataFrame:
    """The same with FIP for games with innings pitched."""
    return _training(fact, games, rolling, first, last, "pit_fip", "pit_innings_pitched", PITCHER, latest)


def training_of_both(fact: DataFrame, games: DataFrame, rolling: DataFrame, first: str, last: str) -> DataFrame:
    """player_id, game_date, label_batter, label_pitcher and the features of both models of exactly the day before.

    The labels are those of ``batter_training`` and ``pitcher_training``, null in the rows that the one or the other lacks:
    what both need is put side by side once, in one shuffle.
    """
    day = lambda x: F.lit(x).cast("date")
    counts = lambda label, activity: F.when(F.coalesce(F.col(activity), F.lit(0)) > 0, F.col(label))
    played = games_of(fact, games.where(F.col("game_date").between(day(first), day(last))))
    targets = played.select(
        "player_id",
        "game_date",
        F.date_sub("game_date", 1).alias("as_of_date"),
        counts("bat_woba", "bat_plate_appearances").alias("label_batter"),
        counts("pit_fip", "pit_innings_pitched").alias("label_pitcher"),
    ).where("label_batter is not null or label_pitcher is not null")
    before = F.col("as_of_date").between(F.date_sub(day(first), 1), F.date_sub(day(last), 1))
    found = wide(rolling.where(before), list(dict.fromkeys([*BATTER, *PITCHER])))
    return targets.join(found, ["player_id", "as_of_date"]).drop("as_of_date")


def training_range(games: DataFrame, fact: DataFrame, today: str, days: int = 730) -> DataFrame:
    """One row: first and last game date with facts since ``days`` before today; nulls if there are none."""
    since = games.where(F.col("game_date") >= F.date_sub(F.lit(today).cast("date"), days))
    played = since.join(fact.select("game_pk"), "game_pk", "left_semi")
    return played.agg(F.min("game_date").alias("min_date"), F.max("game_date").alias("max_date"))


def recent_games(games: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Games in the closed range of ``days`` before a date."""
    return games.where(F.col("game_date").between(F.date_sub(as_of, days), as_of))


def roster(schedule: DataFrame, fact: DataFrame, games: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """game_pk, player_id: players of both teams with a game in the closed range of ``days`` before a date.

    Teams are exploded, so the join is by equality and not by a choice of two columns. Games and players carry the sets of their
    teams, and a pair is made by the first team that both have: pairs, of which there may be far more than rows, need no distinct.
    """
    teams = schedule.select("game_pk", F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"))
    teams = teams.groupBy("game_pk").agg(F.collect_set("team_id").alias("teams")).select("*", F.explode("teams").alias("team_id"))
    recent = recent_games(games, as_of, days).select(F.col("game_pk").alias("_game"))
    seen = fact.join(recent, F.col("game_pk") == F.col("_game"), "left_semi")
    seen = seen.groupBy("player_id").agg(F.collect_set("team_id").alias("played")).select("*", F.explode("played").alias("team_id"))
    first = F.filter("teams", lambda t: F.array_contains("played", t))[0]
    return teams.join(seen, "team_id").where(first == F.col("team_id")).select("game_pk", "player_id")


def model_columns(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Keys and a model's features in its order; missing ones are null, others are dropped."""
    keys = [c for c in ("player_id", "as_of_date") if c in rows.columns]
    return rows.select(*keys, *((F.col(c) if c in rows.columns else F.lit(None)).cast("double").alias(c) for c in columns))
