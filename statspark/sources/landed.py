"""Landed JSON inputs: schedules, boxscores, game metadata and season constants."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from statspark.schemas import CONSTANTS, METADATA, METADATA_DEFAULTS, SCHEDULE, boxscore


def schedule(spark: SparkSession, path: str) -> DataFrame:
    """Games of landed schedule files."""
    return spark.read.schema(SCHEDULE).json(path)


def day(text: Column) -> Column:
    """Date of a text that begins with YYYY-MM-DD; null for others."""
    trimmed = F.trim(text)
    return F.when(F.length(trimmed) >= 10, F.substring(trimmed, 1, 10).try_cast("date"))


def us_day(text: Column) -> Column:
    """Date of MM/DD/YYYY."""
    return F.try_to_timestamp(text, F.lit("MM/dd/yyyy")).cast("date")


def schedule_for(games: DataFrame, date: str | Column) -> DataFrame:
    """Games of one date, given as MM/DD/YYYY or as a date column."""
    wanted = us_day(F.lit(date)) if isinstance(date, str) else date
    return games.where(day(F.col("game_date")) == wanted)


def readiness(games: DataFrame | None, date: str) -> DataFrame:
    """One row: status 'ready' with games on the date, 'empty' without. ``None`` is for ``landed_readiness``."""
    n = schedule_for(games, date).limit(1).agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.lit(date).alias("date"), F.when(F.col("n") > 0, "ready").otherwise("empty").alias("status"))


def landed_readiness(spark: SparkSession, path: str, date: str | None) -> DataFrame:
    """The same for a landing path; a path that isn't there yet is 'not_ready', an absent date an error."""
    if date is None:
        raise ValueError("a date is needed")
    try:
        return readiness(schedule(spark, path), date)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(1).select(F.lit(date).alias("date"), F.lit("not_ready").alias("status"))


def require_ready(status: DataFrame) -> bool:
    """False if not landed yet; raises if the day has no games."""
    state = status.first()["status"]
    if state == "empty":
        raise ValueError("no games are scheduled")
    return state == "ready"


def boxscores(spark: SparkSession, path: str, games: list[int] | None = None) -> DataFrame:
    """game_pk and json of files <game_pk>.json, of the given games alone if there are any given.

    Then only their files are opened; those that have not landed are left out.
    """
    none = spark.createDataFrame([], "game_pk long, json string")
    if games == []:
        return none
    names = path if games is None else f"{path}/{{{','.join(map(str, games))}}}.json"
    try:
        files = spark.read.text(names, wholetext=True).withColumn("file", F.input_file_name())
    except AnalysisException as e:
        if games is None or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return none
    return files.select(F.regexp_extract("file", r"(\d+)\.json$", 1).cast("long").alias("game_pk"), F.col("value").alias("json"))


def boxscore_players(raw: DataFrame, games: DataFrame | None = None) -> DataFrame:
    """Player rows of boxscores (game_pk, json), of the given games only if there are any given.

    Sides without players and players without id, team or stats are left out; code and name of a position default to ''.
    A section is a struct of the keys that the library knows, which one pass of the parser fills; a key that is absent is
    null, and so are all of an empty section.
    """
    if games is not None:
        raw = raw.join(games.select("game_pk"), "game_pk", "left_semi")
    box = raw.select("game_pk", F.from_json("json", StructType.fromDDL(boxscore())).alias("box"))
    sides = box.select("game_pk", F.explode("box.teams").alias("side", "team"))
    players = sides.select("game_pk", F.explode("team.players").alias("key", "p"))
    stats = F.col("p.stats")
    some = stats["batting"].isNotNull() | stats["pitching"].isNotNull() | stats["fielding"].isNotNull()
    kept = players.where(F.col("p.person.id").isNotNull() & F.col("p.parentTeamId").isNotNull() & some)
    return kept.select(
        "game_pk",
        F.col("p.person.id").alias("player_id"),
        F.col("p.parentTeamId").alias("team_id"),
        F.coalesce("p.position.code", F.lit("")).alias("position_code"),
        F.coalesce("p.position.name", F.lit("")).alias("position_name"),
        stats["batting"].alias("batting"),
        stats["pitching"].alias("pitching"),
        stats["fielding"].alias("fielding"),
    )


def game_metadata(raw: DataFrame, column: str = "json") -> DataFrame:
    """Typed metadata of game feeds; unknown keys are dropped, missing fields get their defaults."""
    flat = raw.select(F.from_json(column, StructType.fromDDL(METADATA)).alias("m")).select("m.*")
    return flat.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in METADATA_DEFAULTS.items()})


def season_constants(raw: DataFrame, column: str = "json") -> DataFrame:
    """A row for each season of {year: {key: value}}."""
    years = raw.select(F.explode(F.from_json(column, "map<string, map<string, double>>")).alias("year", "values"))
    values = [F.try_element_at("values", F.lit(key)).alias(name) for name, key in CONSTANTS.items()]
    return years.select(F.col("year").cast("int").alias("season"), *values)
