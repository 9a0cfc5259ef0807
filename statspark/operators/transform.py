"""From raw games and player rows to the fact table's columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statspark.functions import metrics
from statspark.schemas import (
    BATTING,
    CONSTANTS,
    CONTEXT,
    COUNTS,
    EXTRA,
    FACT,
    FIELDING,
    INNINGS_KEY,
    LANDED_METRICS,
    METRICS,
    PITCHING,
    SECTIONS,
    json_key,
)

#: Seasons for which constants can be looked up.
FIRST_SEASON, LAST_SEASON = 1800, 2200


def project_games(schedule: DataFrame, *more: str) -> DataFrame:
    """Raw schedule games as game rows: the season comes from the date, a missing winner is ''. ``more`` columns stay."""
    return schedule.select(
        F.col("game_id").cast("long").alias("game_pk"),
        F.col("game_date"),
        F.substring("game_date", 1, 4).cast("int").alias("season"),
        "game_type",
        F.col("venue_id").cast("int").alias("venue_id"),
        F.col("home_id").cast("int").alias("home_team_id"),
        F.col("away_id").cast("int").alias("away_team_id"),
        F.col("home_name").alias("home_team"),
        F.col("away_name").alias("away_team"),
        F.coalesce("winning_team", F.lit("")).alias("winning_team"),
        *more,
    )


def scheduled_games(schedule: DataFrame) -> DataFrame:
    """game_pk, home_team_id, away_team_id."""
    return project_games(schedule).select("game_pk", "home_team_id", "away_team_id")


def numeric(value: Column) -> Column:
    """A variant as double if it is a number; null if it is text, true, false, an object or nothing."""
    kind = F.schema_of_variant(value)
    return F.when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT)"), F.try_variant_get(value, "$", "double"))


def numeric_only(json: Column) -> Column:
    """The same for a JSON value as text."""
    return numeric(F.try_parse_json(json))


def flatten(players: DataFrame) -> DataFrame:
    """Context, raw counts and landed metrics of player rows (batting, pitching, fielding: structs of known keys).

    Absent sections give nulls, and so do those without any known key.
    """
    section = lambda column: F.col(SECTIONS[column[:3]])
    counts = [section(c)[json_key(c)].try_cast("int").alias(c) for c in COUNTS + EXTRA]
    landed = [numeric(section(c)[key]).alias(c) for c, key in LANDED_METRICS.items()]
    innings = F.col("pitching")[INNINGS_KEY]
    known = [F.col("pitching")[json_key(c)] for c in COUNTS + EXTRA if c.startswith("pit")]
    text = F.when(F.coalesce(innings, *known).isNotNull(), F.coalesce(innings, F.lit("")))
    return players.select(*CONTEXT, *counts, *landed, text.alias("pit_innings_text"))


def nearest_constants(constants: DataFrame) -> DataFrame:
    """for_season and the constants of the nearest season (of two as near, the earlier one), for every season.

    Each season's constants reach half-way to its neighbours', so this takes no comparison of all pairs. A season that
    occurs twice is an error, so that there are 401 rows at most.
    """
    once = constants.groupBy("season").agg(F.first(F.struct(*constants.columns)).alias("row"), F.count(F.lit(1)).alias("n"))
    safe = F.when(F.col("n") == 1, F.col("row")).otherwise(F.raise_error(F.lit("a season has two rows of constants")))
    constants = once.select(safe.alias("row")).select("row.*")
    order = Window.orderBy("season")
    before, after = F.lag("season").over(order), F.lead("season").over(order)
    reach = constants.select(
        *constants.columns,
        F.coalesce(F.floor((before + F.col("season")) / 2).cast("int") + 1, F.lit(FIRST_SEASON)).alias("_from"),
        F.coalesce(F.floor((F.col("season") + after) / 2).cast("int"), F.lit(LAST_SEASON)).alias("_to"),
    )
    return reach.select(F.explode(F.sequence("_from", "_to")).alias("for_season"), *constants.columns)


def with_constants(rows: DataFrame, constants: DataFrame, season: str = "season") -> DataFrame:
    """Rows with a struct ``c`` of their season's constants; without any constants there are no rows."""
    lookup = nearest_constants(constants).select("for_season", F.struct("season", *CONSTANTS).alias("c"))
    return rows.join(F.broadcast(lookup), F.col(season) == F.col("for_season")).drop("for_season")  # 401 rows at most


def enrich(flat: DataFrame, games: DataFrame, constants: DataFrame, true_singles: bool = False) -> DataFrame:
    """The fact table's columns, from flattened counts of games that are known.

    Games that occur twice count once. On-base percentage and slugging take all hits where singles belong, as the
    stored per-game OPS does; ``true_singles`` takes singles.
    """
    seasons = games.groupBy("game_pk").agg(F.max("season").alias("season"))
    rows = with_constants(flat.join(seasons, "game_pk"), constants)
    c = lambda name: F.col(f"c.{name}")
    b = lambda name: F.col(f"bat_{name}")
    p = lambda name: F.col(f"pit_{name}")
    singles = b("hits") - b("home_runs") - b("doubles") - b("triples")
    counted = singles if true_singles else b("hits")
    extra = (b("doubles"), b("triples"), b("home_runs"))
    obp = metrics.on_base(b("base_on_balls"), b("hit_by_pitch"), counted, *extra, b("at_bats"), b("intentional_walks"), b("sac_flies"))
    ip = metrics.innings(F.col("pit_innings_text"))
    woba = metrics.woba(
        c, b("base_on_balls"), b("hit_by_pitch"), b("home_runs"), singles, b("doubles"), b("triples"), b("intentional_walks"), b("at_bats"), b("sac_flies")
    )
    fly = p("fly_outs") + p("sac_flies") + p("home_runs")
    value = {
        "bat_woba": woba,
        "bat_wrc_plus": metrics.wrc_plus(c, woba, b("plate_appearances")),
        "bat_ops": metrics.on_base_plus_slugging(obp, metrics.slugging(counted, *extra, b("at_bats"))),
        **{n: (F.col(n) if n in rows.columns else F.lit(None)).cast("double") for n in LANDED_METRICS},
        "pit_innings_pitched": ip,
        "pit_fip": metrics.fip(c, p("base_on_balls"), p("hit_by_pitch"), p("home_runs"), p("strike_outs"), ip),
        "pit_babip": metrics.pitching_babip(p("hits"), p("home_runs"), p("at_bats"), p("strike_outs"), p("sac_flies")),
        "pit_home_run_rate": metrics.pitching_home_run_rate(p("home_runs"), fly),
        "fld_fielding_runs": metrics.fielding_runs(F.col("fld_assists"), F.col("fld_errors"), F.col("fld_chances")),
    }
    own = {"bat": "bat_at_bats", "pit": "pit_innings_text", "fld": "fld_chances"}
    stored = {n: F.when(F.col(own[n[:3]]).isNotNull(), metrics.rounded(x, METRICS[n])) for n, x in value.items()}
    stored |= {n: metrics.rounded(value[n], METRICS[n]) for n in LANDED_METRICS}
    rows = rows.withColumn("team_id", metrics.apart(F.col("team_id")))
    return rows.select(*CONTEXT, *((stored[x] if x in stored else F.col(x)).alias(x) for x in BATTING + PITCHING + FIELDING))


def load_ready(players: DataFrame, games: DataFrame, constants: DataFrame) -> DataFrame:
    """Player rows to fact rows in one plan."""
    return enrich(flatten(players), games, constants)


def fixed_columns(rows: DataFrame, columns: list[str] = FACT) -> DataFrame:
    """The given columns in order; missing ones are null, others are dropped."""
    return rows.select(*(F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in columns))
