"""Domain tables derived from the driver's tables; the same SQL text runs in Spark and in DuckDB (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statspark.schemas import SECTIONS, json_key

#: Game = order, player = supplier, team = nation.
GAME = """
select o_orderkey as game_pk, cast(o_orderdate as date) as game_date, cast(year(o_orderdate) as int) as season,
 case when o_orderkey % 20 = 0 then 'S' else 'R' end as game_type, cast(o_orderkey % 30 as int) as venue_id,
 c_nationkey as home_team_id, cast((c_nationkey + 1 + o_orderkey % 24) % 25 as int) as away_team_id,
 case when o_orderstatus = 'F' then concat('NATION_', cast(c_nationkey as string)) else '' end as winning_team
from orders join customer on o_custkey = c_custkey
"""

#: Raw counts of a fact row per order and supplier.
FACT_RAW = """
with base as (
 select l_orderkey as game_pk, l_suppkey as player_id, s_nationkey as team_id,
  cast(sum(l_quantity) as int) as q, cast(sum(l_linenumber) as int) as ln, cast(max(l_partkey) as int) as pk,
  max(case when l_returnflag = 'R' then 1 else 0 end) as isp
 from lineitem join supplier on l_suppkey = s_suppkey group by l_orderkey, l_suppkey, s_nationkey),
b1 as (select *, case when pk % 17 <> 0 then 1 else 0 end as isb, case when pk % 11 = 0 then 0 else 1 + q % 5 end as ab, q % 3 as bb,
  case when ln % 6 = 0 then 1 else 0 end as hbp, case when pk % 7 = 0 then 1 else 0 end as sf from base),
b2 as (select *, least(ab, pk % 4) as h, case when bb > 0 and pk % 13 = 0 then 1 else 0 end as ibb from b1),
b3 as (select *, least(h, case when pk % 5 = 0 then 1 else 0 end) as hr from b2),
b4 as (select *, case when h - hr >= 1 and ln % 2 = 0 then 1 else 0 end as d2 from b3),
b5 as (select *, case when h - hr - d2 >= 1 and ln % 9 = 0 then 1 else 0 end as d3 from b4)
select game_pk, player_id, team_id,
 cast(1 + pk % 10 as string) as position_code, concat('POS_', cast(1 + pk % 10 as string)) as position_name,
 case when isb = 1 then 1 end as bat_games_played, case when isb = 1 then hr + q % 2 end as bat_runs,
 case when isb = 1 then h end as bat_hits, case when isb = 1 then d2 end as bat_doubles,
 case when isb = 1 then d3 end as bat_triples, case when isb = 1 then hr end as bat_home_runs,
 case when isb = 1 then least(ab - h, q % 3) end as bat_strike_outs, case when isb = 1 then bb end as bat_base_on_balls,
 case when isb = 1 then ab end as bat_at_bats, case when isb = 1 then ab + bb + hbp + sf end as bat_plate_appearances,
 case when isb = 1 then hr + ln % 3 end as bat_rbi, case when isb = 1 then case when ln % 4 = 0 then 1 else 0 end end as bat_stolen_bases,
 case when isb = 1 then case when ln % 10 = 0 then 1 else 0 end end as bat_caught_stealing,
 case when isb = 1 then q % 4 end as bat_fly_outs, case when isb = 1 then ln % 3 end as bat_ground_outs,
 case when isb = 1 then q % 5 end as bat_air_outs, case when isb = 1 then ibb end as bat_intentional_walks,
 case when isb = 1 then hbp end as bat_hit_by_pitch, case when isb = 1 then case when q % 8 = 0 then 1 else 0 end end as bat_ground_into_double_play,
 case when isb = 1 then h + d2 + 2 * d3 + 3 * hr end as bat_total_bases, case when isb = 1 then q % 6 end as bat_left_on_base,
 case when isb = 1 then case when q % 12 = 0 then 1 else 0 end end as bat_sac_bunts, case when isb = 1 then sf end as bat_sac_flies,
 case when isp = 1 then 1 end as pit_games_played, case when isp = 1 then case when q % 2 = 0 then 1 else 0 end end as pit_games_started,
 case when isp = 1 then case when pk % 23 = 0 then '0.0' else concat(cast(1 + q % 8 as string), '.', cast(ln % 3 as string)) end end as pit_innings_text,
 case when isp = 1 then case when ln % 5 = 0 then 1 else 0 end end as pit_wins, case when isp = 1 then case when ln % 5 = 1 then 1 else 0 end end as pit_losses,
 case when isp = 1 then case when ln % 5 = 2 then 1 else 0 end end as pit_saves, case when isp = 1 then q % 9 end as pit_hits,
 case when isp = 1 then ln % 6 end as pit_earned_runs, case when isp = 1 then q % 11 end as pit_strike_outs,
 case when isp = 1 then pk % 5 end as pit_base_on_balls, case when isp = 1 then pk % 3 end as pit_home_runs,
 case when isp = 1 then 10 + q % 20 end as pit_at_bats, case when isp = 1 then ln % 4 end as pit_fly_outs,
 case when isp = 1 then q % 2 end as pit_sac_flies, case when isp = 1 then ln % 2 end as pit_hit_by_pitch,
 case when isp = 1 then 12 + q % 24 end as pit_batters_faced, case when isp = 1 then 3 * (1 + q % 8) + ln % 3 end as pit_outs,
 case when isp = 1 then pk % 2 end as pit_holds, case when isp = 1 then case when pk % 9 = 0 then 1 else 0 end end as pit_blown_saves,
 case when isp = 1 then case when ln % 5 = 2 or pk % 9 = 0 then 1 else 0 end end as pit_save_opportunities,
 case when isp = 1 then 40 + q end as pit_pitches_thrown, case when isp = 1 then 15 + q % 30 end as pit_balls,
 case when isp = 1 then 25 + q - q % 30 end as pit_strikes, case when isp = 1 then ln % 2 end as pit_hit_batsmen,
 case when isp = 1 then case when q % 25 = 0 then 1 else 0 end end as pit_balks, case when isp = 1 then case when q % 7 = 0 then 1 else 0 end end as pit_wild_pitches,
 case when isp = 1 then case when q % 14 = 0 then 1 else 0 end end as pit_pickoffs, case when isp = 1 then pk % 4 end as pit_inherited_runners,
 case when isp = 1 then least(pk % 4, ln % 2) end as pit_inherited_runners_scored,
 q % 4 as fld_assists, ln % 7 as fld_put_outs, case when pk % 19 = 0 then 1 else 0 end as fld_errors,
 q % 4 + ln % 7 + case when pk % 19 = 0 then 1 else 0 end as fld_chances,
 case when pk % 29 = 0 then 1 else 0 end as fld_passed_ball, case when pk % 31 = 0 then 1 else 0 end as fld_pickoffs
from b5
"""

#: Synthetic season constants, with gaps and a tie between seasons.
CONSTANTS = """
select * from (values
 (1996, 0.320, 1.210, 0.690, 0.720, 0.880, 1.240, 1.560, 2.000, 0.117, 3.10),
 (1998, 0.314, 1.236, 0.691, 0.722, 0.883, 1.251, 1.584, 2.041, 0.114, 3.17),
 (2001, 0.331, 1.157, 0.690, 0.719, 0.870, 1.217, 1.529, 1.940, 0.126, 3.21)
) t(season, woba, woba_scale, w_bb, w_hbp, w_1b, w_2b, w_3b, w_hr, r_per_pa, c_fip)
"""

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def views(spark: SparkSession, sf_dir: str) -> None:
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir)
    return spark.sql(GAME)


_LINES = "lineitem join supplier on l_suppkey = s_suppkey"
#: The higher-order function keeps the projection of all columns out of Spark's whole-stage method, which would be longer than
#: the 8,000 bytes up to which the JIT compiles a method.
_CODE, _SHORT = "cast(1 + pk % 10 as string) as position_code", "transform(array(1 + pk % 10), x -> cast(x as string))[0] as position_code"


def raw_fact(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """Narrow lines are shuffled by their game, so that sums by game and player, and what else goes by game, need no other shuffle.

    With ``of`` (game_pk) only lines of these games are shuffled and summed; the hint keeps Spark from moving such a join below it.
    """
    views(spark, sf_dir)
    lines = "l_orderkey, l_suppkey, s_nationkey, l_quantity, l_linenumber, l_partkey, l_returnflag"
    source = _LINES
    if of is not None:
        of.select("game_pk").createOrReplaceTempView("wanted_game")
        source = f"{_LINES} left semi join wanted_game on l_orderkey = game_pk"
    return spark.sql(FACT_RAW.replace(_LINES, f"(select /*+ repartition(l_orderkey) */ {lines} from {source})").replace(_CODE, _SHORT))


def constants(spark: SparkSession) -> DataFrame:
    """The constants as doubles."""
    rows = spark.sql(CONSTANTS)
    return rows.select(*(F.col(c).cast("int" if c == "season" else "double").alias(c) for c in rows.columns))


def players(raw: DataFrame) -> DataFrame:
    """Raw counts as player rows with sections; what a player did not do is {}."""

    def section(prefix: str, present: str):
        names = [c for c in raw.columns if c.startswith(prefix) and c != "pit_innings_text"]
        entries = [F.struct(F.lit(json_key(c)).alias("key"), F.col(c).cast("string").alias("value")) for c in names]
        if prefix == "pit":
            entries.append(F.struct(F.lit("inningsPitched").alias("key"), F.col("pit_innings_text").alias("value")))
        return F.when(F.col(present).isNotNull(), F.map_from_entries(F.array(*entries))).otherwise(F.create_map().cast("map<string,string>"))

    first = {"bat": "bat_at_bats", "pit": "pit_outs", "fld": "fld_chances"}
    return raw.select(
        "game_pk",
        "player_id",
        "team_id",
        "position_code",
        "position_name",
        *(section(p, first[p]).alias(name) for p, name in SECTIONS.items()),
    )


def boxscore_json(rows: DataFrame) -> DataFrame:
    """game_pk, json: player rows as boxscore documents of two sides (odd and even teams).

    Players become texts one by one, so that what is gathered by game are texts and not maps of their values.
    """
    player = F.struct(
        F.struct(F.col("player_id").alias("id")).alias("person"),
        F.col("team_id").alias("parentTeamId"),
        F.struct(F.col("position_code").alias("code"), F.col("position_name").alias("name")).alias("position"),
        F.struct("batting", "pitching", "fielding").alias("stats"),
    )
    text = F.concat(F.lit('"ID'), F.col("player_id").cast("string"), F.lit('":'), F.to_json(player))
    entries = rows.select("game_pk", F.coalesce(F.col("team_id") % 2 == 0, F.lit(False)).alias("home"), text.alias("text"))
    sides = entries.groupBy("game_pk").agg(
        F.collect_list(F.when(F.col("home"), F.col("text"))).alias("home"), F.collect_list(F.when(~F.col("home"), F.col("text"))).alias("away")
    )
    team = lambda c: F.when(F.size(c) > 0, F.concat(F.lit(f'"{c}":{{"players":{{'), F.array_join(c, ","), F.lit("}}")))
    return sides.select("game_pk", F.concat(F.lit('{"teams":{'), F.concat_ws(",", team("away"), team("home")), F.lit("}}")).alias("json"))


def schedule(games_: DataFrame) -> DataFrame:
    """Game rows under the raw schedule's names."""
    name = lambda c: F.concat(F.lit("NATION_"), F.col(c).cast("string"))
    return games_.select(
        F.col("game_pk").cast("string").alias("game_id"),
        "game_type",
        F.lit("Final").alias("status"),
        name("home_team_id").alias("home_name"),
        name("away_team_id").alias("away_name"),
        F.col("home_team_id").alias("home_id"),
        F.col("away_team_id").alias("away_id"),
        F.col("game_date").cast("string").alias("game_date"),
        "venue_id",
        "season",
        "winning_team",
    )
