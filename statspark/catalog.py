"""The library's queries on the driver's tables, each with its DuckDB equivalent."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statspark import fixtures as fx
from statspark.functions import metrics
from statspark.operators import features, learning, quality, rolling, transform, upsert
from statspark.operators.transform import with_constants
from statspark.plans import jobs
from statspark.schemas import (
    BATTER,
    BATTING,
    CONSTANTS,
    CONTEXT,
    EXTRA,
    FACT,
    FIELDING,
    HELPERS,
    METRICS,
    PITCHER,
    PITCHING,
    ROLLING_SUMS,
    WINDOWS,
    feature_names,
)
from statspark.sources import landed, tables
from statspark.sources.tables import checkpoint_folder
from statspark.streaming.landing import affected_dates

#: Dates of the fixtures: a prediction day, the day before, the split between stored and new games.
DAY, AS_OF, FIRST, LAST, SPLIT, NEW = "2001-08-01", "2001-07-31", "1999-01-01", "2001-08-01", "1999-01-01", "1998-06-01"
NOW = "2024-01-31 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def fact_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.enrich(fx.raw_fact(spark, sf_dir), fx.games(spark, sf_dir), fx.constants(spark))


def stored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fact rows, games, constants."""
    return fact_of(spark, sf_dir), fx.games(spark, sf_dir), fx.constants(spark)


def rolling_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.rolling_all_dates(*stored(spark, sf_dir))


def wide_of(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    return rolling.wide_all_dates(*stored(spark, sf_dir), columns)


# ---- SQL building blocks -------------------------------------------------------------------------------------------


def r(x: str, n: int) -> str:
    return f"round({x} + case when {x} < 0 then -1e-9 else 1e-9 end, {n})"


_CONST = f"const as (select season as c_season, {', '.join(f'cast({c} as double) as k_{c}' for c in 'woba woba_scale w_bb w_hbp w_1b w_2b w_3b w_hr r_per_pa c_fip'.split())} from ({fx.CONSTANTS}))"
_NEAR = """near as (select s.season as n_season, arg_min(c_season, abs(c_season - s.season) * 10000 + c_season) as c_season
 from (select distinct season from game) s, const group by s.season)"""
_BASE = f"with recursive game as ({fx.GAME}), raw as ({fx.FACT_RAW}), {_CONST}, {_NEAR}"
_GAME = f"with game as ({fx.GAME})"
_REACHED = "(bat_at_bats + bat_base_on_balls - bat_intentional_walks + bat_sac_flies + bat_hit_by_pitch)"
_SINGLES = "(bat_hits - bat_home_runs - bat_doubles - bat_triples)"
_WEIGHTED = (
    f"(k_w_bb * bat_base_on_balls + k_w_hbp * bat_hit_by_pitch + k_w_1b * {_SINGLES} + k_w_2b * bat_doubles"
    " + k_w_3b * bat_triples + k_w_hr * bat_home_runs)"
)
_WOBA = f"(case when bat_at_bats = 0 then 0.0 else {_WEIGHTED} / cast({_REACHED} as double) end)"
_WRC = f"(case when bat_plate_appearances = 0 then 0.0 else ({_WOBA} - k_woba) / k_woba_scale + k_r_per_pa * bat_plate_appearances end)"


def _ops(singles: str) -> tuple[str, str]:
    obp = f"(case when bat_at_bats = 0 then 0.0 else cast(bat_base_on_balls + bat_hit_by_pitch + {singles} + bat_doubles + bat_triples + bat_home_runs as double) / {_REACHED} end)"
    slg = f"(case when bat_at_bats = 0 then 0.0 else cast({singles} + 2 * bat_doubles + 3 * bat_triples + 4 * bat_home_runs as double) / bat_at_bats end)"
    return obp, slg


_OBP, _SLG = _ops("bat_hits")
_OPS = f"(case when {_OBP} = 0 or {_SLG} = 0 then 0.0 else {_OBP} + {_SLG} end)"
_IP = "coalesce(try_cast(trim(pit_innings_text) as double), 0.0)"
_FIP = f"(case when {_IP} = 0 then 0.0 else cast(13 * pit_home_runs + 3 * (pit_base_on_balls + pit_hit_by_pitch) - 2 * pit_strike_outs as double) / {_IP} + k_c_fip end)"
_PBASE = "(pit_at_bats - pit_strike_outs - pit_home_runs + pit_sac_flies)"
_PBABIP = f"(case when pit_at_bats = 0 or {_PBASE} = 0 then 0.0 else cast(pit_hits - pit_home_runs as double) / {_PBASE} end)"
_FLY = "(pit_fly_outs + pit_sac_flies + pit_home_runs)"
_PHR = f"(case when {_FLY} = 0 then 0.0 else cast(pit_home_runs as double) / {_FLY} * 100 end)"
_FLD = "(case when fld_chances = 0 then 0.0 else cast(fld_assists + fld_errors as double) / fld_chances end)"
_METRIC = {
    "bat_woba": f"case when bat_at_bats is not null then {r(_WOBA, 4)} end",
    "bat_wrc_plus": f"case when bat_at_bats is not null then {r(_WRC, 2)} end",
    "bat_ops": f"case when bat_at_bats is not null then {r(_OPS, 4)} end",
    "bat_babip": "cast(null as double)",
    "bat_home_run_rate": "cast(null as double)",
    "pit_innings_pitched": f"case when pit_innings_text is not null then {r(_IP, 2)} end",
    "pit_fip": f"case when pit_innings_text is not null then {r(_FIP, 2)} end",
    "pit_babip": f"case when pit_innings_text is not null then {r(_PBABIP, 4)} end",
    "pit_home_run_rate": f"case when pit_innings_text is not null then {r(_PHR, 4)} end",
    "fld_fielding_runs": f"case when fld_chances is not null then {r(_FLD, 4)} end",
}
_ALL = f"{_BASE}, with_c as (select raw.*, season, game_date, const.* from raw join game using (game_pk) join near on n_season = season join const using (c_season))"
_FACT = f"{_ALL}, fact as (select {', '.join(f'{_METRIC[c]} as {c}' if c in METRICS else c for c in FACT)} from with_c)"

_SUM = ", ".join(f"cast(sum(coalesce({c}, 0)) as bigint) as {c}" for c in ROLLING_SUMS)
_DEC = "cast(coalesce({0}, 0) as decimal(8,2))"
_SUM_D = f"sum({_DEC.format('pit_innings_pitched')}) as ip, sum({_DEC.format('pit_fip')} * {_DEC.format('pit_innings_pitched')}) as fip_ip"
_ROLL_SUMS = f"""{_FACT},
 dated as (select fact.*, season, game_date from fact join game using (game_pk)),
 days as (select distinct player_id, game_date as as_of_date from dated),
 sums as (select d.player_id, as_of_date, n as window_days, max(season) as season, {_SUM}, {_SUM_D}
  from days d, (values (7), (30)) w(n) join dated f on f.player_id = d.player_id and f.game_date <= as_of_date and f.game_date > as_of_date - n
  group by d.player_id, as_of_date, n
  having sum(coalesce(bat_games_played, 0) + coalesce(pit_games_played, 0) + coalesce(fld_chances, 0)) > 0)"""
_SOME, _IPD = f"{_REACHED} > 0", "cast(ip as double)"
_RW = f"{_WEIGHTED} / cast({_REACHED} as double)"
_RATE = {
    "bat_avg": f"case when bat_at_bats > 0 then {r('cast(bat_hits as double) / bat_at_bats', 4)} end",
    "bat_ops": f"case when bat_at_bats > 0 and {_SOME} then {r(f'((bat_base_on_balls + bat_hit_by_pitch + bat_hits) / cast({_REACHED} as double) + bat_total_bases / cast(bat_at_bats as double))', 4)} end",
    "bat_woba": f"case when {_SOME} then {r(_RW, 4)} end",
    "bat_wrc_plus": f"case when {_SOME} and bat_plate_appearances > 0 then {r(f'(({_RW} - k_woba) / k_woba_scale + k_r_per_pa * bat_plate_appearances)', 2)} end",
    "pit_innings_pitched": f"case when ip > 0 then {r(_IPD, 2)} end",
    "pit_era": f"case when ip > 0 then {r(f'9.0 * pit_earned_runs / {_IPD}', 2)} end",
    "pit_fip": f"case when ip > 0 then {r(f'cast(fip_ip as double) / {_IPD}', 2)} end",
    "pit_whip": f"case when ip > 0 then {r(f'(pit_hits + pit_base_on_balls) / {_IPD}', 2)} end",
}
_COUNTS = [c for c in ROLLING_SUMS if c not in HELPERS]
_OUT = ", ".join([f"nullif({c}, 0) as {c}" for c in _COUNTS] + [f"{x} as {c}" for c, x in _RATE.items()])
_ROLL = f"""{_ROLL_SUMS},
 rolling as (select player_id, cast(as_of_date as date) as as_of_date, cast(window_days as smallint) as window_days, {_OUT}
  from sums join near on n_season = season join const using (c_season))"""


def _wide_sql(columns: list[str]) -> str:
    value = ", ".join(f"max(case when window_days = {n} then {c} end) as {c}_{n}" for n in WINDOWS for c in columns)
    return f"select player_id, as_of_date, {value} from rolling group by player_id, as_of_date"


def _training_sql(label: str, activity: str, columns: list[str]) -> str:
    return f"""{_ROLL}, wide as ({_wide_sql(columns)}),
 target as (select player_id, cast(game_date as date) as game_date, cast(game_date - 1 as date) as before, {label} as label from dated
  where game_date between date '{FIRST}' and date '{LAST}' and coalesce({activity}, 0) > 0 and {label} is not null)
 select target.player_id, game_date, label, {', '.join(feature_names(columns))}
 from target join wide on wide.player_id = target.player_id and as_of_date = before"""


# ---- Sources and projections ---------------------------------------------------------------------------------------


@query(f"{_GAME} select game_pk, cast(game_date as varchar) as game_date, season, game_type, venue_id, home_team_id, away_team_id, 'NATION_' || home_team_id as home_team, 'NATION_' || away_team_id as away_team, winning_team from game")
def schedule_project(spark, sf_dir):
    return transform.project_games(fx.schedule(fx.games(spark, sf_dir)))


@query(f"{_GAME} select game_pk, home_team_id, away_team_id from game where game_date = date '{DAY}'")
def schedule_one_day(spark, sf_dir):
    return transform.scheduled_games(landed.schedule_for(fx.schedule(fx.games(spark, sf_dir)), "08/01/2001"))


@query(f"{_GAME} select '08/01/2001' as date, case when count(*) > 0 then 'ready' else 'empty' end as status from game where game_date = date '{DAY}'")
def schedule_readiness(spark, sf_dir):
    return landed.readiness(fx.schedule(fx.games(spark, sf_dir)), "08/01/2001")


_RAW_COLUMNS = [*CONTEXT, *(c for c in BATTING + PITCHING + FIELDING if c not in METRICS), *EXTRA, "pit_innings_text"]


@query(f"with raw as ({fx.FACT_RAW}) select {', '.join(_RAW_COLUMNS)} from raw")
def boxscore_explode(spark, sf_dir):
    box = fx.boxscore_json(fx.players(fx.raw_fact(spark, sf_dir)))
    return transform.flatten(landed.boxscore_players(box)).select(*_RAW_COLUMNS)


@query(f"{_BASE} select raw.game_pk, count(*) as n_players from raw join game using (game_pk) where game_date between date '2001-01-01' and date '{DAY}' group by raw.game_pk")
def boxscore_for_games(spark, sf_dir):
    wanted = fx.games(spark, sf_dir).where(F.col("game_date").between("2001-01-01", DAY))
    box = fx.boxscore_json(fx.players(fx.raw_fact(spark, sf_dir)))
    return landed.boxscore_players(box, wanted).groupBy("game_pk").agg(F.count(F.lit(1)).alias("n_players"))


@query(f"{_FACT} select * from fact")
def flatten_fact(spark, sf_dir):
    box = fx.boxscore_json(fx.players(fx.raw_fact(spark, sf_dir)))
    return transform.load_ready(landed.boxscore_players(box), fx.games(spark, sf_dir), fx.constants(spark))


@query(f"{_GAME}, {_CONST}, {_NEAR} select game_pk, season, c_season, k_woba, k_c_fip from game join near on n_season = season join const using (c_season)")
def nearest_constants(spark, sf_dir):
    rows = with_constants(fx.games(spark, sf_dir), fx.constants(spark))
    c = {"c_season": "season", "k_woba": "woba", "k_c_fip": "c_fip"}
    return rows.select("game_pk", "season", *(F.col(f"c.{x}").alias(n) for n, x in c.items()))


@query(f"{_GAME} select game_pk, 'R' as gameType, cast(1 as int) as gameNumber, 'N' as doubleHeader, cast(9 as int) as scheduledInnings, false as isTie, home_team_id as home_id, cast(venue_id as int) as venue_id from game where game_type = 'R'")
def game_metadata(spark, sf_dir):
    games = fx.games(spark, sf_dir).where("game_type = 'R'")
    feed = games.select(
        F.to_json(
            F.struct(
                "game_pk",
                F.col("game_type").alias("gameType"),
                F.lit("dropped").alias("unknown"),
                F.struct(F.struct(F.struct(F.col("home_team_id").alias("id")).alias("team")).alias("home")).alias("teams"),
                F.struct(F.col("venue_id").alias("id")).alias("venue"),
            )
        ).alias("json")
    )
    meta = landed.game_metadata(feed)
    kept = ("game_pk", "gameType", "gameNumber", "doubleHeader", "scheduledInnings", "isTie")
    return meta.select(*kept, F.col("teams.home.team.id").alias("home_id"), F.col("venue.id").alias("venue_id"))


_YEARS = "select season, round(avg(venue_id) / 100, 4) as woba, round(avg(home_team_id) / 10, 4) as woba_scale, cast(count(*) as double) as w_bb from game group by season"


@query(f"{_GAME} select season, woba, woba_scale, w_bb, cast(null as double) as c_fip from ({_YEARS})")
def season_constants(spark, sf_dir):
    """Constants of {year: {key: value}}; keys that are absent give nulls."""
    fx.games(spark, sf_dir).createOrReplaceTempView("game")
    keys = {"woba": CONSTANTS["woba"], "woba_scale": CONSTANTS["woba_scale"], "w_bb": CONSTANTS["w_bb"]}
    values = F.map_from_entries(F.array(*(F.struct(F.lit(k).alias("key"), F.col(c).cast("double").alias("value")) for c, k in keys.items())))
    years = spark.sql(_YEARS).select(F.to_json(F.create_map(F.col("season").cast("string"), values)).alias("json"))
    return landed.season_constants(years).select("season", *keys, "c_fip")


_FIXED = ["game_pk", "player_id", "bat_hits", "absent"]


@query(f"with raw as ({fx.FACT_RAW}) select game_pk, player_id, bat_hits, cast(null as varchar) as absent from raw")
def fixed_projection(spark, sf_dir):
    return transform.fixed_columns(fx.raw_fact(spark, sf_dir), _FIXED).withColumn("absent", F.col("absent").cast("string"))


_JSON = """select l_orderkey, l_linenumber, l_quantity as q,
 case l_linenumber % 4 when 0 then concat('"', cast(l_quantity as string), '"') when 1 then cast(l_quantity as string) when 2 then 'true' end as json from lineitem"""


@query("select l_orderkey, l_linenumber, case when l_linenumber % 4 = 1 then cast(l_quantity as double) end as number from lineitem")
def numeric_guard(spark, sf_dir):
    """Of JSON values only numbers pass; the same number as text doesn't."""
    fx.views(spark, sf_dir)
    return spark.sql(_JSON).select("l_orderkey", "l_linenumber", transform.numeric_only(F.col("json")).alias("number"))


@query(f"with raw as ({fx.FACT_RAW}) select game_pk, player_id, case when game_pk % 4 = 0 then game_pk % 100 + 0.25 end::double as bat_babip, case when game_pk % 3 = 0 then cast(game_pk % 7 as double) end as bat_home_run_rate, bat_hits from raw")
def landed_numbers(spark, sf_dir):
    """Values whose JSON type matters: numbers are kept, text, true, and absent ones are null."""
    pk = F.col("game_pk")
    # Marked values become JSON numbers and literals, as the fixture writes texts alone.
    babip = F.when(pk % 4 == 0, F.concat(F.lit("@"), pk % 100, F.lit(".25"))).when(pk % 4 == 1, "0.5").when(pk % 4 == 2, "@true")
    rate = F.when(pk % 3 == 0, F.concat(F.lit("@"), pk % 7)).when(pk % 3 == 1, "12")
    more = F.map_filter(F.create_map(F.lit("babip"), babip, F.lit("home_run_rate"), rate), lambda _, v: v.isNotNull())
    rows = fx.players(fx.raw_fact(spark, sf_dir)).withColumn("batting", F.map_concat("batting", more))
    json = fx.boxscore_json(rows).withColumn("json", F.regexp_replace("json", '"@([^"]*)"', "$1"))
    flat = transform.flatten(landed.boxscore_players(json))
    return flat.select("game_pk", "player_id", "bat_babip", "bat_home_run_rate", "bat_hits")


@query(f"{_FACT} select f.* from fact f join game using (game_pk) where game_date = date '{DAY}'")
def boxscore_files(spark, sf_dir):
    """Facts of one day from files <game_pk>.json."""
    root, games = _folder(spark), fx.games(spark, sf_dir)
    chosen = games.where(F.col("game_date") == DAY).select("game_pk")
    raw = _of_days(spark, sf_dir, chosen)
    for r in fx.boxscore_json(fx.players(raw)).toLocalIterator():
        _put(spark, f"{root}/{r['game_pk']}.json", r["json"])
    wanted = [r["game_pk"] for r in chosen.collect()]
    return transform.load_ready(landed.boxscore_players(landed.boxscores(spark, root, [*wanted, -1])), games, fx.constants(spark))


def _of_days(spark: SparkSession, sf_dir: str, chosen: DataFrame) -> DataFrame:
    """Raw facts of the games of one day or two. Their numbers are few, so they are broadcast and meet the lines at the scan."""
    return fx.raw_fact(spark, sf_dir).join(F.broadcast(chosen.select("game_pk")), "game_pk", "left_semi")


def _put(spark: SparkSession, path: str, text: str) -> None:
    """A file as it lands: by Hadoop's file systems, so that the folder may be anywhere."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file)
    out.write(bytearray(text, "utf-8"))
    out.close()


# ---- Metrics -------------------------------------------------------------------------------------------------------


def _per_game(*columns: str) -> tuple[str, Query]:
    sql = f"{_FACT} select game_pk, player_id, {', '.join(columns)} from fact"
    return sql, lambda spark, sf_dir: fact_of(spark, sf_dir).select("game_pk", "player_id", *columns)


for _name, _columns in {
    "woba_game": ("bat_woba",),
    "wrc_game": ("bat_wrc_plus",),
    "ops_game": ("bat_ops",),
    "fip_game": ("pit_innings_pitched", "pit_fip"),
    "pit_babip": ("pit_babip",),
    "pit_hr_rate": ("pit_home_run_rate",),
    "fielding_runs": ("fld_fielding_runs",),
}.items():
    _SQL[_name], _QUERIES[_name] = _per_game(*_columns)

_BDEN = "(bat_at_bats - bat_strike_outs - bat_sac_flies - bat_home_runs)"


@query(f"with raw as ({fx.FACT_RAW}) select game_pk, player_id, case when bat_at_bats = 0 then 0.0 when {_BDEN} <> 0 then {r(f'(cast(bat_hits - bat_home_runs as double) / {_BDEN})', 4)} end as bat_babip from raw where bat_at_bats is not null")
def bat_babip(spark, sf_dir):
    raw = fx.raw_fact(spark, sf_dir).where("bat_at_bats is not null")
    value = metrics.batting_babip(*(F.col(f"bat_{c}") for c in ("hits", "home_runs", "at_bats", "strike_outs", "sac_flies")))
    return raw.select("game_pk", "player_id", metrics.rounded(value, 4).alias("bat_babip"))


@query(f"with raw as ({fx.FACT_RAW}) select game_pk, player_id, case when bat_fly_outs = 0 then 0.0 else {r('(cast(bat_home_runs as double) / bat_fly_outs)', 4)} end as bat_home_run_rate from raw where bat_at_bats is not null")
def bat_hr_rate(spark, sf_dir):
    raw = fx.raw_fact(spark, sf_dir).where("bat_at_bats is not null")
    value = metrics.batting_home_run_rate(F.col("bat_home_runs"), F.col("bat_fly_outs"))
    return raw.select("game_pk", "player_id", metrics.rounded(value, 4).alias("bat_home_run_rate"))


_XFIP = f"(case when {_IP} = 0 then 0.0 else (13 * ({_FLY} * (cast(l_hr as double) / cast(l_fb as double))) + 3 * (pit_base_on_balls + pit_hit_by_pitch) - 2 * pit_strike_outs) / {_IP} + k_c_fip end)"


@query(f"{_ALL}, league as (select season, sum(pit_home_runs) as l_hr, sum({_FLY}) as l_fb from with_c group by season) select game_pk, player_id, {r(_XFIP, 2)} as pit_xfip from with_c join league using (season) where pit_innings_text is not null")
def xfip_game(spark, sf_dir):
    raw = fx.raw_fact(spark, sf_dir).join(fx.games(spark, sf_dir).select("game_pk", "season"), "game_pk")
    p = lambda n: F.col(f"pit_{n}")
    fly = p("fly_outs") + p("sac_flies") + p("home_runs")
    league = raw.groupBy("season").agg(F.sum("pit_home_runs").alias("l_hr"), F.sum(fly).alias("l_fb"))
    rows = with_constants(raw.where("pit_innings_text is not null").join(league, "season"), fx.constants(spark))
    ip = metrics.innings(F.col("pit_innings_text"))
    value = metrics.xfip(lambda n: F.col(f"c.{n}"), p("base_on_balls"), p("hit_by_pitch"), p("strike_outs"), ip, fly, F.col("l_hr"), F.col("l_fb"))
    return rows.select("game_pk", "player_id", metrics.rounded(value, 2).alias("pit_xfip"))


_OBP1, _SLG1 = _ops(_SINGLES)


@query(f"{_ALL} select game_pk, player_id, {r(_OBP1, 4)} as obp, {r(_SLG1, 4)} as slg from with_c where bat_at_bats is not null")
def obp_slg_game(spark, sf_dir):
    b = lambda n: F.col(f"bat_{n}")
    singles = b("hits") - b("home_runs") - b("doubles") - b("triples")
    extra = (b("doubles"), b("triples"), b("home_runs"))
    obp = metrics.on_base(b("base_on_balls"), b("hit_by_pitch"), singles, *extra, b("at_bats"), b("intentional_walks"), b("sac_flies"))
    slg = metrics.slugging(singles, *extra, b("at_bats"))
    raw = fx.raw_fact(spark, sf_dir).where("bat_at_bats is not null")
    return raw.select("game_pk", "player_id", metrics.rounded(obp, 4).alias("obp"), metrics.rounded(slg, 4).alias("slg"))


# ---- Rolling -------------------------------------------------------------------------------------------------------


@query(f"{_ROLL} select * from rolling")
def rolling_all_dates(spark, sf_dir):
    return rolling_of(spark, sf_dir)


@query(f"{_ROLL} select * from rolling where as_of_date = date '{AS_OF}'")
def rolling_one_date(spark, sf_dir):
    return rolling.rolling_one_date(*stored(spark, sf_dir), AS_OF)


@query(f"{_ROLL} select player_id, as_of_date, window_days, {', '.join(_RATE)} from rolling")
def rolling_rates(spark, sf_dir):
    return rolling_of(spark, sf_dir).select("player_id", "as_of_date", "window_days", *_RATE)


@query(f"{_ROLL_SUMS} select player_id, cast(as_of_date as date) as as_of_date, cast(window_days as smallint) as window_days, {', '.join(ROLLING_SUMS)} from sums")
def rolling_sums(spark, sf_dir):
    fact, games, _ = stored(spark, sf_dir)
    return rolling.sums_all_dates(fact, games).select("player_id", "as_of_date", "window_days", *ROLLING_SUMS)


@query(f"{_BASE} select distinct player_id from raw join game using (game_pk) where game_date = date '{AS_OF}'")
def distinct_players(spark, sf_dir):
    return rolling.players_on(fx.raw_fact(spark, sf_dir), fx.games(spark, sf_dir), F.lit(AS_OF).cast("date"))


# ---- Features and models -------------------------------------------------------------------------------------------


@query(f"{_ROLL} {_wide_sql(BATTER)}")
def pivot_features_batter(spark, sf_dir):
    return wide_of(spark, sf_dir, BATTER)


@query(f"{_ROLL} {_wide_sql(PITCHER)}")
def pivot_features_pitcher(spark, sf_dir):
    return wide_of(spark, sf_dir, PITCHER)


@query(f"{_ROLL}, wide as ({_wide_sql(BATTER)}) select * from wide where as_of_date = date '{AS_OF}'")
def batter_features_date(spark, sf_dir):
    return features.batter_features(wide_of(spark, sf_dir, BATTER), AS_OF)


@query(f"{_ROLL}, wide as ({_wide_sql(PITCHER)}) select * from wide where as_of_date between date '2001-01-01' and date '{AS_OF}'")
def pitcher_features_range(spark, sf_dir):
    return features.pitcher_features(wide_of(spark, sf_dir, PITCHER), "2001-01-01", AS_OF)


@query(f"{_ROLL}, wide as ({_wide_sql(PITCHER)}) select * from wide where as_of_date = date '{AS_OF}'")
def pitcher_features_date(spark, sf_dir):
    return features.pitcher_features(wide_of(spark, sf_dir, PITCHER), AS_OF)


@query(f"{_ROLL}, wide as ({_wide_sql(BATTER)}) select * from wide where as_of_date between date '2001-01-01' and date '{AS_OF}'")
def batter_features_range(spark, sf_dir):
    return features.batter_features(wide_of(spark, sf_dir, BATTER), "2001-01-01", AS_OF)


_MODEL = ["bat_hits_30", "absent", "bat_hits_7"]


@query(f"{_ROLL}, wide as ({_wide_sql(BATTER)}) select player_id, as_of_date, cast(bat_hits_30 as double) as bat_hits_30, cast(null as double) as absent, cast(bat_hits_7 as double) as bat_hits_7 from wide")
def model_columns(spark, sf_dir):
    """Features in a model's order: absent ones are null, others go."""
    return features.model_columns(wide_of(spark, sf_dir, BATTER), _MODEL)


@query(_training_sql("bat_woba", "bat_plate_appearances", BATTER))
def training_batter(spark, sf_dir):
    fact, games, constants = stored(spark, sf_dir)
    return features.batter_training(fact, games, rolling.wide_all_dates(fact, games, constants, BATTER, followed=True), FIRST, LAST)


@query(_training_sql("pit_fip", "pit_innings_pitched", PITCHER))
def training_pitcher(spark, sf_dir):
    fact, games, constants = stored(spark, sf_dir)
    return features.pitcher_training(fact, games, rolling.wide_all_dates(fact, games, constants, PITCHER, followed=True), FIRST, LAST)


@query(
    _training_sql("bat_woba", "bat_plate_appearances", BATTER)
    .replace("select target.player_id, game_date, label,", "select target.player_id, game_date, label, as_of_date,")
    .replace("from target join wide on wide.player_id = target.player_id and as_of_date = before", "from target asof join wide on wide.player_id = target.player_id and wide.as_of_date < target.game_date")
)
def training_batter_asof(spark, sf_dir):
    """Each game with the batter's features of the latest date before it."""
    fact, games, constants = stored(spark, sf_dir)
    rows = features.batter_training(fact, games, rolling.wide_all_dates(fact, games, constants, BATTER), FIRST, LAST, latest=True)
    return rows.select("player_id", "game_date", "label", "as_of_date", *feature_names(BATTER))


@query(f"{_BASE} select cast(min(game_date) as date) as min_date, cast(max(game_date) as date) as max_date from game where game_date >= date '{DAY}' - 730 and game_pk in (select game_pk from raw)")
def training_range(spark, sf_dir):
    return features.training_range(fx.games(spark, sf_dir), fx.raw_fact(spark, sf_dir), DAY)


_ROSTER = f"""select distinct s.game_pk, f.player_id from game s join raw f on f.team_id in (s.home_team_id, s.away_team_id) join game g on g.game_pk = f.game_pk
 where s.game_date = date '{DAY}' and g.game_date between date '{AS_OF}' - 7 and date '{AS_OF}'"""


@query(f"{_BASE} {_ROSTER}")
def roster_for_schedule(spark, sf_dir):
    games, as_of = fx.games(spark, sf_dir), F.lit(AS_OF).cast("date")
    fact = fx.raw_fact(spark, sf_dir, of=features.recent_games(games, as_of))
    return features.roster(games.where(F.col("game_date") == DAY), fact, games, as_of)


@query(f"{_ROLL}, wide as ({_wide_sql(BATTER)}) select {', '.join(f'cast(coalesce(median({c}), 0) as double) as {c}' for c in feature_names(BATTER))} from wide")
def feature_medians(spark, sf_dir):
    return learning.medians(wide_of(spark, sf_dir, BATTER), feature_names(BATTER))


_MIDDLE = f"mid as (select {', '.join(f'cast(coalesce(median({c}), 0) as double) as m_{c}' for c in feature_names(BATTER))} from wide)"
_EACH = " union all ".join(
    f"select '{c}' as feature, any_value(m_{c}) as median, avg(coalesce(cast({c} as double), m_{c})) as mean, stddev_pop(coalesce(cast({c} as double), m_{c})) as std from wide, mid"
    for c in feature_names(BATTER)
)


@query(f"{_ROLL}, wide as ({_wide_sql(BATTER)}), {_MIDDLE}, each as ({_EACH}) select feature, median, round(mean, 6) as mean, round(std, 6) as std from each")
def feature_statistics(spark, sf_dir):
    """Median, mean and spread of every feature after imputation."""
    rows = learning.feature_statistics(wide_of(spark, sf_dir, BATTER), feature_names(BATTER))
    return rows.select("feature", "median", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


_LABELS = {"batter": ("bat_woba", "bat_plate_appearances", BATTER), "pitcher": ("pit_fip", "pit_innings_pitched", PITCHER)}


def _ridge_sql(which: str, days: str) -> str:
    """Tables of one model, from ``_ROLL``: <which>_wide, _t (rows), _s (median, mean, spread), _w (weights), _fit (prediction).

    The normal equations of standardised features are solved by elimination, one column a step.
    """
    label, activity, columns = _LABELS[which]
    w, p = which, 2 * len(columns)
    values = ", ".join(f"cast({c} as double)" for c in feature_names(columns))
    return f""", {w}_wide as (select player_id, as_of_date, [{values}] as v from ({_wide_sql(columns)})),
 {w}_t as (select row_number() over () as id, cast({label} as double) as y, v from dated f join {w}_wide d on d.player_id = f.player_id and as_of_date = cast(game_date - 1 as date)
  where {days} and coalesce({activity}, 0) > 0 and {label} is not null),
 {w}_j as (select unnest(generate_series(1, {p})) as j),
 {w}_m as (select j, coalesce(median(v[j]), 0) as middle from {w}_t, {w}_j group by j),
 {w}_x as (select id, y, j, coalesce(v[j], middle) as x from {w}_t, {w}_m),
 {w}_s as (select j, avg(x) as mean, case when stddev_pop(x) < 1e-9 then 1 else stddev_pop(x) end as std, any_value(middle) as middle from {w}_x join {w}_m using (j) group by j),
 {w}_b as (select avg(y) as base, count(*) as n from {w}_t),
 {w}_z as (select id, y - base as y, j, (x - mean) / std as z from {w}_x join {w}_s using (j), {w}_b),
 {w}_g as (select a.j as i, b.j as j, sum(a.z * b.z) + case when a.j = b.j then 1.0 else 0.0 end as g from {w}_z a join {w}_z b using (id) group by a.j, b.j
  union all select j, {p + 1}, sum(z * y) from {w}_z group by j),
 {w}_e as (select 0 as k, list(line order by i) as m from (select i, list(g order by j) as line from {w}_g group by i)
  union all select k + 1, list_transform(m, lambda r, i: list_transform(range(1, {p + 2}), lambda j: case when i = k + 1 then r[j] / r[k + 1] else r[j] - r[k + 1] * m[k + 1][j] / m[k + 1][k + 1] end)) from {w}_e where k < {p}),
 {w}_w as (select j, m[j][{p + 1}] as weight from {w}_e, {w}_j where k = {p}),
 {w}_error as (select sqrt(avg((hat - y) ** 2)) as rmse from (select id, any_value(y) as y, sum(z * weight) as hat from {w}_z join {w}_w using (j) group by id)),
 {w}_fit as (select player_id, as_of_date, any_value(base) + sum(weight * (coalesce(v[j], middle) - mean) / std) as hat
  from {w}_wide, {w}_w join {w}_s using (j), {w}_b group by player_id, as_of_date)"""


_SPAN = f"game_date between date '{FIRST}' and date '{LAST}'"
_BOTH = _ridge_sql("batter", _SPAN) + _ridge_sql("pitcher", _SPAN)


def _predictions_sql(models: str, day: str) -> str:
    return f"""{_ROLL}{models}, team as ({_ROSTER}) select game_pk, team.player_id, cast(date '{AS_OF}' as date) as as_of_date,
 round(b.hat, 4) as pred_bat_woba, round(p.hat, 2) as pred_pit_fip, '{NOW}' as model_version_bat, '{NOW}' as model_version_pit
 from team left join batter_fit b on b.player_id = team.player_id and b.as_of_date = {day} left join pitcher_fit p on p.player_id = team.player_id and p.as_of_date = {day}"""


def _model(spark, sf_dir, which: str, last: str = LAST) -> learning.Model | dict:
    fact, games, constants = stored(spark, sf_dir)
    build, columns = jobs.MODELS[which]
    with tables.staging(spark) as stage:
        rows = stage(build(fact, games, rolling.wide_all_dates(fact, games, constants, columns, followed=True), FIRST, last))
        return learning.train(rows, feature_names(columns), NOW)


@query(
    f"{_ROLL}{_BOTH} select 'batter' as model, n as n_samples, round(rmse, 6) as train_rmse from batter_b, batter_error"
    " union all select 'pitcher', n, round(rmse, 6) from pitcher_b, pitcher_error"
)
def train_metrics(spark, sf_dir):
    """model, n_samples, train_rmse of both ridge models."""
    rows = [(w, m.metadata["n_samples"], round(m.metadata["train_rmse"], 6)) for w in ("batter", "pitcher") for m in [_model(spark, sf_dir, w)]]
    return spark.createDataFrame(rows, "model string, n_samples long, train_rmse double")


@query(f"{_BASE} select 'batter' as model, count(*) as n_samples from game join raw using (game_pk) where game_date between date '{FIRST}' and date '1990-01-01'")
def train_without_rows(spark, sf_dir):
    """Training on a span without games: empty metadata and no model."""
    about = _model(spark, sf_dir, "batter", "1990-01-01")
    return spark.createDataFrame([("batter", about["n_samples"])], "model string, n_samples long")


@query(
    f"{_ROLL}{_ridge_sql('pitcher', _SPAN)}, name as (select unnest({feature_names(PITCHER)!r}) as feature, unnest(generate_series(1, {2 * len(PITCHER)})) as j)"
    " select feature, round(middle, 6) as median, round(weight / std, 5) as coefficient from name join pitcher_s using (j) join pitcher_w using (j)"
)
def model_saved_and_loaded(spark, sf_dir):
    """Medians and coefficients of the pitchers' model after it was saved and loaded."""
    root = _folder(spark)
    _model(spark, sf_dir, "pitcher").save(root)
    model = learning.Model.load(root)
    rows = [(c, model.medians[c], w) for c, w in zip(model.columns, model.fitted.coefficients, strict=True)]
    found = spark.createDataFrame(rows, "feature string, median double, coefficient double")
    return found.select("feature", F.round("median", 6).alias("median"), F.round("coefficient", 5).alias("coefficient"))


@query(_predictions_sql(_BOTH, f"date '{AS_OF}'"))
def predictions(spark, sf_dir):
    """Predictions for the scheduled games of one day."""
    day = rolling_one_date(spark, sf_dir)
    return learning.predictions(roster_for_schedule(spark, sf_dir), day, AS_OF, _model(spark, sf_dir, "batter"), _model(spark, sf_dir, "pitcher"))


# ---- Upserts -------------------------------------------------------------------------------------------------------


@query(f"{_GAME}, pair as (select home_team_id as team_id, 'TEAM_' || (home_team_id + season) as name, 2 * game_pk as ord from game union all select away_team_id, 'TEAM_' || (away_team_id + season), 2 * game_pk + 1 from game), seen as (select team_id, name, min(ord) as ord from pair group by all), last as (select team_id, arg_max(name, ord) as name from seen group by team_id) select coalesce(team_id, n_nationkey) as team_id, coalesce(name, n_name) as name from last full join nation on n_nationkey = team_id")
def upsert_teams(spark, sf_dir):
    named = lambda c: F.concat(F.lit("TEAM_"), (F.col(c) + F.col("season")).cast("string"))
    games = fx.games(spark, sf_dir).withColumn("home_team", named("home_team_id")).withColumn("away_team", named("away_team_id"))
    teams = spark.table("nation").select(F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("name"))
    return upsert.upsert_teams(teams, games)


@query(f"with raw as ({fx.FACT_RAW}), known as (select s_suppkey as player_id, s_name as full_name from supplier where s_suppkey % 2 = 0) select * from known union all select distinct player_id, 'Unknown' from raw where player_id not in (select player_id from known)")
def insert_players(spark, sf_dir):
    raw = fx.raw_fact(spark, sf_dir)
    known = spark.table("supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("player_id"), F.col("s_name").alias("full_name"))
    return upsert.insert_players(known, raw)


_G7 = "game_pk, cast(game_date as date) as game_date, season, game_type, {v} as venue_id, home_team_id, away_team_id, nullif(winning_team, '') as winning_team"


@query(f"{_GAME} select {_G7.format(v='venue_id')} from game where game_date < date '{NEW}' union all select {_G7.format(v='cast(venue_id + 100 as int)')} from game where game_date >= date '{NEW}'")
def upsert_games(spark, sf_dir):
    games = fx.games(spark, sf_dir)
    old = games.where(F.col("game_date") < SPLIT).withColumn("winning_team", F.nullif("winning_team", F.lit("")))
    new = games.where(F.col("game_date") >= NEW).withColumn("venue_id", (F.col("venue_id") + 100).cast("int"))
    return upsert.upsert_games(old, new)


@query(f"{_FACT} select {', '.join(f'cast(null as int) as {c}' if c == 'bat_runs' else f'f.{c}' for c in FACT)} from fact f join game g using (game_pk) where game_date >= date '{NEW}' union all select {', '.join(f'f.{c}' for c in FACT)} from fact f join game g using (game_pk) where game_date < date '{NEW}'")
def upsert_fact(spark, sf_dir):
    fact, games, _ = stored(spark, sf_dir)
    dated = lambda cond: fact.join(games.where(cond).select("game_pk"), "game_pk", "left_semi")
    old = dated(F.col("game_date") < SPLIT)
    new = dated(F.col("game_date") >= NEW).withColumn("bat_runs", F.lit(None).cast("int"))
    return upsert.upsert_fact(old, new).select(*FACT)


@query(f"{_ROLL} select * from rolling where as_of_date <= date '{AS_OF}'")
def upsert_rolling(spark, sf_dir):
    fact, games, constants = stored(spark, sf_dir)
    old = rolling.rolling_all_dates(fact, games, constants).where(F.col("as_of_date") <= AS_OF).withColumn("bat_runs", F.when(F.col("as_of_date") < AS_OF, F.col("bat_runs")))
    return upsert.upsert_rolling(old, rolling.rolling_one_date(fact, games, constants, AS_OF))


@query(f"{_BASE}, old as (select game_pk, player_id, 0.1 as p, 'old' as v, timestamp '2001-01-01 00:00:00' as created_at from raw where game_pk % 3 = 0), new as (select game_pk, player_id, 0.2 as p, 'new' as v, timestamp '2001-02-01 00:00:00' as created_at from raw where game_pk % 2 = 0) select coalesce(n.game_pk, o.game_pk) as game_pk, coalesce(n.player_id, o.player_id) as player_id, cast(coalesce(n.p, o.p) as double) as pred_bat_woba, coalesce(n.v, o.v) as model_version_bat, coalesce(o.created_at, n.created_at) as created_at from old o full join new n on n.game_pk = o.game_pk and n.player_id = o.player_id")
def upsert_predictions(spark, sf_dir):
    keys = fx.raw_fact(spark, sf_dir).select("game_pk", "player_id")

    def rows(cond: str, p: float, v: str, at: str) -> DataFrame:
        return keys.where(cond).select(
            "*", F.lit(p).alias("pred_bat_woba"), F.lit(v).alias("model_version_bat"), F.lit(at).cast("timestamp_ntz").alias("created_at")
        )

    return upsert.upsert_predictions(rows("game_pk % 3 = 0", 0.1, "old", "2001-01-01"), rows("game_pk % 2 = 0", 0.2, "new", "2001-02-01"))


@query(f"with c as ({fx.CONSTANTS}), g as ({fx.GAME}), n as (select season, avg(venue_id) as woba from g where season >= 1998 group by season) select cast(coalesce(n.season, c.season) as int) as season, cast(coalesce(n.woba, c.woba) as double) as woba from c full join n on n.season = c.season")
def upsert_constants(spark, sf_dir):
    new = fx.games(spark, sf_dir).where("season >= 1998").groupBy("season").agg(F.avg("venue_id").alias("woba"))
    return upsert.upsert_constants(fx.constants(spark).select("season", "woba"), new)


@query(f"{_BASE} select (select count(distinct t) from (select home_team_id as t from game union all select away_team_id from game)) as teams, count(distinct player_id) as players, (select count(*) from game) as games, count(*) as fact_rows from raw")
def load_counts(spark, sf_dir):
    games = transform.project_games(fx.schedule(fx.games(spark, sf_dir)))
    return upsert.load_counts(games, fx.raw_fact(spark, sf_dir))


# ---- Quality -------------------------------------------------------------------------------------------------------

_AUDIT = "select event_type as pipeline_name, case when event_id % 997 = 0 and event_type = 'signup' then null else cast(ts as timestamp) end as loaded_at from events"


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx.views(spark, sf_dir)
    return spark.sql(_AUDIT)


@query(f"with a as ({_AUDIT}) select pipeline_name, case when bool_or(loaded_at is null) then null else cast(max(loaded_at) as varchar)[:19] end as loaded_at from a group by pipeline_name")
def audit_latest(spark, sf_dir):
    return quality.latest_loads(_audit(spark, sf_dir)).withColumn("loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss"))


@query(f"with a as ({_AUDIT}), l as (select pipeline_name, case when bool_or(loaded_at is null) then null else max(loaded_at) end as t from a group by pipeline_name) select pipeline_name, case when t is null then 'none' when t < timestamp '{NOW}' - interval 24 hour then 'stale' else 'fresh' end as status from l")
def freshness(spark, sf_dir):
    return quality.freshness(_audit(spark, sf_dir), NOW).select("pipeline_name", "status")


@query(f"{_ROLL} select cast(max(as_of_date) as date) as latest, coalesce(max(as_of_date) >= date '{AS_OF}', false) as ready from rolling")
def rolling_ready(spark, sf_dir):
    return quality.rolling_ready(rolling_of(spark, sf_dir), AS_OF)


_BROKEN = f"""select case when game_pk % 50 = 0 then '-' || game_pk when game_pk % 51 = 0 then 'x' || game_pk else cast(game_pk as varchar) end as game_id,
 case when game_pk % 40 = 0 then null else 'h' end as home_name, case when game_pk % 45 = 0 then null else 'a' end as away_name, case when game_pk % 60 = 0 then null else cast(game_date as varchar) end as game_date from game"""


@query(f"{_GAME}, s as ({_BROKEN}) select game_id as key, 'missing home_name' as reason from s where home_name is null union all select game_id, 'missing away_name' from s where away_name is null union all select game_id, 'missing game_date' from s where game_date is null union all select game_id, 'invalid game_id' from s where not coalesce(try_cast(game_id as bigint) > 0, false)")
def validate_schedule(spark, sf_dir):
    pk = F.col("game_pk")
    broken = fx.games(spark, sf_dir).select(
        F.when(pk % 50 == 0, F.concat(F.lit("-"), pk)).when(pk % 51 == 0, F.concat(F.lit("x"), pk)).otherwise(pk.cast("string")).alias("game_id"),
        F.when(pk % 40 != 0, F.lit("h")).alias("home_name"),
        F.when(pk % 45 != 0, F.lit("a")).alias("away_name"),
        F.when(pk % 60 != 0, F.col("game_date").cast("string")).alias("game_date"),
    )
    return quality.schedule_violations(broken)


@query(f"{_GAME}, s as (select game_pk * (case when game_pk % 30 = 0 then -1 else 1 end) as game_pk, case when game_pk % 70 = 0 then 1800 else season end as season, case when game_pk % 80 = 0 then '2001/01/01' when game_pk % 90 = 0 then '2001' else cast(game_date as varchar) end as d from game) select cast(game_pk as varchar) as key, 'invalid game_pk' as reason from s where game_pk <= 0 union all select cast(game_pk as varchar), 'invalid season' from s where season not between 1870 and 2100 union all select cast(game_pk as varchar), 'invalid game_date' from s where not (length(d) >= 10 and d[5] = '-' and d[8] = '-')")
def validate_transformed(spark, sf_dir):
    pk = F.col("game_pk")
    date = F.when(pk % 80 == 0, "2001/01/01").when(pk % 90 == 0, "2001").otherwise(F.col("game_date").cast("string"))
    season = F.when(pk % 70 == 0, 1800).otherwise(F.col("season"))
    broken = fx.games(spark, sf_dir).select(F.when(pk % 30 == 0, -pk).otherwise(pk).alias("game_pk"), season.alias("season"), date.alias("game_date"))
    return quality.transformed_violations(broken)


def _broken_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.players(fx.raw_fact(spark, sf_dir))
    gone = F.col("game_pk") % 33 == 0
    sections = {c: F.when(~gone, F.col(c)) for c in ("batting", "pitching", "fielding")}
    return rows.withColumns(sections | {"team_id": F.when(F.col("game_pk") % 35 != 0, F.col("team_id"))})


@query(f"with raw as ({fx.FACT_RAW}) select cast(player_id as varchar) as key, 'no section' as reason from raw where game_pk % 33 = 0 union all select cast(player_id as varchar), 'missing team_id' from raw where game_pk % 35 = 0")
def validate_stats(spark, sf_dir):
    return quality.stats_violations(_broken_players(spark, sf_dir))


@query(f"with raw as ({fx.FACT_RAW}) select cast(player_id as varchar) as key, 'no section' as reason from raw where game_pk % 33 = 0")
def validate_sections(spark, sf_dir):
    return quality.section_violations(_broken_players(spark, sf_dir))


_GATES = " union all ".join(
    f"select '{reason}' as reason, count(*) filter ({broken}) as broken, min(cast(player_id as varchar)) filter ({broken}) as first_key, count(*) as n_rows from raw"
    for reason, broken in {
        "missing game_pk": "game_pk is null",
        "missing player_id": "player_id is null",
        "missing team_id": "team_id is null or game_pk % 35 = 0",
        "missing position_code": "position_code is null",
        "missing position_name": "position_name is null",
        "no section": "game_pk % 33 = 0",
    }.items()
)


@query(f"with raw as ({fx.FACT_RAW}) {_GATES}")
def gate_counts(spark, sf_dir):
    """What Spark counts for a gate while the rows are written."""
    gate = quality.Gate(quality.stats_rules(), "player_id")
    gate.on(_broken_players(spark, sf_dir)).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(*x, gate.rows) for x in gate.found()], "reason string, broken long, first_key string, n_rows long")


@query(f"{_GAME}, a as (select game_pk from game where game_pk % 7 <> 0 union all select game_pk from game where game_pk % 9 = 0), k as (select game_pk as key, -1 as n from game union all select game_pk, 1 from a) select key, cast(sum(n) as bigint) as difference from k group by key having sum(n) <> 0")
def game_pk_multiset_diff(spark, sf_dir):
    games = fx.games(spark, sf_dir)
    actual = games.where("game_pk % 7 <> 0").unionByName(games.where("game_pk % 9 = 0"))
    return quality.key_difference(games, actual)


@query(f"{_GAME} select count(*) as scheduled, count(*) filter (game_pk % 11 <> 0) as loaded, count(*) = count(*) filter (game_pk % 11 <> 0) as ok from game")
def load_count(spark, sf_dir):
    games = fx.games(spark, sf_dir)
    return quality.load_count(games, games.where("game_pk % 11 <> 0"))


@query(f"{_BASE} select game_pk, player_id from raw where game_pk not in (select game_pk from game where game_pk % 13 <> 0)")
def orphan_facts(spark, sf_dir):
    games = fx.games(spark, sf_dir).where("game_pk % 13 <> 0")
    return quality.orphans(fx.raw_fact(spark, sf_dir), games, "game_pk").select("game_pk", "player_id")


@query("select l_orderkey, l_suppkey, count(*) as n from lineitem group by l_orderkey, l_suppkey having count(*) > 1")
def pk_duplicates(spark, sf_dir):
    fx.views(spark, sf_dir)
    return quality.duplicate_keys(spark.table("lineitem"), ["l_orderkey", "l_suppkey"])


@query(f"{_FACT}, b as (select game_pk, case when game_pk % 41 = 0 then bat_woba + 10 else bat_woba end as w, case when game_pk % 43 = 0 then 'ABCDE' else position_code end as p from fact) select cast(game_pk as varchar) as key, 'bat_woba overflows' as reason from b where w is not null and abs(w) >= 10 union all select cast(game_pk as varchar), 'position_code too long' from b where length(p) > 4 union all select cast(game_pk as varchar), 'pit_fip overflows' from fact where abs(pit_fip) >= 1000")
def fact_constraints(spark, sf_dir):
    pk = F.col("game_pk")
    woba = F.when(pk % 41 == 0, F.col("bat_woba") + 10).otherwise(F.col("bat_woba"))
    code = F.when(pk % 43 == 0, "ABCDE").otherwise(F.col("position_code"))
    return quality.constraint_violations(fact_of(spark, sf_dir).withColumns({"bat_woba": woba, "position_code": code}))


@query(f"with a as (select pipeline_name, loaded_at from ({_AUDIT}) union all select 'click', timestamp '{NOW}') select pipeline_name, case when bool_or(loaded_at is null) then null else cast(max(loaded_at) as varchar)[:19] end as loaded_at, count(*) as loads from a group by pipeline_name")
def audit_append(spark, sf_dir):
    """The audit after one more load."""
    root = _folder(spark)
    tables.append(root, "load_audit", _audit(spark, sf_dir).select("pipeline_name", F.lit(None).cast("date").alias("load_date"), "loaded_at"))
    tables.append(root, "load_audit", upsert.audit_row(spark, "click", NOW))
    audit = spark.read.parquet(f"{root}/load_audit")
    counts = audit.groupBy("pipeline_name").agg(F.count(F.lit(1)).alias("loads"))
    return quality.latest_loads(audit).withColumn("loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss")).join(counts, "pipeline_name")


# ---- Jobs ----------------------------------------------------------------------------------------------------------


def _folder(spark: SparkSession) -> str:
    """A new folder for tables, in the folder that the cluster shares."""
    return f"{checkpoint_folder(spark)}/{uuid.uuid4().hex}"




def _loaded(spark, sf_dir, *days: str) -> str:
    """A folder with the tables after the given days (YYYY-MM-DD) were loaded, in this order, from landed JSON."""
    root, games = _folder(spark), fx.games(spark, sf_dir)
    chosen = games.where(F.col("game_date").isin([*days]))
    # Every game is listed twice; the first listing has another venue.
    listed = fx.schedule(chosen.withColumn("venue_id", F.col("venue_id") + 500)).unionByName(fx.schedule(chosen))
    listed.coalesce(1).write.json(f"{root}/schedule")
    raw = _of_days(spark, sf_dir, chosen)
    boxes = f"{root}/boxes"
    fx.boxscore_json(fx.players(raw)).write.parquet(boxes)
    for day in days:
        y, m, d = day.split("-")
        jobs.run_daily_stats(spark, f"{root}/schedule", spark.read.parquet(boxes), fx.constants(spark), root, f"{m}/{d}/{y}", f"{day} 02:00:00")
    return root


_TWO = ("2001-07-06", "2001-07-24")


@query(f"{_FACT} select f.*, cast(g.venue_id as int) as venue_id, p.n as player_rows from fact f join game g using (game_pk) join (select player_id, count(distinct player_id) as n from raw group by player_id) p on p.player_id = f.player_id where g.game_date = date '{_TWO[0]}'")
def daily_load_twice(spark, sf_dir):
    """The fact table after one day was loaded twice, with its games' venues and the number of rows of each player."""
    root = _loaded(spark, sf_dir, _TWO[0], _TWO[0])
    fact, games, players = (tables.read(spark, root, t) for t in ("fact_game_state", "dim_game", "dim_player"))
    once = players.groupBy("player_id").agg(F.count(F.lit(1)).alias("player_rows"))
    return fact.join(games.select("game_pk", "venue_id"), "game_pk").join(once, "player_id")


_ONLY = f"with recursive game as (select * from ({fx.GAME}) where game_date in (date '{_TWO[0]}', date '{_TWO[1]}'))"


@query(f"{_ROLL.replace(f'with recursive game as ({fx.GAME})', _ONLY)} select * from rolling")
def late_game_refresh(spark, sf_dir):
    """The rolling table after a day was loaded and then an earlier one, which reaches into the windows of the first."""
    return tables.read(spark, _loaded(spark, sf_dir, _TWO[1], _TWO[0]), "player_rolling_stats")


_DAYS = f"{_FACT.replace(f'with recursive game as ({fx.GAME})', _ONLY)}"


@query(f"{_DAYS} select player_id, cast(game_date as date) as game_date, max(season) as season, {_SUM}, cast(round(sum({_DEC.format('pit_innings_pitched')}) * 100) as bigint) as pit_innings_hundredths from fact join game using (game_pk) group by player_id, game_date")
def daily_sums_after_late_load(spark, sf_dir):
    """The stored sums of each player and day after a day was loaded and then an earlier one."""
    return tables.read(spark, _loaded(spark, sf_dir, _TWO[1], _TWO[0]), "player_daily").drop("pit_fip_times_ip")


@query(_SQL["late_game_refresh"])
def streamed_loads(spark, sf_dir):
    """The rolling table after two schedule files, the later day first, were loaded by the stream."""
    root, games = _folder(spark), fx.games(spark, sf_dir)
    raw = _of_days(spark, sf_dir, games.where(F.col("game_date").isin([*_TWO])))
    fx.boxscore_json(fx.players(raw)).write.parquet(f"{root}/boxes")
    for day in _TWO[::-1]:
        fx.schedule(games.where(F.col("game_date") == day)).coalesce(1).write.json(f"{root}/landed/{day}")
        given = (f"{root}/landed/*", f"{root}/stream", spark.read.parquet(f"{root}/boxes"), fx.constants(spark), root, f"{day} 02:00:00")
        jobs.follow_landing(spark, *given, files=1).awaitTermination()
    return tables.read(spark, root, "player_rolling_stats")


def _all_stored(spark, sf_dir, training: bool) -> str:
    """A folder with all facts and games, and what a backfill derives from them."""
    root, (fact, games, constants) = _folder(spark), stored(spark, sf_dir)
    tables.write(spark, root, "dim_game", games)
    tables.write(spark, root, "fact_game_state", jobs.placed(fact, games))
    jobs.run_rolling_backfill(spark, root, constants, training)
    tables.append(root, "load_audit", upsert.audit_row(spark, jobs.STATS, f"{AS_OF} 02:00:00"))
    return root


@query(f"{_ROLL} select * from rolling")
def rolling_backfill(spark, sf_dir):
    """The stored rolling table after a backfill."""
    return tables.read(spark, _all_stored(spark, sf_dir, training=False), "player_rolling_stats")


_LATELY = f"game_date >= date '{AS_OF}' - 730"


@query(_predictions_sql(_ridge_sql("batter", _LATELY) + _ridge_sql("pitcher", _LATELY), f"date '{AS_OF}'"))
def predictions_stored(spark, sf_dir):
    """What the prediction job stores for the games of one day, trained on the stored sums of the last 730."""
    root, games = _all_stored(spark, sf_dir, training=True), fx.games(spark, sf_dir)
    today = fx.schedule(games.where(F.col("game_date") == DAY))
    return jobs.run_predictions(spark, today, root, AS_OF, f"{AS_OF} 06:00:00", NOW).drop("created_at")


@query(f"{_GAME} select season, woba, woba_scale, w_bb, cast(null as double) as c_fip from ({_YEARS})")
def constants_job(spark, sf_dir):
    """The stored constants after a landed file was loaded twice."""
    root = _folder(spark)
    years = season_constants(spark, sf_dir)
    keys = {c: CONSTANTS[c] for c in ("woba", "woba_scale", "w_bb")}
    values = F.struct(*(F.col(c).alias(k) for c, k in keys.items()))
    entry = F.struct(F.col("season").cast("string").alias("key"), values.alias("value"))
    years.agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value")).coalesce(1).write.text(f"{root}/landed")
    for _ in range(2):
        jobs.run_constants(spark, f"{root}/landed", root)
    return tables.read(spark, root, "dim_stat_constants").select("season", *keys, "c_fip")


@query(f"{_BASE} select game_pk, player_id from raw where game_pk < 0")
def predictions_none_scheduled(spark, sf_dir):
    """No scheduled games, no rows; no model is needed for that."""
    root = _loaded(spark, sf_dir, _TWO[0])
    none = fx.schedule(fx.games(spark, sf_dir)).where("game_id is null")
    return jobs.run_predictions(spark, none, root, _TWO[0], f"{_TWO[0]} 06:00:00", NOW, days=0).select("game_pk", "player_id")


# ---- Incremental ---------------------------------------------------------------------------------------------------


@query(f"{_GAME} select distinct cast(game_date + cast(i as int) as date) as as_of_date from game, generate_series(0, 29) t(i) where game_date >= date '2001-06-01'")
def affected_dates_of_late_games(spark, sf_dir):
    return affected_dates(fx.schedule(fx.games(spark, sf_dir).where(F.col("game_date") >= "2001-06-01")))
