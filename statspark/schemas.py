"""Column lists and input schemas."""

from __future__ import annotations

# The fact table's columns in order, by section.
CONTEXT = ["game_pk", "player_id", "team_id", "position_code", "position_name"]
# Fixed values.
BATTING = [
    "bat_games_played", "bat_runs", "bat_hits", "bat_doubles", "bat_triples", "bat_home_runs", "bat_strike_outs", "bat_base_on_balls",
    "bat_at_bats", "bat_plate_appearances", "bat_rbi", "bat_stolen_bases", "bat_caught_stealing", "bat_woba", "bat_wrc_plus", "bat_ops",
    "bat_babip", "bat_home_run_rate", "bat_fly_outs", "bat_ground_outs", "bat_air_outs", "bat_intentional_walks", "bat_hit_by_pitch",
    "bat_ground_into_double_play", "bat_total_bases", "bat_left_on_base", "bat_sac_bunts", "bat_sac_flies",
]
# Fixed values.
PITCHING = [
    "pit_games_played", "pit_games_started", "pit_innings_pitched", "pit_wins", "pit_losses", "pit_saves", "pit_hits", "pit_earned_runs",
    "pit_strike_outs", "pit_base_on_balls", "pit_fip", "pit_babip", "pit_home_run_rate", "pit_batters_faced", "pit_outs", "pit_holds",
    "pit_blown_saves", "pit_save_opportunities", "pit_pitches_thrown", "pit_balls", "pit_strikes", "pit_hit_batsmen", "pit_balks",
    "pit_wild_pitches", "pit_pickoffs", "pit_inherited_runners", "pit_inherited_runners_scored",
]
# Fixed values.
FIELDING = [
    "fld_assists", "fld_put_outs", "fld_errors", "fld_chances", "fld_fielding_runs", "fld_passed_ball", "fld_pickoffs",
]
FACT = CONTEXT + BATTING + PITCHING + FIELDING
# Columns that the library computes, with the decimal places that the fact table keeps.
METRICS = {
    "bat_woba": 4,
    "bat_wrc_plus": 2,
    "bat_ops": 4,
    "bat_babip": 4,
    "bat_home_run_rate": 4,
    "pit_innings_pitched": 2,
    "pit_fip": 2,
    "pit_babip": 4,
    "pit_home_run_rate": 4,
    "fld_fielding_runs": 4,
}
# Counts that only the metrics need; the fact table does not keep them.
EXTRA = ["pit_home_runs", "pit_at_bats", "pit_fly_outs", "pit_sac_flies", "pit_hit_by_pitch"]
#: Metrics that are taken from landed JSON, by their key: a number is kept, other values count as nothing.
LANDED_METRICS = {"bat_babip": "babip", "bat_home_run_rate": "home_run_rate"}
INNINGS_KEY = "inningsPitched"
SECTIONS = {"bat": "batting", "pit": "pitching", "fld": "fielding"}
COUNTS = [c for c in BATTING + PITCHING + FIELDING if c not in METRICS]

# Features of the two models, for each window.
BATTER = [
    "bat_games_played", "bat_plate_appearances", "bat_at_bats", "bat_runs", "bat_hits", "bat_doubles", "bat_triples", "bat_home_runs",
    "bat_rbi", "bat_strike_outs", "bat_base_on_balls", "bat_stolen_bases", "bat_caught_stealing", "bat_avg", "bat_ops", "bat_woba",
    "bat_wrc_plus", "pit_games_played", "pit_innings_pitched", "pit_era", "pit_fip", "pit_whip",
]
# Fixed values.
PITCHER = [
    "pit_games_played", "pit_innings_pitched", "pit_wins", "pit_losses", "pit_saves", "pit_hits", "pit_earned_runs", "pit_strike_outs",
    "pit_base_on_balls", "pit_era", "pit_fip", "pit_whip", "bat_games_played", "bat_plate_appearances", "bat_woba", "bat_wrc_plus",
]
WINDOWS = (7, 30)

# Measures that the windows sum.
ROLLING_SUMS = [
    "bat_games_played", "bat_plate_appearances", "bat_at_bats", "bat_runs", "bat_hits", "bat_doubles", "bat_triples", "bat_home_runs",
    "bat_rbi", "bat_strike_outs", "bat_base_on_balls", "bat_stolen_bases", "bat_caught_stealing", "bat_intentional_walks",
    "bat_hit_by_pitch", "bat_sac_flies", "bat_total_bases", "pit_games_played", "pit_wins", "pit_losses", "pit_saves", "pit_hits",
    "pit_earned_runs", "pit_strike_outs", "pit_base_on_balls", "fld_assists", "fld_put_outs", "fld_errors", "fld_chances",
]
# Those of them that the rolling table does not keep.
HELPERS = ["bat_intentional_walks", "bat_hit_by_pitch", "bat_sac_flies", "bat_total_bases"]
# Rates of the rolling table.
RATES = [
    "bat_avg", "bat_ops", "bat_woba", "bat_wrc_plus", "pit_innings_pitched", "pit_era", "pit_fip", "pit_whip",
]
# The rolling table's columns in order.
ROLLING = ["player_id", "as_of_date", "window_days", *[c for c in ROLLING_SUMS if c not in HELPERS], *RATES]

# Key in the landed JSON of each season constant's column.
CONSTANTS = {
    "woba": "wOBA",
    "woba_scale": "wOBAScale",
    "w_bb": "wBB",
    "w_hbp": "wHBP",
    "w_1b": "w1B",
    "w_2b": "w2B",
    "w_3b": "w3B",
    "w_hr": "wHR",
    "r_per_pa": "R/PA",
    "c_fip": "cFIP",
}

SCHEDULE = """game_id string, game_type string, status string, home_name string, away_name string, home_id int, away_id int,
 game_date string, venue_id int, season int, winning_team string"""
_SIDE = """struct<score: int, isWinner: boolean, splitSquad: boolean, seriesNumber: int,
 leagueRecord: struct<wins: int, losses: int, pct: string>, team: struct<id: int, name: string, link: string>>"""
METADATA = f"""game_pk bigint, link string, gameType string, season string, gameDate string, officialDate string, isTie boolean,
 gameNumber int, publicFacing boolean, doubleHeader string, gamedayType string, tiebreaker string, calendarEventID string,
 seasonDisplay string, dayNight string, scheduledInnings int, reverseHomeAwayStatus boolean, inningBreakLength int,
 gamesInSeries int, seriesGameNumber int, seriesDescription string, recordSource string, ifNecessary string,
 ifNecessaryDescription string,
 status struct<abstractGameState: string, codedGameState: string, detailedState: string, statusCode: string,
  startTimeTBD: boolean, abstractGameCode: string>,
 teams struct<away: {_SIDE}, home: {_SIDE}>, venue struct<id: int, name: string, link: string>, content struct<link: string>"""
# What a missing field of the metadata counts as.
METADATA_DEFAULTS = {
    "isTie": False,
    "gameNumber": 1,
    "publicFacing": True,
    "doubleHeader": "N",
    "gamedayType": "P",
    "tiebreaker": "N",
    "calendarEventID": "",
    "seasonDisplay": "",
    "dayNight": "D",
    "scheduledInnings": 9,
    "reverseHomeAwayStatus": False,
    "inningBreakLength": 120,
    "gamesInSeries": 1,
    "seriesGameNumber": 1,
    "seriesDescription": "",
    "recordSource": "N",
    "ifNecessary": "N",
    "ifNecessaryDescription": "",
}


def json_key(column: str) -> str:
    """Key of a count in its JSON section: the column's name without prefix, in camel case."""
    first, *rest = column.split("_")[1:]
    return first + "".join(w.title() for w in rest)


def _section(prefix: str) -> str:
    """Struct of a section's known keys. Counts are kept as they are written, as number or text; of the values whose JSON type
    matters the type is kept as well."""
    counts = [f"{json_key(c)}: string" for c in COUNTS + EXTRA if c.startswith(prefix)]
    typed = [f"{key}: variant" for c, key in LANDED_METRICS.items() if c.startswith(prefix)]
    return f"struct<{', '.join(counts + typed + [f'{INNINGS_KEY}: string'] * (prefix == 'pit'))}>"


def boxscore() -> str:
    """Schema of a landed boxscore, down to the keys that the library knows."""
    stats = ", ".join(f"{name}: {_section(prefix)}" for prefix, name in SECTIONS.items())
    player = f"""struct<person: struct<id: int>, parentTeamId: int, position: struct<code: string, name: string>,
 stats: struct<{stats}>>"""
    return f"teams map<string, struct<players: map<string, {player}>>>"


def feature_names(columns: list[str]) -> list[str]:
    """Names of the wide features in their fixed order: all of the first window, then all of the second."""
    return [f"{c}_{n}" for n in WINDOWS for c in columns]
