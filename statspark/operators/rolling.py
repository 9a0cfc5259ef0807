"""Trailing statistics of players over the last 7 and 30 days."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statspark.functions.metrics import apart, reached, rounded, share, weighted_on_base
from statspark.operators.transform import with_constants
from statspark.schemas import HELPERS, ROLLING, ROLLING_SUMS, WINDOWS

#: Innings in hundredths and innings-weighted FIP in ten thousandths: whole numbers, so that sums of a window are exact
#: differences of running sums and do not depend on the order of rows.
INNINGS, WEIGHTED = "pit_innings_hundredths", "pit_fip_times_ip"
SUMS = [*ROLLING_SUMS, INNINGS, WEIGHTED]


def games_of(fact: DataFrame, games: DataFrame) -> DataFrame:
    """Fact rows with their game's date and season."""
    return fact.join(games.select("game_pk", "game_date", "season"), "game_pk")


def _measures() -> dict[str, Column]:
    hundredths = lambda c: F.coalesce(F.round(F.col(c) * 100).cast("long"), F.lit(0))
    plain = {c: F.coalesce(F.col(c).cast("long"), F.lit(0)) for c in ROLLING_SUMS}
    return plain | {INNINGS: hundredths("pit_innings_pitched"), WEIGHTED: hundredths("pit_fip") * hundredths("pit_innings_pitched")}


def daily(fact: DataFrame, games: DataFrame) -> DataFrame:
    """Sums of each player and date; several games of a day come together here, before anything is sorted.

    Rows are shuffled by player, which serves the windows too.
    """
    rows = games_of(fact, games).select("player_id", "game_date", "season", *(x.alias(c) for c, x in _measures().items()))
    sums = [F.sum(c).alias(c) for c in SUMS]
    return rows.repartition("player_id").groupBy("player_id", "game_date").agg(F.max("season").alias("season"), *sums)


def _active(of: Callable[[str], Column]) -> Column:
    return of("bat_games_played") + of("pit_games_played") + of("fld_chances") > 0


def active(rows: DataFrame) -> DataFrame:
    return rows.where(_active(F.col))


def _edges(days: DataFrame, windows: tuple[int, ...], followed: bool = False) -> DataFrame:
    """player_id, as_of_date, season and, of every sum and window, ``_<n>_<sum>``; sums that nobody reads are not made.

    Running sums are taken once; a window's sums are the difference between those of its own date and those of the last
    date before it. Every frame only grows, so a row costs the same however many dates a window holds, and all windows
    share one shuffle and one sort. A season covers later dates than the one before it, so the latest row has the greatest.
    """
    by_date = Window.partitionBy("player_id").orderBy(F.datediff("game_date", F.lit("1970-01-01")))
    so_far = by_date.rowsBetween(Window.unboundedPreceding, 0)
    running = days.select("player_id", "game_date", "season", *(F.sum(c).over(so_far).alias(c) for c in SUMS))
    before = {f"_{n}_{c}": F.last(c).over(by_date.rangeBetween(Window.unboundedPreceding, -n)) for n in windows for c in SUMS}
    after = [F.lead("game_date").over(by_date).alias("_after")] if followed else []
    edges = running.select("player_id", F.col("game_date").alias("as_of_date"), "season", *SUMS, *(x.alias(c) for c, x in before.items()), *after)
    if followed:
        edges = edges.where(F.col("_after") == F.date_add("as_of_date", 1))
    between = [(F.col(c) - F.coalesce(f"_{n}_{c}", F.lit(0))).alias(f"_{n}_{c}") for n in windows for c in SUMS]
    return edges.select("player_id", "as_of_date", "season", *between)


def windowed(days: DataFrame, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """Sums of all windows for every player and date with a row in ``days`` (see ``daily``)."""
    sums = lambda n: F.struct(F.lit(n).cast("smallint").alias("window_days"), *(F.col(f"_{n}_{c}").alias(c) for c in SUMS))
    edges = _edges(days, windows).withColumn("season", apart(F.col("season")))
    return active(edges.select("player_id", "as_of_date", "season", F.inline(F.array(*map(sums, windows)))))


def sums_all_dates(fact: DataFrame, games: DataFrame, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """The same from facts."""
    return windowed(daily(fact, games), windows)


def players_on(fact: DataFrame, games: DataFrame, as_of: Column) -> DataFrame:
    """Players with a fact row on a date."""
    return fact.join(games.where(F.col("game_date") == as_of).select("game_pk"), "game_pk", "left_semi").select("player_id").distinct()


def sums_one_date(fact: DataFrame, games: DataFrame, as_of: str, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """Sums for the players of one date. Facts are read once: each row counts in every window that reaches it."""
    day = F.lit(as_of).cast("date")
    recent = games.where((F.col("game_date") > F.date_sub(day, max(windows))) & (F.col("game_date") <= day))
    rows = games_of(fact, recent).join(players_on(fact, recent, day), "player_id", "left_semi")
    reaching = F.filter(F.array(*(F.lit(n).cast("smallint") for n in windows)), lambda n: F.col("game_date") > F.date_sub(day, n))
    rows = rows.withColumn("window_days", F.explode(reaching))
    sums = [F.sum(x).alias(c) for c, x in _measures().items()]
    result = rows.groupBy("player_id", "window_days").agg(F.max("season").alias("season"), *sums)
    return active(result.withColumn("as_of_date", day))


def _values(of: Callable[[str], Column]) -> dict[str, Column]:
    """Counts and rates of the rolling table from the sums that ``of`` names and the constants ``c``."""
    c = lambda name: F.col(f"c.{name}")
    b = lambda name: of(f"bat_{name}")
    base = reached(b("at_bats"), b("base_on_balls"), b("intentional_walks"), b("sac_flies"), b("hit_by_pitch"))
    singles = b("hits") - b("home_runs") - b("doubles") - b("triples")
    weights = weighted_on_base(c, b("base_on_balls"), b("hit_by_pitch"), singles, b("doubles"), b("triples"), b("home_runs"))
    woba = weights / base.cast("double")
    ip = of(INNINGS) / 100.0
    some, bats = base > 0, b("at_bats") > 0
    on_base = (b("base_on_balls") + b("hit_by_pitch") + b("hits")) / base.cast("double")
    value = {
        "bat_avg": share(b("hits"), b("at_bats"), 4),
        "bat_ops": F.when(bats & some, rounded(on_base + b("total_bases") / b("at_bats").cast("double"), 4)),
        "bat_woba": F.when(some, rounded(woba, 4)),
        "bat_wrc_plus": F.when(
            some & (b("plate_appearances") > 0),
            rounded((woba - c("woba")) / c("woba_scale") + c("r_per_pa") * b("plate_appearances"), 2),
        ),
        "pit_innings_pitched": F.when(ip > 0, rounded(ip, 2)),
        "pit_era": F.when(ip > 0, rounded(9.0 * of("pit_earned_runs") / ip, 2)),
        "pit_fip": F.when(ip > 0, rounded(of(WEIGHTED) / 10000.0 / ip, 2)),
        "pit_whip": F.when(ip > 0, rounded((of("pit_hits") + of("pit_base_on_balls")) / ip, 2)),
    }
    return value | {n: F.nullif(of(n), F.lit(0)) for n in ROLLING_SUMS if n not in HELPERS}


def rates(sums: DataFrame, constants: DataFrame) -> DataFrame:
    """The rolling table's columns: counts that are 0 become null, rates are null without a base."""
    value = {"window_days": apart(F.col("window_days"))} | _values(F.col)
    return with_constants(sums, constants).select(*(value.get(n, F.col(n)).alias(n) for n in ROLLING))


def rolling_all_dates(fact: DataFrame, games: DataFrame, constants: DataFrame) -> DataFrame:
    return rates(sums_all_dates(fact, games), constants)


def wide_all_dates(
    fact: DataFrame, games: DataFrame, constants: DataFrame, columns: list[str], windows: tuple[int, ...] = WINDOWS, followed: bool = False
) -> DataFrame:
    """``features.wide`` of ``rolling_all_dates``: windows stay side by side, and sums that no column needs are not made.

    ``followed``: only dates on whose next day the player has a row too, which are all that training rows ask for.
    """
    edges = _edges(daily(fact, games), windows, followed)
    rows = with_constants(edges, constants)
    of = {n: lambda c, n=n: F.col(f"_{n}_{c}") for n in windows}
    some = {n: _active(of[n]) for n in windows}
    value = {n: _values(of[n]) for n in windows}
    found = [F.when(some[n], value[n][c]).alias(f"{c}_{n}") for n in windows for c in columns]
    return rows.where(functools.reduce(Column.__or__, some.values())).select("player_id", "as_of_date", *found)


def reaching(dates: list[dt.date]) -> tuple[dt.date, dt.date]:
    """First and last date whose games count for one of the dates."""
    return min(dates) - dt.timedelta(days=max(WINDOWS) - 1), max(dates)


def rolling_of_days(days: DataFrame, constants: DataFrame, dates: list[dt.date]) -> DataFrame:
    """Rolling statistics of some dates from daily sums, of which those that reach none of the dates are left out."""
    first, last = reaching(dates)
    near = days.where(F.col("game_date").between(F.lit(first), F.lit(last)))
    return rates(windowed(near).where(F.col("as_of_date").isin(dates)), constants)


def rolling_one_date(fact: DataFrame, games: DataFrame, constants: DataFrame, as_of: str) -> DataFrame:
    return rates(sums_one_date(fact, games, as_of), constants)
