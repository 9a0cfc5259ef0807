"""The daily jobs: from landed files to tables, and from tables to predictions. Dates are parameters, never the clock."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statspark.operators import features, learning, quality, rolling, upsert
from statspark.operators.transform import enrich, flatten, project_games, scheduled_games
from statspark.schemas import BATTER, PITCHER, WINDOWS, feature_names
from statspark.sources import landed, tables
from statspark.streaming import landing

STATS, PREDICTIONS = "player_stats", "predictions"
#: Numbers of the stream's batches that are loaded; days whose training sums are not up to date.
BATCHES, PENDING = "applied_batches", "training_pending"


def run_daily_stats(
    spark: SparkSession,
    schedule_path: str,
    boxscores: str | DataFrame,
    constants: DataFrame,
    root: str,
    date: str,
    loaded_at: str,
    gate: bool = True,
    least_games: int = 1,
    least_players: int = 1,
) -> DataFrame:
    """``load_day`` from a path of landed schedule files; a path that isn't there yet raises ``FileNotFoundError``."""
    if date is None:
        raise ValueError("a date is needed")
    try:
        schedule = landed.schedule(spark, schedule_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError("the schedule has not landed yet") from e
    return load_day(spark, schedule, boxscores, constants, root, date, loaded_at, gate, least_games, least_players)


def load_day(
    spark: SparkSession,
    schedule: DataFrame,
    boxscores: str | DataFrame,
    constants: DataFrame,
    root: str,
    date: str,
    loaded_at: str,
    gate: bool = True,
    least_games: int = 1,
    least_players: int = 1,
) -> DataFrame:
    """Load one date (MM/DD/YYYY) and refresh the rolling statistics of all dates that it reaches: its own, and later ones if
    it is loaded late. Returns the counts of what was loaded.

    ``boxscores`` is a path of files <game_pk>.json or a table (game_pk, json). Schedule and boxscores are read and parsed
    once: parsed rows are staged, and the gates judge what Spark counted while it wrote them, before any table changes. A
    game that is listed twice counts as it is listed last, at the first load as at later ones; one that has moved from
    another date leaves that date's month, and the old date's statistics are refreshed too. Of stored tables, the months
    and blocks that the games, their old dates and the windows reach are read, however long the history is. Loading a date
    again changes nothing.
    """
    day = dt.datetime.strptime(date, "%m/%d/%Y").date()  # noqa: DTZ007
    with tables.staging(spark) as stage:
        listed = quality.Gate(quality.schedule_rules(), "game_id")
        raw = stage(listed.on(landed.schedule_for(schedule.withColumn("_row", F.monotonically_increasing_id()), date)))
        if listed.rows == 0:
            raise ValueError("no games are scheduled")
        shaped = quality.Gate(quality.transformed_rules(), "game_pk", least_games)
        games = stage(shaped.on(upsert.last_wins(project_games(raw, "_row"), ["game_pk"], "_row")))
        files = boxscores
        if isinstance(boxscores, str):
            files = landed.boxscores(spark, boxscores, [r["game_pk"] for r in games.select("game_pk").where("game_pk is not null").collect()])
        played = quality.Gate(quality.stats_rules(), "player_id", least_players)
        players = stage(flatten(played.on(landed.boxscore_players(files, games))))
        if gate:
            for each in (listed, shaped, played):
                each.require()
            scheduled = raw.select(F.col("game_id").cast("long").alias("game_pk")).distinct()
            quality.require(quality.key_difference(scheduled, games).select("key", F.lit("scheduled and transformed games differ").alias("reason")))
        stored = games.withColumn("game_date", landed.day(F.col("game_date"))).withColumn("winning_team", F.nullif("winning_team", F.lit("")))
        month = tables.months(day, day)
        old_months, old_dates = _places(spark, root, games)
        by = lambda *keys, **more: lambda old, new: upsert.upsert(old, new, list(keys), **more)
        tables.merge(spark, root, "dim_team", upsert.last_wins(upsert.team_pairs(games, "game_pk"), ["team_id"], "ord"), by("team_id"))
        rows = stage(enrich(players, stored, constants))
        named = rows.select("player_id").distinct().withColumn("full_name", F.lit("Unknown"))
        tables.merge(spark, root, "dim_player", named, upsert.insert_players)
        here = games.select("game_pk", F.lit(month[0]).cast("long").alias("here"))

        def facts(old: DataFrame, new: DataFrame) -> DataFrame:
            moved = old.join(here, "game_pk", "left").withColumn(tables.PART, F.coalesce("here", tables.PART)).drop("here")
            return upsert.upsert_fact(moved, new)

        tables.merge(spark, root, "fact_game_state", rows.withColumn(tables.PART, F.lit(month[0]).cast("long")), facts, old_months)
        tables.merge(spark, root, "dim_game", stored.drop("home_team", "away_team", "_row"), by("game_pk"), old_months)
        tables.merge(spark, root, "game_months", games.select("game_pk", F.lit(month[0]).alias("month")), by("game_pk"))
        loaded = tables.read(spark, root, "dim_game", month).where(F.col("game_date") == F.lit(day))
        if gate and not quality.load_count(games, loaded).first()["ok"]:
            raise quality.QualityError("scheduled and loaded games differ in number")
        refresh(spark, root, constants, sorted({day, *old_dates}))
        tables.append(root, "load_audit", upsert.audit_row(spark, STATS, loaded_at, str(day)))
        counts = upsert.load_counts(games, rows).collect()
    return spark.createDataFrame(counts, "teams long, players long, games long, fact_rows long")


def _places(spark: SparkSession, root: str, games: DataFrame) -> tuple[list[int], list[dt.date]]:
    """Months and dates under which the games of a load are stored so far."""
    if not tables.exists(spark, root, "game_months"):
        return [], []
    blocks = [r["b"] for r in games.select(F.floor(F.col("game_pk") / tables.BLOCK).alias("b")).distinct().collect()]
    known = tables.read(spark, root, "game_months", blocks).join(games.select("game_pk"), "game_pk", "left_semi")
    months = [r["month"] for r in known.select("month").distinct().collect()]
    before = tables.read(spark, root, "dim_game", months).join(games.select("game_pk"), "game_pk", "left_semi")
    return months, [r["game_date"] for r in before.select("game_date").distinct().collect() if r["game_date"] is not None]


def placed(fact: DataFrame, games: DataFrame) -> DataFrame:
    """Facts with the month of their game, as ``tables.write`` stores them."""
    return fact.join(games.select("game_pk", tables.month(F.col("game_date")).alias(tables.PART)), "game_pk")


def refresh(spark: SparkSession, root: str, constants: DataFrame, dates: list[dt.date]) -> DataFrame:
    """Bring the daily sums of some dates up to date, and the rolling statistics of all dates whose windows hold one of them.

    Facts are read for the given dates alone; the windows are put together from stored daily sums.
    """
    own = sorted({m for d in dates for m in tables.months(d, d)})
    games = tables.read(spark, root, "dim_game", own).where(F.col("game_date").isin(dates))
    sums = rolling.daily(tables.read(spark, root, "fact_game_state", own), games)
    reached = sorted({d + dt.timedelta(days=i) for d in dates for i in range(max(WINDOWS))})
    near = sorted({m for d in reached for m in tables.months(*rolling.reaching([d]))})
    with tables.staging(spark) as stage:
        swap = lambda on, column: lambda old, new: upsert.replace_dates(old, new, on, column)
        tables.merge(spark, root, "player_daily", stage(sums), swap(dates, "game_date"), own)
        days = tables.read(spark, root, "player_daily", near)
        rows = stage(rolling.rolling_of_days(days, constants, reached))
        months = {m for d in reached for m in tables.months(d, d)}
        stats = tables.merge(spark, root, "player_rolling_stats", rows, swap(reached, "as_of_date"), months)
    later = sorted({*dates, *(d + dt.timedelta(days=1) for d in reached)})
    tables.append(root, PENDING, spark.createDataFrame([(d,) for d in later], "day date").coalesce(1))
    return stats


def refresh_training(spark: SparkSession, root: str) -> None:
    """Bring the training sums of the days up to date that loads have touched since the last call."""
    if not tables.exists(spark, root, PENDING):
        return
    days = sorted(r["day"] for r in spark.read.parquet(f"{root}/{PENDING}").distinct().collect())
    months = {m for d in days for m in tables.months(d, d)}
    with tables.staging(spark) as stage:
        for name, sums in _training_sums(spark, root, stage, days).items():
            tables.merge(spark, root, name, stage(sums), lambda old, new: upsert.replace_dates(old, new, days, "day"), months)
    tables.remove(spark, f"{root}/{PENDING}")


MODELS = {"batter": (features.batter_training, BATTER), "pitcher": (features.pitcher_training, PITCHER)}


def _training_sums(
    spark: SparkSession, root: str, stage: Callable[[DataFrame], DataFrame], days: list[dt.date] | None = None
) -> dict[str, DataFrame]:
    """Gram matrices and value counts of both models' training rows, by day, of some days or of all.

    The rows are staged once, the rows of a day together: a matrix is larger than many rows, and tasks that met all days
    would each shuffle a matrix for every day.
    """
    if days is None:
        first, last, own, before = dt.date(1, 1, 2), dt.date(9999, 12, 31), None, None
    else:
        first, last = min(days), max(days)
        own = sorted({m for d in days for m in tables.months(d, d)})
        before = sorted({m for d in days for m in tables.months(d - dt.timedelta(days=1), d)})
    fact, games = (tables.read(spark, root, t, own) for t in ("fact_game_state", "dim_game"))
    stats = tables.read(spark, root, "player_rolling_stats", before)
    every = features.training_of_both(fact, games, stats, str(first), str(last))
    every = every if days is None else every.where(F.col("game_date").isin(days))
    every = stage(every.repartition("game_date").sortWithinPartitions("game_date"))
    products, values = [], []
    for model, (_, columns) in MODELS.items():
        rows = every.withColumn("label", F.col(f"label_{model}")).where("label is not null")
        products.append(learning.grams(rows, feature_names(columns)).withColumn("model", F.lit(model)))
        counts = learning.value_counts(rows, feature_names(columns), "game_date")
        values.append(counts.withColumnRenamed("game_date", "day").withColumn("model", F.lit(model)))
    return {"training_products": products[0].unionByName(products[1]), "training_values": values[0].unionByName(values[1])}


def follow_landing(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    boxscores: str | DataFrame,
    constants: DataFrame,
    root: str,
    loaded_at: str,
    gate: bool = True,
    files: int | None = None,
) -> StreamingQuery:
    """Load every date of the schedule files that have landed since the last call, batch by batch, and stop.

    A batch counts once: its number is stored after its dates are loaded, and a batch that comes again is passed over. One
    that broke off half-way is loaded again, which changes nothing about what it had loaded. ``files`` bounds a batch.
    """

    def apply(batch: DataFrame, number: int) -> None:
        if tables.exists(spark, root, BATCHES) and spark.read.parquet(f"{root}/{BATCHES}").where(F.col("batch") == number).count():
            return
        with tables.staging(spark) as stage:
            games = stage(batch)
            dates = games.select(F.date_format(landed.day(F.col("game_date")), "MM/dd/yyyy").alias("d")).where("d is not null").distinct()
            for date in sorted((r["d"] for r in dates.collect()), key=lambda d: (d[6:], d)):
                load_day(spark, games, boxscores, constants, root, date, loaded_at, gate)
        tables.append(root, BATCHES, spark.range(1).select(F.lit(number).cast("long").alias("batch")))

    return landing.follow(spark, path, checkpoint, apply, files)


def run_predictions(spark: SparkSession, schedule: DataFrame, root: str, as_of: str, now: str, trained_at: str, days: int = 730) -> DataFrame:
    """Train both models on the last ``days``, score the players of the scheduled games, store and return the rows.

    Training adds up the stored sums of those days. Facts and features are read for the days alone that loads have touched
    since the last training.
    Without scheduled players no model is read and there are no rows.
    """
    quality.require_fresh(spark.read.parquet(f"{root}/load_audit"), STATS, now)
    last = dt.date.fromisoformat(as_of)
    since = tables.months(first := last - dt.timedelta(days=max(days, 8) + 1), first)[0]
    stats, fact, games = (tables.read(spark, root, t, since=since) for t in ("player_rolling_stats", "fact_game_state", "dim_game"))
    if not quality.rolling_ready(stats, as_of).first()["ready"]:
        raise quality.QualityError("rolling statistics do not reach the day before")
    span = features.training_range(games, fact, as_of, days).first()
    if span["min_date"] is not None:
        refresh_training(spark, root)
        known = all(tables.exists(spark, root, name) for name in ("training_values", "training_products"))
        for model, (_, columns) in MODELS.items() if known else ():
            own = {}
            for name in ("training_values", "training_products"):
                sums = tables.read(spark, root, name, since=tables.months(span["min_date"], span["min_date"])[0])
                own[name] = sums.where((F.col("model") == model) & F.col("day").between(F.lit(span["min_date"]), F.lit(span["max_date"])))
            learning.train_from_sums(*own.values(), feature_names(columns), trained_at, path=f"{root}/models/{model}")
    day = F.lit(as_of).cast("date")
    players = features.roster(scheduled_games(schedule), fact, games, day)
    at = F.lit(now).cast("timestamp").alias("created_at")
    if players.isEmpty():
        tables.append(root, "load_audit", upsert.audit_row(spark, PREDICTIONS, now))
        return learning.no_predictions(players).select("*", at)
    models = [learning.Model.load(f"{root}/models/{m}") for m in ("batter", "pitcher")]
    with tables.staging(spark) as stage:
        rows = stage(learning.predictions(players, stats.where(F.col("as_of_date") == day), as_of, *models).select("*", at))
        stored = tables.merge(spark, root, "predictions", rows, upsert.upsert_predictions)
    tables.append(root, "load_audit", upsert.audit_row(spark, PREDICTIONS, now))
    return stored.join(players, ["game_pk", "player_id"], "left_semi")


def run_rolling_backfill(spark: SparkSession, root: str, constants: DataFrame, training: bool = True) -> DataFrame:
    """Daily sums, rolling statistics and (``training``) training sums of all dates, each in one pass."""
    fact, games = (tables.read(spark, root, t) for t in ("fact_game_state", "dim_game"))
    days = tables.write(spark, root, "player_daily", rolling.daily(fact, games))
    stats = tables.write(spark, root, "player_rolling_stats", rolling.rates(rolling.windowed(days), constants))
    if training:
        with tables.staging(spark) as stage:
            for name, sums in _training_sums(spark, root, stage).items():
                tables.write(spark, root, name, sums)
        tables.remove(spark, f"{root}/{PENDING}")
    return stats


def run_constants(spark: SparkSession, path: str, root: str) -> DataFrame:
    """Upsert the season constants of landed files {year: {key: value}}; of a season that is listed twice, an error."""
    with tables.staging(spark) as stage:
        rows = stage(landed.season_constants(spark.read.text(path, wholetext=True), "value"))
        stored = tables.merge(spark, root, "dim_stat_constants", rows, upsert.upsert_constants)
    return stored
