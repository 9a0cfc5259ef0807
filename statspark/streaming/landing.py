"""Follow a landing folder: each new batch of schedule files leads to recomputed dates, late games included."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statspark.schemas import SCHEDULE, WINDOWS
from statspark.sources.landed import day


def affected_dates(games: DataFrame, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """Dates whose trailing windows hold one of the games: its own and those after it, up to the longest window."""
    own = games.select(day(F.col("game_date")).alias("d")).where("d is not null").distinct()
    return own.select(F.explode(F.sequence("d", F.date_add("d", max(windows) - 1))).alias("as_of_date")).distinct()


def follow(
    spark: SparkSession, path: str, checkpoint: str, handle: Callable[[DataFrame, int], None], files: int | None = None
) -> StreamingQuery:
    """Run ``handle`` on every batch of schedule games that is there, each file once, and stop; a batch has ``files`` at most."""
    reader = spark.readStream.schema(SCHEDULE)
    games = (reader if files is None else reader.option("maxFilesPerTrigger", files)).json(path)
    return games.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(handle).start()
