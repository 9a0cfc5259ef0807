"""Stored tables: plain Parquet, partitioned by month or by blocks of numbers.

A load reads and rewrites the partitions that it touches, and these are named in the plan, so that every scan of a stored
table has partition filters and a day's load reads as many files however long the history is.
"""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: So many neighbouring numbers of games or players stand in one partition. Its rows are few bytes each, and the games of a
#: day may lie anywhere: small blocks would give a day as many partitions as it has games.
BLOCK = 1_000_000
PART = "part"


def month(date: Column) -> Column:
    """Number of a date's month as yyyymm; 0 without a date."""
    return F.coalesce(F.year(date) * 100 + F.month(date), F.lit(0))


def months(first: dt.date, last: dt.date) -> list[int]:
    """Numbers of the months from one date's to another's."""
    span = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [m // 12 * 100 + m % 12 + 1 for m in span]


#: Partition of each table's rows. Facts are offered with the month of their game, which ``game_months`` keeps by game.
PARTITIONS: dict[str, Callable[[], Column]] = {
    "dim_team": lambda: F.lit(0),
    "dim_player": lambda: F.floor(F.col("player_id") / BLOCK),
    "dim_game": lambda: month(F.col("game_date")),
    "game_months": lambda: F.floor(F.col("game_pk") / BLOCK),
    "fact_game_state": lambda: F.col(PART),
    "player_daily": lambda: month(F.col("game_date")),
    "player_rolling_stats": lambda: month(F.col("as_of_date")),
    "training_products": lambda: month(F.col("day")),
    "training_values": lambda: month(F.col("day")),
    "dim_stat_constants": lambda: F.lit(0),
    "predictions": lambda: F.floor(F.col("game_pk") / BLOCK),
}


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _stored(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The stored rows, or None where there is no table yet. Every failure to read one that is there is an error."""
    folder, files = _folder(spark, f"{root}/{name}")
    if not files.exists(folder):
        return None
    try:
        return spark.read.parquet(f"{root}/{name}")
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without any file
            return None
        raise


def exists(spark: SparkSession, root: str, name: str) -> bool:
    return _stored(spark, root, name) is not None


def read(
    spark: SparkSession, root: str, name: str, parts: Iterable[int] | None = None, since: int | None = None, keep: bool = False
) -> DataFrame:
    """Rows of a table, of some partitions or of those from one on if they are given; ``keep``: with the partition's number."""
    rows = spark.read.parquet(f"{root}/{name}")
    if parts is not None:
        rows = rows.where(F.col(PART).isin(sorted(parts)))
    if since is not None:
        rows = rows.where(F.col(PART) >= since)
    return rows if keep else rows.drop(PART)


def parted(name: str, rows: DataFrame) -> DataFrame:
    return rows.withColumn(PART, PARTITIONS[name]().cast("long"))


def remove(spark: SparkSession, path: str) -> None:
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def write(spark: SparkSession, root: str, name: str, rows: DataFrame, touched: Iterable[int] = ()) -> DataFrame:
    """Replace the partitions that ``rows`` touch; the others stay, but for ``touched`` ones without rows, which go."""
    rows, touched, seen = parted(name, rows), sorted(touched), Observation()
    if touched:
        rows = rows.observe(seen, F.collect_set(PART).alias("parts"))
    out = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(PART)
    with shuffles_freed(spark):
        out.parquet(f"{root}/{name}")
    for p in sorted({*touched} - {*seen.get["parts"]}) if touched else ():
        remove(spark, f"{root}/{name}/{PART}={p}")
    stored = _stored(spark, root, name)
    return (rows.limit(0) if stored is None else stored).drop(PART)


def merge(
    spark: SparkSession,
    root: str,
    name: str,
    rows: DataFrame,
    how: Callable[[DataFrame, DataFrame], DataFrame],
    also: Iterable[int] = (),
) -> DataFrame:
    """Write ``how(stored rows, rows)``, both with their partition's number.

    Of the stored rows, those of the partitions that ``rows`` touch and of ``also`` are read, at a first load none. The
    touched partitions are few; ``rows`` are run for their numbers and for the write, so they should be read from a table.
    """
    rows = parted(name, rows)
    touched = {r[PART] for r in rows.select(PART).distinct().collect()} | {*also}
    stored = _stored(spark, root, name)
    old = rows.limit(0) if stored is None else stored.where(F.col(PART).isin(sorted(touched))).withColumn(PART, F.col(PART).cast("long"))
    return write(spark, root, name, how(old, rows), touched)


def append(root: str, name: str, rows: DataFrame) -> None:
    rows.write.mode("append").parquet(f"{root}/{name}")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of an action go when it has ended and its result is written, and not when the driver's garbage
    is collected. Only for code that writes what it uses again; an executor that is lost on the way matters as little as ever."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A function that writes rows to the shared folder and gives them back as a table, which goes when the block ends."""
    made: list[str] = []

    def stage(rows: DataFrame) -> DataFrame:
        made.append(f"{checkpoint_folder(spark)}/{uuid.uuid4().hex}")
        with shuffles_freed(spark):
            rows.write.option("compression", "zstd").parquet(made[-1])
        return spark.read.schema(rows.schema).parquet(made[-1])

    try:
        yield stage
    finally:
        for path in made:
            remove(spark, path)


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only a session on one machine may lack the setting; it gets a temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None and context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir()
