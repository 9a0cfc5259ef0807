"""Small helpers that the corpus operators have in common."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statspark.sources.tables import shuffles_freed as shuffles_freed

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: ASCII characters that separate words made of digits, letters and everything beyond ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same rule for bytes: separators become spaces and A-Z become lower case.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared_folder(df: DataFrame) -> str:
    """The checkpoint folder that the cluster shares: the session's ``spark.checkpoint.dir``.

    Only a session on one machine may lack the setting; it gets a temporary folder.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None and context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir()


def materialised(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, which survives lost executors."""
    _shared_folder(df)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """The same for larger rows: a compressed table in the checkpoint folder, of which later steps read columns."""
    path = f"{_shared_folder(df)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone. Pure ASCII texts take the fast built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def plain_words(text: Column) -> Column:
    """Array of lower-cased words between ASCII separators; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def in_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` for functions of this package, which the workers get with the job if they lack it."""
    context = df.sparkSession.sparkContext
    if not getattr(context, "_statspark_shipped", False):
        root = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="statspark-")) / "statspark.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for source in root.rglob("*.py"):
                z.write(source, f"{root.name}/{source.relative_to(root)}")
        context.addPyFile(str(archive))
        context._statspark_shipped = True
    return df.mapInArrow(function, schema)


#: Up to so many ids (8 bytes each) are broadcast to pick rows; beyond, they are joined by shuffling.
KEY_LIMIT = 1_000_000


def bounded(keys: DataFrame) -> DataFrame:
    """Keys, written once, with a hint to broadcast them if they are few enough for it."""
    keys = materialised(keys)
    return F.broadcast(keys) if keys.count() <= KEY_LIMIT else keys


def without_rows(docs: DataFrame, gone: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is not in the one column of ``gone``; nulls match nothing, names may clash."""
    ids = bounded(gone.select(F.col(gone.columns[0]).alias("id")).where("id is not null").distinct())
    return docs.alias("d").join(ids.alias("g"), F.col(f"d.{key}") == F.col("g.id"), "left_anti")


def free_name(docs: DataFrame, name: str = "_row") -> str:
    """A column name that ``docs`` does not have."""
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    return name


def named_rows(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    """``docs`` with a number for each different pair of id and text, and its name: rows that differ are told apart even
    where they repeat an id or lack one, and a recomputed task gives the same numbers."""
    name = free_name(docs)
    return docs.withColumn(name, F.xxhash64(F.col(key).cast("long"), F.col(key).isNull(), F.col(text), F.col(text).isNull())), name
