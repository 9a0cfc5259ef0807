"""Mixing sources to target weights, in DataFrame functions alone.

Each document gets a key that only seed and id decide. Documents are sorted by source and key over range partitions,
so that a large source lies in many of them; sums of each partition, running sums inside it and the sums of those
before it give each document's place among the words of its source without any task that sees a whole source. A
source's budget of words is cut at its exact place in that order: whole epochs first, then the documents before the cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import free_name, materialised, written

WORD = r"[^\x20\x09-\x0D]+"
WHITE = r"[\x20\x09-\x0D]*"
#: A table of sources is broadcast up to so many rows and bytes of names; beyond, it is joined by shuffling.
SOURCES, SOURCE_BYTES = 100_000, 8_000_000
WIDE = "decimal(38,0)"


def running(rows: DataFrame, order: list[str], values: list[str]) -> DataFrame:
    """``rows`` with before_<value>: the sums over all rows that come earlier in ``order``, which must tell rows apart.

    Range partitions are summed each on its own; only their sums, one row a partition, meet in one task.
    """
    ranged = written(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    sums = ranged.groupBy("part").agg(*(F.sum(v).alias(v) for v in values))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("part", *(F.sum(v).over(earlier).alias(f"start_{v}") for v in values))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    before = [
        (F.coalesce(f"start_{v}", zero) + F.coalesce(F.sum(v).over(inside), zero)).alias(f"before_{v}") for v in values
    ]
    return ranged.join(F.broadcast(starts), "part").select(*rows.columns, *before)


def shares(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), percent: int = 150, epochs: int = 2) -> DataFrame:
    """source, place, start, source_size, target of each source of ``sizes`` (source, size).

    Sources by code point, null last, weigh ``weights``, which repeat, and share ``percent`` of all words; a target stops at
    ``epochs`` times its source's size, and what is above goes to the others by weight until none is above. In order of size
    by weight, a source is full exactly if it would be with all before it full, so one pass of running sums settles all.
    Whole numbers decide, and one division gives a target.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).select("*", F.col("source").isNull().alias("none"), F.lit(1).cast("long").alias("one"))
    placed = running(per, ["none", "source"], ["one", "source_size"])
    cycle = F.array(*(F.lit(w).cast("long") for w in weights))
    weighed = placed.select(
        "source",
        "source_size",
        F.col("before_one").alias("place"),
        F.col("before_source_size").alias("start"),
        F.element_at(cycle, (F.col("before_one") % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * epochs).alias("most"),
    )
    ordered = running(weighed.withColumn("fill", F.col("most") / F.col("weight")), ["fill", "place"], ["weight", "most"])
    ordered = materialised(ordered)
    all_ = ordered.agg(F.sum("source_size").cast(WIDE).alias("words"), F.sum("weight").cast(WIDE).alias("weight")).first()
    asked = F.lit(percent * int(all_["words"] or 0)).cast(WIDE)
    wide = lambda c: F.col(c).cast(WIDE)
    left = F.lit(int(all_["weight"] or 0)).cast(WIDE) - wide("before_weight")
    full = (100 * wide("most")) * left < wide("weight") * (asked - 100 * wide("before_most"))
    judged = ordered.withColumn("full", full)
    rest = judged.agg(
        F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))), F.lit(0)).alias("most"),
        F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))), F.lit(0)).alias("weight"),
    ).first()
    share = wide("weight") * (asked - F.lit(100 * rest["most"]).cast(WIDE))
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(
        share.cast("double") / F.lit(float(100 * max(1, rest["weight"])))
    )
    return judged.select("source", "place", "start", "source_size", target.alias("target"))


def _few(sources: DataFrame) -> DataFrame:
    about = sources.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("source")).alias("bytes")).first()
    few = about["n"] <= SOURCES and (about["bytes"] or 0) <= SOURCE_BYTES
    return F.broadcast(sources) if few else sources


def mixture(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (5, 2, 1),
    percent: int = 150,
    epochs: int = 2,
    seed: int = 42,
    number: str | None = None,
) -> DataFrame:
    """row, doc_id, source, size, source_size, target, taken: the words that the mix takes of each row, repeats counted.

    A source's rows are taken in the order of md5('<seed>:<id>'), as often as its target asks for; the row at the cut is
    taken in part, so that the taken words of a source are its target without the fraction. Null and blank texts have no
    words and are never taken; a null id counts as '' in the key and comes before others of the same key; rows that repeat an
    id are ordered by their size, and rows alike in all of this are interchangeable. A null source is a source. An empty table
    gives no rows. ``row`` is the column ``number``, which tells rows apart, or a number of this call.
    """
    sized = written(
        docs.select(
            (F.monotonically_increasing_id() if number is None else F.col(number)).alias("row"),
            F.col(key).cast("long").alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
            F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("long").cast("string"), F.lit("")))).alias("key"),
        )
    )
    sources = materialised(shares(sized, weights, percent, epochs))
    names = [F.col(f"s.{c}") for c in ("place", "start", "source_size", "target")]
    placed = sized.alias("d").join(_few(sources).alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select("d.*", *names)
    ordered = running(placed, ["place", "key", "doc_id", "size", "row"], ["size"])
    inside = F.col("before_size") - F.col("start")
    budget = F.floor("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size")).cast("long")).otherwise(0)
    cut = budget - whole * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), cut - inside))
    return ordered.select(
        "row", "doc_id", "source", "size", "source_size", "target", (whole * F.col("size") + part).alias("taken")
    )


def first_words(text: Column, n: Column) -> Column:
    """A text up to the end of its n-th word."""
    return F.regexp_replace(text, F.concat(F.lit(rf"(?s)\A((?:{WHITE}{WORD}){{"), n.cast("string"), F.lit(r"}+).*\z")), F.lit("$1"))


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix: columns of ``docs`` and ``epoch`` (from 0; under a free name), a row for each time that a document is taken.

    A document taken in part ends after its last taken word.
    """
    number = free_name(docs)
    rows = written(docs.withColumn(number, F.monotonically_increasing_id()))
    picks = mixture(rows, key, text, source, number=number, **options).where("taken > 0")
    times = picks.select("row", "size", "taken", F.explode(F.sequence(F.lit(0), F.floor((F.col("taken") - 1) / F.col("size")))).alias("epoch"))
    words = F.least(F.col("p.size"), F.col("p.taken") - F.col("p.epoch") * F.col("p.size"))
    both = rows.alias("d").join(times.alias("p"), F.col(f"d.{number}") == F.col("p.row"))
    cut = F.when(words < F.col("p.size"), first_words(F.col(f"d.`{text}`"), words)).otherwise(F.col(f"d.`{text}`"))
    kept = [cut.alias(c) if c == text else F.col(f"d.`{c}`") for c in docs.columns]
    return both.select(*kept, F.col("p.epoch").cast("int").alias(free_name(docs, "epoch")))
