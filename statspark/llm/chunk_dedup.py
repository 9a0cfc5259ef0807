"""Substring dedup by content-defined chunking with a gear rolling hash.

Chunks begin at words whose gear hash (of the 16 bytes from there) is the least among their neighbours, so equal passages
are cut alike wherever they stand, an insertion moves no cut beyond its own neighbourhood, and no chunk has more words
than there are neighbours. A chunk's digest covers the chunks behind it too, up to as many words as every passage holds
behind a cut of its own; documents with an equal digest are compared byte by byte around it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .passages import LEAST_WORDS, minimisers, repeated, steps, words_of

#: Bytes that the gear hash of a place depends on.
REACH = 16
GEAR = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash of the up to 16 bytes that end at each place: each byte's number, shifted left once a byte since."""
    h = GEAR[data]
    for width in (1, 2, 4, 8):
        moved = h[:-width] << np.uint32(width)
        h = h.copy()
        h[width:] += moved
    return h


def rolled(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Gear hash of the bytes from each of the given places on."""
    return gear(data)[np.minimum(starts + REACH - 1, len(data) - 1)] if len(starts) else np.empty(0, np.uint32)


def cuts(data: np.ndarray, least_words: int = LEAST_WORDS) -> np.ndarray:
    """Starts of the chunks of a text; its last words, which begin no passage, have none."""
    starts = words_of(data)[0]
    last = len(starts) - least_words + steps(least_words)
    return starts[minimisers(rolled(data, starts[:last]), steps(least_words))] if len(starts) >= least_words else starts[:0]


def repeated_passages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS, within: bool = False
) -> DataFrame:
    """doc_id, start, end, n_words, keep_doc_id, keep_start: passages that an earlier document holds too.

    Every passage of ``least_words`` words is found, in each of its places; ``within`` adds repeats inside one document.
    Offsets are code points; matches have at least ``least_words`` whole words. Rows without id can't be named and are
    left out; null and empty texts have no chunks. Repeated rows of one id count as one document, with its smallest
    text. An empty table gives no rows.
    """
    held = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return repeated(held, rolled, least_words, within)


def without(docs: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the spans (doc_id, start, end) cut out of their texts; all rows and columns stay."""
    per = spans.groupBy(F.col("doc_id").alias("_key")).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("_spans"))
    start = F.struct(F.lit("").alias("left"), F.lit(0).alias("at"))
    cut = F.aggregate(
        "_spans",
        start,
        lambda a, s: F.struct(
            F.concat(a["left"], F.substring(F.col(text), a["at"] + 1, F.greatest(F.lit(0), s["start"] - a["at"]))).alias("left"),
            F.greatest(a["at"], s["end"]).alias("at"),
        ),
        lambda a: F.concat(a["left"], F.substring(F.col(text), a["at"] + 1, F.length(F.col(text)))),
    )
    joined = docs.join(per, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(text, F.when(F.col("_spans").isNull(), F.col(text)).otherwise(cut)).select(*docs.columns)
