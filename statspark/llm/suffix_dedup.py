"""Suffix-array dedup over sparse suffixes.

Of all suffixes those are kept that begin at minimisers: words whose 32-byte block has the least hash among their
neighbours. They are sorted by the words that follow, in two steps (hashes stand for the words: any order that keeps
equal beginnings together serves), and compared with their neighbours in that order: each is matched with the one of an
earlier document with which it has the longest beginning in common, and the match is extended byte by byte to the left
and to the right.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .passages import LEAST_WORDS, minimisers, repeated

__all__ = ["block_hashes", "blocks_at", "minimisers", "repeated_passages"]

#: Bytes of a block.
BLOCK = 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWERS = [(1 << i, np.uint64(pow(int(_ODD), 1 << i, 1 << 64))) for i in range(5)]
_BYTE = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64)


def block_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the 32 bytes that begin at each place where that many are left."""
    h = _BYTE[data]
    for width, factor in _POWERS:
        h = h[:-width] * factor + h[width:]
    return (h ^ (h >> np.uint64(29))) * _ODD


def blocks_at(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of the block at each of the given places; of the last ones that a shorter text has."""
    if len(data) < BLOCK or not len(starts):
        return np.zeros(len(starts), np.uint64)
    h = block_hashes(data)
    return h[np.minimum(starts, len(h) - 1)]


def repeated_passages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS, within: bool = False
) -> DataFrame:
    """doc_id, start, end, n_words, keep_doc_id, keep_start: passages that an earlier document holds too.

    Every passage of ``least_words`` whole words is found, in each of its places; ``within`` adds repeats inside one
    document. Offsets are code points. Rows without id are left out, null and short texts have no passages, repeated
    rows of one id count as one document with its smallest text, an empty table has none.
    """
    held = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return repeated(held, blocks_at, least_words, within)
