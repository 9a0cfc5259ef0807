"""Exact common passages of pairs of documents, from seeds at which their texts agree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import bounded, in_batches, materialised, written

#: Whole words in the shortest match that is kept.
LEAST_WORDS = 50
SCHEMA = "doc_id long, start int, end int, n_words int, keep_doc_id long, keep_start int, h long"


def whole_words(text: bytes, start: int, end: int) -> int:
    """Words between ASCII white space that lie in a part of a text as a whole."""
    n = len(text[start:end].split())
    cut_left = start > 0 and not text[start - 1 : start].isspace() and not text[start : start + 1].isspace()
    cut_right = end < len(text) and not text[end : end + 1].isspace() and not text[end - 1 : end].isspace()
    return n - cut_left - cut_right


def _extended(least_words: int, aside: int):
    """Matches of pairs of texts (a, b, ta, tb, seeds) around their seeds, each match once; and as rows with ``h`` alone
    the seeds that other documents might extend further: those whose match does not go on for ``aside`` words to both
    sides of the seed's run, or to the text's ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for a, b, ta, tb, seeds in zip(*(batch.column(i) for i in range(5)), strict=True):
                a, b, x = a.as_py(), b.as_py(), ta.as_py().encode("utf-8", "surrogatepass")
                y, seeds = tb.as_py().encode("utf-8", "surrogatepass"), seeds.as_py()
                found: dict[int, list[tuple[int, int]]] = {}
                for sa, sb, n in matches(x, y, seeds):
                    words = whole_words(y, sb, sb + n)
                    if words >= least_words:
                        found.setdefault(sb - sa, []).append((sb, sb + n))
                        start = len(y[:sb].decode("utf-8", "surrogatepass"))
                        keep = len(x[:sa].decode("utf-8", "surrogatepass"))
                        size = len(y[sb : sb + n].decode("utf-8", "surrogatepass"))
                        rows.append((b, start, start + size, words, a, keep, None))
                others = [s for s in seeds if s["h"] is not None]
                if others:
                    begins, ends = words_of(np.frombuffer(y, np.uint8))
                    for s in others:
                        i = int(np.searchsorted(begins, s["at"]))
                        low = begins[i - aside] if i >= aside else 0
                        high = ends[last] if (last := i + least_words - 1) < len(ends) else len(y)
                        if not any(u <= low and high <= v for u, v in found.get(s["at"] - s["other"], ())):
                            rows.append((None, None, None, None, None, None, s["h"]))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            names = ["doc_id", "start", "end", "n_words", "keep_doc_id", "keep_start", "h"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def matches(x: bytes, y: bytes, seeds: list[dict]) -> Iterator[tuple[int, int, int]]:
    """Start in x, start in y and length in bytes of each greatest match that holds a seed, in whole characters."""
    u, v = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    by: dict[int, list[int]] = {}
    for s in seeds:
        by.setdefault(s["at"] - s["other"], []).append(s["other"])
    for shift, places in sorted(by.items()):
        low = max(0, -shift)
        high = min(len(u), len(v) - shift)
        differ = np.flatnonzero(u[low:high] != v[low + shift : high + shift]) + low
        end = -1
        for p in sorted(places):
            if p < end:
                continue
            i = int(np.searchsorted(differ, p))
            if i < len(differ) and differ[i] == p:  # equal hashes of different bytes
                continue
            start, end = (int(differ[i - 1]) + 1 if i else low), (int(differ[i]) if i < len(differ) else high)
            while start < end and (x[start] & 0xC0) == 0x80:
                start += 1
            stop = end
            while stop > start and stop < len(x) and (x[stop] & 0xC0) == 0x80:
                stop -= 1
            yield start, start + shift, stop - start


_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_BYTE = np.random.default_rng(13).integers(0, 1 << 63, 256, dtype=np.uint64)
_WHITE = np.zeros(256, bool)
_WHITE[list(b"\t\n\v\f\r ")] = True


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words."""
    inside = np.concatenate(([False], ~_WHITE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each of the given parts."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * np.cumprod(np.full(len(data), _ODD)), out=total[1:])
    h = (total[ends] - total[starts]) * np.cumprod(np.full(len(data) + 1, _INVERSE))[starts]
    h = (h ^ (h >> np.uint64(31)) ^ (ends - starts).astype(np.uint64)) * _ODD
    return h ^ (h >> np.uint64(29))


def minimisers(h: np.ndarray, window: int) -> np.ndarray:
    """Places that are the least of some ``window`` neighbouring places, ties included."""
    if not len(h):
        return np.empty(0, np.int64)
    window = min(window, len(h))
    least, width = h, 1
    while width * 2 <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = window - width
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    # A place is chosen if its value is the least of a window that holds it: of the windows that begin up to window-1 before.
    n = len(least)
    high, width = np.concatenate((np.zeros(window - 1, h.dtype), least, np.zeros(window - 1, h.dtype))), 1
    while width * 2 <= window:
        high = np.maximum(high[:-width], high[width:])
        width *= 2
    rest = window - width
    high = np.maximum(high[: len(high) - rest], high[rest:]) if rest else high
    return np.flatnonzero(h == high[: n + window - 1])


def steps(least_words: int) -> int:
    """Neighbouring words of which one at least is an anchor, so that a run of the others behind it tells a passage."""
    apart = least_words // 4 + 1
    return apart if 2 * (least_words - apart + 1) - 1 >= 32 else 1


def _anchors(least_words: int, value):
    """h, deep, doc_id, at of the anchors of rows (doc_id, text): words whose ``value`` (of the bytes that follow) is the
    least of so many neighbours that each passage has one with a run of words behind it. ``h`` is that run's hash,
    ``deep`` that of half a passage more, 0 where the text ends before."""
    apart = steps(least_words)
    run_words, more = least_words - apart + 1, least_words // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[tuple] = []
            held = 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = np.frombuffer((text.as_py() or "").encode("utf-8", "surrogatepass"), np.uint8)
                starts, ends = words_of(data)
                if len(starts) < least_words:
                    continue
                at = minimisers(value(data, starts[: len(starts) - run_words + 1]), apart)
                far = at + run_words + more - 1
                long = far < len(ends)
                both = hashed(data, np.concatenate((starts[at], starts[at[long]])), np.concatenate((ends[at + run_words - 1], ends[far[long]])))
                deep = np.zeros(len(at), np.uint64)
                deep[long] = both[len(at) :]
                parts.append((both[: len(at)], deep, np.full(len(at), key, np.int64), starts[at].astype(np.int32)))
                held += len(at)
                if held > 300_000:
                    yield _anchor_rows(parts)
                    parts, held = [], 0
            if parts:
                yield _anchor_rows(parts)

    return run


def _anchor_rows(parts: list[tuple]) -> pa.RecordBatch:
    h, deep, key, at = (np.concatenate(x) for x in zip(*parts, strict=True))
    columns = [h.view(np.int64), deep.view(np.int64), key, at]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "deep", "doc_id", "at"])


def _around(least_words: int):
    """h, doc_id, at of all runs of ``least_words`` words that hold the run behind one of the given anchors."""
    apart = steps(least_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                data = np.frombuffer((text.as_py() or "").encode("utf-8", "surrogatepass"), np.uint8)
                starts, ends = words_of(data)
                first = np.searchsorted(starts, np.array(places, np.int64))
                first = np.unique((first[:, None] - np.arange(apart)).ravel())
                first = first[(first >= 0) & (first + least_words <= len(starts))]
                if len(first):
                    h = hashed(data, starts[first], ends[first + least_words - 1]).view(np.int64)
                    columns = [pa.array(h), pa.array(np.full(len(h), key, np.int64)), pa.array(starts[first].astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, ["h", "doc_id", "at"])

    return run


def _nearest(rows: DataFrame, *by: str) -> Column:
    """Of rows that agree in ``by``, the last place in the nearest earlier document."""
    earlier = Window.partitionBy(*by).orderBy("doc_id").rangeBetween(Window.unboundedPreceding, -1)
    return F.max(F.struct("doc_id", "at")).over(earlier)


def _pairs(seeds: DataFrame, least_words: int) -> DataFrame:
    """a, b, seeds of rows (near, doc_id, at, more, h).

    Of seeds of one shift that begin so near to each other that they are of one match, one is enough, but for those of
    which ``h`` may be asked for.
    """
    shift, asked = F.col("at") - F.col("near.at"), F.when(F.col("more"), F.col("h"))
    step = (F.col("at") / (2 * (least_words - steps(least_words)) + 1)).cast("int")
    once = seeds.groupBy(
        F.col("near.doc_id").alias("a"), F.col("doc_id").alias("b"), shift.alias("shift"), step.alias("step"), asked.alias("h")
    ).agg(F.min("at").alias("at"))
    seed = F.struct("at", (F.col("at") - F.col("shift")).alias("other"), "h")
    return once.groupBy("a", "b").agg(F.collect_list(seed).alias("seeds"))


def repeated(docs: DataFrame, value, least_words: int = LEAST_WORDS, within: bool = False) -> DataFrame:
    """doc_id, start, end, n_words, keep_doc_id, keep_start: what rows (doc_id, text) have in common with earlier ones.

    Each passage of ``least_words`` words holds an anchor with a run of words behind it, and equal passages hold equal
    ones. Each anchor's run is matched with the nearest earlier document's, with one that agrees for longer first, and the
    two texts are compared to both sides. Where a document further off might agree with other words around the run, all
    passages that hold it are matched one by one. So whatever passage an earlier document has, a match covers it; matches
    inside others of their document are left out.
    ``within`` adds repeats inside one document. A very frequent run is sorted by one task, which spills.
    """
    rows = in_batches(docs.select("doc_id", "text"), _anchors(least_words, value), "h long, deep long, doc_id long, at int")
    every, upto = Window.partitionBy("h"), Window.partitionBy("h").orderBy("doc_id").rangeBetween(Window.unboundedPreceding, -1)
    ranked = rows.select(
        "h",
        "deep",
        "doc_id",
        "at",
        F.max("doc_id").over(every).alias("last"),
        F.min("doc_id").over(upto).alias("first"),
        _nearest(rows, "h").alias("near"),
        F.when(F.col("deep") != 0, _nearest(rows, "h", "deep")).alias("far"),
    )
    shared = ranked.where("first is not null or last > doc_id").withColumn("near", F.coalesce("far", "near"))
    shared = written(shared.select("h", "doc_id", "at", "near", (F.col("first") < F.col("near.doc_id")).alias("more")))
    found = written(_matched(docs, _pairs(shared.where("near is not null"), least_words), least_words))
    more = found.where("h is not null").select("h").distinct()
    places = shared.join(more, "h", "left_semi").groupBy(F.col("doc_id").alias("_key")).agg(F.collect_set("at").alias("places"))
    places = materialised(places)
    result = found.where("doc_id is not null").drop("h")
    if not places.isEmpty():
        ids = bounded(places.select(F.col("_key").alias("_id")))
        around = _texts(docs, ids).join(places, F.col("doc_id") == F.col("_key")).select("doc_id", "text", "places")
        around = in_batches(around, _around(least_words), "h long, doc_id long, at int")
        near = around.select("h", "doc_id", "at", _nearest(around, "h").alias("near"), F.lit(False).alias("more")).where("near is not null")
        result = result.unionByName(_matched(docs, _pairs(near, least_words), least_words).drop("h"))
    if within:
        order = Window.partitionBy("h", "doc_id").orderBy("at")
        runs = in_batches(docs.select("doc_id", "text"), _anchors(least_words, value), "h long, deep long, doc_id long, at int")
        same = runs.select("h", "doc_id", "at", F.lag(F.struct("doc_id", "at")).over(order).alias("near"), F.lit(False).alias("more"))
        result = result.unionByName(_matched(docs, _pairs(same.where("near is not null"), least_words), least_words).drop("h"))
    return _widest(result)


def _widest(found: DataFrame) -> DataFrame:
    """Of the matches of a document those that lie in none of its others, and one of equal ones."""
    order = Window.partitionBy("doc_id").orderBy("start", F.desc("end"), F.desc("keep_doc_id"), "keep_start")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return found.distinct().withColumn("_before", before).where("_before is null or _before < end").drop("_before")


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, text of the documents with the given ids; an id's smallest text where it has several."""
    return docs.join(ids, F.col("doc_id") == F.col("_id"), "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))


def _matched(docs: DataFrame, pairs: DataFrame, least_words: int) -> DataFrame:
    """The matches of ``pairs`` (a, b, seeds: array of byte places at in b and other in a) in ``docs`` (doc_id, text).

    Every pair's texts meet once, by two joins; only documents of pairs are moved.
    """
    pairs = materialised(pairs)
    ids = bounded(pairs.select(F.explode(F.array("a", "b")).alias("_id")).distinct())
    texts = _texts(docs, ids)
    both = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b"
    )
    return in_batches(both.select("a", "b", "ta", "tb", "seeds"), _extended(least_words, steps(least_words) - 1), SCHEMA)
