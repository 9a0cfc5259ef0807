"""Benchmark decontamination in DataFrame functions alone.

The windows of the benchmark's words form a hash set. Every window of every document is looked up in it, hits are
verified word by word in a join with the windows themselves, and hit spans or documents are removed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import materialised, named_rows, plain_words, without_rows

WINDOW = 13
#: Most windows that go into the scan as a hash set (8 bytes each); more of them are joined instead.
SET_LIMIT = 50_000
#: A character of a word, and one between words, before lower-casing.
WORD, GAP = r"[0-9A-Za-z[^\x00-\x7F]]", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def windows(items: DataFrame, item: str = "item_id", text: str = "text", n: int = WINDOW) -> DataFrame:
    """item_id, size, window (array of words), h: every n consecutive words of an item; a shorter one is one window."""
    words = items.select(F.col(item).cast("string").alias("item_id"), plain_words(F.col(text)).alias("words"))
    words = words.where((F.size("words") > 0) & F.col("item_id").isNotNull()).withColumn(
        "size", F.least(F.lit(n), F.size("words"))
    )
    every = words.select(
        "item_id",
        "size",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("words") - F.col("size") + 1),
                lambda i: F.slice(F.col("words"), i, F.col("size")),
            )
        ).alias("window"),
    )
    return every.withColumn("h", F.xxhash64("window")).distinct()


def _starts(words: Column, size: int) -> Column:
    """The places (from 0) where a window of ``size`` words fits."""
    last = F.size(words) - size
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _found(words: Column, size: int, first: list[str], hashes: list[int]) -> Column:
    """The places whose window's first word and hash are in the set."""
    return F.filter(
        _starts(words, size),
        lambda i: F.get(words, i).isin(first) & F.xxhash64(F.slice(words, i + 1, size)).isin(hashes),
    )


def _window_at(words: Column, size: int, hashed: bool = False) -> Callable[[Column], Column]:
    def at(i: Column) -> Column:
        window = F.slice(words, i + 1, size)
        return F.struct(
            i.alias("place"), F.lit(size).alias("size"), F.xxhash64(window).alias("h") if hashed else window.alias("window")
        )

    return at


def hits(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n: int = WINDOW,
    set_limit: int = SET_LIMIT,
) -> tuple[DataFrame, DataFrame]:
    """(rows, found): every row of ``docs`` with a number, and verified windows as row, place, size, item_id."""
    window = windows(items, n=n)
    known = window.select("size", "h", F.get("window", F.lit(0)).alias("first")).distinct()
    sample = known.limit(set_limit + 1).collect()
    keyed = docs.select(F.col(key).alias("doc_id"), plain_words(F.col(text)).alias("words"))
    if len(sample) <= set_limit:
        parts = [
            F.transform(
                _found(
                    F.col("words"),
                    size,
                    sorted({r["first"] for r in sample if r["size"] == size}),
                    sorted({r["h"] for r in sample if r["size"] == size}),
                ),
                _window_at(F.col("words"), size),
            )
            for size in sorted({r["size"] for r in sample})
        ]
        empty = F.array().cast("array<struct<place:int,size:int,window:array<string>>>")
        rows = keyed.select(
            "doc_id",
            F.size("words").alias("n_words"),
            (reduce(lambda a, b: F.concat(a, b), parts) if parts else empty).alias("hits"),
        ).withColumn("row", F.monotonically_increasing_id())
        rows = materialised(rows)
        seen = rows.where(F.size("hits") > 0).select("row", F.inline("hits")).withColumn("h", F.xxhash64("window"))
        found = seen.alias("s").join(
            window.alias("w"),
            (F.col("s.h") == F.col("w.h"))
            & (F.col("s.size") == F.col("w.size"))
            & (F.col("s.window") == F.col("w.window")),
        )
        return rows.drop("hits"), found.select("row", "place", F.col("s.size").alias("size"), "item_id")
    # A benchmark beyond the limit: hashes of all windows are joined with the documents' (Spark picks the strategy).
    sizes = sorted(r["size"] for r in known.select("size").distinct().collect())
    rows = materialised(keyed.withColumn("row", F.monotonically_increasing_id()))
    every = reduce(
        lambda a, b: F.concat(a, b),
        [
            F.transform(
                _starts(F.col("words"), size),
                _window_at(F.col("words"), size, hashed=True),
            )
            for size in sizes
        ],
    )
    seen = rows.select("row", F.inline(every)).join(window, ["h", "size"])
    found = (
        seen.join(rows.select("row", "words"), "row")
        .where(F.slice("words", F.col("place") + 1, F.col("size")) == F.col("window"))
        .select("row", "place", "size", "item_id")
    )
    return rows.select("doc_id", F.size("words").alias("n_words"), "row"), found


def _covered(spans: Column) -> Column:
    """Number of words that sorted (place, size) spans cover together."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(
        F.array_sort(spans),
        start,
        lambda a, s: F.struct(
            F.greatest(a["end"], s["place"] + s["size"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), s["place"] + s["size"] - F.greatest(a["end"], s["place"]))).alias("n"),
        ),
        lambda a: a["n"],
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n: int = WINDOW,
    percent: int = 5,
    set_limit: int = SET_LIMIT,
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (array of place, size): a row for each row.

    A word inside any occurrence of a window is hit; ``percent`` of hit words make a document contaminated. A null or
    empty text has no words and is clean; items without words or id are left out; without items all rows are clean.
    Repeated rows each get their own result, and other columns are not read.
    """
    rows, found = hits(docs, items, key, text, n, set_limit)
    # The same few windows can occur in very many documents, so each row's hits meet only by the row's number.
    per_row = found.groupBy("row").agg(
        F.collect_set(F.struct("place", "size")).alias("spans"), F.collect_set("item_id").alias("item_ids")
    )
    spans = F.coalesce("spans", F.array().cast("array<struct<place:int,size:int>>"))
    item_ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    result = rows.join(per_row, "row", "left").select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        _covered(spans).cast("long").alias("n_hit"),
        F.size(item_ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(item_ids), ","), 256).alias("items_sha256"),
        F.array_sort(spans).alias("spans"),
    )
    dirty = (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))
    return result.withColumn("contaminated", dirty)


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns, each judged by its own text."""
    rows, number = named_rows(docs, key, text)
    gone = contamination(rows, items, number, text).where("contaminated").select("doc_id")
    return without_rows(rows, gone, number).select(*(F.col(f"`{c}`") for c in docs.columns))


def without_spans(text: Column, spans: Column) -> Column:
    """A text without its hit words and the separators before them."""
    whole = F.coalesce(text, F.lit(""))
    unit = F.regexp_extract_all(whole, F.lit(f"{GAP}*{WORD}+"), F.lit(0))
    hit = F.flatten(F.transform(spans, lambda s: F.sequence(s["place"], s["place"] + s["size"] - 1)))
    left = F.filter(unit, lambda _, i: ~F.array_contains(hit, i))
    return F.concat(F.array_join(left, ""), F.regexp_extract(whole, f"({GAP}*)$", 1))
