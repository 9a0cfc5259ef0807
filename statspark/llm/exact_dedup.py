"""Exact dedup by content-defined chunk recipes, in DataFrame functions alone.

A text without its ASCII white space is cut into chunks at places that its own content decides. Chunks get
identifiers that are verified byte for byte, a document becomes the short ordered list of its chunks' identifiers
(its recipe), and documents are equal when their recipes are. Whole texts are never shuffled: chunks move once, for
the verification, and afterwards only recipes do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import bounded, free_name, materialised, named_rows, shuffles_freed, without_rows, written

WHITE = r"[\x20\x09-\x0D]+"
#: Chunk sizes in bytes.
LEAST, MOST = 512, 8192
#: Every fifth byte value. A chunk of the least size ends before the next character of which the last byte is one of
#: these, and so is one of the two before that: letters, digits and the bytes of any script hold some.
MARKS = "[" + "".join(f"\\x{b:02x}" for b in range(2, 256, 5)) + "]"
WHOLE = r"(?![\x80-\xbf])"
CUT = f"(?<={MARKS}.?{MARKS}){WHOLE}"


def chunks_of(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """Content-defined chunks of a text, in order; their concatenation is the text.

    They are cut in its UTF-8 bytes, each read as one character, and never inside a character of the text
    (bytes that are none of UTF-8 are chunks of their own).
    """
    octets = F.decode(text.cast("binary"), "ISO-8859-1")
    cut = F.regexp_extract_all(octets, F.lit(f"(?s).{{{least},{most}}}?{CUT}|.{{1,{most}}}{WHOLE}|."), F.lit(0))
    return F.transform(cut, lambda c: F.encode(c, "ISO-8859-1").cast("string"))


def chunk_id(chunk: Column) -> Column:
    """128 bits as two longs; ``unverified`` tells whether two different chunks share them."""
    return F.array(F.xxhash64(chunk), F.xxhash64(F.lit("second"), chunk))


def unverified(docs: DataFrame, text: str = "text") -> DataFrame:
    """Identifiers that different chunks share: the bytes of every chunk are compared within its identifier."""
    chunk = docs.select(F.explode(chunks_of(squeezed(text))).alias("chunk"))
    both = chunk.groupBy(chunk_id(F.col("chunk")).alias("id")).agg(
        F.min("chunk").alias("low"), F.max("chunk").alias("high")
    )
    return both.where(F.col("low") != F.col("high")).select("id")


def squeezed(text: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE, "")


def recipes(docs: DataFrame, key: str = "doc_id", text: str = "text", strong: bool = False, *more: Column) -> DataFrame:
    """One row per row of ``docs``: key, characters, digest of the squeezed text, and recipe; ``more`` columns first.

    ``strong`` names chunks by SHA-256 instead, for corpora in which ``unverified`` found something.
    """
    one = (lambda c: F.array(F.sha2(c, 256))) if strong else chunk_id
    whole = docs.select(
        F.struct(*more).alias("more") if more else F.lit(None).alias("more"),
        F.col(key).cast("long").alias("doc_id"),
        F.length(F.coalesce(F.col(text), F.lit(""))).alias("chars"),
        squeezed(text).alias("squeezed"),
    )
    return whole.select(
        *(["more.*"] if more else []),
        "doc_id",
        "chars",
        F.sha2(F.col("squeezed"), 256).alias("text_sha256"),
        F.flatten(F.transform(chunks_of(F.col("squeezed")), one)).alias("recipe"),
    )


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Groups of equal texts: doc_id, keep_id, group_size, kept, text_sha256, one row per row of ``docs``.

    Texts are equal when identical without the characters ``[\\x20\\x09-\\x0D]``; null counts as empty, and all empty
    texts are one group. The row with the most characters of original text stays, then the smallest id; rows without
    an id come last. Rows that repeat an id share its decision. An empty table gives no rows; columns other than key
    and text are not read, so their names cannot clash.
    """
    with shuffles_freed(docs.sparkSession):
        strong = not unverified(docs, text).isEmpty()
        each = materialised(recipes(docs, key, text, strong))
    best = F.min(F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id"))
    groups = each.groupBy("recipe").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    return each.join(groups, "recipe").select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("best.doc_id")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, with all its columns: the one with the most characters of original text, then
    the smallest id (rows without an id come last), then the first.

    Rows are decided one by one, also where they repeat an id. Texts are not written again, but those of rows that repeat
    both id and text and stay.
    """
    with shuffles_freed(docs.sparkSession):
        return _without_copies(docs, key, text)


def _without_copies(docs: DataFrame, key: str, text: str) -> DataFrame:
    rows, number = named_rows(docs, key, text)
    strong = not unverified(rows, text).isEmpty()
    each = recipes(rows, key, text, strong, F.col(number).alias("row"))
    each = materialised(each.drop("text_sha256").withColumn("place", F.monotonically_increasing_id()))
    order = F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id", "place", "row")
    groups = each.groupBy("recipe").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = materialised(each.join(groups, "recipe").select("row", F.col("best.row").alias("stays")))
    kept = without_rows(rows, groups.where("row <> stays").select("row"), number)
    again = materialised(groups.where("row = stays").groupBy("row").count().where("count > 1").select("row"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if again.isEmpty():
        return kept.select(*columns)
    place = free_name(rows, "_place")
    same = kept.join(bounded(again.withColumnRenamed("row", "_again")), F.col(number) == F.col("_again"), "left_semi")
    same = written(same.withColumn(place, F.monotonically_increasing_id()))
    first = same.groupBy(F.col(number).alias("row")).agg(F.min(place).alias("place")).select("place")
    once = same.join(first, F.col(place) == F.col("place"), "left_semi")
    return without_rows(kept, again, number).select(*columns).unionByName(once.select(*columns))
