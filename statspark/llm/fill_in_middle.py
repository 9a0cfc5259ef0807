"""Fill-in-middle transformation by counted quantifiers.

``regexp_count`` gives a text's units (white space with the word behind it, or white space at the end). Hashes of the
row's id choose two cuts among them, and the row's own pattern, two possessive groups of as many units as the cuts ask
for, takes prefix, middle and suffix apart in one match, whose groups the replacement puts in the asked-for order.
Possessive groups are matched in a loop without a stack, so texts may be of any length. One scan, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = r"(?:[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+)"
#: Marks of prefix, suffix and middle. No mark ends as another begins, so none arises where a text meets one.
MARKS = ("<P>", "<S>", "<M>")
ORDERS = {"psm": "<P>$1<S>$3<M>$2", "spm": "<S>$3<P>$1<M>$2"}


def draws(key: Column, seed: int, n: int = 4) -> list[Column]:
    """``n`` unsigned 32-bit numbers that depend on seed and id alone; a missing id counts as ''."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)]


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, rate: int = 50, spm: int = 80
) -> DataFrame:
    """doc_id, n (units), form, output, one row per row of ``docs``.

    Of 100 texts ``rate`` are transformed, of 100 of those ``spm`` to the order suffix, prefix, middle (form 'spm'), the others
    to prefix, suffix, middle ('psm'). Texts that are null or empty or hold one of the marks stay as they are ('plain', null
    as ''). Any part may be empty. Equal rows get equal results; rows without an id share one draw. An empty table gives no
    rows; columns other than key and text are not read, so their names cannot clash.
    """
    drawn = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.array(*draws(F.col(key).cast("long"), seed)).alias("h"),
    )
    counted = drawn.withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("long"))
    h, whole = F.col("h"), F.col("text")
    plain = (whole == "") | (h[2] % 100 >= rate)
    for mark in MARKS:
        plain = plain | whole.contains(mark)
    cut = counted.select(
        "doc_id",
        "n",
        "text",
        F.least(h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1)).alias("first"),
        F.greatest(h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1)).alias("second"),
        F.when(plain, "plain").when(h[3] % 100 < spm, "spm").otherwise("psm").alias("form"),
    )
    units = lambda count: F.concat(F.lit(f"({UNIT}{{"), count.cast("string"), F.lit("}+)"))
    pattern = F.concat(F.lit(r"(?s)\A"), units(F.col("first")), units(F.col("second") - F.col("first")), F.lit(r"(.*)\z"))
    ordered = F.when(F.col("form") == "spm", ORDERS["spm"]).otherwise(ORDERS["psm"])
    output = F.when(F.col("form") == "plain", whole).otherwise(F.regexp_replace(whole, pattern, ordered))
    return cut.select("doc_id", "n", "form", output.alias("output"))


def parts(output: Column, form: Column) -> Column:
    """Struct of prefix, middle and suffix; null for a plain text."""
    cut = F.split(output, "<[PSM]>")
    spm = form == "spm"
    return F.when(
        form != "plain",
        F.struct(
            F.when(spm, cut[2]).otherwise(cut[1]).alias("prefix"),
            cut[3].alias("middle"),
            F.when(spm, cut[1]).otherwise(cut[2]).alias("suffix"),
        ),
    )


def restored(output: Column, form: Column) -> Column:
    """The text, from output and form alone."""
    part = parts(output, form)
    return F.when(form == "plain", output).otherwise(F.concat(part["prefix"], part["middle"], part["suffix"]))
