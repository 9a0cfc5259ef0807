"""Language identification by Bayesian fusion of a text's likelihood with what is said about it.

Byte-trigram counts of all rows with a declared language but the row's own give each language's likelihood of a text; a uniform model
stands for anything else ("und"). Declared language, address suffix and host add evidence whose weights are learned
from grouped counts of what the texts alone say: how often a declaration or a suffix goes with a language, and how
often a host's rows are in it, smoothed towards the host's domain, and that towards all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import FOLD, free_name, in_batches, materialised, without_rows

LANGUAGES = ("de", "en", "es", "fr")
BITS = 15
#: Weight of a trigram's log-likelihood (neighbouring trigrams overlap), rows that a parent counts for, least posterior.
TEMPER, STRENGTH, SURE = 0.3, 8.0, 0.5
#: Log-odds against "und" before anything is seen.
UNKNOWN = -4.6


def trigrams(text: str | None) -> np.ndarray:
    """Hashed byte trigrams of the words of a text, with single spaces between and around them."""
    raw = b" " + b" ".join((text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()) + b" "
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.uint32)
    x = b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))
    return (x * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def _counts(languages: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), 1 << BITS), np.int64)
        number = {x: i for i, x in enumerate(languages)}
        for batch in batches:
            for declared, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                total[number[declared]] += np.bincount(trigrams(text.as_py()), minlength=1 << BITS)
        where = np.nonzero(total)
        columns = [where[0].astype(np.int32), where[1].astype(np.int32), total[where]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["language", "bucket", "n"])

    return run


def trigram_counts(rows: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> np.ndarray:
    """Raised counts of each trigram bucket in each language and in "und", from all rows (declared, text)."""
    held = rows.where(F.col("declared").isin(list(languages))).select("declared", "text")
    counts = in_batches(held, _counts(languages), "language int, bucket int, n long")
    table = np.full((1 << BITS, len(languages) + 1), 0.5)
    for r in counts.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        table[r["bucket"], r["language"]] += r["n"]
    table[:, -1] = 1
    return table


def likelihoods(rows: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> np.ndarray:
    """Log-probability of each trigram bucket in each language and in "und", from all rows (declared, text)."""
    table = trigram_counts(rows, languages)
    return np.log(table / table.sum(axis=0)).astype(np.float32)


def _scored(table: np.ndarray, counts: np.ndarray | None, languages: tuple[str, ...]):
    """Log-likelihoods of texts. With ``counts`` these hold the rows' own texts, and each row's is taken out of the language
    that it declares, so that a declaration does not speak twice."""
    number = {x: i for i, x in enumerate(languages)}
    totals = None if counts is None else counts.sum(axis=0)

    def score(text: str | None, declared: str | None) -> np.ndarray:
        found = trigrams(text)
        scores = table[found].sum(axis=0, dtype=np.float64)
        if counts is not None and declared in number and len(found):
            k = number[declared]
            own = np.bincount(found, minlength=len(counts))
            at = np.flatnonzero(own)
            scores[k] = own[at] @ np.log((counts[at, k] - own[at]) / (totals[k] - len(found)))
        return scores

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            declared = batch.column("declared").to_pylist()
            scores = [score(x.as_py(), d) for x, d in zip(batch.column("text"), declared, strict=True)]
            flat = pa.array(np.concatenate(scores) * TEMPER if scores else np.empty(0))
            ends = pa.array(np.arange(len(scores) + 1, dtype=np.int32) * table.shape[1])
            rest = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), pa.ListArray.from_arrays(ends, flat)], [*rest, "text_ll"])

    return run


def _best(scores: Column) -> Column:
    """Number (from 0) of the greatest score."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def _plus(*arrays: Column) -> Column:
    total = arrays[0]
    for more in arrays[1:]:
        total = F.when(more.isNull(), total).otherwise(F.zip_with(total, more, lambda x, y: x + y))
    return total


def _tally(rows: DataFrame, by: list[str], classes: int) -> DataFrame:
    """For each value how many rows the texts alone put in each class: ``by``, n (array)."""
    each = [F.count_if(F.col("text_best") == k).cast("double") for k in range(classes)]
    return rows.where(F.col(by[-1]).isNotNull()).groupBy(*by).agg(F.array(*each).alias("n"))


def identified(rows: DataFrame, languages: tuple[str, ...] = LANGUAGES, table: np.ndarray | None = None) -> DataFrame:
    """``rows`` (declared, host, domain, suffix, text and any keys) without text but with language, posterior, accepted.

    A row is accepted when its language is not "und" and its posterior is at least 0.5. A null or empty text leaves
    the decision to the other evidence, and without any it is "und"; missing evidence says nothing. Each row's own
    count is left out of its host's, and its text out of the counts of the language that it declares (a ``table`` of
    likelihoods that is given is taken as it is). Rows may repeat; an empty table gives no rows.
    """
    classes = len(languages) + 1
    counts = trigram_counts(rows, languages) if table is None else None
    table = np.log(counts / counts.sum(axis=0)).astype(np.float32) if table is None else table
    keys = [f"{n} {t}" for n, t in rows.dtypes if n != "text"]
    scored = in_batches(rows, _scored(table, counts, languages), ", ".join([*keys, "text_ll array<double>"]))
    prior = F.array(*[F.lit(0.0)] * len(languages), F.lit(UNKNOWN))
    # Without text the likelihoods are all zero; such a row must not count as evidence for the first language.
    told = F.array_min("text_ll") < 0
    scored = scored.withColumn("text_best", F.when(told, _best(_plus(F.col("text_ll"), prior))))
    scored = materialised(scored)
    everywhere = F.array(*[F.count_if(F.col("text_best") == k).cast("double") for k in range(classes)])
    overall = [float(x) for x in scored.agg(everywhere.alias("n")).first()["n"]]
    share = F.array(*[F.lit((x + 1) / (sum(overall) + classes)) for x in overall])

    def smoothed(n: Column, parent: Column) -> Column:
        total = F.aggregate(n, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(n, parent, lambda x, p: (x + STRENGTH * p) / (total + STRENGTH))

    domains = _tally(scored, ["domain"], classes).select("domain", smoothed(F.col("n"), share).alias("of_domain"))
    hosts = _tally(scored, ["host"], classes).withColumnRenamed("n", "of_host")
    declared = _tally(scored, ["declared"], classes)
    suffixes = _tally(scored, ["suffix"], classes)
    of_classes = F.array(*[F.lit(x) for x in overall])

    def evidence(tally: DataFrame, name: str, out: str) -> DataFrame:
        """Log-probability of a value in each class, by counts of it and of the class, each a little raised."""
        said = F.zip_with(F.col("n"), of_classes, lambda x, t: F.log((x + 0.5) / (t + 1.0)))
        return tally.select(name, said.alias(out))

    joined = (
        scored.join(hosts, "host", "left")
        .join(domains, "domain", "left")
        .join(evidence(declared, "declared", "of_declared"), "declared", "left")
        .join(evidence(suffixes, "suffix", "of_suffix"), "suffix", "left")
    )
    own = F.array(*[F.coalesce((F.col("text_best") == k).cast("double"), F.lit(0.0)) for k in range(classes)])
    others = F.zip_with("of_host", own, lambda n, x: F.greatest(n - x, F.lit(0.0)))
    parent = F.coalesce("of_domain", share)
    host = F.when(F.col("of_host").isNotNull(), F.transform(smoothed(others, parent), lambda x: F.log(x))).otherwise(
        F.transform(parent, lambda x: F.log(x))
    )
    joined = joined.withColumn("total", _plus(F.col("text_ll"), host, F.col("of_declared"), F.col("of_suffix"), prior))
    names = F.array(*[F.lit(x) for x in (*languages, "und")])
    top = F.array_max("total")
    posterior = 1.0 / F.aggregate("total", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    silent = ~told & F.col("declared").isNull() & F.col("host").isNull() & F.col("suffix").isNull()
    result = joined.withColumn("language", F.when(silent, F.lit("und")).otherwise(F.element_at(names, _best(F.col("total")) + 1)))
    result = result.withColumn("posterior", posterior).withColumn("text_language", F.element_at(names, F.col("text_best") + 1))
    kept = [n for n, _ in rows.dtypes if n not in ("text", "domain", "suffix")]
    accepted = (F.col("language") != "und") & (F.col("posterior") >= SURE)
    return result.select(*kept, "text_language", "language", "posterior", accepted.alias("accepted"))


def primary(tag: Column) -> Column:
    """Primary subtag of a language tag, lower-cased; null if there is none."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(tag)), "^([a-z]{2,3})(?:[-_].*)?$", 1), F.lit(""))


def document_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", declared: str = "lang", host: str = "source") -> DataFrame:
    """Rows of documents: the column ``declared`` names a language and ``host`` where a text comes from."""
    return docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.lit(None).cast("long").alias("page_id"),
        primary(F.col(declared)).alias("declared"),
        F.col(host).cast("string").alias("host"),
        F.lit(None).cast("string").alias("domain"),
        F.lit(None).cast("string").alias("suffix"),
        F.col(text).alias("text"),
    )


def page_rows(pages: DataFrame) -> DataFrame:
    """Rows of web pages: the markup's language, host and suffix of the address, text without markup."""
    html = F.coalesce("html", F.lit(""))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;", " ")
    return pages.select(
        F.lit(None).cast("long").alias("doc_id"),
        F.col("page_id").cast("long").alias("page_id"),
        primary(F.regexp_extract(html, r"""(?i)<html\b[^>]*\blang\s*=\s*["']?([A-Za-z_-]+)""", 1)).alias("declared"),
        F.nullif(host, F.lit("")).alias("host"),
        F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit("")).alias("domain"),
        F.nullif(F.regexp_extract(host, r"\.([a-z]+)$", 1), F.lit("")).alias("suffix"),
        text.alias("text"),
    )


def keep_identified(docs: DataFrame, key: str = "doc_id", text: str = "text", declared: str = "lang", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that are accepted, with all their columns; others go.

    Rows are decided one by one, by their own text and evidence: those that repeat an id or lack one like all others. Rows
    alike in id, text, declaration and host share a decision. An empty table gives no rows; names may clash.
    """
    name = free_name(docs)
    told = [F.col(c) for c in (key, text, declared, host)]
    rows = docs.withColumn(name, F.xxhash64(*told, *(c.isNull() for c in told)))
    gone = identified(document_rows(rows, name, text, declared, host)).where("not accepted").select("doc_id")
    return without_rows(rows, gone, name).select(*(F.col(f"`{c}`") for c in docs.columns))
