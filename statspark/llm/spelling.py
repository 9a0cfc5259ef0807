"""Spelling variant grouping by pivotal grams.

Two words within one edit keep a bigram of every two disjoint ones. Bigrams are ordered from rare to frequent; a word's
prefix are its three rarest occurrences with all that are as rare, and of the prefix a dynamic programme picks the two
disjoint pivots that stand in the fewest words. Of two near words, the one whose prefix ends no later has a pivot in
the other's prefix, at a place that the difference of lengths settles but for one step.

Position limits go further than that: where an edit lies settles what the words share. Before a surviving pivot it leaves
the rest from the pivot on, behind it all up to the pivot. So the word asks by its two pivots, the other answers by each
occurrence of its prefix, and both by the letters that must then be equal:

1. an edit before both pivots: the rest from the first on;
2. an edit behind both: the beginning up to the second;
3. between them, or in the second with two letters or more behind it: the beginning up to the first, and the last two;
4. in the first with two letters or more before it: the first two, and the rest from the second on;
5. in the first with fewer before it: the rest behind the first (answered by the rests behind one to four letters);
6. in the second with fewer behind it: the beginning before the second (answered likewise).

A key is a number made of these letters, the length and the case; words that meet under one are verified by their edit
distance. Words are of the 90 letters a-z and U+00C0-U+00FF, so there are at most 8,100 bigrams: their counts fit in every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ascii_lower, in_batches, materialised, written

LETTER = "[A-Za-zÀ-ÿ]"
LETTERS = 26 + 64
GRAMS = LETTERS * LETTERS
#: Of one edit: a word's prefix has 2 * 1 + 1 bigrams, and 1 + 1 of them are pivots.
PREFIX = 3
#: Letters beside a pivot that make a key of their own (cases 3 to 6).
SIDE = 2
#: Odd factors that spread keys over 64 bits.
SPREAD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)


def counted(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 7, times: int = 2, every: int = 0) -> DataFrame:
    """word, n: lower-cased runs (A-Z alone) of at least ``least`` letters that occur at least ``times`` times.

    ``every`` > 0 damages a word where its crc32 with the row's id is a multiple: it loses one letter. Null texts have no
    words; a null id counts as ''. Rows that repeat are counted again. An empty table gives no rows; columns other than key
    and text are not read, so their names cannot clash.
    """
    runs = F.regexp_extract_all(F.col(text), F.lit(f"{LETTER}{{{least},}}"), F.lit(0))
    each = docs.select(F.coalesce(F.col(key).cast("long").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    each = each.select("id", ascii_lower(F.col("run")).alias("run"))
    if every:
        each = each.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
        place = F.col("h") % F.length("run")
        shorter = F.concat(F.substring("run", F.lit(1), place.cast("int")), F.substring("run", (place + 2).cast("int"), F.length("run")))
        each = each.select(F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run")).alias("run"))
    words = each.where(F.length("run") >= least).groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return words.where(F.col("n") >= times)


def _bigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word, place and number of every bigram, and the words' lengths."""
    code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    letter = np.where(code < 128, code - 97, code - 0xC0 + 26)
    length = np.array([len(w) for w in words], np.int64)
    word = np.repeat(np.arange(len(words)), length)
    place = np.arange(len(code)) - np.repeat(np.cumsum(length) - length, length)
    here = np.flatnonzero(place < length[word] - 1) if len(code) else np.zeros(0, np.int64)
    return word[here], place[here], letter[here] * LETTERS + letter[here + 1] if len(here) else here, length


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(GRAMS, np.int64)
    for batch in batches:
        total += np.bincount(_bigrams(batch.column(0).to_pylist())[2], minlength=GRAMS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["gram", "n"])


def gram_counts(words: DataFrame) -> np.ndarray:
    """Occurrences of each of the 8,100 bigrams in different words."""
    counts = np.zeros(GRAMS, np.int64)
    for r in in_batches(words.select("word"), _tallied, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[r["gram"]] = r["n"]
    return counts


def prefixes_and_pivots(words: list[str], counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of every prefix occurrence, in order of word and place: word, place, bigram, whether it is a pivot; and for each word
    the rank where its prefix ends."""
    rank = np.empty(GRAMS, np.int64)
    rank[np.lexsort((np.arange(GRAMS), counts))] = np.arange(GRAMS)
    word, place, gram, length = _bigrams(words)
    order = np.lexsort((place, rank[gram], word))
    first = np.concatenate([[0], np.cumsum(length - 1)[:-1]]).astype(np.int64)
    last = rank[gram][order][first + PREFIX - 1]
    inside = rank[gram] <= last[word]
    word, place, gram = word[inside], place[inside], gram[inside]
    # Least cost of one occurrence up to each place, anew for each word; then of a pair that ends there.
    cost = counts[gram].astype(np.float64)
    step = float(counts.max(initial=0)) + 1
    lowered = cost - word * step
    least = np.minimum.accumulate(lowered)
    at = np.maximum.accumulate(np.where(lowered == least, np.arange(len(word)), 0))
    n = np.arange(len(word))
    near = np.concatenate([[False], (word[1:] == word[:-1]) & (place[1:] - place[:-1] == 1)])
    back = np.maximum(n - 1 - near, 0)
    possible = (n - 1 - near >= 0) & (word[back] == word)
    pair = np.where(possible, cost + cost[at[back]], np.inf)
    best = np.lexsort((n, pair, word))
    best = best[np.concatenate([[True], word[best][1:] != word[best][:-1]])] if len(word) else n
    pivot = np.zeros(len(word), bool)
    pivot[best] = pivot[at[back[best]]] = True
    return word, place, gram, pivot, last


class _Letters:
    """Numbers of the beginnings and ends of words: equal ones have equal numbers (sums modulo 2^64)."""

    def __init__(self, words: list[str]):
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
        self.length = np.array([len(w) for w in words], np.int64)
        self.first = np.cumsum(self.length) - self.length
        place = np.arange(len(code)) - np.repeat(self.first, self.length)
        power = np.multiply.accumulate(np.full(int(self.length.max()), SPREAD[0], np.uint64))
        zero = np.zeros(1, np.uint64)
        self.ahead = np.concatenate([zero, np.cumsum(code * power[place])])
        self.behind = np.concatenate([zero, np.cumsum(code * power[np.repeat(self.length, self.length) - 1 - place])])

    def upto(self, word: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        return self.ahead[self.first[word] + n] - self.ahead[self.first[word]]

    def since(self, word: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        return self.behind[self.first[word] + self.length[word]] - self.behind[self.first[word] + n]


def _key(case: int, left, right, length: np.ndarray) -> np.ndarray:
    h = left * np.uint64(SPREAD[1]) + right * np.uint64(SPREAD[2]) + length.astype(np.uint64) * np.uint64(SPREAD[3]) + np.uint64(case)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(SPREAD[4])
    return (h ^ (h >> np.uint64(33))).view(np.int64)


def asked(words: list[str], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word and key of everything that words ask for by their pivots; where each word's prefix ends."""
    word, place, _, pivot, last = prefixes_and_pivots(words, counts)
    text, none = _Letters(words), np.uint64(0)
    every = np.arange(len(words))
    p, q = place[np.flatnonzero(pivot)].reshape(-1, 2).T
    length = text.length
    cases = [
        (1, every, lambda w: (none, text.since(w, p[w]))),
        (2, every, lambda w: (text.upto(w, q[w] + 2), none)),
        (3, every, lambda w: (text.upto(w, p[w] + 2), text.since(w, length[w] - SIDE))),
        (4, np.flatnonzero(p >= SIDE), lambda w: (text.upto(w, SIDE), text.since(w, q[w]))),
        (5, np.flatnonzero(p < SIDE), lambda w: (none, text.since(w, p[w] + 2))),
        (6, np.flatnonzero(length - q - 2 < SIDE), lambda w: (text.upto(w, q[w]), none)),
    ]
    found = [(w, _key(case, *sides(w), length[w] + longer)) for case, w, sides in cases for longer in (-1, 0, 1)]
    return np.concatenate([w for w, _ in found]), np.concatenate([k for _, k in found]), last


def answered(words: list[str], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for everything that words answer to by their prefixes."""
    word, place, _, _, last = prefixes_and_pivots(words, counts)
    text, none = _Letters(words), np.uint64(0)
    length = text.length
    found = [
        (word, _key(1, none, text.since(word, place), length[word])),
        (word, _key(2, text.upto(word, place + 2), none, length[word])),
        (word, _key(3, text.upto(word, place + 2), text.since(word, length[word] - SIDE), length[word])),
        (word, _key(4, text.upto(word, SIDE), text.since(word, place), length[word])),
    ]
    for n in range(1, SIDE + 3):
        w = np.flatnonzero(length > n)
        found += [(w, _key(5, none, text.since(w, n), length[w])), (w, _key(6, text.upto(w, length[w] - n), none, length[w]))]
    return np.concatenate([w for w, _ in found]), np.concatenate([k for _, k in found]), last


def _keyed(make, counts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            word, key, last = make(batch.column(0).to_pylist(), counts)
            order = np.argsort(word, kind="stable")
            ends = np.searchsorted(word[order], np.arange(len(batch) + 1)).astype(np.int32)
            keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(key[order]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(last, pa.int32()), keys], ["word", "last", "keys"])

    return run


def near_words(words: DataFrame) -> DataFrame:
    """word, other: every pair of words within exactly one inserted, deleted or replaced code point, once.

    Words are distinct, of the 90 letters, and of four code points at least; columns other than ``word`` are not read. AQE
    splits keys that are hot; a word has a bounded number of near ones, so nothing else can be.
    """
    counts = gram_counts(words)
    sides = [
        in_batches(words.select("word"), _keyed(make, counts), "word string, last int, keys array<bigint>").select(
            F.explode("keys").alias("key"), "last", "word"
        )
        for make in (asked, answered)
    ]
    p, q = sides[0].alias("p"), sides[1].alias("q")
    earlier = (F.col("p.last") < F.col("q.last")) | ((F.col("p.last") == F.col("q.last")) & (F.col("p.word") < F.col("q.word")))
    one = F.levenshtein("p.word", "q.word", 1) == 1
    met = p.join(q, [F.col("p.key") == F.col("q.key"), earlier, one])
    return met.select(F.col("p.word").alias("word"), F.col("q.word").alias("other")).distinct()


def _last(links: DataFrame) -> DataFrame:
    """word, root: links (word, form) followed to the end; each round doubles the steps, and forms are ever more frequent."""
    reached = materialised(links.select("word", F.col("form").alias("root")))
    while not reached.alias("a").join(reached.alias("b"), F.col("a.root") == F.col("b.word"), "left_semi").isEmpty():
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        both = reached.join(further, "root", "left")
        reached = materialised(both.select("word", F.coalesce("next", "root").alias("root")))
    return reached


def variants(words: DataFrame, factor: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n, one row per row of ``words`` (word, n).

    A word's form is its near word with the largest n (of equal ones the smallest by code point) if that is at least
    ``factor`` times the word's own, else null; its root is the last form of forms, or the word itself.
    """
    if factor < 2:
        raise ValueError("a form must be more frequent than its word")
    words = written(words)
    pairs = materialised(near_words(words))
    both = pairs.union(pairs.select("other", "word")).join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    most = -F.col("best.less")
    fits = most >= factor * F.col("n")
    formed = materialised(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.when(fits, F.col("best.other")).alias("form"),
            F.when(fits, most).alias("form_n"),
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        )
    )
    roots = _last(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
