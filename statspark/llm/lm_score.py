"""Language-model scores by online logistic context mixing, beside a smoothed unigram base.

A text is a row of bytes with an end; a Huffman code for each preceding byte, made from all training pairs, turns each
byte into a few binary decisions. Hashed contexts (the last 2, 4 and 6 bytes, and the word so far) predict every decision
from counts of all training texts. A slot's counts are told as one of 256 states (how many, and how uneven), and what a
state says is learned from every training decision, met in its slot's counts without itself. The predictions are mixed by
weights that are equal at first and learn while a text is scored, and a map of the mixed probability, which learns from
the text too, refines it.

Tables are hashed, and what one document alone says is lost in them among the counts of all. So each text is cut into
passages (some 250 bytes, by content), and Spark counts in the whole corpus which passage follows which. A passage that
follows the same one in training rows other than the text's own has the share of its followers as a second probability,
weighed by how often such a share holds good for training rows. The base scores words by their training counts.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import in_batches, written

ORDERS = (2, 4, 6)
K = len(ORDERS) + 1
END = 256
#: Symbols: bytes and the end.
SYMBOLS = 257
#: Training bytes per slot of a predictor's table, least bits of its size (small inputs get more slots than their
#: share), and bits of the hashes.
PER_SLOT, LEAST_BITS, HASH_BITS = 256, 21, 32
#: Tables of up to so many bits are counted in arrays by every task; for larger ones tasks sort what some texts meet.
COUNTED_BITS = 22
#: Tables of up to so many bits (a byte for each slot and context: 128 MiB) are broadcast; larger ones stay with Spark, and
#: texts ask for their slots by a shuffle.
HELD_BITS = 25
#: Decisions of a text between two updates of its weights: the first and the greatest number (it doubles in between).
FIRST_SEGMENT, SEGMENT = 64, 4096
#: Segments of rounds from this length on are multiplied by their text's weights one by one.
ONE_BY_ONE = 512
#: What the weights are at first, sizes of the updates of weights and of the refining map, and the map's places over the logit.
WEIGHT, RATE, REFINE, PLACES = 0.3, 1.5, 1.0, 24
#: Bytes of texts scored together, the same where they ask for slots and where they are counted by sorting, and slots in a
#: part of a table as it is merged.
TOGETHER, ASKING, SORTING, PART = 64_000, 2_000_000, 4_000_000, 1 << 12
#: Decisions that a task counts in 32 bits before it hands its counts on.
COUNTED = 1 << 31
#: Distinct words that a task counts before it hands its counts on.
WORDS_HELD = 200_000
#: Up to so many of the most frequent words are what every task gets the counts of; the others' are joined.
FREQUENT = 150_000
#: A passage ends where the hash of the last 6 bytes is among the least 1 in 256; the hash of what stands before the first one.
CUT, BEGIN = np.uint32(1 << 24), np.uint64(0x8C5F1E3A2D7B9461)
_ODD = np.uint32(2654435761)


@dataclass
class Code:
    """Huffman code: where a symbol's decisions begin, how many they are, and each decision's node (0 is the root) and bit.

    There is one code for all symbols, or one for those behind each symbol.
    """

    start: np.ndarray
    size: np.ndarray
    node: np.ndarray
    bit: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Code:
        """By the counts of symbols, or of pairs of symbols (preceding one first)."""
        if counts.ndim == 2:
            # Behind a rare symbol the code is much like that for all.
            share = counts.sum(axis=0) / max(1, counts.sum())
            codes = [cls.of(256 * row + np.rint(2048 * share).astype(np.int64)) for row in counts]
            begins = np.cumsum([0, *(len(c.node) for c in codes[:-1])])
            start = np.concatenate([c.start + b for c, b in zip(codes, begins, strict=True)])
            return cls(start, *(np.concatenate([getattr(c, x) for c in codes]) for x in ("size", "node", "bit")))
        heap = [(int(c) + 1, i, i) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        parent, nodes = {}, 0
        order = len(heap)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            name = -1 - nodes
            parent[a[2]], parent[b[2]] = (name, 0), (name, 1)
            heapq.heappush(heap, (a[0] + b[0], order, name))
            nodes, order = nodes + 1, order + 1
        start, size, node, bit = [], [], [], []
        for symbol in range(len(counts)):
            path, at = [], symbol
            while at in parent:
                at, one = parent[at]
                path.append((-1 - at, one))
            start.append(len(node))
            size.append(len(path))
            node += [n for n, _ in reversed(path)]
            bit += [b for _, b in reversed(path)]
        return cls(np.array(start), np.array(size), nodes - 1 - np.array(node, np.int64), np.array(bit, np.uint8))

    @functools.cached_property
    def steps(self) -> np.ndarray:
        """Node and bit of each decision as one number."""
        return (self.node << 1) | self.bit

    def places(self, symbols: np.ndarray) -> np.ndarray:
        """Where ``start`` and ``size`` have each symbol of texts with their ends."""
        return symbols if len(self.size) == SYMBOLS else paired(symbols)


def paired(symbols: np.ndarray) -> np.ndarray:
    """Number of each symbol's pair with the one before; the first of a text stands behind an end."""
    pairs = symbols.astype(np.int64)
    pairs[0] += END * SYMBOLS
    pairs[1:] += symbols[:-1].astype(np.int64) * SYMBOLS
    return pairs


_P = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def ended(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of texts with their ends, and their symbols."""
    sizes = np.array([len(t) + 1 for t in texts])
    symbols = np.frombuffer(b"\0".join([*texts, b""]), np.uint8).astype(np.uint32)
    symbols[np.cumsum(sizes) - 1] = END
    return sizes, symbols


def contexts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Symbols of texts with their ends, each one's text, and a 32-bit hash of every context of each symbol."""
    return _hashed(texts)[:3]


def _hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """The same, with the sums and powers that give any run of symbols a 64-bit hash."""
    sizes, symbols = ended(texts)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)
    n = len(symbols)
    starts = ends - sizes
    h, out, last = np.zeros(n, np.uint32), [], None
    for order in range(1, max(ORDERS) + 1):
        before = np.zeros(n, np.uint32)
        before[order:] = symbols[:-order] + np.uint32(1)
        early = (starts[:, None] + np.arange(order)).ravel()
        before[early[early < n]] = 0
        last = before if last is None else last
        h = (h + before) * _ODD + np.uint32(order)
        if order in ORDERS:
            out.append((h ^ (h >> np.uint32(15))) * _ODD)
    white = np.zeros(n, bool)
    white[1:] = symbols[:-1] <= 32
    white[starts] = True
    first = np.maximum.accumulate(np.where(white, np.arange(n), 0))
    power = np.cumprod(np.full(n, _P))
    back = np.cumprod(np.full(n, _INVERSE))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((symbols + np.uint32(1)).astype(np.uint64) * power, out=total[1:])
    word = (total[:-1] - total[first]) * back[first]
    h = (((word * _P) >> np.uint64(32)).astype(np.uint32) ^ np.uint32(0x5BD1E995)) + last * _ODD
    out.append((h ^ (h >> np.uint32(15))) * _ODD)
    return symbols, owner, out, total, back


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _P
    return h ^ (h >> np.uint64(29))


@dataclass
class Passages:
    """Passages of texts in their order: each one's text and first symbol, hashes of the one before it in the text and of itself,
    how often the former stands before any passage of the text (0: it is the text's begin) and before this one."""

    owner: np.ndarray
    start: np.ndarray
    before: np.ndarray
    own: np.ndarray
    n_before: np.ndarray
    n_both: np.ndarray

    @classmethod
    def of(cls, owner: np.ndarray, hashes: list[np.ndarray], total: np.ndarray, back: np.ndarray) -> Passages:
        new = hashes[len(ORDERS) - 1] < CUT
        first = np.diff(owner, prepend=-1) > 0
        start = np.flatnonzero(new | first)
        own = _mixed((total[np.append(start[1:], len(owner))] - total[start]) * back[start])
        begins = first[start]
        before = np.where(begins, _mixed(own ^ BEGIN), np.roll(own, 1))
        owner = owner[start]
        text = owner.astype(np.uint64) * _P
        n_before, n_both = (_times(_mixed(h ^ text)) for h in (before, before + own * _P))
        return cls(owner, start, before, own, np.where(begins, 0, n_before), n_both)


def _times(keys: np.ndarray) -> np.ndarray:
    _, again, n = np.unique(keys, return_inverse=True, return_counts=True)
    return n[again]


def decisions(code: Code, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbol of each decision and its place in the code."""
    places = code.places(symbols)
    size = code.size.take(places)
    of = np.repeat(np.arange(len(symbols)), size)
    return of, np.arange(len(of)) + np.repeat(code.start.take(places) - np.cumsum(size) + size, size)


def slots(h: np.ndarray, of: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    """A context's decisions lie in one window of slots, the frequent nodes close together."""
    at = (h >> np.uint32(32 - bits)).astype(np.int64).take(of)
    at ^= node
    return at


def placed(code: Code, bits: int, texts: list[bytes]) -> Iterator[np.ndarray]:
    """Slot and bit of each decision as one number, for each context."""
    symbols, _, hashes = contexts(texts)
    of, at = decisions(code, symbols)
    # The lowest bit of a node's and of a window's place is free.
    step = code.steps.take(at)
    for h in hashes:
        place = ((h >> np.uint32(32 - bits)).astype(np.int64) << 1).take(of)
        place ^= step
        yield place


def tallied(code: Code, bits: int, texts: list[bytes], into: np.ndarray) -> int:
    """Add the decisions of texts to counts (context, slot and bit); how many they are."""
    for k, place in enumerate(placed(code, bits, texts)):
        np.add.at(into[k], place, into.dtype.type(1))
    return len(place)


#: Class of a slot's number of counts; steps of the odds within a class.
_CLASS = np.array([0, 1, 2, 3, 4, 4, *[5] * 5, *[6] * 20, 7], np.uint8)
STEP, STEPS = 0.45, 32
#: What a state says by itself: the logit of its odds' middle.
_MIDDLE = (np.arange(256) % STEPS - STEPS // 2) * STEP


def logits(counts: np.ndarray) -> np.ndarray:
    """Logit of the share of ones among counts, each a little raised."""
    zero, one = counts[..., 0].astype(np.float32), counts[..., 1].astype(np.float32)
    return np.log((one + np.float32(0.3)) / (zero + np.float32(0.3)))


def states(counts: np.ndarray) -> np.ndarray:
    """The state of each slot's counts; 0 where there are none."""
    total = counts.sum(axis=-1)
    number = _CLASS[np.minimum(total, len(_CLASS) - 1)]
    step = np.clip(np.rint(logits(counts) / STEP) + STEPS // 2, 0, STEPS - 1)
    return np.where(total > 0, number * STEPS + step.astype(np.uint8), 0).astype(np.uint8)


def met(counts: np.ndarray) -> np.ndarray:
    """How often either bit was met in each state, when every counted decision meets its slot's counts without itself."""
    total = np.zeros((256, 2), np.int64)
    for bit in (0, 1):
        others = counts[counts[:, bit] > 0].astype(np.int64)
        times = others[:, bit].copy()
        others[:, bit] -= 1
        total[:, bit] = np.bincount(states(others), times, 256).astype(np.int64)
    return total


def in_rounds(counts: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """An order of decisions by rounds: a round has the next segment of each text that has one. With it each round's texts
    and how many decisions they bring."""
    starts, low, size, parts, rounds = np.cumsum(counts) - counts, 0, FIRST_SEGMENT, [np.empty(0, np.int64)], []
    while len(texts := np.flatnonzero(counts > low)):
        n = np.minimum(counts[texts] - low, size)
        parts.append(np.repeat(starts[texts] + low - np.cumsum(n) + n, n) + np.arange(n.sum()))
        rounds.append((texts, n))
        low, size = low + size, min(2 * size, SEGMENT)
    return np.concatenate(parts), rounds


@dataclass
class Mixer:
    """What each state says in each context."""

    maps: np.ndarray

    @classmethod
    def plain(cls) -> Mixer:
        said = np.where(np.arange(256) < STEPS, 0, _MIDDLE)
        return cls(np.tile(said, (K, 1)).astype(np.float32))

    @classmethod
    def of(cls, bits: np.ndarray) -> Mixer:
        """By how often either bit was met (context, state and bit); a state that was hardly met says what it says by itself."""
        prior = 1 / (1 + np.exp(-_MIDDLE))
        said = np.log((bits[..., 1] + 4 * prior + 0.02) / (bits[..., 0] + 4 * (1 - prior) + 0.02))
        return cls(np.where(np.arange(256) < STEPS, 0, said).astype(np.float32))

    def score(
        self,
        seen: list[np.ndarray],
        bit: np.ndarray,
        rounds: list[tuple[np.ndarray, np.ndarray]],
        n: int,
        parts: tuple[np.ndarray, Callable[[np.ndarray], np.ndarray]] | None = None,
    ) -> np.ndarray:
        """Natural logarithm of each text's probability, or with ``parts`` (which decisions begin a part, and a function that gives
        the parts of decisions) of each part's. Every text starts from the same weights and the same map; after each of its
        segments they move along its errors."""
        x = np.empty((K, len(bit)), np.float32)
        for k, state in enumerate(seen):
            self.maps[k].take(state, mode="clip", out=x[k])
        sign = bit * np.float32(2) - np.float32(1)
        weights = np.full((n, K), WEIGHT, np.float32)
        refine = np.tile(_centres().astype(np.float32), n)
        score, a = np.zeros(n if parts is None else np.count_nonzero(parts[0])), 0
        for turn, (texts, size) in enumerate(rounds):
            b, begins = a + int(size.sum()), np.cumsum(size) - size
            s = sign[a:b]
            # Long segments are multiplied one by one. How, the round alone decides, so that equal texts have equal scores.
            each = []
            if FIRST_SEGMENT << turn >= ONE_BY_ONE:
                each = list(zip(texts.tolist(), begins.tolist(), (begins + size).tolist(), strict=True))
                z = np.empty(b - a, np.float32)
                for t, i, j in each:
                    np.dot(weights[t], x[:, a + i : a + j], out=z[i:j])
            else:
                z = np.repeat(weights[texts, 0], size) * x[0, a:b]
                for k in range(1, K):
                    z += np.repeat(weights[texts, k], size) * x[k, a:b]
            np.clip(z, -11.5, 11.5, out=z)
            place = np.rint(z + np.float32(PLACES // 2)).astype(np.int64) + np.repeat(texts * (PLACES + 1), size)
            better = np.float32(0.5) * (refine.take(place) + z)
            right = 1 / (1 + np.exp(-better * s))
            # Products of up to 16 probabilities, each of 1e-6 at least, before the logarithm.
            runs = -(-size // 16)
            ends = np.cumsum(runs)
            at = np.repeat(begins - 16 * (ends - runs), runs) + 16 * np.arange(ends[-1])
            if parts is None:
                score[texts] += np.add.reduceat(np.log(np.multiply.reduceat(right, at, dtype=float)), ends - runs)
            else:
                begins_run = parts[0][a:b].copy()
                begins_run[at] = True
                at = np.flatnonzero(begins_run)
                score += np.bincount(parts[1](a + at), np.log(np.multiply.reduceat(right, at, dtype=float)), len(score))
            # The errors of the mixed logit move the weights, those of the refined one its map.
            error = s / (1 + np.exp(z * s))
            step = (RATE / (size + 64)).astype(np.float32)
            for (t, i, j), one in zip(each, step, strict=False):
                weights[t] += one * np.dot(x[:, a + i : a + j], error[i:j])
            if not each:
                for k in range(K):
                    weights[texts, k] += step * np.add.reduceat(error * x[k, a:b], begins)
            first = int(texts[0]) * (PLACES + 1)
            met = place - first
            held = np.bincount(met)
            refine[first : first + len(held)] += (REFINE / (held + 64) * np.bincount(met, (1 - right) * s)).astype(np.float32)
            a = b
        return score


def _centres() -> np.ndarray:
    return np.arange(PLACES + 1) - PLACES / 2


@dataclass
class Model:
    code: Code
    bits: int
    #: States by context and slot, or a table of part and counts with Spark.
    table: np.ndarray | DataFrame
    mixer: Mixer

    def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each text with its end by the tables alone."""
        passages, logs = self.passages(texts)
        return np.bincount(passages.owner, logs, len(texts))

    def passages(self, texts: list[bytes]) -> tuple[Passages, np.ndarray]:
        """Passages of texts with the log10 probability of each."""
        return scored(self.code, self.mixer, texts, lambda k, h, of, node: self.table[k].take(slots(h, of, node, self.bits)))


def scored(code: Code, mixer: Mixer, texts: list[bytes], state) -> tuple[Passages, np.ndarray]:
    """Passages and their log10 probabilities by the states of their decisions (a function of context, hashes, symbols and nodes)."""
    symbols, owner, hashes, total, back = _hashed(texts)
    passages = Passages.of(owner, hashes, total, back)
    size = code.size.take(code.places(symbols))
    order, rounds = in_rounds(np.bincount(owner, size, minlength=len(texts)).astype(np.int64))
    start = np.cumsum(size) - size
    begins = np.zeros(len(order), bool)
    begins[start[passages.start]] = True
    part = np.repeat(np.arange(len(passages.start)), np.diff(np.append(passages.start, len(symbols))))
    of = np.repeat(np.arange(len(symbols)), size).take(order)
    step = code.steps.take(order + (code.start.take(code.places(symbols)) - start).take(of))
    node = step >> 1
    seen = [state(k, h, of, node) for k, h in enumerate(hashes)]
    told = mixer.score(seen, (step & 1).astype(np.uint8), rounds, len(texts), (begins.take(order), lambda which: part.take(of.take(which))))
    return passages, told * math.log10(math.e)


#: What is kept of each passage (see ``Passages``), and the log10 probability that the tables give it.
PASSAGES = "array<struct<before: long, own: long, n_before: int, n_both: int, log: double>>"


_PASSAGES = pa.list_(pa.struct({"before": pa.int64(), "own": pa.int64(), "n_before": pa.int32(), "n_both": pa.int32(), "log": pa.float64()}))


def _lists(passages: Passages, logs: np.ndarray, n: int) -> pa.Array:
    """A list of each text's passages."""
    columns = (passages.before.view(np.int64), passages.own.view(np.int64), passages.n_before.astype(np.int32), passages.n_both.astype(np.int32), logs)
    values = pa.StructArray.from_arrays([pa.array(c) for c in columns], ["before", "own", "n_before", "n_both", "log"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(passages.owner, np.arange(n + 1)).astype(np.int32)), values)


def passage_gains(rows: DataFrame, training: int) -> DataFrame:
    """row, gain: log10 of how much likelier the followers of passages in other rows make each row, of rows (row, trained,
    passages) of which ``training`` ones are trained on.

    The probability of a passage becomes w * (share among the followers of the one before) + (1 - w) * (that by the tables).
    A text's own passages are not among the followers. w is the share of the training rows' passages that are among those
    of the one before, for each class of how many followers that has (2 to 3, 4 to 7, ...); begins are a class of their own.
    """
    each = rows.select("row", "trained", F.inline("passages")).repartition("before")
    trained = F.col("trained").cast("long")
    both, before = Window.partitionBy("before", "own"), Window.partitionBy("before")
    each = each.withColumn("both", F.sum(trained).over(both) - trained * F.col("n_both"))
    begins = F.col("n_before") == 0
    others = F.when(begins, F.lit(training) - trained).otherwise(F.sum(trained).over(before) - trained * F.col("n_before"))
    kind = F.when(begins, -1).otherwise(F.floor(F.log2("others"))).cast("int")
    found = each.withColumn("others", others).where("others > 0").select("row", "trained", "log", "both", "others", kind.alias("kind"))
    found = written(found)
    hits = found.where("trained").groupBy("kind").agg(F.count(F.when(F.col("both") > 0, 1)).alias("hits"), F.count(F.lit(1)).alias("n"))
    weight = {r["kind"]: (r["hits"] + 0.5) / (r["n"] + 1) for r in hits.collect()}
    w = F.coalesce(F.create_map(*(F.lit(x) for pair in weight.items() for x in pair))[F.col("kind")], F.lit(0.5)) if weight else F.lit(0.5)
    share = F.log10(w * F.col("both") / F.col("others"))
    rest = F.log10(1 - w) + F.col("log")
    # The larger one of two logarithms, and what the smaller one adds to it.
    sum_ = F.greatest(share, rest) + F.log1p(F.pow(F.lit(10.0), -F.abs(share - rest))) / math.log(10)
    gain = F.when(F.col("both") > 0, sum_).otherwise(rest) - F.col("log")
    # Whole numbers, so that the order of a row's passages does not matter.
    return found.groupBy("row").agg((F.sum(F.round(gain * 1e9).cast("long")) / 1e9).alias("gain"))


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def _raw(column: pa.Array) -> list[bytes]:
    return [(x.as_py() or "").encode("utf-8", "surrogatepass") for x in column]


def _together(texts: list[bytes], most: int = TOGETHER) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for i, t in enumerate(texts, 1):
        held += len(t)
        if held >= most or i == len(texts):
            yield start, i
            start, held = i, 0


def _pairs_counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SYMBOLS * SYMBOLS, np.int64)
    for batch in batches:
        raw = _raw(batch.column(0))
        for a, b in _together(raw, ASKING):
            total += np.bincount(paired(ended(raw[a:b])[1]), minlength=len(total))
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["pair", "n"])


def _planes(counts: np.ndarray) -> bytes:
    """The counts' low bytes, then the next ones, as far as there are any but zeros."""
    planes = np.ascontiguousarray(counts, np.int64).view(np.uint8).reshape(-1, 8)
    return planes[:, : max(1, (int(counts.max(initial=0)).bit_length() + 7) // 8)].T.tobytes()


def _counts_of(planes: bytes) -> np.ndarray:
    some = np.frombuffer(planes, np.uint8).reshape(-1, 2 * PART)
    whole = np.zeros((2 * PART, 8), np.uint8)
    whole[:, : len(some)] = some.T
    return whole.view(np.int64).ravel()


def _tables_counted(code: Code, bits: int):
    def parts_of(total: np.ndarray) -> Iterator[pa.RecordBatch]:
        parts = total.reshape(-1, 2 * PART)
        some = np.flatnonzero(parts.any(axis=1))
        for i in range(0, len(some), 256):
            chunk = some[i : i + 256]
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk.astype(np.int32)), pa.array([_planes(parts[j]) for j in chunk], pa.binary())], ["part", "counts"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, done = np.zeros((K, 2 << bits), np.uint32), 0
        for batch in batches:
            raw = _raw(batch.column(0))
            for a, b in _together(raw):
                size = 40 * (sum(map(len, raw[a:b])) + b - a)
                if done + size > COUNTED:
                    yield from parts_of(total)
                    total, done = np.zeros((K, 2 << bits), np.uint32), 0
                done += tallied(code, bits, raw[a:b], total)
        yield from parts_of(total)

    return run


def _tables_added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            add = _counts_of(counts.as_py())
            if part in total:
                total[part] += add
            else:
                total[part] = add
    columns = [pa.array(list(total), pa.int32()), pa.array([_planes(x) for x in total.values()], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, ["part", "counts"])


def _states_of_parts(bits: int):
    """The states of each part's slots; last, under part -1, what the task's slots have met (context, state and bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((K, 256, 2), np.int64)
        for batch in _tables_added(batches):
            told = []
            for part, held in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = _counts_of(held.as_py()).reshape(-1, 2)
                told.append(states(counts).tobytes())
                total[part * PART >> bits] += met(counts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(told, pa.binary())], ["part", "states"])
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "states"])

    return run


def keys(code: Code, bits: int, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each context, the decisions' slots (numbered over all contexts) and bits."""
    symbols, _, hashes = contexts(texts)
    of, at = decisions(code, symbols)
    node, bit = code.node[at], code.bit[at]
    for k, h in enumerate(hashes):
        yield slots(h, of, node, bits) + (k << bits), bit


def _by_part(at: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Part, begin and end of the runs of sorted slots that lie in one part."""
    part = at // PART
    edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    yield from zip(part[edges[:-1]].tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True)


def _slots_counted(code: Code, bits: int):
    """Counts of the slots that some texts meet, a row for each part: places (slot and bit) and their counts, a byte each if
    all are below 256, else eight."""
    kind = np.uint32 if bits < 32 else np.int64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = _raw(batch.column(0))
            for a, b in _together(raw, SORTING):
                each = [[x.astype(kind) for x in placed(code, bits, raw[a + i : a + j])] for i, j in _together(raw[a:b])]
                for k in range(K):
                    at = np.concatenate([x[k] for x in each])
                    at.sort()
                    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                    n = np.diff(np.append(first, len(at)))
                    at = at[first].astype(np.int64) + (k << bits + 1)
                    runs = list(_by_part(at >> 1))
                    small = np.maximum.reduceat(n, [i for _, i, _ in runs]) < 256
                    place, byte = (at % (2 * PART)).astype(np.uint16), n.astype(np.uint8)
                    columns = [
                        pa.array([p for p, _, _ in runs], pa.int32()),
                        pa.array([place[i:j].tobytes() for _, i, j in runs], pa.binary()),
                        pa.array([(byte if x else n)[i:j].tobytes() for (_, i, j), x in zip(runs, small.tolist(), strict=True)], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["part", "places", "counts"])

    return run


def _numbers(places: bytes, counts: bytes) -> np.ndarray:
    """Counts of so many places as ``_slots_counted`` gives them."""
    return np.frombuffer(counts, np.uint8 if 2 * len(counts) == len(places) else np.int64)


def _slots_added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, sorted by part, added up: one row for each part, one part in memory at a time."""
    names = ["part", "places", "counts"]

    def row(part: int, total: np.ndarray) -> pa.RecordBatch:
        some = np.flatnonzero(total)
        values = [pa.array([part], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (some.astype(np.uint16), total[some]))]
        return pa.RecordBatch.from_arrays(values, names)

    now, total = None, np.zeros(2 * PART, np.int64)
    for batch in batches:
        for part, places, counts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            if part != now:
                if now is not None:
                    yield row(now, total)
                now, total = part, np.zeros(2 * PART, np.int64)
            places, counts = places.as_py(), counts.as_py()
            total[np.frombuffer(places, np.uint16)] += _numbers(places, counts)
    if now is not None:
        yield row(now, total)


def _part_of(places: bytes, counts: bytes) -> np.ndarray:
    total = np.zeros(2 * PART, np.int64)
    total[np.frombuffer(places, np.uint16)] = _numbers(places, counts)
    return total.reshape(-1, 2)


def _met_in_parts(bits: int):
    """What the slots of a task's parts have met (context, state and bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((K, 256, 2), np.int64)
        for batch in batches:
            for part, places, counts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                total[part * PART >> bits] += met(_part_of(places.as_py(), counts.as_py()))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["met"])

    return run


def _states_of_slots(bits: int):
    """The same as ``_states_of_parts`` from the rows of ``_slots_counted``, sorted by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((K, 256, 2), np.int64)
        for batch in _slots_added(batches):
            counts = _part_of(batch.column(1)[0].as_py(), batch.column(2)[0].as_py())
            total[batch.column(0)[0].as_py() * PART >> bits] += met(counts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([states(counts).tobytes()], pa.binary())], ["part", "states"])
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "states"])

    return run


def _in_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row, doc_id, text) with the number of the first row that they are scored together with."""
    for batch in batches:
        ids, chunk = batch.column("row").to_pylist(), []
        for a, b in _together(_raw(batch.column("text")), ASKING):
            chunk += [ids[a]] * (b - a)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chunk, pa.int64())], ["row", "doc_id", "text", "chunk"])


def _chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[int], list[bytes]]]:
    for batch in batches:
        chunk, ids, raw = batch.column("chunk").to_numpy(), batch.column("row").to_pylist(), _raw(batch.column("text"))
        edges = np.flatnonzero(np.diff(chunk, prepend=-1, append=-1)).tolist()
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield int(chunk[a]), ids[a:b], raw[a:b]


def _asked(code: Code, bits: int):
    """What each chunk of texts asks for: part, chunk, first row and places of the slots, each once and in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, ids, raw in _chunks_of(batches):
            for at, _ in keys(code, bits, raw):
                at = np.unique(at)
                runs = list(_by_part(at))
                place = (at % PART).astype(np.uint16)
                columns = [
                    pa.array([p for p, _, _ in runs], pa.int32()),
                    pa.array([chunk] * len(runs), pa.int64()),
                    pa.array([ids[0]] * len(runs), pa.int64()),
                    pa.array([place[i:j].tobytes() for _, i, j in runs], pa.binary()),
                    pa.nulls(len(runs), pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["part", "chunk", "row", "places", "counts"])

    return run


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States of the asked slots; rows come by part, its counts (if it has some) before those that ask."""
    now, table = None, np.zeros(PART, np.uint8)
    for batch in batches:
        rows = []
        for part, chunk, row, places, counts in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if part != now:
                now, table = part, np.zeros(PART, np.uint8)
            if counts is not None:
                table = states(_part_of(places, counts))
            else:
                rows.append((chunk, row, part, table[np.frombuffer(places, np.uint16)].tobytes()))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["chunk", "first", "part", "states"])


def _chunk_scored(code: Code, bits: int, mixer: Mixer):
    """row, score, passages from rows by chunk: the answers by part, then the texts by row."""

    def score(ids: list[int], texts: list[bytes], answers: list[bytes]) -> pa.RecordBatch:
        table, done = np.frombuffer(b"".join(answers), np.uint8), 0

        def state(k: int, h: np.ndarray, of: np.ndarray, node: np.ndarray) -> np.ndarray:
            nonlocal done
            used, again = np.unique(slots(h, of, node, bits), return_inverse=True)
            done += len(used)
            return table[done - len(used) : done][again]

        passages, logs = scored(code, mixer, texts, state)
        columns = [pa.array(ids, pa.int64()), pa.array(np.bincount(passages.owner, logs, len(texts))), _lists(passages, logs, len(texts))]
        return pa.RecordBatch.from_arrays(columns, ["row", "score", "passages"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, texts, answers = None, [], [], []
        for batch in batches:
            for chunk, part, row, held, text in zip(*(batch.column(i) for i in range(5)), strict=True):
                chunk = chunk.as_py()
                if chunk != now:
                    if ids:
                        yield score(ids, texts, answers)
                    now, ids, texts, answers = chunk, [], [], []
                if held.is_valid:
                    answers.append(held.as_py())
                else:
                    ids.append(row.as_py())
                    texts.append((text.as_py() or "").encode("utf-8", "surrogatepass"))
        if ids:
            yield score(ids, texts, answers)

    return run


def joined_scores(rows: DataFrame, model: Model) -> DataFrame:
    """row, score, passages of rows (row, doc_id, text, chunk) by a table that stays with Spark: each chunk of texts asks the parts
    of the table for its slots, and the answers come back to the texts."""
    asked = in_batches(rows, _asked(model.code, model.bits), "part int, chunk long, row long, places binary, counts binary")
    table = model.table.select("part", F.lit(None).cast("long").alias("chunk"), F.lit(None).cast("long").alias("row"), "places", "counts")
    by_part = asked.unionByName(table).repartition("part").sortWithinPartitions("part", F.col("counts").isNull())
    answers = in_batches(by_part, _answered, "chunk long, first long, part int, states binary")
    answers = answers.select("chunk", "part", F.col("first").alias("row"), "states", F.lit(None).cast("string").alias("text"))
    texts = rows.select("chunk", F.lit(None).cast("int").alias("part"), "row", F.lit(None).cast("binary").alias("states"), "text")
    by_chunk = answers.unionByName(texts).repartition("chunk").sortWithinPartitions("chunk", F.col("states").isNull(), "part", "row")
    return in_batches(by_chunk, _chunk_scored(model.code, model.bits, model.mixer), f"row long, score double, passages {PASSAGES}")


def train(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """The model of the rows that are not held out: codes, counts and what states say come from all of them.

    A table's size follows the training bytes, as far as the hashes can tell slots apart. Up to HELD_BITS its states come to
    the driver as one array; a larger one is a Spark table (part, places, counts).
    """
    seen = docs.where(~held_out(F.col(key))).select(F.col(text).alias("text"))
    sums = in_batches(seen, _pairs_counted, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = np.zeros(SYMBOLS * SYMBOLS, np.int64)
    for r in sums.collect():
        pairs[r["pair"]] = r["n"]
    code = Code.of(pairs.reshape(SYMBOLS, SYMBOLS))
    bits = min(HASH_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, pairs.sum() / PER_SLOT)))))
    said = np.zeros((K, 256, 2), np.int64)
    if bits > min(HELD_BITS, COUNTED_BITS):
        parts = in_batches(seen, _slots_counted(code, bits), "part int, places binary, counts binary")
        parts = parts.repartition("part").sortWithinPartitions("part")
    if bits > HELD_BITS:
        table = written(in_batches(parts, _slots_added, "part int, places binary, counts binary"))
        for r in in_batches(table, _met_in_parts(bits), "met binary").toLocalIterator():
            said += np.frombuffer(r["met"], np.int64).reshape(said.shape)
        return Model(code, bits, table, Mixer.of(said))
    if bits > COUNTED_BITS:
        merged = in_batches(parts, _states_of_slots(bits), "part int, states binary")
    else:
        parts = in_batches(seen, _tables_counted(code, bits), "part int, counts binary")
        # Every task sends a row for a part, so the rows of all parts are spread evenly and add up in small arrays.
        merged = in_batches(parts.repartition("part"), _states_of_parts(bits), "part int, states binary")
    table = np.zeros((K * (1 << bits) // PART, PART), np.uint8)
    for r in merged.toLocalIterator():
        if r["part"] < 0:
            said += np.frombuffer(r["states"], np.int64).reshape(said.shape)
        else:
            table[r["part"]] = np.frombuffer(r["states"], np.uint8)
    return Model(code, bits, table.reshape(K, 1 << bits), Mixer.of(said))


def _words_counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    held: Counter[bytes] = Counter()
    for batch in batches:
        for t in _raw(batch.column(0)):
            held.update(t.lower().split())  # splits at [\x20\x09-\x0D] only
            if len(held) > WORDS_HELD:
                yield rows()
                held.clear()
    yield rows()


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n over the rows that are not held out."""
    seen = docs.where(~held_out(F.col(key)))
    words = in_batches(seen.select(F.col(text).alias("text")), _words_counted, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int | None = None) -> DataFrame:
    """Rows of ``counts`` (word, n) that hold the most frequent words, ``most`` at most. Classes of counts (a fifth wide) tell
    from which one on, so that no words are sorted; a class is taken whole or not at all."""
    level = F.floor(4 * F.log2("n"))
    held, least = 0, None
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        held += r["count"]
        if held > (FREQUENT if most is None else most):
            break
        least = r["level"]
    return counts.where(F.lit(False) if least is None else level >= least)


def _scored(shared_model, shared_words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, frequent = shared_model.value, shared_words.value
        for batch in batches:
            raw = _raw(batch.column("text"))
            score, passages = np.zeros(len(raw)), pa.nulls(len(raw), pa.null())
            size, known, base, rare = [], [], [], []
            if model is not None:
                # Texts of like sizes go through their rounds together.
                order = np.argsort([len(t) for t in raw], kind="stable")
                like, lists = [raw[i] for i in order], []
                for a, b in _together(like):
                    found, logs = model.passages(like[a:b])
                    score[order[a:b]] = np.bincount(found.owner, logs, b - a)
                    lists.append(_lists(found, logs, b - a))
                if lists:
                    passages = pa.concat_arrays(lists).take(pa.array(np.argsort(order)))
            for t in raw:
                words = t.lower().split()
                others = list(itertools.filterfalse(frequent.__contains__, words))
                rare.append([w.decode("utf-8", "surrogatepass") for w in others])
                size.append(len(words))
                known.append(len(words) - len(others))
                base.append(sum(filter(None, map(frequent.get, words))))  # no logarithm is 0: counts are 1 and more
            columns = [
                batch.column("row"),
                batch.column("doc_id"),
                pa.array([len(t) for t in raw], pa.int64()),
                pa.array(size, pa.int64()),
                pa.array(known, pa.int64()),
                pa.array(base, pa.float64()),
                pa.array(score, pa.float64()),
                passages.cast(_PASSAGES) if pa.types.is_null(passages.type) else passages,
                pa.array(rare, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_bytes", "words", "known", "logs", "score", "passages", "rare"])

    return run


def scores(docs: DataFrame, key: str = "doc_id", text: str = "text", model: Model | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte: a row for each row.

    Rows whose crc32 of the id as text leaves 1 by 5 are held out; the others are learned from. Null texts are empty
    and have the end as their one token; a missing id counts as empty text. ``score`` is the model's log10 probability
    of the text's bytes and their end, by the tables and by the passages that follow each other in other training rows. Without training rows all counts are 0, and the model knows nothing. Repeated
    rows get equal results; an empty table gives no rows.
    """
    spark = docs.sparkSession
    model = train(docs, key, text) if model is None else model
    counts = written(word_counts(docs, key, text))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = docs.where(~held_out(F.col(key))).count()
    tokens, distinct = total["n"] + ends, total["v"] + (ends > 0)
    frequent = {r["word"].encode("utf-8", "surrogatepass"): math.log10(r["n"] + 0.5) for r in frequent_words(counts).toLocalIterator()}
    held = isinstance(model.table, np.ndarray)
    shared = [spark.sparkContext.broadcast(x) for x in (model if held else None, frequent)]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    if not held:
        rows = written(in_batches(rows, _in_chunks, "row long, doc_id long, text string, chunk long"))
    each = written(
        in_batches(
            rows.select("row", "doc_id", "text"),
            _scored(*shared),
            f"row long, doc_id long, n_bytes long, words long, known long, logs double, score double, passages {PASSAGES}, rare array<string>",
        )
    )
    if not held:
        each = each.drop("score", "passages").join(joined_scores(rows, model), "row")
        each = written(each)
    # Words outside the broadcast list are rare, so no key of this join is hot.
    rare = each.select("row", F.explode("rare").alias("word")).join(counts, "word", "left")
    rare = rare.groupBy("row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_logs"), F.count("n").alias("rare_known")
    )
    gains = passage_gains(each.select("row", (~held_out(F.col("doc_id"))).alias("trained"), "passages"), ends)
    each = each.drop("rare", "passages").join(rare, "row", "left").join(gains, "row", "left")
    n_tokens = F.col("words") + 1
    score = F.col("score") + F.coalesce("gain", F.lit(0.0))
    base = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) + math.log10(ends + 0.5)
    return each.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        n_tokens.alias("n_tokens"),
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (base - n_tokens * math.log10(tokens + 0.5 * (distinct + 1))).alias("base_score"),
        score.alias("score"),
        "n_bytes",
        (-score / math.log10(2) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
