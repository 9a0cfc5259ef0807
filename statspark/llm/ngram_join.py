"""Exact self-join of documents on the Jaccard similarity of their word shingles, with PartEnum signatures.

Set sizes fall into bands, so that sets similar enough are in the same or in neighbouring bands, where the threshold
bounds the number of elements in which they differ. The domain of shingle hashes is cut into groups of three parts;
with k differing elements and more than k/2 groups, some group has at most one, so that two of its three parts agree.
Each set gets a signature for every pair of parts of every group: similar sets share one. Buckets with the same members
count once. Within a bucket, parity bits tell which pairs can be similar at all, and the bucket proposes a spanning
forest of these; only its edges are verified by the sets themselves. Other pairs are asked for only where an edge failed
and they would still join two components, so a bucket of many near copies costs about one comparison a member.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import connected
from .shared import bounded, in_batches, materialised, named_rows, shuffles_freed, without_rows, written

WORDS, PERCENT = 5, 80
#: Least number of a set's parity bits; larger sets have two to four an element. They are shuffled with every member of
#: every bucket. With fewer bits more pairs are proposed and verified in vain; none is lost.
LEAST_BITS = 512
#: Members of a bucket that are compared at once; larger buckets are cut into so large parts, every two of which meet.
TILE = 2048
#: How many times more pairs a member may propose in each round.
STEP = 16
#: Words whose hashes a task remembers, and sets that it knows to have signed.
CACHE, SIGNED = 200_000, 1_000_000
#: Bits of a signature that are shuffled: each byte less is a byte less a row on disk. Sets that share one by chance are one
#: more bucket to compare; no pair is lost.
SHUFFLED_BITS = 48
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


class _Hashes(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(text: str | None, words: int, cache: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles (a shorter text is one shingle)."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # splits at [\x20\x09-\x0D] only
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, tokens), np.uint64, len(tokens))
    n = min(words, len(h))
    at = len(h) - n + 1
    value = np.full(at, n, np.uint64)
    for i in range(n):
        value = _mix(value + h[i : i + at])
    return np.unique(value)


@lru_cache(4)
def bands(percent: int) -> np.ndarray:
    """Largest size of each band."""
    ends, low = [], 1
    while low < 1 << 40:
        ends.append(low * 100 // percent)
        low = ends[-1] + 1
    return np.array(ends, np.int64)


@lru_cache(4096)
def _plan(band: int, percent: int) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Spare groups, number of parts, their borders in the domain, and what tells the signatures apart."""
    k = (100 - percent) * 2 * int(bands(percent)[band]) // (100 + percent)
    spare = int(k > 1)
    parts = 3 * (k // 2 + 1 + spare) if k else 1
    borders = np.arange(1, parts, dtype=np.uint64) * np.uint64(((1 << 64) - 1) // parts)
    return spare, parts, borders, _mix(np.arange(parts, dtype=np.uint64) + (np.uint64(band + 1) << np.uint64(40)))


def signatures(h: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """A set's signatures, for pairs with sets of its own band and of both neighbouring bands.

    A signature of two empty parts says nothing; it is left out where the spare groups allow for it.
    """
    own = int(np.searchsorted(bands(percent), len(h)))
    total = np.concatenate(([np.uint64(0)], np.cumsum(_mix(h), dtype=np.uint64)))
    out = []
    for band in (own, own + 1):
        spare, parts, borders, names = _plan(band, percent)
        at = np.concatenate(([0], np.searchsorted(h, borders), [len(h)]))
        part, held = total[at[1:]] - total[at[:-1]], np.diff(at)
        if parts == 1:
            out.append(_mix(part + names))
            continue
        part, held = part.reshape(-1, 3), held.reshape(-1, 3)
        value = _mix(_mix(part[:, [0, 0, 1]] + names.reshape(-1, 3)) + part[:, [1, 2, 2]])
        full = held[:, [0, 0, 1]] + held[:, [1, 2, 2]] > 0
        out.append(value.ravel() if (~full).any(axis=1).sum() > spare else value[full])
    return np.concatenate(out)


def parities(h: np.ndarray) -> np.ndarray:
    """Bits as bytes: whether each part of the domain holds an odd number of elements.

    Each element in which two sets differ changes one bit, so sets differ in at least as many elements as bits. The
    number of bits is a power of two that follows the size; ``folded`` brings more bits to fewer.
    """
    width = max(LEAST_BITS.bit_length() - 1, int(2 * len(h) - 1).bit_length())
    return np.packbits(np.bincount((h >> np.uint64(64 - width)).astype(np.int64), minlength=1 << width).astype(np.uint8) & 1)


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Rows of parity bits (bytes) over parts that are so many times larger that ``size`` bytes are left.

    Neighbouring parts become one: its parity is theirs, added up.
    """
    while bits.shape[1] > size:
        both = bits ^ (bits << np.uint8(1))  # in each two bits the upper one is the parity of both
        both &= np.uint8(0xAA)
        both |= both << np.uint8(1)
        both &= np.uint8(0xCC)
        both |= both << np.uint8(2)
        both &= np.uint8(0xF0)
        bits = both[:, ::2] | (both[:, 1::2] >> np.uint8(4))
    return bits


def _set_id(h: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(h.tobytes()) - (1 << 63)


def _sets(key: str, text: str, words: int, what: str, percent: int = PERCENT):
    """A mapInArrow function; what: 'size' (id, n, s, bits), 'shingles' (s, n, shingles) or 'signatures' (sig, s).

    Repeated sets of a task are left out where only the set counts; what it forgets is merely said again.
    """
    dropped = np.uint64(64 - SHUFFLED_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seen = _Hashes(), set()
        for batch in batches:
            ids, out, held = batch.column(key), [], 0
            for value in batch.column(text):
                h = shingle_hashes(value.as_py(), words, cache)
                if what == "size":
                    out.append((len(h), _set_id(h), parities(h).tobytes()) if len(h) else (0, None, None))
                    continue
                s = _set_id(h)
                if s in seen or not len(h):
                    continue
                if len(seen) >= SIGNED:
                    seen.clear()
                seen.add(s)
                x = h if what == "shingles" else signatures(h, percent) >> dropped
                out.append((s, len(h), x.view(np.int64)))
                held += len(x)
                if held > 400_000:
                    yield _batch(what, out)
                    out, held = [], 0
            if what == "size":
                n, s, bits = zip(*out, strict=True) if out else ((), (), ())
                columns = [ids, pa.array(n, pa.int64()), pa.array(s, pa.int64()), pa.array(bits, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "s", "bits"])
            elif out:
                yield _batch(what, out)

    return run


def _batch(what: str, rows: list[tuple]) -> pa.RecordBatch:
    s, n = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int32)
    lengths = np.array([len(r[2]) for r in rows])
    flat = pa.array(np.concatenate([r[2] for r in rows]))
    if what == "shingles":
        ends = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(s), pa.array(n), pa.ListArray.from_arrays(ends, flat)], ["s", "n", "shingles"])
    return pa.RecordBatch.from_arrays([flat, pa.array(np.repeat(s, lengths))], ["sig", "s"])


def proposed(
    n: np.ndarray, bits: list[bytes], root: np.ndarray, percent: int, more: int
) -> tuple[list[tuple[int, int]], bool]:
    """Pairs (places) of a bucket's sets to verify: a spanning forest of those that sizes and bits allow between
    different roots, and up to ``more`` others for each set, the likeliest first; and whether there are others still."""
    order = np.argsort(n, kind="stable")
    n, label, pairs, left = n[order], np.unique(root[order], return_inverse=True)[1], [], False
    root, ends, level, held = label.copy(), np.searchsorted(n, n * 100 // percent, "right"), 0, None
    for i in range(len(n) - 1):
        if len(bits[order[i]]) != level:
            level, low = len(bits[order[i]]), i
            wide = [np.frombuffer(bits[j], np.uint8) for j in order[low : ends[low:].max()].tolist()]
            sizes = np.array([len(w) for w in wide])
            held = np.empty((len(wide), level), np.uint8)
            for size in np.unique(sizes):
                of = np.flatnonzero(sizes == size)
                held[of] = folded(np.stack([wide[j] for j in of]), level)
            held = held.view(np.uint64)
        stop = int(ends[i])
        if stop <= i + 1:
            continue
        apart = np.bitwise_count(held[i + 1 - low : stop - low] ^ held[i - low]).sum(1, dtype=np.int64)
        both = n[i + 1 : stop] + n[i]
        fits = np.flatnonzero(((100 + percent) * apart <= (100 - percent) * both) & (root[i + 1 : stop] != root[i]))
        if not len(fits):
            continue
        fits = fits[np.argsort(apart[fits] / both[fits], kind="stable")]
        js = fits + i + 1
        news, at = np.unique(label[js], return_index=True)
        tree = at[news != label[i]]
        label[np.isin(label, news)] = label[i]
        rest = np.delete(np.arange(len(js)), tree)
        left |= len(rest) > more
        pairs += [(order[i], order[j]) for j in js[np.concatenate((tree, rest[:more]))].tolist()]
    return pairs, left


def _proposals(percent: int, more: int):
    """Rows a, b to verify from rows (bucket, tile, s, root, n, bits) by bucket and tile; or a bucket and tile of which
    other pairs are left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        said: set[tuple[int, int]] = set()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["a", "b", "bucket", "tile"])

        for (bucket, tile), s, root, n, bits in _grouped(batches):
            pairs, left = proposed(n, bits, root, percent, more)
            if len(said) > SIGNED:
                said.clear()
            found = {(int(min(s[i], s[j])), int(max(s[i], s[j]))) for i, j in pairs} - said
            said |= found
            rows = [(a, b, None, None) for a, b in sorted(found)] + [(None, None, bucket, tile)] * left
            if rows:
                yield batch_of(rows)

    return run


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(bucket, tile), s, root, n, bits of each tile; rows come sorted, and a tile is bounded."""
    now, parts = None, []
    for batch in batches:
        bucket, tile = batch.column("bucket").to_numpy(), batch.column("tile").to_numpy()
        edges = np.flatnonzero(np.diff(bucket, prepend=0) | np.diff(tile, prepend=0))
        edges = np.unique(np.concatenate(([0], edges, [len(bucket)]))).tolist()
        s, root, n = (batch.column(c).to_numpy() for c in ("s", "root", "n"))
        bits = batch.column("bits").to_pylist()
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            name = int(bucket[i]), int(tile[i])
            if parts and name != now:
                yield _joined(now, parts)
                parts = []
            now = name
            parts.append((s[i:j], root[i:j], n[i:j], bits[i:j]))
    if parts:
        yield _joined(now, parts)


def _joined(name: tuple[int, int], parts: list[tuple]) -> tuple:
    s, root, n = (np.concatenate([p[i] for p in parts]) for i in range(3))
    return name, s, root, n, [x for p in parts for x in p[3]]


class _Verifier:
    """Compares pairs of sets by their shingles, read again from the documents that hold them."""

    def __init__(self, docs: DataFrame, each: DataFrame, words: int, percent: int):
        self.docs, self.words, self.percent = docs, words, percent
        self.holders = each.where("s is not null").groupBy("s").agg(F.min("doc_id").alias("doc_id"))

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Of different pairs (a, b) those that are similar enough."""
        wanted = pairs.select(F.col("a").alias("s")).unionByName(pairs.select(F.col("b").alias("s"))).distinct()
        keys = bounded(self.holders.join(wanted, "s", "left_semi").select(F.col("doc_id").alias("_id")))
        docs = self.docs.join(keys, F.col("doc_id") == F.col("_id"), "left_semi")
        sets = in_batches(docs, _sets("doc_id", "text", self.words, "shingles"), "s long, n int, shingles array<long>")
        sides = [sets.select(F.col("s").alias(x), F.col("n").alias(f"n{x}"), F.col("shingles").alias(f"{x}s")) for x in "ab"]
        both = pairs.join(sides[0], "a").join(sides[1], "b").withColumn("common", F.size(F.array_intersect("as", "bs")))
        return both.where(100 * F.col("common") >= self.percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def _buckets(rows: DataFrame, tile: int) -> DataFrame:
    """bucket, s, parts: the members of signatures (sig, s) that two sets share, once for equal lists of members.

    Sorting streams: nothing but the first and the last set of a signature is kept. ``parts`` is the number of parts
    that a bucket is cut into.
    """
    order = Window.partitionBy("sig").orderBy("s")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = rows.select("sig", "s", F.first("s").over(upto).alias("hub"), F.lag("s").over(order).alias("previous"))
    shared = written(ranked.where("s <> hub and s <> previous").drop("previous"))
    # Members are told apart by their number, the sum of one hash and the parity of another.
    total, parity = F.sum(F.xxhash64("s") % (1 << 40)), F.bit_xor(F.xxhash64("s", F.lit(1)))
    lists = shared.groupBy("sig", "hub").agg(F.count(F.lit(1)).alias("size"), total.alias("total"), parity.alias("parity"))
    kept = lists.groupBy("hub", "size", "total", "parity").agg(F.min("sig").alias("sig"))
    kept = materialised(kept.select("sig", "hub", F.ceil((F.col("size") + 1) / tile).cast("int").alias("parts")))
    others = shared.select("sig", "s").join(kept.select("sig", "parts"), "sig")
    return others.unionByName(kept.select("sig", F.col("hub").alias("s"), "parts")).withColumnRenamed("sig", "bucket")


def _tiled(members: DataFrame) -> DataFrame:
    """bucket, tile, s: members of a bucket of p parts stand in the p tiles of their part with each part."""
    own = F.pmod(F.xxhash64("s"), F.col("parts")).cast("int")
    each = F.sequence(F.lit(0), F.col("parts") - 1)
    tiles = F.transform(each, lambda i: F.least(i, own) * F.col("parts") + F.greatest(i, own))
    small = members.where("parts = 1").select("bucket", F.lit(0).alias("tile"), "s")
    return small.unionByName(members.where("parts > 1").select("bucket", F.explode(tiles).alias("tile"), "s"))


def jaccard_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT, tile: int = TILE
) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``docs``.

    Words are separated by ASCII white space and A-Z are lower-cased; a set holds a text's distinct shingles of
    ``words`` words, or the whole sequence of a shorter text. Sets with at least ``percent`` of their union in common
    are linked; equal sets are one node. Null or empty texts have no shingles and are their own component, also those
    without an id (component null). Repeated rows share their set. An empty table gives no rows.
    """
    with shuffles_freed(docs.sparkSession):
        return _components(docs, key, text, words, percent, tile)


def _components(docs: DataFrame, key: str, text: str, words: int, percent: int, tile: int) -> DataFrame:
    plain = docs.select(
        F.coalesce(F.col(key).cast("long"), F.xxhash64(F.col(text))).alias("doc_id"),
        F.col(key).cast("long").alias("own_id"),
        F.col(text).alias("text"),
    )
    held = plain.select("doc_id", "text")
    sized = in_batches(
        plain.select(F.struct("doc_id", "own_id").alias("id"), "text"),
        _sets("id", "text", words, "size"),
        "id struct<doc_id:long,own_id:long>, n long, s long, bits binary",
    )
    each = written(sized.select("id.doc_id", "id.own_id", "n", "s", "bits"))
    rows = in_batches(held, _sets("doc_id", "text", words, "signatures", percent), "sig long, s long")
    cells = materialised(_tiled(_buckets(rows, tile)))
    known = each.where("s is not null").join(cells.select("s").distinct(), "s", "left_semi")
    known = materialised(known.groupBy("s").agg(F.first("n").alias("n"), F.first("bits").alias("bits")))
    each = each.drop("bits")
    verifier = _Verifier(held, each, words, percent)
    links, roots, asked, more = None, None, None, 0
    while True:
        named = known.withColumn("root", F.col("s")) if roots is None else _rooted(known, roots)
        # Sorted by set, so that a partition's rows of one set stand together and their bits compress.
        blocks = cells.join(named.hint("merge"), "s").repartition("bucket", "tile").sortWithinPartitions("bucket", "tile")
        blocks = blocks.select("bucket", "tile", "s", "root", "n", "bits")
        found = written(in_batches(blocks, _proposals(percent, more), "a long, b long, bucket long, tile int"))
        pairs = found.where("a is not null").select("a", "b").distinct()
        pairs = materialised(pairs if asked is None else pairs.join(asked, ["a", "b"], "left_anti"))
        new = verifier.linked(pairs)
        links = materialised(new if links is None else links.unionByName(new))
        asked = pairs if asked is None else asked.unionByName(pairs)
        roots = connected(links)
        # Where all edges of a forest hold, its other pairs join nothing.
        open_tiles = found.where("bucket is not null").select("bucket", "tile").distinct()
        inside = _rooted(cells.join(open_tiles, ["bucket", "tile"], "left_semi"), roots)
        apart = inside.groupBy("bucket", "tile").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
        cells = materialised(cells.join(apart, ["bucket", "tile"], "left_semi"))
        if cells.isEmpty():
            break
        more = max(1, more) * STEP
    named = each.join(roots.withColumnRenamed("node", "s"), "s", "left").withColumn("root", F.coalesce("root", "s"))
    named = materialised(named)
    first = named.where("root is not null").groupBy("root").agg(F.min("own_id").alias("first_id"))
    return named.join(first, "root", "left").select(
        F.col("own_id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("own_id")).otherwise(F.col("first_id")).alias("component_id"),
    )


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows with the component ``root`` that their set ``s`` is in so far."""
    return rows.join(roots.withColumnRenamed("node", "s"), "s", "left").withColumn("root", F.coalesce("root", "s"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component those with the smallest id.

    Rows are told apart by id and text, so one that repeats an id with another text has a decision of its own; rows
    without an id come last. Texts without words stay.
    """
    rows, number = named_rows(docs, key, text)
    found = materialised(jaccard_components(rows, number, text, words, percent).distinct())
    ids = rows.select(F.col(number).alias("doc_id"), F.col(key).cast("long").alias("id")).distinct()
    each = materialised(found.join(ids, "doc_id"))
    first = each.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "doc_id")).alias("first"))
    gone = each.join(first, "component_id").where("doc_id <> first.doc_id").select("doc_id")
    return without_rows(rows, gone, number).select(*(F.col(f"`{c}`") for c in docs.columns))
