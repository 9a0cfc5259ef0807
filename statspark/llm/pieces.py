"""SentencePiece encoding by Gumbel top-k sampling without replacement, and decoding.

A text's segmentations into pieces of a public vocabulary form a lattice. Each segmentation gets a Gumbel-perturbed
log-probability; the k greatest ones are found by a search over regions of the lattice, always splitting the region
with the greatest perturbed bound (the maximum of a region is a Gumbel of its mass, truncated by its parent's). So k
distinct segmentations come out, in order, each with the probability of being among the k at the bound that the next
one sets. No piece spans the start of a word, so the lattice is a row of small ones and equal words share theirs.
Random numbers are seeded by the row's key.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import in_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
#: Lattice places that a task remembers.
PLACES = 1_200_000
#: Characters of texts whose words are built together.
TOGETHER = 200_000
SPACE, LITERAL = "▁", "\ud800"  # a lone surrogate, which no text holds, stands for a literal U+2581
SCHEMA = "doc_id long, sample int, n_pieces int, log_prob double, value double, inclusion double, log_inclusion double, round_trip boolean, ids array<int>"


_STEP = np.uint64(0x9E3779B97F4A7C15)
_POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, i, 1 << 64)) for i in range(64)]


@dataclass
class Vocabulary:
    """Pieces by text, log-probability and bytes by number, and numbers of the byte pieces."""

    number: dict[str, int]
    log_prob: np.ndarray
    raw: list[bytes]
    byte: list[int]
    longest: int
    unit: str

    def __post_init__(self) -> None:
        self.sizes = np.array([len(r) for r in self.raw])
        self.flat, self.starts = np.frombuffer(b"".join(self.raw), np.uint8), np.cumsum(self.sizes) - self.sizes

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of pieces, one after the other."""
        sizes = self.sizes[ids]
        return self.flat[np.repeat(self.starts[ids] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))]


def vocabulary(path: str = MODEL, power: float = 1.0) -> Vocabulary:
    """Read a SentencePiece model. BPE scores are ranks; Zipf's rule makes them probabilities, 1 / (rank + 10)^power."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(size)]
    plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    number = {pieces[i]: i for i in plain}
    if any(SPACE in p.lstrip(SPACE) for p in number):
        raise ValueError("a piece of this vocabulary spans the start of a word")
    byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    weight = np.full(size, 0.0)
    weight[plain] = 1.0 / (np.arange(len(plain)) + 10.0) ** power
    weight[byte] = weight[plain].min()
    raw = [b""] * size
    for p, i in number.items():
        raw[i] = p.replace(SPACE, " ").encode()
    for b, i in enumerate(byte):
        raw[i] = bytes([b])
    # Line ends never join pieces if no longer piece holds one; then they delimit the small lattices too.
    ends = "" if any("\n" in p for p in number if len(p) > 1) else "\n"
    unit = f"{SPACE}+[^{SPACE}{ends}]*|[^{SPACE}{ends}]+" + (f"|{ends}" if ends else "")
    with np.errstate(divide="ignore"):
        logs = np.log(weight / weight.sum())
    return Vocabulary(number, logs, raw, byte, max(map(len, number)), unit)


class _Rows(dict):
    """Numbers of words in the order in which they come up; ``new`` lists those without a lattice."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class _Store:
    """A numpy array of records that grows at its end."""

    def __init__(self, **kinds: type):
        self.held, self.n = np.empty(1 << 16, list(kinds.items())), 0

    def add(self, **values: np.ndarray) -> None:
        n = self.n + len(next(iter(values.values())))
        if n > len(self.held):
            more = np.empty(max(2 * len(self.held), n), self.held.dtype)
            more[: self.n] = self.held[: self.n]
            self.held = more
        for name, x in values.items():
            self.held[name][self.n : n] = x
        self.n = n

    def __getitem__(self, name: str) -> np.ndarray:
        return self.held[name]


class Lattices:
    """The lattices of words, one behind the other.

    A lattice of n characters has places base + 1 to base + n. The edges that end at a place p are numbered from
    first[p] up to first[p + 1], the longest first, and have cumulative probabilities up to 1; ``other`` is the
    probability of the place's other edges, and ``mass`` the logarithm of all that leads from the base to a place.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        by_size: dict[int, list[tuple[str, int]]] = {}
        for piece, i in vocabulary.number.items():
            by_size.setdefault(len(piece), []).append((piece, i))
        self.known = {}
        for size, pieces in by_size.items():
            codes = _codes("".join(p for p, _ in pieces)).reshape(-1, size)
            hashes = sum(codes[:, size - 1 - i] * _POWERS[i] for i in range(size))
            order = np.argsort(hashes)
            self.known[size] = hashes[order], np.array([i for _, i in pieces], np.int32)[order]
        # Most strings are no pieces; a table of hash prefixes tells so at once.
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(np.concatenate([h for h, _ in self.known.values()]) * _STEP) >> np.uint64(42)] = True
        # What is read together stands together in memory.
        self.words = _Store(base=np.int64, end=np.int64)
        self.places = _Store(first=np.int64, mass=np.float64)  # place p at p; its edges end where the next one's begin
        self.edges = _Store(bound=np.float64, log=np.float64, other=np.float64, piece=np.int32, length=np.int32)
        self.clear()

    def clear(self) -> None:
        """Forget all words; the arrays stay, so that they need not grow again."""
        self.of = _Rows()
        self.last = 0
        for store in (self.words, self.places, self.edges):
            store.n = 0
        self.places.add(first=np.zeros(2, np.int64), mass=np.zeros(2))

    def build(self) -> None:
        """Build the lattices of the words that have come up, all at once."""
        new, self.of.new = self.of.new, []
        if not new:
            return
        n = np.array([len(w) for w in new])
        codes, total, longest = _codes("".join(new)), int(n.sum()), self.v.longest
        ends = np.cumsum(n)
        j = np.arange(total) - np.repeat(ends - n, n) + 1  # place in the word
        order = np.argsort(j.astype(np.uint16) if n.max() < 1 << 16 else j, kind="stable")
        borders = np.concatenate(([0], np.cumsum(np.bincount(j)[1:])))
        every, found = np.zeros(total, np.uint64), []
        for size in range(1, min(longest, len(borders) - 1) + 1):
            begin = borders[size - 1]  # places that so long a string can end at; fewer with each size
            at = order[begin:]
            h = every[begin:]
            h += codes.take(at - (size - 1)) * _POWERS[size - 1]
            if size in self.known:
                hashes, numbers = self.known[size]
                some = np.flatnonzero(self.maybe.take(((h * _STEP) >> np.uint64(42)).view(np.int64)))
                at, value = at.take(some), h.take(some)
                i = np.minimum(np.searchsorted(hashes, value), len(hashes) - 1)
                hit = hashes[i] == value
                found.append((size, at[hit], numbers[i[hit]], self.v.log_prob[numbers[i[hit]]]))
        bare = np.ones(total, bool)  # characters that are no pieces: their bytes are
        for size, at, _, _ in found:
            if size == 1:
                bare[at] = False
        bare = np.flatnonzero(bare)
        code = codes[bare].astype(np.int64)
        n_bytes = np.where(code == ord(LITERAL), 3, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))
        as_bytes = np.where(n_bytes == 1, np.array(self.v.byte)[np.minimum(code, 127)], -2 - code).astype(np.int32)
        found.append((1, bare, as_bytes, n_bytes * self.v.log_prob[self.v.byte[0]]))
        count = np.bincount(np.concatenate([at for _, at, _, _ in found]), minlength=total)
        first = np.cumsum(count) - count
        free, edges = first.copy(), int(count.sum())
        piece, log, length = np.empty(edges, np.int32), np.empty(edges), np.empty(edges, np.int32)
        for size, at, numbers, logs in sorted(found, key=lambda f: -f[0]):  # the longest first
            slot = free[at]
            free[at] += 1
            piece[slot], log[slot], length[slot] = numbers, logs, size
        mass, share, other = np.zeros(total), np.empty(edges), np.empty(edges)
        for place in range(1, len(borders)):
            at = order[borders[place - 1] : borders[place]]
            width = count[at]
            begin = np.cumsum(width) - width
            edge = np.arange(int(width.sum())) + np.repeat(first[at] - begin, width)
            size = length[edge]
            before = mass[np.repeat(at, width) - size]
            before[size == place] = 0.0
            value = log[edge] + before
            top = np.maximum.reduceat(value, begin)
            value = np.exp(value - np.repeat(top, width))
            sums = np.add.reduceat(value, begin)
            mass[at] = top + np.log(sums)
            value /= np.repeat(sums, width)
            share[edge] = value
            # What the others have; where an edge has most of it, their sum and not the difference to 1.
            most = value > 0.5
            other[edge] = 1.0 - value
            few = np.add.reduceat(np.where(most, 0.0, value), begin)
            other[edge[most]] = np.repeat(few, width)[most]
        share = np.cumsum(share)
        start = np.where(first > 0, share[first - 1], 0.0)
        end = first + count - 1
        bound = (share - np.repeat(start, count)) / np.repeat(share[end] - start, count)
        bound[end] = 1.0
        self.words.add(base=self.last + ends - n, end=self.last + ends)
        self.places.held["mass"][self.places.n - 1] = mass[0]  # the next place, whose edges begin where the last one's end
        self.places.add(first=self.edges.n + np.cumsum(count), mass=np.append(mass[1:], 0.0))
        self.edges.add(bound=bound, log=log, other=other, piece=piece, length=length)
        self.last += total

    def rows(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.of.__getitem__, words), np.int64, len(words))

    def draw(self, rows: np.ndarray, seeds: np.ndarray):
        """One segmentation of each word: log-probability, logarithm of all others' probability, pieces, their ends.

        The random numbers depend on the words' seeds alone.
        """
        bound, edge_log, other, first = self.edges["bound"], self.edges["log"], self.edges["other"], self.places["first"]
        piece, length = self.edges["piece"], self.edges["length"]
        m = len(rows)
        base, at = self.words["base"][rows], self.words["end"][rows]
        log, count = -self.places["mass"][at], np.zeros(m, np.int64)
        reach, rest = np.ones(m), np.zeros(m)
        alive, left, steps = np.arange(m), base, []
        while len(alive):
            noise = _mixed(seeds + np.uint64((len(steps) + 1) * int(_STEP) % (1 << 64))) >> np.uint64(11)
            above = 1.0 - noise * 2.0**-53
            edge = first[at]
            low = np.flatnonzero(bound[edge] < above)
            while len(low):
                edge[low] += 1
                low = low[bound[edge[low]] < above[low]]
            steps.append((alive, piece[edge]))
            log[alive] += edge_log[edge]
            at = at - length[edge]
            beside = other[edge]
            rest[alive] += reach * beside
            count[alive] += 1
            more = at > left
            reach = (reach * (1.0 - beside))[more]
            alive, at, left, seeds = alive[more], at[more], left[more], seeds[more]
        ends = np.cumsum(count)
        ids = np.empty(ends[-1] if m else 0, np.int32)
        for step, (who, number) in enumerate(steps):
            ids[ends[who] - 1 - step] = number
        with np.errstate(divide="ignore"):
            return log, np.log(rest), ids, ends

    def _shares(self, at: int, base: int) -> dict[int, float]:
        """The edges that end at a place, and their probabilities."""
        mass, first = self.places["mass"], self.places["first"]
        low, high = int(first[at]), int(first[at + 1])
        logs, lengths = self.edges["log"][low:high].tolist(), self.edges["length"][low:high].tolist()
        before = [float(mass[at - n]) if at - n > base else 0.0 for n in lengths]
        here = float(mass[at])
        return {low + i: math.exp(x + y - here) for i, (x, y) in enumerate(zip(logs, before, strict=True))}

    def _seen(self, row: int, seen: list[list[int]]) -> list[tuple[dict[int, float], dict[int, int]]]:
        """The tree of segmentations, each from its end on: by edge, the probability of what is not in the tree and the
        tree's next node. The root comes first."""
        piece, length = self.edges["piece"], self.edges["length"]
        base, end = self.words.held[row].tolist()
        nodes: list[tuple] = [(self._shares(end, base), {})]
        for pieces in seen:
            now, at = 0, end
            for number in reversed(pieces):
                shares, after = nodes[now]
                edge = next(e for e in shares if piece[e] == number)
                at -= int(length[edge])
                if edge not in after:
                    after[edge] = len(nodes)
                    nodes.append((self._shares(at, base) if at > base else {}, {}))
                now = after[edge]
        for shares, after in reversed(nodes):
            for edge, node in after.items():
                shares[edge] *= sum(nodes[node][0].values())
        return nodes

    def unseen(self, row: int, seen: list[list[int]]) -> float:
        """Probability of all segmentations of a word but those."""
        return sum(self._seen(row, seen)[0][0].values())

    def draw_other(self, row: int, seen: list[list[int]], rng: np.random.Generator) -> tuple[float, list[int]]:
        """Another segmentation of a word than those seen, of which some must be left: log-probability and pieces.

        From the end on it stays in the tree of those as far as it is drawn to, and then goes on freely.
        """
        base, end = self.words.held[row].tolist()
        nodes, first, bound = self._seen(row, seen), self.places["first"], self.edges["bound"]
        at, node, edges = end, 0, []
        while at > base:
            if node is None:
                low, high = int(first[at]), int(first[at + 1])
                edge = low + int(np.searchsorted(bound[low:high], 1.0 - rng.random()))
            else:
                shares, after = nodes[node]
                edge = min(shares) + _pick(list(shares.values()), rng)
                node = after.get(edge)
            edges.append(edge)
            at -= int(self.edges["length"][edge])
        log = float(self.edges["log"][edges].sum() - self.places["mass"][end])
        return log, self.edges["piece"][edges[::-1]].tolist()


def _pick(weights: list[float], rng: np.random.Generator) -> int:
    r = rng.random() * sum(weights)
    for i, w in enumerate(weights):
        r -= w
        if r < 0:
            return i
    return max(range(len(weights)), key=weights.__getitem__)


def _bytes_of(character: str) -> bytes:
    return SPACE.encode() if character == LITERAL else character.encode("utf-8", "surrogatepass")


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


@dataclass
class Path:
    """A segmentation: log-probability by word, pieces, their ends by word, perturbed value, and its open regions.

    Region j holds the segmentations with the path's first words and another one of word j than those in out[j]. The
    greatest perturbed value of all open regions is a Gumbel of their whole mass below the last value taken from them;
    the region that has it is drawn by the masses.
    """

    log: np.ndarray
    ids: np.ndarray
    ends: np.ndarray
    value: float
    masses: np.ndarray
    out: dict[int, list[list[int]]]
    bound: float = -math.inf

    def look(self, below: float, rng: np.random.Generator) -> None:
        """Draw the greatest value of the open regions."""
        total = _log_sum(self.masses)
        self.bound = _truncated(total, below, rng) if total > -math.inf else -math.inf

    def region(self, rng: np.random.Generator) -> int:
        weights = np.cumsum(np.exp(self.masses - self.masses.max()))
        return int(np.searchsorted(weights, rng.random() * weights[-1], "right"))


def _log_sum(x: np.ndarray) -> float:
    top = float(x.max())
    return top + math.log(float(np.exp(x - top).sum())) if top > -math.inf else top


def _truncated(mass: float, value: float, rng: np.random.Generator) -> float:
    """A Gumbel of a mass, given as logarithm, below a value."""
    return -float(np.logaddexp(-value, math.log(rng.exponential() + 1e-300) - mass))


class Search:
    """The search over one text's segmentations; the words that it wants drawn are drawn for many texts at once."""

    def __init__(self, words: list[str], key: object, seed: int, lattices: Lattices):
        self.seed = xxhash.xxh3_64_intdigest(f"{seed}:{key}")
        self.rng = np.random.Generator(np.random.SFC64(self.seed))
        self.rows, self.lattices = lattices.rows(words), lattices
        self.paths: list[Path] = []
        self.value = -math.log(self.rng.exponential() + 1e-300)  # of the next path
        self.start, self.kept = 0, None

    def wanted(self) -> tuple[np.ndarray, np.ndarray]:
        """Words to draw for the next path, and their seeds."""
        rows = self.rows[self.start :]
        first = np.uint64((self.seed + len(self.paths) * 0xD1B54A32D192ED03) % (1 << 64))
        return rows, _mixed(np.arange(self.start, self.start + len(rows), dtype=np.uint64) * _STEP + first)

    def drawn(self, log: np.ndarray, rest: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> None:
        """Take the drawn words as the rest of the next path, and choose the region of the one after it."""
        if self.kept is not None:
            log0, ids0, ends0 = self.kept
            log, rest = np.concatenate((log0, log)), np.concatenate((np.full(len(log0), -np.inf), rest))
            ids, ends = np.concatenate((ids0, ids)), np.concatenate((ends0, len(ids0) + ends))
        masses = rest
        masses[1:] += np.cumsum(log[:-1])
        self.paths.append(Path(log, ids, ends, self.value, masses, {}))
        self.paths[-1].look(self.value, self.rng)
        self.origin = max(self.paths, key=lambda p: p.bound)
        self.value = self.origin.bound

    def branch(self) -> None:
        """Fix the next path up to the word by which it leaves its origin."""
        p = self.origin
        j = p.region(self.rng)
        start = int(p.ends[j - 1]) if j else 0
        seen = p.out.setdefault(j, [p.ids[start : int(p.ends[j])].tolist()])
        log, piece = self.lattices.draw_other(int(self.rows[j]), seen, self.rng)
        self.start = j + 1
        self.kept = (
            np.append(p.log[:j], log),
            np.concatenate((p.ids[:start], np.array(piece, np.int32))),
            np.append(p.ends[:j], start + len(piece)),
        )
        seen.append(piece)
        left = self.lattices.unseen(int(self.rows[j]), seen)
        p.masses[j] = float(p.log[:j].sum()) + math.log(left) if left > 0 else -math.inf
        p.look(self.value, self.rng)


def search(texts: list[tuple[object, list[str]]], lattices: Lattices, k: int, seed: int = 0) -> list[Search]:
    """Finished searches for the k best segmentations of each (key, words); words must not be empty."""
    if lattices.last > PLACES:
        lattices.clear()
    every = [Search(words, key, seed, lattices) for key, words in texts]
    lattices.build()
    turn = every
    for _ in range(k):
        if not turn:
            break
        asked = [s.wanted() for s in turn]
        log, rest, ids, ends = lattices.draw(np.concatenate([r for r, _ in asked]), np.concatenate([x for _, x in asked]))
        a = b = 0
        for s, (rows, _) in zip(turn, asked, strict=True):
            stop = int(ends[a + len(rows) - 1]) if len(rows) else b
            part = slice(a, a + len(rows))
            s.drawn(log[part], rest[part], ids[b:stop], ends[part] - b)
            a, b = a + len(rows), stop
        turn = [s for s in turn if s.value > -math.inf and len(s.paths) < k]
        for s in turn:
            s.branch()
    return every


def units(text: str, pattern: re.Pattern) -> list[str]:
    """The words of a text in the vocabulary's writing, each with the spaces before it."""
    if not text:
        return []
    return pattern.findall(SPACE + text.replace(SPACE, LITERAL).replace(" ", SPACE))


def expanded(ids: np.ndarray, v: Vocabulary) -> np.ndarray:
    """Piece numbers, with the bytes of characters that are no pieces."""
    if not len(ids) or ids.min() >= 0:
        return ids
    return np.array([x for i in ids.tolist() for x in ([i] if i >= 0 else [v.byte[b] for b in _bytes_of(chr(-2 - i))])], np.int32)


def decode(ids: list[int] | np.ndarray, v: Vocabulary) -> str:
    """The text of pieces; exact for every encoded text."""
    raw = b"".join([v.raw[i] for i in (ids.tolist() if isinstance(ids, np.ndarray) else ids)])
    return raw[1:].decode("utf-8", "surrogatepass")


def samples(done: Search, v: Vocabulary) -> list[tuple]:
    """(sample, log-probability, value, inclusion, its logarithm, ids) of a finished search."""
    out = []
    for sample, p in enumerate(done.paths, 1):
        log = float(p.log.sum())
        # The chance that a Gumbel around the log-probability exceeds the next value; nearly their ratio where it is small.
        above = log - done.value
        inclusion = 1.0 if done.value == -math.inf else -math.expm1(-math.exp(min(above, 700.0)))
        out.append((sample, log, p.value, inclusion, math.log(inclusion) if inclusion > 1e-9 else above, expanded(p.ids, v)))
    return out


NOTHING = [(1, 0.0, 0.0, 1.0, 0.0, np.empty(0, np.int32))]


def encode(texts: list[tuple[object, str | None]], lattices: Lattices, k: int = SAMPLES, seed: int = 0) -> list[list[tuple]]:
    """The samples of each (key, text); an empty text has the empty segmentation alone."""
    pattern = re.compile(lattices.v.unit)
    words = [(key, units(text or "", pattern)) for key, text in texts]
    done = iter(search([x for x in words if x[1]], lattices, k, seed) if any(w for _, w in words) else [])
    return [samples(next(done), lattices.v) if w else NOTHING for _, w in words]


def _encoder(v: Vocabulary, k: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = Lattices(v)
        for batch in batches:
            waiting, size = [], 0
            texts = zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
            for last, (key, text) in enumerate(texts, 1):
                waiting.append((key, text.as_py() or ""))
                size += len(waiting[-1][1])
                if size < TOGETHER and last < len(batch):
                    continue
                rows = []
                for (key, t), found in zip(waiting, encode(waiting, lattices, k, seed), strict=True):
                    raw = b" " + t.encode("utf-8", "surrogatepass") if t else b""
                    for sample, log, value, inclusion, log_inclusion, ids in found:
                        same = v.joined(ids).tobytes() == raw
                        rows.append((key, sample, len(ids), log, value, inclusion, log_inclusion, same, ids))
                yield _batch(rows)
                waiting, size = [], 0

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    *plain, ids = zip(*rows, strict=True)
    kinds = (pa.int64(), pa.int32(), pa.int32(), *[pa.float64()] * 4, pa.bool_())
    ends = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32))
    lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids)))
    names = ["doc_id", "sample", "n_pieces", "log_prob", "value", "inclusion", "log_inclusion", "round_trip", "ids"]
    return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(plain, kinds, strict=True)), lists], names)


def encoded(
    docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SAMPLES, seed: int = 0, v: Vocabulary | None = None, model: str = MODEL
) -> DataFrame:
    """doc_id, sample, n_pieces, log_prob, value, inclusion, log_inclusion, round_trip, ids: up to ``k`` rows for each row of ``docs``.

    Samples are distinct, in falling order of ``value`` (perturbed log-probability); a text with fewer segmentations
    gives all of them, a null or empty text the empty one. ``round_trip`` tells that the pieces decode to the text.
    A row's samples depend on its key, its text, ``k`` and ``seed`` alone, so repeated rows give equal samples.
    """
    v = vocabulary(model) if v is None else v
    return in_batches(docs.select(F.col(key).cast("long").alias("doc_id"), text), _encoder(v, k, seed), SCHEMA)


def decoded(rows: DataFrame, v: Vocabulary | None = None, model: str = MODEL) -> DataFrame:
    """doc_id, sample, text of encoded rows; null pieces give a null text."""
    v = vocabulary(model) if v is None else v

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else decode(x, v) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["doc_id", "sample", "text"])

    return in_batches(rows.select("doc_id", "sample", "ids"), run, "doc_id long, sample int, text string")
