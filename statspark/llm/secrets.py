"""Secret scan: rules for known shapes, and a character convolutional network over every candidate.

The network sees a candidate and its context on both sides, a long one in overlapping parts of which the most suspicious
counts. It is fitted in numpy on a bounded sample of labelled findings. So that it learns what tokens of secrets look
like, and not to repeat the rules that label them, findings also come in variants (the same token in other alphabets,
lengths and with prefixes), and contexts are exchanged among findings of both classes. Harmless tokens also come made of
the corpus' own words, dates and numbers. It is calibrated on held-out findings and their variants, and its thresholds,
one for each kind of candidate, are the highest that keep the asked-for recall there. Where a corpus has no labelled
findings, the variants of made tokens are what it learns from.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import batched

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import in_batches, materialised

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")
#: What a text must contain, in lower case, for ASSIGN to match at all.
NAMES = (b"passw", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "network")
#: Least length of a candidate, characters that the network sees of it at once and of its context on each side.
LEAST, SEEN, CONTEXT = 16, 48, 24
#: Most labelled findings of each class that the fit uses, and the recall that the thresholds keep.
FINDINGS, RECALL = 1500, 0.98
#: Kinds of candidates, each with its own threshold: digits, hexadecimal, upper case and digits, others.
SHAPES = (re.compile(r"[0-9]+"), re.compile(r"[0-9a-f]+"), re.compile(r"[A-Z0-9]+"))
#: Made findings of each class that the fit always has, whatever the corpus holds.
MADE = 4000
#: Invented words among those of harmless tokens, beyond as many as the corpus' own.
INVENTED = 300
#: Views encoded at once.
AT_ONCE = 2048
_TOKEN = np.zeros(256, bool)
_TOKEN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[list(b"0123456789")] = True
_SYMBOLS = "\0abcdefghijklmnopqrstuvwxyz0123456789 \n\"'=:._-+/@#$%&*()[]{}<>,;|"
_CODE = {c: i for i, c in enumerate(_SYMBOLS)} | {c.upper(): i for i, c in enumerate(_SYMBOLS) if c.isalpha()}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the rules' findings, in order."""
    found = []
    low = text.encode("utf-8", "surrogatepass").lower()
    if any(name in low for name in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(a, 2, b) for a, b in _runs(text, 24, HEXADECIMAL)]
    return sorted(found)


HEXADECIMAL = np.zeros(256, bool)
HEXADECIMAL[list(b"0123456789abcdef")] = True


def _runs(text: str, least: int, of: np.ndarray) -> list[tuple[int, int]]:
    """Start and end (code points) of the longest runs of the given ASCII characters."""
    raw = text.encode("utf-8", "surrogatepass")
    inside = np.concatenate(([False], of[np.frombuffer(raw, np.uint8)], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    long = edges[1::2] - edges[::2] >= least
    starts, ends = edges[::2][long].tolist(), edges[1::2][long].tolist()
    if len(raw) == len(text):
        return list(zip(starts, ends, strict=True))
    return [(n := len(raw[:a].decode("utf-8", "surrogatepass")), n + b - a) for a, b in zip(starts, ends, strict=True)]


def candidates(text: str) -> list[tuple[int, int]]:
    """Runs of token characters that hold a digit."""
    return [(a, b) for a, b in _runs(text, LEAST, _TOKEN) if any(c.isdigit() for c in text[a:b])]


def view(text: str, a: int, b: int) -> str:
    """What the network sees, always of the same length."""
    left = text[max(0, a - CONTEXT) : a].rjust(CONTEXT, "\0")
    return left + text[a : min(b, a + SEEN)].ljust(SEEN, "\0") + text[b : b + CONTEXT].ljust(CONTEXT, "\0")


def parts(a: int, b: int) -> list[tuple[int, int]]:
    """What of a candidate is seen at once: all of it, or overlapping parts that cover it."""
    if b - a <= SEEN:
        return [(a, b)]
    return [(s, s + SEEN) for s in [*range(a, b - SEEN, SEEN // 2), b - SEEN]]


def views(text: str, a: int, b: int) -> list[str]:
    return [view(text, s, e) for s, e in parts(a, b)]


def marked(a: int, b: int, base: list[tuple[int, int, int]]) -> list[bool]:
    """Which parts of a candidate hold a finding of the rules, or LEAST characters of it."""
    inside = [(max(s, a), min(e, b)) for s, _, e in base if s < b and a < e]
    return [any(min(e, y) - max(s, x) >= min(LEAST, y - x) for x, y in inside) for s, e in parts(a, b)]


def greatest(p: np.ndarray, counts: list[int]) -> np.ndarray:
    """Of every candidate with so many views the greatest value."""
    return np.maximum.reduceat(p, np.cumsum([0, *counts[:-1]])) if len(counts) else p


def shape(token: str) -> int:
    return next((i for i, s in enumerate(SHAPES) if s.fullmatch(token)), len(SHAPES))


def encoded(views: list[str]) -> np.ndarray:
    """Codes of characters, upper case apart, others as one."""
    other = len(_SYMBOLS)
    upper = other + 1
    return np.array([[_CODE.get(c, other) + (upper if "A" <= c <= "Z" else 0) for c in v] for v in views], np.int32)


@dataclass
class Network:
    """Embedding, one convolution with the greatest response over places, and a logistic output."""

    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    shift: float
    scale: float = 1.0
    offset: float = 0.0
    thresholds: tuple[float, ...] = ()
    #: Of the held-out findings that reach the thresholds, the part that is secret.
    precision: float = 1.0

    width = 5

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, epochs: int = 8, rate: float = 0.01, size: int = 8, filters: int = 24) -> Network:
        rng = np.random.default_rng(3)
        net = cls(
            rng.normal(0, 0.3, (2 * (len(_SYMBOLS) + 1), size)),
            rng.normal(0, 0.2, (cls.width * size, filters)),
            np.zeros(filters),
            rng.normal(0, 0.2, filters),
            0.0,
        )
        weights = ["embedding", "filters", "bias", "out"]
        first = {k: np.zeros_like(getattr(net, k)) for k in weights}
        second = {k: np.zeros_like(getattr(net, k)) for k in weights}
        balance = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6))
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), 64):
                part = order[i : i + 64]
                step += 1
                for k, g in net._gradients(x[part], y[part], balance[part]).items():
                    if k == "shift":
                        net.shift -= rate * g
                        continue
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    fix = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                    setattr(net, k, getattr(net, k) - rate * fix)
        return net

    def _pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        places = sliding_window_view(self.embedding[x], self.width, axis=1).transpose(0, 1, 3, 2)
        places = places.reshape(len(x), -1, self.filters.shape[0])
        response = places @ self.filters + self.bias
        best = response.argmax(axis=1)
        return np.maximum(np.take_along_axis(response, best[:, None], 1)[:, 0], 0), best, places

    def _gradients(self, x: np.ndarray, y: np.ndarray, balance: np.ndarray) -> dict:
        pooled, best, places = self._pooled(x)
        error = (1 / (1 + np.exp(-(pooled @ self.out + self.shift))) - y) * balance / len(x)
        back = error[:, None] * self.out * (pooled > 0)
        at = places[np.arange(len(x))[:, None], best]
        size = self.embedding.shape[1]
        towards = (back[:, :, None] * self.filters.T).reshape(len(x), -1, self.width, size)
        embedding = np.zeros_like(self.embedding)
        codes = x[np.arange(len(x))[:, None, None], best[:, :, None] + np.arange(self.width)]
        np.add.at(embedding, codes.ravel(), towards.reshape(-1, size))
        return {
            "embedding": embedding,
            "filters": np.einsum("nf,nfk->kf", back, at),
            "bias": back.sum(0),
            "out": pooled.T @ error,
            "shift": error.sum(),
        }

    def logits(self, x: np.ndarray) -> np.ndarray:
        parts = [self._pooled(x[i : i + 256])[0] @ self.out + self.shift for i in range(0, len(x), 256)]
        return np.concatenate(parts) if parts else np.empty(0)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * self.logits(x) + self.offset)))

    def judged(self, seen: Iterable[str]) -> np.ndarray:
        """Probabilities of views, a bounded number of them encoded at once."""
        return np.concatenate([np.empty(0), *(self.probability(encoded(list(some))) for some in batched(seen, AT_ONCE))])

    def calibrate(self, x: np.ndarray, y: np.ndarray, shapes: np.ndarray, recall: float, counts: list[int] | None = None) -> None:
        """Fit scale and offset to held-out findings (with ``counts`` views, or one each), then the thresholds."""
        counts = counts or [1] * len(y)
        self.scale, self.offset = 1.0, 0.0
        z = greatest(self.logits(x), counts)
        for _ in range(300):
            error = 1 / (1 + np.exp(-(self.scale * z + self.offset))) - y
            self.scale -= 0.05 * float((error * z).mean())
            self.offset -= 0.05 * float(error.mean())
        p = greatest(self.probability(x), counts)
        of = lambda mask: float(np.quantile(p[mask], 1 - recall, method="lower")) if mask.any() else 0.5
        every = of(y == 1)
        kinds = [(y == 1) & (shapes == k) for k in range(len(SHAPES) + 1)]
        self.thresholds = tuple(of(m) if m.sum() >= 20 else every for m in kinds)
        found = p >= np.array(self.thresholds)[shapes]
        self.precision = float(y[found].mean()) if found.any() else 1.0


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column(0):
            t = text.as_py() or ""
            if places := candidates(t):
                base = base_spans(t)
                rows += [(views(t, a, b), shape(t[a:b]), any(m := marked(a, b, base)), m) for a, b in places]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = (pa.list_(pa.string()), pa.int32(), pa.bool_(), pa.list_(pa.bool_()))
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["seen", "shape", "secret", "marks"])


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ALPHABETS = (_DIGITS + "abcdef", _DIGITS + "ABCDEF", _DIGITS + _LOWER, _DIGITS + _UPPER, _DIGITS + _LOWER + _UPPER, _DIGITS + _LOWER + _UPPER + "+/", _DIGITS + _LOWER + _UPPER + "-_")


def variant(token: str, rng: np.random.Generator) -> str:
    """A token of another alphabet and length; equal characters of the token stay equal."""
    alphabet = rng.permutation(list(_ALPHABETS[rng.integers(len(_ALPHABETS))]))
    letters = [c for c in token if c.isalnum()] or list("".join(rng.choice(list(_DIGITS + _LOWER), 24)))
    size = int(rng.integers(LEAST, SEEN + 1))
    out = [str(alphabet[(ord(letters[i % len(letters)]) * 7 + (i // len(letters)) * int(rng.integers(1, 64))) % len(alphabet)]) for i in range(size)]
    if rng.random() < 0.4:
        # A short name in front, at times a number or a second name too.
        joint = str(rng.choice(["_", "-"]))
        names = [_some(_LOWER, int(rng.integers(2, 5)), rng)]
        if rng.random() < 0.5:
            names.append(_some(_DIGITS if rng.random() < 0.5 else _LOWER, int(rng.integers(3, 13)), rng))
        front = "".join(n + joint for n in names)
        out = [*front, *out[: max(20, SEEN - len(front))]]
    return "".join(out)


def invented(rng: np.random.Generator) -> str:
    """A word that can be spoken, as names that no corpus holds are."""
    heads, vowels, tails = ["", *"bcdfghjklmnpqrstvwxz", "st", "tr", "pl", "ch", "sh", "br"], [*"aeiou", "ea", "ou", "io"], ["", "", *"nrslt", "nd", "ng"]
    return "".join(str(rng.choice(x)) for _ in range(int(rng.integers(1, 4))) for x in (heads, vowels, tails))


def _joined(words: list[str], rng: np.random.Generator) -> str:
    """Words, dates and numbers between the same sign."""
    number = lambda: str(int(rng.integers(0, 10 ** int(rng.integers(1, 6)))))
    date = lambda: f"{rng.integers(1980, 2030)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}"
    joint, parts = str(rng.choice(list("-_/="))), []
    while sum(map(len, parts)) + len(parts) < LEAST + int(rng.integers(0, 30)):
        kind = rng.random()
        parts.append(date() if kind < 0.1 else number() if kind < 0.25 else str(rng.choice(words)) + (number() if kind < 0.4 else ""))
    token = joint.join(parts)
    token = token.title() if rng.random() < 0.2 else token.upper() if rng.random() < 0.1 else token
    return token if any(c.isdigit() for c in token) else f"{token}{joint}{number()}"


def _some(alphabet: str, n: int, rng: np.random.Generator) -> str:
    return "".join(rng.choice(list(alphabet), n))


def _number(words: list[str], rng: np.random.Generator) -> str:
    return _some(_DIGITS, int(rng.integers(LEAST, 24)), rng)


def _uuid(words: list[str], rng: np.random.Generator) -> str:
    """Hexadecimal groups of fixed lengths."""
    token = "-".join(_some(_DIGITS + "abcdef", n, rng) for n in (8, 4, 4, 4, 12))
    return token.upper() if rng.random() < 0.3 else token


def _stock(words: list[str], rng: np.random.Generator) -> str:
    """Short groups of capitals and of digits."""
    joint, parts = str(rng.choice(list("-_/"))), [_some(_UPPER, int(rng.integers(1, 5)), rng) + _some(_DIGITS, int(rng.integers(0, 5)), rng)]
    while sum(map(len, parts)) + len(parts) < LEAST + int(rng.integers(0, 8)):
        parts.append(_some(_DIGITS if rng.random() < 0.6 else _UPPER, int(rng.integers(1, 7)), rng))
    return joint.join([*parts, _some(_DIGITS, 2, rng)])


def _camel(words: list[str], rng: np.random.Generator, least: int = LEAST) -> str:
    """Words in one, each with a capital, a number among them."""
    parts = [str(rng.choice(words)).lower()]
    while sum(map(len, parts)) < least + int(rng.integers(0, 12)):
        parts.append(str(rng.choice(words)).lower().title())
    at = int(rng.integers(1, len(parts) + 1))
    parts.insert(at, str(int(rng.integers(0, 10 ** int(rng.integers(1, 4))))))
    return "".join(parts) if rng.random() < 0.7 else "".join(parts).replace(parts[0], parts[0].title(), 1)


def _path(words: list[str], rng: np.random.Generator) -> str:
    """Folders, some of them words in one."""
    parts = [""] if rng.random() < 0.3 else []
    while sum(map(len, parts)) + len(parts) < LEAST + int(rng.integers(0, 30)):
        parts.append(_camel(words, rng, 6) if rng.random() < 0.3 else str(rng.choice(words)) + (_some(_DIGITS, 1, rng) if rng.random() < 0.3 else ""))
    token = "/".join(parts)
    return token if any(c.isdigit() for c in token) else token + _some(_DIGITS, 1, rng)


def _version(words: list[str], rng: np.random.Generator) -> str:
    """A name and the numbers of a release."""
    name = str(rng.choice(list("-_"))).join(str(w) for w in rng.choice(words, int(rng.integers(2, 4))))
    token = f"{name}-v{_some(_DIGITS, 1, rng)}-{rng.integers(0, 40)}-{rng.integers(0, 9999)}"
    return token + str(rng.choice(["", "-rc1", "-beta2", "-SNAPSHOT", "_x86_64", "-amd64"]))


#: Kinds of tokens with digits that are none of a secret, each as likely as it is listed.
HARMLESS = (_joined, _joined, _number, _number, _uuid, _stock, _camel, _camel, _camel, _path, _version)


def harmless(words: list[str], rng: np.random.Generator, kinds: tuple = HARMLESS) -> str:
    """A token with digits that is none of a secret."""
    return kinds[int(rng.integers(len(kinds)))](words, rng)


def made(rows: list[tuple[list[str], bool]], most: int, rng: np.random.Generator) -> tuple[list[str], list[bool]]:
    """Views of variants and harmless tokens in the contexts of rows (views, whether secret), and which are secret."""
    contexts = [(v[:CONTEXT], v[CONTEXT + SEEN :]) for views_, _ in rows for v in views_] or [("\0" * CONTEXT, "\0" * CONTEXT)]
    words = sorted({w for left, right in contexts for w in re.findall(r"[^\W\d_]{3,}", left[1:] + " " + right[:-1])} | {"alpha", "report", "table", "index", "version", "image", "part", "data"})
    words += [w for w in (invented(rng) for _ in range(len(words) + INVENTED)) if len(w) > 2]
    tokens = [v[CONTEXT : CONTEXT + SEEN].rstrip("\0") for views_, secret in rows if secret for v in views_[:1]] or [""]
    out, secret = [], []
    for i in range(2 * most):
        left, right = contexts[int(rng.integers(len(contexts)))]
        token = (variant(tokens[int(rng.integers(len(tokens)))], rng) if i % 2 else harmless(words, rng))[:SEEN]
        out.append(left + token.ljust(SEEN, "\0") + right)
        secret.append(bool(i % 2))
    return out, secret


def train(docs: DataFrame, text: str = "text", findings: int = FINDINGS, recall: float = RECALL) -> Network:
    """Fit on at most ``findings`` labelled findings of each class and on made ones, a quarter held out for the thresholds.

    The labels are the rules': a candidate is secret if it holds a finding of theirs. Findings are picked by a hash of
    what the network sees, so the pick does not depend on the order of rows. Whatever there is of them, MADE variants of
    each class are added, so a corpus without labelled findings has a network too.
    """
    found = in_batches(docs.select(text), _labelled, "seen array<string>, shape int, secret boolean, marks array<boolean>")
    found = materialised(found.distinct())
    picked = [found.where(F.col("secret") == c).orderBy(F.xxhash64("seen"), "seen").limit(findings).collect() for c in (True, False)]
    rng = np.random.default_rng(5)
    held = [r for part in picked for r in part[3::4]]
    rows = [r for part in picked for i, r in enumerate(part) if i % 4 != 3]
    seen, marks = [v for r in rows for v in r["seen"]], [m for r in rows for m in r["marks"]]
    # The same tokens in the contexts of others: a secret must be told by itself too.
    contexts = [(v[:CONTEXT], v[CONTEXT + SEEN :]) for v in seen]
    for v, m in list(zip(seen, marks, strict=True)):
        left, right = contexts[int(rng.integers(len(contexts)))]
        seen.append(left + v[CONTEXT : CONTEXT + SEEN] + right)
        marks.append(m)
    more, secret = made([(r["seen"], r["secret"]) for r in rows], MADE, rng)
    net = Network.fit(encoded([*seen, *more]), np.array([*marks, *secret], float))
    more, secret = made([(r["seen"], r["secret"]) for r in held], MADE // 2, rng)
    shapes = [r["shape"] for r in held] + [shape(v[CONTEXT : CONTEXT + SEEN].rstrip("\0")) for v in more]
    counts = [len(r["seen"]) for r in held] + [1] * len(more)
    y = np.array([r["secret"] for r in held] + secret, float)
    net.calibrate(encoded([v for r in held for v in r["seen"]] + more), y, np.array(shapes), recall, counts)
    return net


def _scan(net: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_py() or "" for x in batch.column(1)]
            base = [base_spans(t) for t in texts]
            places = [(i, a, b) for i, t in enumerate(texts) for a, b in candidates(t)] if net is not None else []
            spans = [list(x) for x in base]
            judged = np.bincount([i for i, _, _ in places], minlength=len(texts)) if places else np.zeros(len(texts), np.int64)
            if places:
                p = net.judged(v for i, a, b in places for v in views(texts[i], a, b))
                p = greatest(p, [len(parts(a, b)) for _, a, b in places])
                for (i, a, b), value in zip(places, p, strict=True):
                    if value >= net.thresholds[shape(texts[i][a:b])] and not any(s <= a and b <= e for s, _, e in base[i]):
                        spans[i].append((a, 3, b))
            said = lambda x: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(x))
            counts = [pa.array([sum(k == n for _, k, _ in x) for x in spans], pa.int64()) for n in range(4)]
            digests = [hashlib.sha256(said(x).encode()).hexdigest() for x in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(judged, pa.int64()), pa.array(digests, pa.string()), pa.array(map(said, spans), pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_network", "n_candidates", "base_sha256", "spans"],
            )

    return run


def secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", net: Network | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_network, n_candidates, base_sha256, spans: one row per row of ``docs``.

    ``spans`` lists kind:start:end of all findings by start and kind (code points, end exclusive); ``base_sha256`` is
    the digest of the rules' part of it. The network judges every candidate; what it finds inside a finding of the rules is
    not said again. A null text is empty and has none. Rows may repeat and lack an id; other
    columns are not read. Without a network only the rules find anything.
    """
    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_network long, n_candidates long, base_sha256 string, spans string"
    return in_batches(docs.select(F.col(key).cast("long").alias("doc_id"), text), _scan(net), schema)


def redacted(text: str, spans: str, mark: str = "[secret]") -> str:
    """A text with its findings replaced; overlapping findings become one mark."""
    out, at = [], 0
    for _, a, b in sorted((s.split(":") for s in spans.split(",") if s), key=lambda s: int(s[1])):
        if int(a) >= at:
            out += [text[at : int(a)], mark]
        at = max(at, int(b))
    return "".join([*out, text[at:]])
