"""Mixing, fill-in-middle and spelling variants against brute force."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from statspark.llm import fill_in_middle, mixing, spelling
from tests.llm.test_corpus import ODD, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SHAPE = "doc_id long, text string, source string, part int, row int, epoch int, place int, size int"


def mix_rows(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], SHAPE).repartition(3)


def targets(sizes, weights=(5, 2, 1), percent=150, epochs=2):
    """By the rule as it is written: share by weight, stop what is above, share again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = {}, sum(sizes.values()) * percent / 100
    while True:
        free = [s for s in names if s not in full]
        rest = (total - sum(full.values())) / max(1, sum(weight[s] for s in free))
        above = [s for s in free if weight[s] * rest > epochs * sizes[s]]
        if not above:
            return full | {s: weight[s] * rest for s in free}
        full |= {s: epochs * sizes[s] for s in above}


MIX = [
    *((i, "w " * (i % 50), "hot") for i in range(300)),
    *((1000 + i, "a b\tc\nd", f"s{i % 7}") for i in range(70)),
    (5, "same words here", "s1"),
    (5, "same words here", "s1"),
    (5, "same words", "s1"),
    (6, None, "s1"),
    (7, " \n", "blank"),
    (None, "no id", None),
    (None, "no id", None),
    (8, "x " * 20_000, "long"),
    (9, "é b 漢字 \U0001f600", "S"),
    (10, "one", ""),
]


@pytest.mark.parametrize("percent", [1, 150, 200])
def test_mixture_cuts_at_the_targets(spark, percent):
    got = mixing.mixture(mix_rows(spark, MIX), percent=percent).collect()
    assert sorted((r.doc_id or 0, r.source or "", r.size) for r in got) == sorted((i or 0, s or "", len(WORD.findall(t or ""))) for i, t, s in MIX)
    sizes, taken, aim = collections.Counter(), collections.Counter(), {}
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        aim[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    want = targets(sizes, percent=percent)
    assert set(aim) == set(want) and all(abs(aim[s] - want[s]) < 1e-6 for s in want)
    assert all(r.source_size == sizes[r.source] for r in got)
    assert all(taken[s] == int(aim[s] + 1e-9) for s in aim)
    # Before the cut each document of a source is taken once more than behind it, one in part.
    for s in aim:
        own = sorted((hashlib.md5(f"42:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest(), r.size, -r.taken) for r in got if r.source == s and r.size)
        times = [-t / z for _, z, t in own]
        assert len({*times}) <= 3 and sum(t != int(t) for t in times) <= 1
    again = mixing.mixture(mix_rows(spark, MIX[::-1]), percent=percent).collect()
    plain = lambda rows: sorted(map(str, ((r.doc_id, r.source, r.size, r.taken) for r in rows)))
    assert plain(again) == plain(got)


def test_mixed_texts_hold_the_words_taken(spark):
    docs = mix_rows(spark, MIX)
    taken = collections.Counter()
    for r in mixing.mixture(docs).collect():
        taken[r.doc_id, r.source] += r.taken
    out = mixing.mixed(docs)
    assert out.columns == [*docs.columns, "epoch_"]
    words = collections.Counter()
    text = collections.defaultdict(set)
    for i, t, s in MIX:
        text[i, s].add(t)
    for r in out.collect():
        words[r.doc_id, r.source] += len(WORD.findall(r.text))
        assert any(t.startswith(r.text) for t in text[r.doc_id, r.source] if t)
    assert {k: v for k, v in taken.items() if v} == words


def test_mixing_nothing(spark):
    assert mixing.mixture(mix_rows(spark, MIX).limit(0)).count() == 0 == mixing.mixed(mix_rows(spark, MIX).limit(0)).count()
    blank = mixing.mixture(mix_rows(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 2


def cut_by_hand(i, text):
    text = text or ""
    units = UNIT.findall(text)
    assert "".join(units) == text
    digest = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", text, None
    if h[3] % 100 < 80:
        return n, "spm", f"<S>{s}<P>{p}<M>{m}", (p, m, s)
    return n, "psm", f"<P>{p}<S>{s}<M>{m}", (p, m, s)


def test_fill_in_middle(spark):
    rng = random.Random(1)
    odd = ["<S>", "a <P> b", "<<", "<P", "S> <M", ">", " lead", "trail \n\n", "$1 \\ $2 {3}", "\U0001f600 é x \x1c\x85 y", "a\0b", "w " * 60_000, " " * 50_000, "x" * 100_000]
    rows = ODD + [(i, rng.choice(odd)) for i in range(100, 400)] + [(i, " ".join(rng.choices(["ab", "<", "P>", "é", "\n", "<M"], k=rng.randrange(30)))) for i in range(400, 900)]
    docs = frame(spark, rows)
    cut = fill_in_middle.fill_in_middle(docs)
    out = cut.select("*", fill_in_middle.restored(cut.output, cut.form).alias("back"), fill_in_middle.parts(cut.output, cut.form).alias("parts")).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.output, r.parts and tuple(r.parts)) for r in out), key=repr)
    assert got == sorted(((i, *cut_by_hand(i, t)) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.back) for r in out), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert fill_in_middle.fill_in_middle(docs.limit(0)).count() == 0


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def words_by_hand(rows, every=31, least=7, times=2):
    n = collections.Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= least and c >= times}


def variants_by_hand(n):
    near = collections.defaultdict(list)
    by = collections.defaultdict(list)
    for w in n:
        by[len(w)].append(w)
    for size, words in by.items():
        for a, b in itertools.chain(itertools.combinations(words, 2), itertools.product(words, by.get(size + 1, []))):
            if one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda o: (-n[o], o), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def test_spelling_variants_of_documents(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = spelling.variants(spelling.counted(docs, every=31)).select("word", "form", "root", "n", "n_near", "form_n").collect()
    want = variants_by_hand(words_by_hand(rows))
    assert len(got) == len(want) > 1000 and {tuple(r) for r in got} == want
    assert any(r.form for r in got) and any(r.n_near for r in got)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_words_are_counted(spark):
    rows = [*ODD, (70, "Straßen ÀÉÎÕÜÿa Straßen ÀÉÎÕÜÿa straßen Kelvins ſecrets×÷ãäåæ"), (71, "Abcdefg-abcdefg ABCDEFG1abcdefgh"), *((i, "wording Wording " * 3) for i in range(200))]
    for every in (0, 3):
        got = {r.word: r.n for r in spelling.counted(frame(spark, rows), every=every).collect()}
        assert got == words_by_hand(rows, every)
    assert spelling.counted(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_near_words_with_repeated_bigrams(spark, seed):
    """Few letters, so that bigrams repeat and tie."""
    rng = random.Random(seed)
    words = {"".join(rng.choices("abÿ"[: 2 + seed % 2], k=rng.randrange(4, 10))) for _ in range(600)} | {"a" * 5_000, "a" * 5_001, "a" * 4_999 + "b"}
    table = spark.createDataFrame([(w, i) for i, w in enumerate(sorted(words))], "word string, n long").repartition(3)
    got = [frozenset((r.word, r.other)) for r in spelling.near_words(table).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {frozenset(p) for p in itertools.combinations(words, 2) if abs(len(p[0]) - len(p[1])) < 2 and one_edit(*p)}


def test_pivots_are_disjoint_and_rare():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdé", k=rng.randrange(4, 12))) for _ in range(300)]
    counts = np.array([rng.randrange(1, 50) for _ in range(spelling.GRAMS)])
    word, place, gram, pivot, _ = spelling.prefixes_and_pivots(words, counts)
    for i in range(len(words)):
        own = [(int(p), int(g), bool(v)) for w, p, g, v in zip(word, place, gram, pivot) if w == i]
        chosen = [(p, g) for p, g, v in own if v]
        assert len(chosen) == 2 and abs(chosen[0][0] - chosen[1][0]) >= 2
        cost = lambda pair: sum(int(counts[g]) for _, g in pair)
        pairs = itertools.combinations([(p, g) for p, g, _ in own], 2)
        assert cost(chosen) == min(cost(x) for x in pairs if abs(x[0][0] - x[1][0]) >= 2)


def test_roots_follow_forms_to_the_last(spark):
    n = {"spelling": 100_000, "spellin": 9_000, "spelln": 700, "speln": 60, "seln": 5, "sel": 1, "another": 3, "spelllng": 10_000}
    words = spark.createDataFrame([(w, c) for w, c in n.items() if len(w) > 3], "word string, n long")
    got = {r.word: tuple(r) for r in spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert {*got.values()} == variants_by_hand({w: c for w, c in n.items() if len(w) > 3})
    assert got["seln"][2] == "spelling"
    assert spelling.variants(words.limit(0)).count() == 0
