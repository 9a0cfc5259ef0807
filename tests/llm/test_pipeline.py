"""Every stage of the pipeline against brute force."""

from __future__ import annotations

import re

import corpus_pipeline
from statspark.llm import pieces
from tests.llm.test_corpus import jaccard_components, lower

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    windows = []
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        w = WORD.findall(lower(r.text))
        windows += [w[i : i + min(13, len(w))] for i in range(max(1, len(w) - 12))] if w else []
    have = {tuple(w) for w in windows}

    def contaminated(t):
        w, hit = WORD.findall(lower(t)), set()
        for n in {len(x) for x in have}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in have:
                    hit.update(range(i, i + n))
        return bool(hit) and 20 * len(hit) >= len(w)

    def copies(kept):
        best = {}
        for i in sorted(kept):
            key = re.sub(r"[\x20\x09-\x0D]", "", texts[i] or "")
            if key not in best or len(texts[i] or "") > len(texts[best[key]] or ""):
                best[key] = i
        return set(best.values())

    near = lambda kept: {i for i, (_, c) in jaccard_components({i: texts[i] for i in kept}, 5, 80).items() if i == c}
    want = [lambda k: k, copies, near, lambda k: {i for i in k if not contaminated(texts[i])}]
    kept = set(texts)
    for (name, stage), expected in zip(corpus_pipeline.STAGES[:-1], want, strict=True):
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        kept = expected(kept)
        assert {r.doc_id for r in docs.collect()} == kept, name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in last.collect()} == kept
    assert all(r.text == texts[r.doc_id] for r in pieces.decoded(last).collect())
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).select("doc_id", "sample").collect())) == sorted(map(tuple, last.select("doc_id", "sample").collect()))


def test_rows_not_ids_are_decided(spark):
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(5, "a unique text"), (5, "copied here"), (3, "copied  here"), (7, "twice"), (7, "twice"), (None, "alone"), (None, "copied here"), (1, None), (2, "")]
    near = [(8, long), (8, "something else altogether"), (9, long + " more"), (None, long + " again")]
    shape = "doc_id long, text string, _row int, _gone int, id int"
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows + near], shape)
    stages = dict(corpus_pipeline.STAGES)
    out = stages["exact_dedup"](spark, docs, "")
    assert out.columns == docs.columns
    said = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert said == sorted([(5, "a unique text"), (3, "copied  here"), (7, "twice"), (None, "alone"), (1, None), *near], key=repr)
    left = stages["ngram_jaccard_join"](spark, out, "")
    assert left.columns == docs.columns
    assert {(r.doc_id, r.text) for r in left.collect()} == {(5, "a unique text"), (3, "copied  here"), (7, "twice"), (None, "alone"), (1, None), (8, long), (8, "something else altogether")}
    empty = docs.limit(0)
    assert all(stages[s](spark, empty, "").count() == 0 for s in ("exact_dedup", "ngram_jaccard_join"))


def test_contaminated_rows_go_one_by_one(spark, sf_dir):
    item = next(r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() if len(r.text.split()) > 15)
    rows = [(4, item), (4, "clean words alone"), (None, item), (6, None), (6, ""), (8, item + " tail")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _row string")
    out = dict(corpus_pipeline.STAGES)["benchmark_decontamination"](spark, docs, sf_dir)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in out.collect()) == [(4, "clean words alone"), (6, ""), (6, "")]


def test_noise_goes_row_by_row(spark, sf_dir):
    """Noise that repeats ids, or has none, goes alone."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    noise = "qzx jvkw xqqz zzj wvxk qjx " * 20
    ids = [r.doc_id for r in docs.limit(3).collect()]
    more = spark.createDataFrame([(i, noise + str(i), None, None, 1) for i in [*ids, None]], docs.schema)
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    out = stage(spark, docs.union(more), sf_dir)
    assert out.columns == docs.columns
    assert sorted(map(repr, out.collect())) == sorted(map(repr, docs.collect()))
    assert stage(spark, docs.limit(0), sf_dir).count() == 0
    odd = spark.createDataFrame([(1, None, None, None, 1), (2, "", "en", "a", 1), (None, " ", None, None, 1), (3, "the house and the garden " * 3000, None, None, 1)], docs.schema)
    clash = odd.selectExpr("*", "1 as host", "2 as declared", "3 as _row", "4 as language", "5 as text_ll")
    kept = stage(spark, clash, sf_dir)
    assert kept.columns == clash.columns and {r.doc_id for r in kept.collect()} <= {1, 2, 3, None}
