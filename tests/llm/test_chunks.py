"""The chunks of operator 7: their size, their distinct grams, and scores that do not depend on the steps."""
import random

import numpy as np
import pyarrow as pa

from corpusprep.llm import perplexity


def _texts(n, size, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcd e", k=size)) for _ in range(n)]


def test_a_chunk_sends_a_gram_once_however_many_steps_it_takes(spark):
    rows = spark.createDataFrame(list(enumerate(_texts(3000, 1000))), "doc_id long, text string").coalesce(1)
    rows = perplexity.chunked(rows, "text", "test-chunks")
    assert rows.select("_chunk").distinct().count() == 1  # 3 MB were three chunks before
    sent = perplexity.chunk_grams(rows, "text")
    assert sent.count() == sent.distinct().count() == 6**4


def test_chunks_are_bounded(spark):
    rows = spark.createDataFrame([(i, "x" * 999_999) for i in range(20)], "doc_id long, text string").coalesce(1)
    sizes = [r["n"] for r in perplexity.chunked(rows, "text", "test-chunks").selectExpr("_chunk", "length(text) AS size").groupBy("_chunk").sum("size").toDF("_chunk", "n").collect()]
    assert sum(sizes) == 20 * 999_999 and max(sizes) <= perplexity.CHUNK_BYTES and len(sizes) == 3


def test_scores_do_not_depend_on_the_steps(monkeypatch):
    texts = [*_texts(40, 300), "", None, "é漢 text 😀😀", *_texts(5, 2000, 2)]
    grams = perplexity.Grams(*perplexity.placed_grams(*perplexity.text_buffers(pa.array(texts)))[:2])
    before, last = grams.columns()
    rng = np.random.default_rng(3)
    bits = pa.table({"before": before, "last": last, "b0": rng.random(len(last), np.float32), "b1": rng.random(len(last), np.float32)})
    which = np.arange(len(texts)) % 2
    scored = lambda: perplexity._scores(pa.array(texts), ["en"] * len(texts), bits, [{}, {}], which, 2, 0.1)
    whole = scored()
    monkeypatch.setattr(perplexity, "STEP_BYTES", 700)
    assert scored() == whole and sum(s is None for s in whole) == 2 and not any(np.isnan(s).any() for s in whole if s)


def test_stems_of_a_step_are_made_once_however_many_models_score_it(monkeypatch):
    texts = ["abcdefgh word", "abcdefgh abcdxyz", None, "word abcdefgh word", "plain text", "abcd"]
    names = np.unique(perplexity.stems(*perplexity.text_buffers(pa.array(["abcdefgh"])))[0][0, :4])
    tables = [{"en": perplexity.StemTable(names, np.arange(4.0) + k)} for k in (1, 10)]
    before, last = perplexity.Grams(*perplexity.placed_grams(*perplexity.text_buffers(pa.array(texts)))[:2]).columns()
    bits = pa.table({"before": before, "last": last, **{f"b{k}": np.zeros(len(last), np.float32) for k in range(8)}})
    calls, made = [], perplexity.stems
    monkeypatch.setattr(perplexity, "stems", lambda *a: calls.append(1) or made(*a))
    got = perplexity._scores(pa.array(texts), ["en"] * 5 + ["xx"], bits, [tables[k & 1] for k in range(8)], np.arange(6), 8, 0.5)
    assert len(calls) == 1  # one for each model before
    short = float(np.flatnonzero(names == made(*perplexity.text_buffers(pa.array(["abcd"])))[0][0, 0])[0])
    assert [s and s[2] for s in got] == [4 - 1.0, 13 + 10 + short - 1.0, None, 13 - 1.5, -1.0, -0.5]


def test_grams_are_numbered_in_their_order():
    rng = np.random.default_rng(5)
    for letters in (3, 90, 5000):
        flat = rng.integers(32, 32 + letters, 4000).astype(np.uint32)
        starts = np.sort(rng.choice(len(flat) - 3, 3000, replace=False))
        grams = perplexity.Grams(flat, starts)
        rows = np.stack([flat[starts + k] for k in range(4)], 1)
        want, number = np.unique(rows, axis=0, return_inverse=True)
        assert np.array_equal(np.stack(grams.points, 1), want) and np.array_equal(grams.numbers, number.ravel())


def test_grams_of_others_are_not_found():
    flat, starts, _ = perplexity.placed_grams(*perplexity.text_buffers(pa.array(["abcabd"])))
    grams = perplexity.Grams(flat, starts)
    asked = perplexity.Grams(*perplexity.placed_grams(*perplexity.text_buffers(pa.array(["abcabd dba", "xyz"])))[:2]).columns()
    at, number = grams.find(*asked)
    assert sorted(number.tolist()) == list(range(len(grams.keys))) and len(at) < len(asked[1])
    many = np.arange(70_000, dtype=np.uint32) + 40  # more letters than four codes of 64 bits hold: surrogates do not matter here
    wide = perplexity.Grams(many, np.arange(len(many) - 3))
    assert wide.triples is not None
    before, last = wide.columns()
    at, number = wide.find(np.append(before, before[0] + 1), np.append(last, last[0]).astype(np.int32))
    assert np.array_equal(at, np.arange(len(last))) and np.array_equal(number, at)


def test_chunks_meet_their_bits_without_moving_texts(spark):
    rows = spark.createDataFrame(list(enumerate(_texts(60, 100))), "doc_id long, text string")
    rows = perplexity.chunked(rows, "text", "test-chunks")
    bits = spark.range(5).selectExpr("id AS _chunk")
    both = rows.groupBy("_chunk").cogroup(bits.groupBy("_chunk")).applyInArrow(lambda a, b: a.select(["doc_id"]), "doc_id long")
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # of the bits; the texts were moved too before
    assert sorted(r["doc_id"] for r in both.collect()) == list(range(60))
    name = rows.__dict__["_scratch_table"]
    perplexity.drop_stored(rows)
    assert not spark.catalog.tableExists(name)
