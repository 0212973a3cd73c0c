"""The pipeline's stages on odd rows, empty tables and clashing names."""
import pytest

import corpus_pipeline

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, _chunk int, row_hash string, keep boolean, perplexity double, hash bigint, ids string"


def _rows(odd):
    return [(i, t, "en" if t else None, None, None if t is None else len(t), 5, "h", False, 0.5, 3, "x") for i, t in odd]


@pytest.fixture()
def folder(spark, tmpdir_path):
    def make(labels, items):
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.mode("overwrite").parquet(f"{tmpdir_path}/labels.parquet")
        spark.createDataFrame(items, "item_id bigint, text string").write.mode("overwrite").parquet(f"{tmpdir_path}/benchmark.parquet")
        return tmpdir_path

    return make


@pytest.mark.parametrize("labels,items", [([], []), ([(1, 1, 0), (9, 1, 0), (None, 1, 0), (6, None, None)], [(1, None), (2, ""), (3, "a passage that none of the texts holds"), (None, "nor this one of a null id")])])
def test_stages_keep_odd_rows_and_all_columns(spark, odd, folder, labels, items):
    sf = folder(labels, items)
    docs = spark.createDataFrame(_rows(odd), DOCS).repartition(3).checkpoint()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        before, got = sorted(map(str, docs.collect())), sorted(map(str, out.collect()))
        if name == "quality" and labels:  # a model of these few texts may reject others, never one without text
            assert set(got) <= set(before) and {str(r) for r in docs.where("coalesce(text, '') = ''").collect()} <= set(got)
        elif name == "near_copies":
            assert set(got) <= set(before) and len(got) < len(before)  # rows equal in id and text are one
            assert {(r.doc_id, r.text) for r in out.collect() if not (r.text or "").strip()} == {(i, t) for i, t in odd if not (t or "").strip()}
        else:
            assert got == before, name
        assert stage(spark, docs.limit(0), sf).count() == 0, name
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert pieces.agg({"length": "sum"}).first()[0] == sum(r.doc_tokens for r in pieces.where("start = 0").collect())
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), sf).count() == 0


def test_scratch_of_the_run_goes(spark):
    import os

    from corpusprep.session import checkpoint_dir
    at = os.path.join(checkpoint_dir(spark).replace("file:", ""), "corpusprep")
    before = set(os.listdir(at)) if os.path.isdir(at) else set()
    corpus_pipeline.run(spark, "/root/testdata/sf0.001").count()
    assert {x.rsplit("-", 1)[0] for x in set(os.listdir(at)) - before} == {"pipeline-secrets"}


def test_quality_stage_knows_words_of_few_toxic_rows_among_much_toxic_text(spark, folder):
    import random

    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9))
    lexicon = ["zzvenomous", "vendible", *(word() for _ in range(40))]  # every four letters of the toxic word are common
    text = lambda more="": " ".join(rng.sample([*rng.choices(lexicon, k=40), *more.split()], 40 + len(more.split())))
    docs = [(i, text()) for i in range(400)] + [(400 + i, text("venomous " * 3)) for i in range(8)]
    long = [(500 + i, " ".join(word() for _ in range(150_000))) for i in range(2)]
    sf = folder([(i, 1, 0) for i in range(400)] + [(i, 0, 1) for i in (*range(400, 405), 500, 501)], [])
    rows = spark.createDataFrame(_rows(docs + long), DOCS).repartition(3)
    kept = {r.doc_id for r in corpus_pipeline.STAGES[0][1](spark, rows, sf).select("doc_id").collect()}
    assert not kept & set(range(400, 408)) and len(kept & set(range(400))) >= 390  # the toxic word was dropped for the long rows' sake
