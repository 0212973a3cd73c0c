"""The map of rows asked for, and sets of equal rows, in operator 1."""
from pyspark.sql import functions as F

from corpusprep.llm.ngram_join import jaccard_components, maybe_asked


def test_texts_not_asked_for_are_left_before_the_join(spark):
    rows = spark.range(3000).select(F.xxhash64("id").alias("row"), F.col("id").cast("string").alias("text"))
    edges = spark.createDataFrame([(v, str(v)) for v in (0, -1, 1, (1 << 25) - 1, 1 << 25, 32767, 32768, -(2**63))], "row bigint, text string")
    texts = rows.unionAll(edges)
    asked = texts.where("abs(hash(text)) % 10 = 0").unionAll(edges).select("row")
    left = {r["text"] for r in maybe_asked(texts, asked).collect()}
    wanted = {r["text"] for r in texts.join(asked, "row", "left_semi").collect()}
    assert wanted <= left
    assert len(left) < len(wanted) + 20  # all texts went to the join before
    assert maybe_asked(texts, asked.where("false")).count() == 0


def test_equal_rows_and_null_ids_with_partners(spark):
    words = [f"w{i}" for i in range(60)]
    text, near = " ".join(words), " ".join(words[:-1])
    rows = [(1, text), (1, text), (1, text), (2, near), (None, text), (None, text), (4, near), (5, None), (5, None), (6, "else")]
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), threshold=0.85)
    found = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in got.collect())
    assert found == [(False, 1, 57, 1)] * 3 + [(False, 2, 56, 1), (False, 4, 56, 1), (False, 5, 0, 5), (False, 5, 0, 5), (False, 6, 1, 6)] + [(True, 0, 57, 1)] * 2


def test_sets_are_made_where_they_are_judged(spark, monkeypatch):
    from corpusprep.llm import ngram_join

    kept, store = {}, ngram_join.stored
    monkeypatch.setattr(ngram_join, "stored", lambda df, name: kept.setdefault(name, store(df, name)))
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[: 60 - i % 2])) for i in range(6)] + [(i, f"unlike {i}") for i in range(6, 9)]
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r["doc_id"], r["component_id"]) for r in got.collect()) == [(i, 0) for i in range(6)] + [(i, i) for i in range(6, 9)]
    assert not [n for n, df in kept.items() if {"tokens", "text"} & set(df.columns)]  # sets were stored, and shuffled by class and by unit


def test_shingles_of_some_dozen_texts_make_no_pairs(spark, monkeypatch):
    from corpusprep.llm import ngram_join

    met, store = [], ngram_join.stored

    def spy(df, name):
        out = store(df, name)
        if name == "shingle-meetings":
            met.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "stored", spy)
    common = " ".join(f"c{k}" for k in range(40))
    rows = [(i, " ".join([*(f"w{i}x{k}" for k in range(80)), common, *(f"v{i}x{k}" for k in range(80))])) for i in range(60)]
    rows += [(100, rows[0][1] + " more"), (101, rows[1][1])]
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {**{i: i for i in range(60)}, 100: 0, 101: 1}
    assert 0 < met[0] < 20  # every two texts met in the passage before, as a shingle of under 64 texts was never taken for frequent


def test_frequent_shingles_are_bounded_by_rank(spark, monkeypatch):
    from corpusprep.llm import ngram_join

    counts = spark.createDataFrame([(0, 0, 90), *((i, n, 0) for i, n in enumerate([9, 9, 7, 7, 7, 5, 2, 1 << 20], 1))], "token bigint, n bigint, total bigint")
    least = []
    for most in (0, 1, 2, 3, 5, 6, 7, 100):
        monkeypatch.setattr(ngram_join, "FREQUENT", most)
        least.append(ngram_join._least_count(counts) if most else None)
    assert least[1:] == [1 << 16, 1 << 16, 9, 9, 7, 5, 2]
    assert ngram_join._least_count(counts.limit(0)) > 0
