import random

import pytest
from pyspark.sql import functions as F

from corpusprep.operators.packing import (
    effective_block_size,
    number_blocks,
    pack_blocks,
    pack_text_blocks,
    packing_report,
)
from corpusprep.operators.tokenizing import tokenize
from model import ids, pack


def _rows(spark, lengths, split="train"):
    data = [(split, i, "".join(chr(97 + (i + j) % 26) for j in range(n))) for i, n in enumerate(lengths)]
    return spark.createDataFrame(data, "split string, row_idx long, text string")


def _blocks(df):
    return sorted((r.batch_id, r.block_no, list(r.input_ids)) for r in df.collect())


def test_fixture_drop_and_short(spark):
    df = tokenize(_rows(spark, [3, 3, 1]))
    b4 = _blocks(pack_blocks(df, 4, 1000))
    assert [len(x[2]) for x in b4] == [4]          # 7 tokens, one block of 4, 3 dropped
    b8 = _blocks(pack_blocks(df, 8, 1000))
    assert [len(x[2]) for x in b8] == [7]          # fewer than a block: one short block
    assert pack_blocks(df, 8, 1000, keep_short=False).count() == 0


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_pack_matches_model_for_any_partitioning(spark, parts):
    rnd = random.Random(parts)
    lengths = [rnd.choice([0, 0, 1, 5, 9, 30, 70]) for _ in range(60)]
    df = _rows(spark, lengths).repartition(parts)
    texts = [r.text for r in sorted(df.collect(), key=lambda r: r.row_idx)]
    expect = sorted((b, k, t) for b, k, t in pack([ids(t) for t in texts], 16, 7))
    arr = pack_blocks(tokenize(df), 16, 7)
    assert _blocks(arr) == expect
    assert _blocks(pack_text_blocks(df, 16, 7)) == expect
    for r in arr.collect():
        assert len(r.input_ids) <= 16 and r.labels == r.input_ids and r.attention_mask == [1] * len(r.input_ids)


def test_document_longer_than_several_blocks_and_empty_batch(spark):
    df = tokenize(_rows(spark, [0, 0, 53, 0]))
    got = _blocks(pack_blocks(df, 10, 2))
    # batch 0 has no tokens -> nothing; batch 1 = 53 tokens -> 5 blocks
    assert [(b, k, len(t)) for b, k, t in got] == [(1, k, 10) for k in range(5)]


def test_report_agrees_with_packing(spark):
    rnd = random.Random(5)
    lengths = [rnd.randint(0, 40) for _ in range(90)]
    df = tokenize(_rows(spark, lengths))
    rep = packing_report(df, 32, 10).first()
    blocks = pack_blocks(df, 32, 10).collect()
    assert rep.rows_in == 90 and rep.tokens_in == sum(lengths)
    assert rep.blocks == len(blocks)
    assert rep.tokens_kept == sum(len(b.input_ids) for b in blocks)
    assert rep.tokens_kept + rep.tokens_dropped == rep.tokens_in
    assert rep.short_blocks == sum(1 for b in blocks if len(b.input_ids) < 32)


def test_number_blocks_is_dense_per_split(spark):
    df = _rows(spark, [40] * 9).unionByName(_rows(spark, [25] * 4, split="validation"))
    nb = number_blocks(pack_text_blocks(df, 16, 2)).collect()
    for split in ("train", "validation"):
        got = sorted((r.batch_id, r.block_no, r.block_idx) for r in nb if r.split == split)
        assert [x[2] for x in got] == list(range(len(got)))


def test_effective_block_size():
    assert effective_block_size(None, 2048) == 2048
    assert effective_block_size(4096, 2048) == 2048
    assert effective_block_size(512, 2048) == 512
    with pytest.warns(UserWarning):
        effective_block_size(None, 10_000)


@pytest.mark.parametrize("seed", range(4))
def test_one_shuffle_packing_equals_general_path(spark, seed):
    from corpusprep.operators.ordering import head_percent_split, row_index
    from corpusprep.operators.packing import pack_corpus_text
    rnd = random.Random(seed)
    n = rnd.choice([5, 40, 120])
    rows = [(k, "".join(chr(97 + rnd.randint(0, 25)) for _ in range(rnd.choice([0, 1, 3, 10, 40, 200]))))
            for k in rnd.sample(range(100_000), n)]
    df = spark.createDataFrame(rows, "k long, text string").repartition(3)
    for B, R, pct, nbk, ks in [(16, 7, 5, 20, True), (8, 1000, None, 3, True), (32, 3, 50, 50, False), (4, 2, 10, 7, True)]:
        if pct is None:
            ref = row_index(df, ["k"]).select(F.lit("train").alias("split"), "row_idx", "text")
        else:
            ref = head_percent_split(df, ["k"], pct).select("split", "row_idx", "text")
        expect = _blocks(pack_text_blocks(ref, B, R, keep_short=ks))
        got = _blocks(pack_corpus_text(df, "k", B, R, percent=pct, keep_short=ks, num_buckets=nbk))
        assert got == expect


def test_strategies_agree(spark, tmpdir_path):
    from corpusprep.plans.pretrain import pretrain_blocks
    spark.createDataFrame([(i, "word " * i) for i in range(50)], "doc_id long, text string") \
        .write.parquet(f"{tmpdir_path}/docs")
    docs = spark.read.parquet(f"{tmpdir_path}/docs")
    a, b = (_blocks(pretrain_blocks(docs, ["doc_id"], block_size=32, rows_per_batch=8, percent=10, strategy=s))
            for s in ("two_shuffle", "one_shuffle"))
    assert a == b and a


def test_pieces_carry_no_whole_text_and_grow_linearly(spark):
    import time

    from corpusprep.operators.packing import pack_blocks, pack_text_blocks

    def seconds(n):
        df = spark.range(1).select(F.lit("train").alias("split"), F.lit(0).cast("bigint").alias("row_idx"),
                                   F.repeat(F.lit("añ😀b "), n // 5).alias("text"))
        t0 = time.perf_counter()
        r = pack_text_blocks(df, 1024, 10).agg(F.count("*"), F.sum(F.size("input_ids"))).first()
        assert tuple(r) == (n // 1024, n // 1024 * 1024)
        return time.perf_counter() - t0

    seconds(500_000)
    assert seconds(4_000_000) < 60
    df = spark.range(1).select(F.lit("train").alias("split"), F.col("id").alias("row_idx"), F.lit("x").alias("text"))
    plan = pack_text_blocks(df, 16, 10)._jdf.queryExecution().optimizedPlan().toString()
    aggregate = plan[plan.index("Aggregate"):]
    assert "text#" not in aggregate.split("Generate")[0]
    long = spark.range(1).select(F.lit("train").alias("split"), F.col("id").alias("row_idx"), F.sequence(F.lit(1), F.lit(300_000)).alias("input_ids"))
    long = long.withColumn("attention_mask", F.transform("input_ids", lambda x: F.lit(1)))
    assert pack_blocks(long, 1000, 10).agg(F.sum(F.aggregate("input_ids", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()[0] == 300_000 * 300_001 // 2


def test_batch_total_exactly_one_block_and_huge_document(spark):
    df = tokenize(_rows(spark, [2, 2]))                       # 4 tokens, block 4: one full block
    assert [len(b[2]) for b in _blocks(pack_blocks(df, 4, 10))] == [4]
    lengths = [3, 5000, 2, 0, 7]                              # one document far above the block size
    df = _rows(spark, lengths)
    texts = [r.text for r in sorted(df.collect(), key=lambda r: r.row_idx)]
    expect = sorted(pack([ids(t) for t in texts], 64, 3))
    assert _blocks(pack_text_blocks(df, 64, 3)) == expect
    assert _blocks(pack_blocks(tokenize(df), 64, 3)) == expect


@pytest.mark.parametrize("with_validation", [False, True])
def test_files_one_shuffle_equals_two_shuffle(spark, tmpdir_path, with_validation):
    import os
    from corpusprep.plans.pretrain import pretrain_from_files
    rnd = random.Random(11)
    for split, n_files in (("train", 4), ("validation", 2)):
        for f in range(n_files):
            os.makedirs(f"{tmpdir_path}/{split}/d{f % 2}", exist_ok=True)
            lines = ["".join(chr(97 + rnd.randint(0, 25)) for _ in range(rnd.choice([0, 3, 9, 40]))) for _ in range(25)]
            with open(f"{tmpdir_path}/{split}/d{f % 2}/f{f}.txt", "w") as fh:
                fh.write("\n".join(lines) + "\n")
    val = f"{tmpdir_path}/validation" if with_validation else None
    kw = dict(block_size=16, rows_per_batch=7, percent=10)
    one = sorted((r.split, r.batch_id, r.block_no, tuple(r.input_ids))
                 for r in pretrain_from_files(spark, f"{tmpdir_path}/train", val, strategy="one_shuffle", **kw).collect())
    two = sorted((r.split, r.batch_id, r.block_no, tuple(r.input_ids))
                 for r in pretrain_from_files(spark, f"{tmpdir_path}/train", val, strategy="two_shuffle", **kw).collect())
    assert one == two and one


def test_one_shuffle_composite_key_many_buckets(spark):
    from corpusprep.operators.ordering import head_percent_split
    from corpusprep.operators.packing import pack_corpus_text
    rnd = random.Random(5)
    rows = [(a, b, "".join(chr(97 + rnd.randint(0, 25)) for _ in range(rnd.choice([0, 2, 7, 60]))))
            for a in range(6) for b in rnd.sample(range(1000), 15)]
    df = spark.createDataFrame(rows, "a long, b long, text string").repartition(4)
    key = F.col("a") * F.lit(1000) + F.col("b")
    ref = head_percent_split(df, ["a", "b"], 20, bucket_key=key).select("split", "row_idx", "text")
    expect = _blocks(pack_text_blocks(ref, 8, 4))
    got = _blocks(pack_corpus_text(df, ["a", "b"], 8, 4, percent=20, bucket_key=key, num_buckets=40))
    assert got == expect


def test_null_rows_carry_no_tokens(spark):
    data = [("train", 0, "abcdef"), ("train", 1, None), ("train", 2, "ghij")]
    df = spark.createDataFrame(data, "split string, row_idx long, text string")
    expect = sorted(pack([ids("abcdef"), [], ids("ghij")], 4, 10))
    assert _blocks(pack_text_blocks(df, 4, 10)) == expect
    assert _blocks(pack_blocks(tokenize(df), 4, 10)) == expect


@pytest.mark.parametrize("seed", range(3))
def test_one_shuffle_ids_equals_array_packing(spark, seed):
    from corpusprep.operators.ordering import head_percent_split
    from corpusprep.operators.packing import pack_corpus_ids
    rnd = random.Random(seed)
    rows = [(k, "".join(chr(97 + rnd.randint(0, 25)) for _ in range(rnd.choice([0, 1, 4, 30, 90]))))
            for k in rnd.sample(range(10_000), 60)]
    toks = tokenize(spark.createDataFrame(rows, "k long, text string").repartition(3), keep_text=False)
    ref = tokenize(head_percent_split(spark.createDataFrame(rows, "k long, text string"), ["k"], 10)
                   .select("split", "row_idx", "text"))
    expect = sorted((r.split, r.batch_id, r.block_no, tuple(r.input_ids), tuple(r.attention_mask))
                    for r in pack_blocks(ref, 16, 5).collect())
    got = sorted((r.split, r.batch_id, r.block_no, tuple(r.input_ids), tuple(r.attention_mask))
                 for r in pack_corpus_ids(toks, "k", 16, 5, percent=10, num_buckets=9).collect())
    assert got == expect


def test_one_shuffle_with_stored_lengths(spark):
    from corpusprep.operators.packing import pack_corpus_text
    rows = [(k, "ab" * (k % 9)) for k in range(50)]
    df = spark.createDataFrame(rows, "k long, text string").withColumn("n", F.length("text"))
    a = _blocks(pack_corpus_text(df, "k", 8, 4, percent=10, num_buckets=7))
    b = _blocks(pack_corpus_text(df, "k", 8, 4, percent=10, num_buckets=7, length_col="n"))
    assert a == b
    wrong = df.withColumn("n", F.col("n") + F.when(F.col("k") == 3, 1).otherwise(0))
    with pytest.raises(Exception):
        pack_corpus_text(wrong, "k", 8, 4, percent=10, num_buckets=7, length_col="n").collect()


def _whole(rows, block, keep_short=True):
    """Concatenate and cut each split: {(split, block_no): text}."""
    out = {}
    for split in {r[0] for r in rows}:
        text = "".join(r[3] or "" for r in sorted((r for r in rows if r[0] == split), key=lambda r: (r[1], r[2])))
        full = len(text) // block * block
        for i in range(0, full, block):
            out[(split, i // block)] = text[i: i + block]
        if not full and text and keep_short:
            out[(split, 0)] = text
    return out


@pytest.mark.parametrize("block,buckets,keep_short", [(7, 1, True), (7, 5, True), (64, 9, True), (5000, 4, True), (5000, 4, False), (1, 3, True)])
def test_pack_whole_splits(spark, block, buckets, keep_short):
    import random

    from pyspark.sql import functions as F

    from corpusprep.functions.tokens import codepoint_ids, ones_like
    from corpusprep.operators.packing import pack_whole_splits
    rng = random.Random(block + buckets)
    rows = [(rng.choice(["train", "train", "validation", "none"]), rng.choice("abc"), i,
             rng.choice([None, "", "x" * rng.randint(1, 40), "".join(rng.choices("uvwé😀", k=rng.choice([3, 9, 300])))])) for i in range(260)]
    rows += [("none", "d", 1000, None), ("tiny", "a", 1001, "ab")]
    df = spark.createDataFrame(rows, "split string, a string, i long, text string").repartition(4)
    want = {k: [ord(c) + 256 for c in t] for k, t in _whole(rows, block, keep_short).items()}

    def read(blocks):
        got = blocks.collect()
        assert len({(r.split, r.block_no) for r in got}) == len(got)
        assert all(r.labels == r.input_ids and len(r.attention_mask) == len(r.input_ids) for r in got)
        return {(r.split, r.block_no): r.input_ids for r in got}

    assert read(pack_whole_splits(df, ["a", "i"], block, num_buckets=buckets, keep_short=keep_short)) == want
    ids = df.select("split", "a", "i", codepoint_ids("text").alias("input_ids")).withColumn("attention_mask", ones_like("input_ids"))
    assert read(pack_whole_splits(ids, ["a", "i"], block, text_col=None, num_buckets=buckets, keep_short=keep_short)) == want
    by_number = {k: [ord(c) + 256 for c in t] for k, t in _whole([(s, "", i, t) for s, _, i, t in rows], block, keep_short).items()}
    assert read(pack_whole_splits(df, "i", block, num_buckets=buckets, keep_short=keep_short)) == by_number
    one = pack_whole_splits(df.where("split = 'train'").drop("split"), "i", block, split_col=None, num_buckets=buckets, keep_short=keep_short)
    assert {("train", r.block_no): r.input_ids for r in one.collect()} == {k: v for k, v in by_number.items() if k[0] == "train"}
    assert pack_whole_splits(df.where(F.lit(False)), "i", block).count() == 0


def test_pack_whole_splits_moves_text_once(spark):
    """One exchange carries whole texts; the second one only pieces of blocks that span ranges."""
    from corpusprep.operators.packing import pack_whole_splits
    df = spark.range(3000).selectExpr("id", "'train' AS split", "repeat('t', 50) AS text").checkpoint()
    blocks = pack_whole_splits(df, "id", 64, num_buckets=6)
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("block_no" in line and "__bucket" in line for line in moved) == 0  # blocks inside a range: no exchange of their own
    assert blocks.count() == 3000 * 50 // 64


def test_block_size_rules_in_the_plan(spark):
    from corpusprep.plans.pretrain import pretrain_blocks
    docs = spark.createDataFrame([(i, "abcdefghij") for i in range(40)], "doc_id long, text string")
    size = lambda **kw: {len(r.input_ids) for r in pretrain_blocks(docs, ["doc_id"], percent=0, **kw).collect()}
    assert size(block_size=None, model_max_length=25) == {25}
    with pytest.warns(UserWarning):
        assert size(block_size=50, model_max_length=20, scope="corpus") == {20}
    assert size(block_size=16, model_max_length=20) == {16}
    with pytest.raises(ValueError):
        size(scope="file")


def test_blocks_by_split_need_no_sort_of_wide_rows(spark):
    from corpusprep.plans.pretrain import pretrain_blocks
    docs = spark.createDataFrame([(i, f"{i} " * (i % 7)) for i in range(200)], "doc_id bigint, text string")
    plain = pretrain_blocks(docs, block_size=16, rows_per_batch=10, percent=40)
    sorted_blocks = pretrain_blocks(docs, block_size=16, rows_per_batch=10, percent=40, by_split=True)
    rows = lambda d: sorted(map(tuple, d.select("split", "batch_id", "block_no", "input_ids", "attention_mask", "labels").collect()))
    assert rows(sorted_blocks) == rows(plain)
    for splits in sorted_blocks.select("split").rdd.glom().collect():
        assert [r.split for r in splits] == sorted(r.split for r in splits)
    assert not sorted_blocks.schema["split"].nullable  # else the writer sorts again by its own form of the column


def test_whole_splits_by_strings_with_running_sums(spark):
    from corpusprep.operators.packing import pack_whole_splits
    docs = spark.createDataFrame([(f"s{i % 3}", i, [i] * (i % 9), "train" if i % 4 else "validation") for i in range(300)], "s string, i int, input_ids array<int>, split string")
    blocks = pack_whole_splits(docs, ["s", "i"], 16, text_col=None, columns=["input_ids"], num_buckets=6)
    for split in ("train", "validation"):
        stream = [t for _, i in sorted((f"s{i % 3}", i) for i in range(300) if (i % 4 > 0) == (split == "train")) for t in [i] * (i % 9)]
        got = [r.input_ids for r in blocks.where(blocks.split == split).orderBy("block_no").collect()]
        assert got == [stream[k: k + 16] for k in range(0, len(stream) // 16 * 16, 16)]
