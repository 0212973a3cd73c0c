import random

import pytest
from pyspark.sql import functions as F

from corpusprep.operators.batching import (
    assign_batches,
    collate,
    epoch_plan,
    epoch_plan_local,
    pad_to_longest,
    skip_batches,
)


def test_epoch_plan_fixture(spark):
    df = spark.range(10).withColumn("split", F.lit("train"))
    r = epoch_plan(df, 4, accumulation=2, epochs=2).first()
    assert (r.batches, r.updates_per_epoch, r.total_updates, r.total_batch_size) == (3, 2, 4, 8)
    assert epoch_plan_local(10, 4, 2, 2) == {"batches": 3, "updates_per_epoch": 2, "total_updates": 4}
    assert epoch_plan(df, 4, accumulation=2, epochs=2, max_steps=3).first().total_updates == 3


def test_batches_do_not_depend_on_partitioning(spark):
    df = spark.range(103).withColumnRenamed("id", "doc_id")
    a = {r.doc_id: (r.batch_no, r.pos) for r in assign_batches(df, 8, 42, "doc_id").collect()}
    b = {r.doc_id: (r.batch_no, r.pos) for r in assign_batches(df.repartition(11), 8, 42, "doc_id").collect()}
    assert a == b
    sizes = {}
    for bn, _ in a.values():
        sizes[bn] = sizes.get(bn, 0) + 1
    assert sorted(sizes.values()) == [7] + [8] * 12      # the last batch is short
    assert skip_batches(assign_batches(df, 8, 42, "doc_id"), 10).count() == 103 - 80


SCHEMA = "batch_no long, pos long, input_ids array<int>, label int, name string, extra array<int>"


def test_collate_fallback_labels_and_strings(spark):
    rows = [(0, 0, [1, 2], 1, "a", None), (0, 1, [3], 0, "b", [9]),       # ragged -> first row
            (1, 0, [5, 6], None, "c", [1]), (1, 1, [7, 8], 1, "d", [2])]   # first label NULL -> no labels
    c = {(r.batch_no, r.pos): r for r in collate(spark.createDataFrame(rows, SCHEMA), on_ragged="repeat_first").collect()}
    assert c[(0, 1)].input_ids == [1, 2] and c[(0, 1)].fell_back
    assert c[(0, 1)].labels == 0                      # labels are not replaced
    assert c[(0, 0)].extra is None and c[(0, 1)].extra is None   # NULL in the first row: dropped
    assert c[(1, 1)].input_ids == [7, 8] and not c[(1, 1)].fell_back
    assert c[(1, 0)].labels is None and c[(1, 1)].labels is None
    assert "name" not in collate(spark.createDataFrame(rows, SCHEMA), on_ragged="repeat_first").columns
    with pytest.raises(Exception):  # the default refuses to repeat rows of a ragged batch
        collate(spark.createDataFrame(rows, SCHEMA)).collect()


def test_collate_pad_and_pad_to_longest(spark):
    rows = [(0, 0, [1, 2, 3], 1, "a", [1]), (0, 1, [4], 0, "b", [2])]
    df = spark.createDataFrame(rows, SCHEMA)
    p = {r.pos: r.input_ids for r in collate(df, on_ragged="pad").collect()}
    assert p == {0: [1, 2, 3], 1: [4, 0, 0]}
    ex = df.select("batch_no", "pos", "input_ids", F.col("input_ids").alias("labels"))
    q = {r.pos: (r.input_ids, r.labels) for r in pad_to_longest(ex).collect()}
    assert q[1] == ([4, 0, 0], [4, -100, -100])



@pytest.mark.parametrize("bs,nbk,split", [(8, 20, False), (3, 50, False), (5, 4, True), (64, 10, False)])
def test_collate_batches_equals_two_steps(spark, bs, nbk, split):
    from corpusprep.operators.batching import collate_batches
    rnd = random.Random(bs)
    rows = [(i, [1] * rnd.choice([1, 2, 2, 3]), rnd.choice([0, 1, None]), "a" if i % 3 else "b") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, input_ids array<int>, label int, split string").repartition(3)
    if not split:
        df = df.drop("split")
    split_col = "split" if split else None
    ref = collate(assign_batches(df, bs, 42, "doc_id", split_col=split_col),
                  batch_cols=(("split",) if split else ()) + ("batch_no",), on_ragged="repeat_first")
    cols = ref.columns
    a = sorted(tuple(str(x) for x in r) for r in ref.select(*cols).collect())
    b = sorted(tuple(str(x) for x in r)
               for r in collate_batches(df, bs, 42, "doc_id", split_col=split_col, num_buckets=nbk,
                                        on_ragged="repeat_first").select(*cols).collect())
    assert a == b


@pytest.mark.parametrize("bs,split,on_ragged", [(8, False, "repeat_first"), (3, True, "repeat_first"), (5, True, "pad"), (64, False, "pad")])
def test_collate_by_id_equals_two_steps(spark, bs, split, on_ragged):
    """The same with lengths given and ids derived from a text after the rows have moved."""
    from corpusprep.functions.tokens import codepoint_ids
    from corpusprep.operators.batching import collate_batches, collate_by_id
    rnd = random.Random(bs)
    rows = [(i, "x" * rnd.choice([1, 2, 2, 3]), rnd.choice([0, 1, None]), rnd.choice([None, "a", "b"])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int, split string").repartition(3)
    df = df if split else df.drop("split")
    split_col = "split" if split else None
    ids = {"input_ids": codepoint_ids("text")}
    whole = df.withColumns(ids)
    ref = collate(assign_batches(whole, bs, 42, "doc_id", split_col=split_col),
                  batch_cols=(("split",) if split else ()) + ("batch_no",), on_ragged=on_ragged)
    show = lambda d: sorted(tuple(str(x) for x in r) for r in d.select(*ref.columns).collect())
    want = show(ref)
    assert show(collate_by_id(whole, bs, 42, "doc_id", split_col=split_col, on_ragged=on_ragged)) == want
    moved = df.withColumn("n", F.length("text"))
    got = collate_by_id(moved, bs, 42, "doc_id", split_col=split_col, on_ragged=on_ragged, lengths={"input_ids": "n"}, derived=ids)
    assert show(got) == want
    if not split:
        assert show(collate_batches(whole, bs, 42, "doc_id", on_ragged=on_ragged)) == want
