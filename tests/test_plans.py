"""Physical plan checks: exchanges, pruning, no Python in the native paths, bounded windows."""

import contextlib
import io
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from corpusprep.operators.chat import chat_examples
from corpusprep.operators.instruct import format_instructions
from corpusprep.operators.ordering import row_index
from corpusprep.operators.packing import pack_text_blocks
from model import chat

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


PY_NODES = re.compile(r"EvalPython|MapInPandas|InPandas|PythonUDF|MapInArrow")


def tree(text: str) -> str:
    return text.split("\n\n")[0]


def test_packing_uses_one_exchange(spark):
    df = spark.createDataFrame([("train", i, "abc" * i) for i in range(50)], "split string, row_idx long, text string")
    p = tree(plan(pack_text_blocks(df, 16, 7)))
    assert p.count("Exchange") == 1, p
    assert "ObjectHashAggregate" in p
    assert not PY_NODES.search(p)


def test_formatting_is_map_side_and_native(spark):
    df = spark.createDataFrame([("a", None, "b")], "instruction string, input string, output string")
    p = plan(format_instructions(df))
    assert "Exchange" not in tree(p)
    assert not PY_NODES.search(p)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_flagship_scan_is_pruned(spark):
    import __spark_entry__ as m
    p = plan(m.queries()["pack_blocks"](spark, SF))
    schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", p))
    assert schemas <= {"struct<doc_id:bigint,text:string>", "struct<doc_id:bigint>"}, schemas
    assert not PY_NODES.search(p)
    # exactly two exchanges move the text (bucket for the row index, batch for packing);
    # the others carry one row per bucket
    blocks = [b for b in p.split("\n\n") if re.match(r"\(\d+\) Exchange", b.strip())]
    assert len([b for b in blocks if "text#" in b.split("Arguments")[0]]) == 2, blocks


def test_hot_conversation_is_split_across_chunks(spark):
    rnd = random.Random(3)
    rows, convs = [], {}
    for c in range(40):
        n = 3000 if c == 7 else rnd.randint(1, 5)           # one conversation holds most rows
        convs[c] = []
        for t in range(n):
            frm = "human" if t % 2 == 0 else "gpt"
            v = "x" * rnd.randint(0, 3)
            rows.append((c, t, frm, v))
            convs[c].append((frm, v))
    msgs = spark.createDataFrame(rows, "conv_id long, turn long, from string, value string").repartition(6)
    out = chat_examples(msgs, max_source=64, max_target=64, chunk_size=64, drop_all_masked=False)
    p = plan(out)
    windows = re.findall(r"windowspecdefinition\(([^,]+),", p)
    assert windows and all("conv_id" in w for w in windows)
    assert "__chunk" in p                                   # message windows are per (conv, chunk)
    got = {r.conv_id: (r.input_ids, r.labels) for r in out.collect()}
    for c, m in convs.items():
        i, lab, _ = chat(m, 64, 64)
        assert got[c] == (i, lab)


def test_row_index_plan_has_no_single_partition_window_over_rows(spark):
    df = spark.range(1000).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 2)
    p = plan(row_index(df, ["k"], num_buckets=8))
    # the only window without a partition key runs over the per-bucket counts
    assert "SinglePartition" not in tree(p) or "HashAggregate" in p
    assert "hashpartitioning(knownfloatingpointnormalized(normalizenanandzero(__bucket" in p


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_one_shuffle_flagship_moves_text_once(spark):
    import __spark_entry__ as m
    p = plan(m.queries()["pack_blocks_one_shuffle"](spark, SF))
    blocks = [b for b in p.split("\n\n") if re.match(r"\(\d+\) Exchange", b.strip())]
    assert len([b for b in blocks if "__p0#" in b.split("Arguments")[0]]) == 1, blocks
    assert not PY_NODES.search(p)


def test_sft_moves_text_once(spark):
    from corpusprep.plans.sft import prepare_instructions
    tr = spark.createDataFrame([(i, f"q{i}", None, f"a{i}") for i in range(100)],
                               "k long, instruction string, input string, output string")
    ex, _ = prepare_instructions(tr, ["k"], seed=1, keep=("k",))
    p = plan(ex)
    nodes = [b for b in p.split("\n\n") if re.match(r"\(\d+\) Exchange", b.strip())]
    texty = [b for b in nodes if re.search(r"(instruction|output)#", b.split("Arguments")[0])]
    assert len(texty) == 1, texty


def test_collate_batches_moves_rows_once(spark):
    from corpusprep.operators.batching import collate_batches
    df = spark.createDataFrame([(i, [1] * (i % 3 + 1), i % 2) for i in range(120)], "doc_id long, input_ids array<int>, label int")
    p = plan(collate_batches(df, 8, 42, "doc_id", on_ragged="repeat_first"))
    assert len([b for b in p.split("\n\n") if re.match(r"\(\d+\) Exchange", b.strip())]) == 1


def test_hot_run_log_is_split_across_chunks(spark):
    from corpusprep.operators.runlog import running_train_loss
    rows = []
    for run, n in (("hot", 3000), ("a", 7), ("b", 40)):
        for step in range(n):
            rows.append((run, step // 100, step, float(step % 13), (step + 1) % 4 == 0))
    log = spark.createDataFrame(rows, "run string, epoch int, micro_step long, loss double, sync boolean").repartition(5)
    out = running_train_loss(log, chunk_size=128)
    p = plan(out)
    assert "__chunk" in p
    got = {(r.run, r.micro_step): (r.completed_steps, r.epoch_loss_sum) for r in out.collect()}
    for run in ("hot", "a", "b"):
        steps = sorted((s, e, l, y) for rr, e, s, l, y in rows if rr == run)
        cs, acc, epoch = 0, 0.0, None
        for s, e, l, y in steps:
            if e != epoch:
                acc, epoch = 0.0, e
            cs += int(y)
            acc += l
            assert got[(run, s)] == (cs, acc)


def test_files_are_written_in_ranges_that_spark_sizes(spark):
    from corpusprep.plans.catalog import _by_id
    docs = spark.range(5000).selectExpr("(id * 7919) % 5000 AS doc_id")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for given, files in ((12, 12), (1200, 1000)):  # not four, whatever the size
            spark.conf.set("spark.sql.shuffle.partitions", str(given))
            parts = _by_id(docs).rdd.glom().map(lambda p: [r.doc_id for r in p]).collect()
            assert len(parts) == files and [i for p in parts for i in p] == list(range(5000))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
