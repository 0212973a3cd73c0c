import pytest
from pyspark.sql import types as T

from corpusprep.operators.instruct import format_instructions
from corpusprep.operators.ordering import row_index
from corpusprep.operators.packing import pack_text_blocks
from corpusprep.streaming.prepare import pack_stream, prepare_stream


def test_stream_equals_batch(spark, tmpdir_path):
    rows = [(i, f"question {i}", None if i % 3 else "ctx", "answer " * (i % 5)) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, instruction string, input string, output string")
    df.repartition(3).write.json(f"{tmpdir_path}/in")
    schema = T.StructType([T.StructField("id", T.LongType())] +
                          [T.StructField(c, T.StringType()) for c in ("instruction", "input", "output")])
    fmt = lambda d: format_instructions(d, max_source=20, max_target=20, keep=("id",))
    q = prepare_stream(spark, f"{tmpdir_path}/in", f"{tmpdir_path}/out", f"{tmpdir_path}/ck", fmt, schema)
    q.awaitTermination()
    got = sorted((r.id, r.input_ids, r.labels) for r in spark.read.parquet(f"{tmpdir_path}/out").collect())
    expect = sorted((r.id, r.input_ids, r.labels) for r in fmt(df).collect())
    assert got == expect and len(got) > 0


def test_pack_stream_per_micro_batch(spark, tmpdir_path):
    docs = spark.createDataFrame([(i, "x" * (i % 13)) for i in range(60)], "doc_id long, text string")
    docs.repartitionByRange(2, "doc_id").sortWithinPartitions("doc_id").select("text").write.json(f"{tmpdir_path}/in")
    q = pack_stream(spark, f"{tmpdir_path}/in", f"{tmpdir_path}/out", f"{tmpdir_path}/ck", block_size=8,
                    rows_per_batch=10)
    q.awaitTermination()
    got = sorted((r.batch_id, r.block_no, r.input_ids) for r in spark.read.parquet(f"{tmpdir_path}/out").collect())
    idx = row_index(docs, ["doc_id"])
    expect = sorted((r.batch_id, r.block_no, r.input_ids)
                    for r in pack_text_blocks(idx, 8, 10, split_col=None).collect())
    assert got == expect


def test_stream_nested_chat_and_transcripts(spark, tmpdir_path):
    import json
    import os

    from corpusprep.operators.chat import chat_examples_nested
    from corpusprep.operators.preference import split_transcripts
    from corpusprep.sources.files import CONVERSATION_SCHEMA, TRANSCRIPT_SCHEMA

    os.makedirs(f"{tmpdir_path}/chat", exist_ok=True)
    convs = [{"conversations": [{"from": "human", "value": "a" * i}, {"from": "gpt", "value": "b"}]} for i in range(5)]
    with open(f"{tmpdir_path}/chat/part-0.json", "w") as f:
        f.write("\n".join(json.dumps(c) for c in convs) + "\n")
    fmt = lambda d: chat_examples_nested(d, max_source=8, max_target=8)
    q = prepare_stream(spark, f"{tmpdir_path}/chat", f"{tmpdir_path}/chat_out", f"{tmpdir_path}/ck1", fmt,
                       CONVERSATION_SCHEMA)
    q.awaitTermination()
    got = sorted(r.input_ids for r in spark.read.parquet(f"{tmpdir_path}/chat_out").collect())
    expect = sorted(r.input_ids for r in fmt(spark.read.schema(CONVERSATION_SCHEMA).json(f"{tmpdir_path}/chat")).collect())
    assert got == expect and len(got) == 5

    os.makedirs(f"{tmpdir_path}/tr", exist_ok=True)
    with open(f"{tmpdir_path}/tr/part-0.json", "w") as f:
        f.write(json.dumps({"chosen": "\n\nHuman: q\n\nAssistant: x", "rejected": "\n\nHuman: q\n\nAssistant: y"}) + "\n")
    q = prepare_stream(spark, f"{tmpdir_path}/tr", f"{tmpdir_path}/tr_out", f"{tmpdir_path}/ck2",
                       split_transcripts, TRANSCRIPT_SCHEMA)
    q.awaitTermination()
    r = spark.read.parquet(f"{tmpdir_path}/tr_out").first()
    assert (r.chosen, r.rejected) == (" x", " y")


@pytest.mark.parametrize("strategy", ["two_shuffle", "one_shuffle"])
def test_pack_stream_each_micro_batch_on_its_own(spark, tmpdir_path, strategy):
    import json
    import os

    from model import ids, pack
    os.makedirs(f"{tmpdir_path}/in", exist_ok=True)
    files = {}
    for f in range(3):
        texts = ["abcdefghij"[: (f + i) % 10] for i in range(7)]
        files[f] = texts
        with open(f"{tmpdir_path}/in/part-{f}.json", "w") as fh:
            fh.write("\n".join(json.dumps({"text": t}) for t in texts) + "\n")
    q = pack_stream(spark, f"{tmpdir_path}/in", f"{tmpdir_path}/out", f"{tmpdir_path}/ck", block_size=6,
                    rows_per_batch=3, max_files_per_trigger=1, strategy=strategy)
    q.awaitTermination()
    got = {}
    for r in spark.read.parquet(f"{tmpdir_path}/out").collect():
        got.setdefault(r.stream_batch, []).append((r.batch_id, r.block_no, list(r.input_ids)))
    assert len(got) == 3
    expect = sorted(sorted(pack([ids(t) for t in texts], 6, 3)) for texts in files.values())
    assert sorted(sorted(v) for v in got.values()) == expect


def test_stream_restart_processes_only_new_files(spark, tmpdir_path):
    import json
    import os
    os.makedirs(f"{tmpdir_path}/in", exist_ok=True)
    schema = T.StructType([T.StructField("id", T.LongType())] +
                          [T.StructField(c, T.StringType()) for c in ("instruction", "input", "output")])
    fmt = lambda d: format_instructions(d, max_source=50, max_target=50, keep=("id",))

    def add(name, ids):
        with open(f"{tmpdir_path}/in/{name}.json", "w") as f:
            f.write("\n".join(json.dumps({"id": i, "instruction": f"q{i}", "input": None, "output": f"a{i}"})
                              for i in ids) + "\n")

    def run():
        q = prepare_stream(spark, f"{tmpdir_path}/in", f"{tmpdir_path}/out", f"{tmpdir_path}/ck", fmt, schema)
        q.awaitTermination()
        return sorted(r.id for r in spark.read.parquet(f"{tmpdir_path}/out").collect())

    add("first", range(5))
    assert run() == list(range(5))
    add("second", range(5, 8))
    assert run() == list(range(8))      # the first file is not read again: no duplicates


def test_pack_stream_restart_adds_a_batch_folder(spark, tmpdir_path):
    import json
    import os
    os.makedirs(f"{tmpdir_path}/in", exist_ok=True)

    def add(name, texts):
        with open(f"{tmpdir_path}/in/{name}.json", "w") as f:
            f.write("\n".join(json.dumps({"text": t}) for t in texts) + "\n")

    def run():
        q = pack_stream(spark, f"{tmpdir_path}/in", f"{tmpdir_path}/out", f"{tmpdir_path}/ck", block_size=4,
                        rows_per_batch=2)
        q.awaitTermination()
        return sorted({r.stream_batch for r in spark.read.parquet(f"{tmpdir_path}/out").collect()})

    add("a", ["abcdef", "gh"])
    assert run() == [0]
    add("b", ["ijklmnop"])
    assert run() == [0, 1]


NUMBERED = T.StructType([T.StructField("split", T.StringType()), T.StructField("row_idx", T.LongType()), T.StructField("text", T.StringType())])


def _numbered_rows():
    import random
    rng = random.Random(21)
    rows = [(s, i, rng.choice([None, "", "ab", "é😀x" * rng.randint(1, 6)])) for s, n in (("train", 137), ("validation", 23)) for i in range(n)]
    rows += [("sparse", i, "q" if i == 3 else "") for i in range(20)]
    return rows


def _numbered_files(path, rows, files, order):
    """Rows dealt over files that arrive in the given order, whatever their numbers."""
    import json
    import os
    os.makedirs(path, exist_ok=True)
    for k, f in enumerate(order):
        name = f"{path}/f{f:02d}.json"
        with open(name, "w") as out:
            out.write("\n".join(json.dumps({"split": s, "row_idx": i, "text": t}) for s, i, t in rows[f::files]) + "\n")
        os.utime(name, (1_700_000_000 + 10 * k, 1_700_000_000 + 10 * k))


def _numbered_expected(spark, rows, block, per_batch):
    df = spark.createDataFrame(rows, NUMBERED)
    return sorted((r.split, r.batch_id, r.block_no, r.input_ids) for r in pack_text_blocks(df, block, per_batch).collect())


def _numbered_got(spark, out, checkpoint, block):
    from corpusprep.streaming.prepare import open_batches
    blocks = spark.read.parquet(out).select("split", "batch_id", "block_no", "input_ids").collect()
    late = open_batches(spark, checkpoint, block, split_col="split")
    assert late.agg({"n_early": "max"}).first()[0] in (0, None)
    short = late.where("input_ids IS NOT NULL").select("split", "batch_id", "block_no", "input_ids").collect()
    return sorted((r.split, r.batch_id, r.block_no, r.input_ids) for r in blocks + short)


@pytest.mark.parametrize("per_trigger,order", [(1, [3, 0, 5, 1, 4, 2]), (3, [0, 1, 2, 3, 4, 5]), (None, [5, 4, 3, 2, 1, 0])])
def test_numbered_stream_does_not_depend_on_arrival(spark, tmpdir_path, per_trigger, order):
    from corpusprep.streaming.prepare import pack_numbered_stream
    rows = _numbered_rows()
    _numbered_files(f"{tmpdir_path}/in", rows, 6, order)
    q = pack_numbered_stream(spark, f"{tmpdir_path}/in", f"{tmpdir_path}/out", f"{tmpdir_path}/ck", block_size=16, rows_per_batch=10,
                             schema=NUMBERED, split_col="split", max_files_per_trigger=per_trigger)
    q.awaitTermination()
    assert _numbered_got(spark, f"{tmpdir_path}/out", f"{tmpdir_path}/ck", 16) == _numbered_expected(spark, rows, 16, 10)


def test_numbered_stream_goes_on_after_a_restart(spark, tmpdir_path):
    """The second run finds the open batches in the checkpoint; rows that come again change nothing."""
    from corpusprep.streaming.prepare import open_batches, pack_numbered_stream
    rows = _numbered_rows()

    def run():
        q = pack_numbered_stream(spark, f"{tmpdir_path}/in", f"{tmpdir_path}/out", f"{tmpdir_path}/ck", block_size=16, rows_per_batch=50,
                                 schema=NUMBERED, split_col="split")
        q.awaitTermination()

    _numbered_files(f"{tmpdir_path}/in", rows, 4, [2, 0])
    run()
    held = open_batches(spark, f"{tmpdir_path}/ck", 16, split_col="split").collect()
    assert sum(r.n_early for r in held) > 0 and all(r.n_left < 16 for r in held)
    _numbered_files(f"{tmpdir_path}/in", rows, 4, [0, 3, 1])
    run()
    assert _numbered_got(spark, f"{tmpdir_path}/out", f"{tmpdir_path}/ck", 16) == _numbered_expected(spark, rows, 16, 50)


def test_open_batch_keeps_less_than_a_block():
    from corpusprep.streaming.prepare import OpenBatch
    batch = OpenBatch(5)
    assert batch.add([(1, "bbb"), (3, None)]) == [] and batch.state()[:3] == (0, 0, "")
    assert batch.add([(0, "aaaa")]) == [(0, "aaaab")] and batch.rest == "bb"
    assert batch.add([(0, "again"), (2, "cccccccc")]) == [(1, "bbccc"), (2, "ccccc")] and batch.taken == 4
    assert batch.close(True) == [] and OpenBatch(5, 1, 0, "x").close(True) == [(0, "x")] and OpenBatch(5, 1, 0, "x").close(False) == []
