"""End-to-end plans on literal fixtures: given validation tables, limits, sanity mode."""


from corpusprep.plans.preference import prepare_pairs, prepare_transcripts
from corpusprep.plans.pretrain import pretrain_blocks
from corpusprep.plans.sft import prepare_instructions
from model import ids, instruction, pack

TRIPLES = "k long, instruction string, input string, output string"


def test_sft_with_validation_table_and_limits(spark):
    train = spark.createDataFrame([(i, f"q{i}", None, f"a{i}") for i in range(20)], TRIPLES)
    val = spark.createDataFrame([(100 + i, f"v{i}", "ctx", f"b{i}") for i in range(5)], TRIPLES)
    ex, counts = prepare_instructions(train, ["k"], validation=val, max_train_samples=8, max_eval_samples=3,
                                      seed=7, keep=("k",), max_source=64, max_target=64)
    rows = ex.collect()
    assert {r.split for r in rows} == {"train", "validation"}
    assert {r.k for r in rows if r.split == "train"} == set(range(8))
    assert sorted(r.position for r in rows if r.split == "train") == list(range(8))
    assert [r.k for r in sorted((r for r in rows if r.split == "validation"), key=lambda r: r.position)] == [100, 101, 102]
    assert {r.split: r.samples for r in counts.collect()} == {"train": 8, "validation": 3}
    r0 = next(r for r in rows if r.k == 3)
    assert (r0.input_ids, r0.labels) == instruction("q3", None, "a3", 64, 64)


def test_pairs_sanity_and_eval_filter(spark):
    rows = [(i, "p" * i, "c", "r" * (i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, prompt string, chosen string, rejected string")
    out = prepare_pairs(df, df, order_by=["k"], sanity=True, max_length=60, keep=("k",))
    train = [r.k for r in out.where("split = 'train'").collect()]
    limit = 60 - len("<reserved_106><reserved_107>")
    assert sorted(train) == [k for k in range(200) if k + max(1, k % 7) <= limit]
    unfiltered = prepare_pairs(df, df, order_by=["k"], sanity=True, max_length=60, filter_eval=False, keep=("k",))
    assert unfiltered.where("split = 'validation'").count() == 200


def test_transcripts_sanity(spark):
    rows = [(i, f"\n\nHuman: q{i}\n\nAssistant: a{i}", f"\n\nHuman: q{i}\n\nAssistant: b{i}") for i in range(1100)]
    df = spark.createDataFrame(rows, "k long, chosen string, rejected string")
    out = prepare_transcripts(df, order_by=["k"], sanity=True, keep=("k",))
    assert out.count() == 1000 and out.where("k >= 1000").count() == 0


def test_pretrain_with_validation_table_and_model_path(spark):
    docs = spark.createDataFrame([(i, "x" * (i * 7 % 23)) for i in range(40)], "doc_id long, text string")
    val = spark.createDataFrame([(1000 + i, "y" * 9) for i in range(4)], "doc_id long, text string")
    got = sorted((r.split, r.batch_id, r.block_no, tuple(r.input_ids))
                 for r in pretrain_blocks(docs, ["doc_id"], validation=val, block_size=16, rows_per_batch=5).collect())
    texts = [t for _, t in sorted((r.doc_id, r.text) for r in docs.collect())]
    expect = [("train", b, k, tuple(t)) for b, k, t in pack([ids(t) for t in texts], 16, 5)]
    expect += [("validation", b, k, tuple(t)) for b, k, t in pack([ids("y" * 9)] * 4, 16, 5)]
    assert got == sorted(expect)


def test_chats_from_files(spark, tmpdir_path):
    import json
    import os

    from corpusprep.plans.sft import chats_from_files
    from model import chat
    os.makedirs(f"{tmpdir_path}/chats/sub", exist_ok=True)
    convs = [[{"from": "human", "value": "q" * i}, {"from": "gpt", "value": "a" * (i % 3)}] for i in range(30)]
    with open(f"{tmpdir_path}/chats/a.jsonl", "w") as f:
        f.write("\n".join(json.dumps({"conversations": c, "extra": i}) for i, c in enumerate(convs[:20])) + "\n")
    with open(f"{tmpdir_path}/chats/sub/b.jsonl", "w") as f:
        f.write("\n".join(json.dumps({"conversations": c}) for c in convs[20:]) + "\n")
    out = chats_from_files(spark, f"{tmpdir_path}/chats", percent=10, max_source=16, max_target=16,
                           drop_all_masked=False)
    rows = out.collect()
    val = sorted((r.position, r.input_ids) for r in rows if r.split == "validation")
    assert [i for _, i in val] == [chat([(m["from"], m["value"]) for m in c], 16, 16)[0] for c in convs[:3]]
    assert sum(1 for r in rows if r.split == "train") == 27


def test_pairs_from_csv_sanity_in_file_order(spark, tmpdir_path):
    from corpusprep.plans.preference import pairs_from_csv
    lines = ["prompt,chosen,rejected"] + [f'"p{i}\nx","c{i}","r{i}"' for i in range(250)]
    with open(f"{tmpdir_path}/train.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    out = pairs_from_csv(spark, f"{tmpdir_path}/train.csv", sanity=True, max_length=4096).collect()
    prompts = sorted(int(r.prompt[len("<reserved_106>p"):].split("\n")[0]) for r in out)
    assert prompts == list(range(200))


def test_pretrain_one_shuffle_with_validation_table(spark):
    docs = spark.createDataFrame([(i, "x" * (i * 7 % 23)) for i in range(40)], "doc_id long, text string")
    val = spark.createDataFrame([(1000 + i, "y" * (i + 5)) for i in range(6)], "doc_id long, text string")
    kw = dict(validation=val, block_size=16, rows_per_batch=5)
    a = sorted((r.split, r.batch_id, r.block_no, tuple(r.input_ids))
               for r in pretrain_blocks(docs, ["doc_id"], strategy="two_shuffle", **kw).collect())
    b = sorted((r.split, r.batch_id, r.block_no, tuple(r.input_ids))
               for r in pretrain_blocks(docs, ["doc_id"], strategy="one_shuffle", **kw).collect())
    assert a == b and a


def test_pretrain_one_shuffle_with_stored_lengths(spark):
    docs = spark.createDataFrame([(i, "x" * (i * 7 % 23)) for i in range(40)], "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "text", "length(text) AS n_chars")
    a = sorted((r.split, r.batch_id, r.block_no, tuple(r.input_ids))
               for r in pretrain_blocks(docs, ["doc_id"], block_size=16, rows_per_batch=5, strategy="two_shuffle").collect())
    b = sorted((r.split, r.batch_id, r.block_no, tuple(r.input_ids))
               for r in pretrain_blocks(docs, ["doc_id"], block_size=16, rows_per_batch=5, strategy="one_shuffle",
                                        length_col="n_chars").collect())
    assert a == b and a
