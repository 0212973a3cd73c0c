"""3.1(b): a tokenizer model file applied by mapInPandas equals the same model in one process."""

import os

import pytest
from pyspark.sql import functions as F

from corpusprep.operators.packing import pack_blocks
from corpusprep.operators.tokenizing import ModelTokenizer, tokenize

tokenizers = pytest.importorskip("tokenizers")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model_path(tmp_path_factory):
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers
    tok = Tokenizer(models.BPE(unk_token="<unk>"))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    trainer = trainers.BpeTrainer(vocab_size=300, special_tokens=["<pad>", "<unk>", "</s>"])
    tok.train_from_iterator(["the quick brown fox", "jumps over the lazy dog", "éèê ça"], trainer)
    path = str(tmp_path_factory.mktemp("tok") / "tokenizer.json")
    tok.save(path)
    return path


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_parity_with_one_process(spark, model_path):
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").repartition(5)
    spec = ModelTokenizer(model_path).ship(spark)
    got = {r.doc_id: r.input_ids for r in tokenize(docs, "text", tokenizer=spec).collect()}
    local = Tokenizer.from_file(model_path)
    rows = docs.collect()
    expect = {r.doc_id: e.ids for r, e in zip(rows, local.encode_batch([r.text for r in rows]))}
    assert got == expect


def test_model_tokens_pack(spark, model_path):
    df = spark.createDataFrame([("train", i, "the quick brown fox " * (i + 1)) for i in range(6)] + [("train", 6, None)],
                               "split string, row_idx long, text string")
    toks = tokenize(df, "text", tokenizer=ModelTokenizer(model_path))
    assert toks.where(F.col("input_ids").isNull()).count() == 1
    blocks = pack_blocks(toks.where(F.col("input_ids").isNotNull()), 8, 3).collect()
    assert all(len(b.input_ids) <= 8 for b in blocks) and blocks


def _local(model_path):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(model_path)


def test_instructions_with_model(spark, model_path):
    from corpusprep.operators.instruct import format_instructions
    tok = _local(model_path)
    rows = [(1, "the quick", "brown", "fox jumps"), (2, "the lazy dog", None, "over")]
    df = spark.createDataFrame(rows, "id long, instruction string, input string, output string")
    got = {r.id: (r.input_ids, r.labels) for r in format_instructions(
        df, keep=("id",), tokenizer=ModelTokenizer(model_path), max_source=50, max_target=50).collect()}
    for rid, ins, inp, out in rows:
        src = ins + "\n" + inp if inp else ins
        s = tok.encode(src).ids
        t = tok.encode(out, add_special_tokens=False).ids + [2]
        assert got[rid] == ([195] + s + [196] + t, [2] + [-100] * (len(s) + 1) + t)


def test_chats_with_model_long_and_nested(spark, model_path):
    from corpusprep.operators.chat import chat_examples, chat_examples_nested
    tok = _local(model_path)
    conv = [("human", "the quick brown"), ("gpt", "fox"), ("human", "jumps over")]
    msgs = spark.createDataFrame([(1, t, f, v) for t, (f, v) in enumerate(conv)],
                                 "conv_id long, turn long, from string, value string")
    nested = spark.createDataFrame([(1, conv)], "conv_id long, conversations array<struct<from:string,value:string>>")
    i, lab = [], []
    for f, v in conv:
        ids = tok.encode(v).ids
        i += ([195] if f == "human" else [196]) + ids
        lab += ([2] + [-100] * len(ids)) if f == "human" else ([-100] + ids)
    i, lab = (i + [2])[:12], (lab + [2])[:12]
    i += [0] * (12 - len(i))
    lab += [-100] * (12 - len(lab))
    a = chat_examples(msgs, max_source=12, max_target=12, tokenizer=ModelTokenizer(model_path)).first()
    b = chat_examples_nested(nested, max_source=12, max_target=12, tokenizer=ModelTokenizer(model_path),
                             keep=("conv_id",)).first()
    assert (a.input_ids, a.labels) == (i, lab) == (b.input_ids, b.labels)


def test_decode_with_model(spark, model_path):
    from corpusprep.operators.tokenizing import decode_model_ids
    tok = _local(model_path)
    ids = tok.encode("the quick brown fox").ids
    df = spark.createDataFrame([(ids,), (None,)], "ids array<int>")
    got = [r.text for r in decode_model_ids(df, "ids", "text", ModelTokenizer(model_path)).collect()]
    assert got == [tok.decode(ids, skip_special_tokens=False), None]


def test_pretrain_model_tokens_one_shuffle_via_store(spark, model_path, tmp_path):
    from corpusprep.plans.pretrain import pretrain_blocks
    docs = spark.createDataFrame([(i, "the quick brown fox " * (i % 5 + 1)) for i in range(30)], "doc_id long, text string")
    tok = ModelTokenizer(model_path)
    kw = dict(block_size=8, rows_per_batch=4, percent=10, tokenizer=tok)
    a = sorted((r.split, r.batch_id, r.block_no, tuple(r.input_ids))
               for r in pretrain_blocks(docs, ["doc_id"], strategy="two_shuffle", **kw).collect())
    b = sorted((r.split, r.batch_id, r.block_no, tuple(r.input_ids))
               for r in pretrain_blocks(docs, ["doc_id"], strategy="one_shuffle", token_store=str(tmp_path / "tok"),
                                        **kw).collect())
    assert a == b and a
