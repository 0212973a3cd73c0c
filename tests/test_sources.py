import json
import os

import pytest
from pyspark.sql import functions as F

from corpusprep.operators.ordering import row_index
from corpusprep.sources.files import (
    check_one_type,
    discover_files,
    read_corpus,
    read_split,
)
from corpusprep.sources.sinks import write_prepared, write_summary


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_text_corpus_lines(spark, tmpdir_path):
    _write(f"{tmpdir_path}/train/a.txt", "one\n\nthree\n")
    _write(f"{tmpdir_path}/train/nested/b.txt", "four\nfive")        # no final newline
    _write(f"{tmpdir_path}/train/c.TXT", "ignored\n")                # suffix is case-sensitive
    files = discover_files(spark, f"{tmpdir_path}/train")
    assert [os.path.basename(p) for p in files] == ["a.txt", "b.txt"]
    assert discover_files(spark, f"{tmpdir_path}/missing") is None
    parts = read_corpus(spark, f"{tmpdir_path}/train", f"{tmpdir_path}/missing")
    assert list(parts) == ["train"]
    rows = row_index(parts["train"], ["file_rank", "file_block", "file_row"], bucket_key=F.col("file_pos"))
    got = [r.text for r in rows.orderBy("row_idx").collect()]
    assert got == ["one\n", "\n", "three\n", "four\n", "five\n"]


def test_mixed_types_raise(spark, tmpdir_path):
    _write(f"{tmpdir_path}/train/a.json", json.dumps({"text": "x"}) + "\n")
    _write(f"{tmpdir_path}/train/b.jsonl", json.dumps({"text": "y"}) + "\n")
    with pytest.raises(ValueError):
        read_corpus(spark, f"{tmpdir_path}/train")
    assert check_one_type({"train": ["a.txt"], "validation": ["b.json"]}, raise_error=False) == \
        {"train": ["txt"], "validation": ["json"]}
    with pytest.raises(ValueError):
        check_one_type({"train": ["a.txt"], "validation": ["b.json"]})


def test_json_lines_extra_columns_and_unicode(spark, tmpdir_path):
    lines = [{"text": "héllo", "extra": 1}, {"text": ""}, {"text": "𝄞 beyond the BMP"}]
    _write(f"{tmpdir_path}/train/x.jsonl", "\n".join(json.dumps(l, ensure_ascii=False) for l in lines) + "\n")
    parts = read_corpus(spark, f"{tmpdir_path}/train")
    rows = row_index(parts["train"], ["file_rank", "file_block", "file_row"], bucket_key=F.col("file_pos"))
    assert [r.text for r in rows.orderBy("row_idx").collect()] == [l["text"] for l in lines]


def test_write_prepared_reuse_and_read_split(spark, tmpdir_path):
    df = spark.createDataFrame([("train", 1), ("validation", 2)], "split string, v int")
    out = f"{tmpdir_path}/prepared"
    _, reused = write_prepared(df, out, params={"a": 1})
    assert not reused
    _, reused = write_prepared(df, out, params={"a": 1})
    assert reused
    _, reused = write_prepared(df, out, params={"a": 2})
    assert not reused
    assert [r.v for r in read_split(spark, out, "validation").collect()] == [2]
    write_summary(spark.createDataFrame([(1.5,)], "perplexity double"), f"{tmpdir_path}/summary")
    assert spark.read.json(f"{tmpdir_path}/summary").first().perplexity == 1.5


def test_json_array_files(spark, tmpdir_path):
    docs = [{"text": f"doc {i}", "meta": {"n": i}} for i in range(5)]
    _write(f"{tmpdir_path}/train/a.json", json.dumps(docs[:3], indent=2))
    _write(f"{tmpdir_path}/train/b.json", json.dumps(docs[3:], indent=2))
    parts = read_corpus(spark, f"{tmpdir_path}/train", json_multiline=True)
    rows = row_index(parts["train"], ["file_rank", "file_block", "file_row"], bucket_key=F.col("file_pos"))
    assert [r.text for r in rows.orderBy("row_idx").collect()] == [d["text"] for d in docs]


def test_write_prepared_notices_new_input_files(spark, tmpdir_path):
    df = spark.createDataFrame([("train", 1)], "split string, v int")
    out = f"{tmpdir_path}/prep2"
    write_prepared(df, out, params={"a": 1}, input_files=["f1"])
    assert write_prepared(df, out, params={"a": 1}, input_files=["f1"])[1]
    assert not write_prepared(df, out, params={"a": 1}, input_files=["f1", "f2"])[1]
    assert not write_prepared(df, out, params={"a": 1}, input_files=["f1", "f2"], overwrite=True)[1]


def test_a_run_that_dies_leaves_the_old_version(spark, tmpdir_path):
    """The newest commit counts: a version that was not written to its end, or not committed, is never read."""
    from corpusprep.sources import sinks
    out = f"{tmpdir_path}/versions"
    df = spark.createDataFrame([("train", 1), ("validation", 2)], "split string, v int")
    sinks.write_prepared(df, out, params={"a": 1})
    dying = df.withColumn("v", F.when(F.col("v") == 2, F.raise_error(F.lit("dies"))).otherwise(F.col("v")))
    with pytest.raises(Exception):
        sinks.write_prepared(dying, out, params={"a": 2})
    df.write.parquet(f"{out}/{sinks.VERSION}uncommitted")
    assert sorted(r.v for r in sinks.read_prepared(spark, out).collect()) == [1, 2]
    assert sinks.write_prepared(df, out, params={"a": 1})[1]
    with pytest.raises(RuntimeError):  # two runs cannot commit the same number
        sinks._commit(spark, out, 0, {"version": "x"})
    for v in (3, 4, 5):
        sinks.write_prepared(df.withColumn("v", F.lit(v)), out, params={"a": v})
    assert {r.v for r in read_split(spark, out, "train").collect()} == {5}
    assert len(sinks._commits(spark, out)) == 2  # the newest, and the one before for its readers
    assert sinks.current_version(spark, out)["params"] == {"a": 5}


def test_content_digest_follows_the_files(spark, tmpdir_path):
    from corpusprep.sources.sinks import content_digest, input_states
    for name in ("a b.txt", "sub/c.txt"):
        _write(f"{tmpdir_path}/in/{name}", "text")
    files = [f"{tmpdir_path}/in/a b.txt", f"{tmpdir_path}/in/sub/c.txt"]
    first = content_digest(spark, files)
    assert first == content_digest(spark, files[::-1]) == content_digest(spark, [f"{tmpdir_path}/in"])
    assert input_states(spark, [f"file:{tmpdir_path}/in/a%20b.txt", files[1]]) == [first]
    _write(f"{tmpdir_path}/in/sub/c.txt", "other text")
    assert content_digest(spark, files) != first
    states = input_states(spark, [files[0], f"{tmpdir_path}/none"])
    assert len(states) == 2 and states[0].endswith("absent") and input_states(spark, None) == []


def test_numbered_rows_do_not_depend_on_scan_splits(spark, tmpdir_path):
    """The same positions, and packed blocks, under two split sizes; ranks come from the manifest."""
    from corpusprep.operators.packing import pack_text_blocks
    from corpusprep.sources.files import file_manifest, read_numbered
    texts = {}
    for k, name in enumerate(["b.txt", "a b/c.txt", "a!b/d.txt", "z/é.txt"]):
        texts[name] = [f"{name} line {i} " + "x" * (i % 9) for i in range(60 + 40 * k)]
        _write(f"{tmpdir_path}/train/{name}", "\n".join(texts[name]) + "\n")
    _write(f"{tmpdir_path}/valid/only.txt", "one\n\ntwo\n")
    manifest = file_manifest(spark, f"{tmpdir_path}/train").orderBy("file_rank").collect()
    assert [r.path.split("/train/")[1] for r in manifest] == sorted(texts) and [r.file_rank for r in manifest] == [0, 1, 2, 3]
    assert {r.extension for r in manifest} == {"txt"} and all(r.length > 0 for r in manifest)
    want = [t + "\n" for name in sorted(texts) for t in texts[name]]
    seen = []
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("134217728", "700"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = read_numbered(spark, {"train": f"{tmpdir_path}/train", "validation": f"{tmpdir_path}/valid", "none": f"{tmpdir_path}/none"})
            spark.conf.set("spark.sql.files.maxPartitionBytes", "300")  # a later job's settings do not matter
            assert [r.text for r in rows.where("split = 'train'").orderBy("row_idx").collect()] == want
            assert [r.text for r in rows.where("split = 'validation'").orderBy("row_idx").collect()] == ["one\n", "\n", "two\n"]
            seen.append(sorted((r.split, r.batch_id, r.block_no, r.input_ids) for r in pack_text_blocks(rows, 64, 50).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert seen[0] == seen[1]
    _write(f"{tmpdir_path}/valid/other.jsonl", "{}")
    with pytest.raises(ValueError):
        read_numbered(spark, {"train": f"{tmpdir_path}/train", "validation": f"{tmpdir_path}/valid"})
    with pytest.raises(FileNotFoundError):
        read_numbered(spark, {"train": f"{tmpdir_path}/none"})
