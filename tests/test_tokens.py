
from corpusprep.functions import argmax, codepoint_ids, decode_ids, labels_for_display
from model import ids


def test_codepoints_and_decode(spark):
    texts = ["aé😀b", "", "a\nb", "plain"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", codepoint_ids("t").alias("i"), decode_ids(codepoint_ids("t")).alias("d")).collect()
    for r in rows:
        assert r.i == ids(r.t)
        assert r.d == r.t


def test_null_text_stays_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(codepoint_ids("t").alias("i")).first().i is None


def test_decode_markers_and_display(spark):
    df = spark.createDataFrame([([195, 353, 196, 354, 2, 0],)], "i array<int>")
    assert df.select(decode_ids("i").alias("d")).first().d == "<reserved_106>a<reserved_107>b</s>"
    df = spark.createDataFrame([([2, -100, -100, 354, 2],)], "l array<int>")
    assert df.select(labels_for_display("l").alias("x")).first().x == [2, 0, 0, 354, 2]


def test_argmax_first_on_ties(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, 2.0],), ([5.0],), ([],)], "a array<float>")
    assert [r.p for r in df.select(argmax("a").alias("p")).collect()] == [1, 0, None]


def test_resolve_pad_id():
    from corpusprep.operators.tokenizing import resolve_pad_id
    assert resolve_pad_id(None, 2) == 0
    assert resolve_pad_id(None, 2, pad_with_eos=True) == 2
    assert resolve_pad_id(5, 2, pad_with_eos=True) == 5
