import pytest
from pyspark.sql import functions as F

from corpusprep.constants import TEMPLATES
from corpusprep.operators.instruct import format_instructions, null_rows, render_template
from model import instruction

SCHEMA = "id long, instruction string, input string, output string"


def _fmt(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.id: (r.input_ids, r.labels) for r in format_instructions(df, keep=("id",), **kw).collect()}


def test_fixture_markers_and_plain(spark):
    got = _fmt(spark, [(1, "a", "b", "c")])
    assert got[1] == ([195, 353, 266, 354, 196, 355, 2], [2, -100, -100, -100, -100, 355, 2])
    got = _fmt(spark, [(1, "a", "b", "c")], style="plain")
    assert got[1] == ([353, 266, 354, 355, 2], [-100, -100, -100, 355, 2])


def test_input_variants_and_limits(spark):
    rows = [(1, "ab", None, "x"), (2, "ab", "", "x"), (3, "ab", "cd", "x"),
            (4, "abcd", None, "xy"),     # both at the limit (4 / 3 with eos): markers push eos out
            (5, "abcde", None, "x"),     # source one over
            (6, "abcd", None, "xyz"),    # target one over
            (7, "ab", None, "xyzw")]     # target one over (eos counted)
    got = _fmt(spark, rows, max_source=4, max_target=3)
    for rid, ins, inp, out in rows:
        expect = instruction(ins, inp, out, 4, 3)
        assert got.get(rid) == (list(expect[0]), list(expect[1])) if expect else rid not in got
    assert got[4][0] == [195, 353, 354, 355, 356, 196, 376] and got[4][1][-1] != 2


def test_null_policies(spark):
    rows = [(1, None, None, "x"), (2, "a", None, None), (3, "a", None, "b")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r.id for r in format_instructions(df, keep=("id",)).collect()) == [3]
    assert sorted(r.reason for r in null_rows(df).collect()) == ["instruction is NULL", "output is NULL"]
    ref = format_instructions(df.where("id > 1"), keep=("id",), null_policy="reference").collect()
    labels = {r.id: r.labels for r in ref}
    assert labels[2][-5:] == [ord(c) + 256 for c in "None"] + [2]
    with pytest.raises(Exception):
        format_instructions(df, keep=("id",), null_policy="error").collect()


def test_render_template(spark):
    df = spark.createDataFrame([("sys", "hi"), ("", "hi")], "instruction string, source string")
    got = [r.prompt for r in render_template(df, TEMPLATES[0][0]).collect()]
    assert got == [" <reserved_102> sys</s>hi <reserved_103> ", " <reserved_102> hi <reserved_103> "]
    with pytest.raises(KeyError):
        render_template(df, "dxy")
    per_row = df.withColumn("t", F.lit(TEMPLATES[0][0]))
    assert [r.prompt for r in render_template(per_row, template_col="t").collect()] == got
    with pytest.raises(Exception):
        render_template(df.withColumn("t", F.lit("nope")), template_col="t").collect()


def test_empty_output_keeps_eos_only(spark):
    got = _fmt(spark, [(1, "a", None, "")])
    assert got[1] == ([195, 353, 196, 2], [2, -100, -100, 2])
