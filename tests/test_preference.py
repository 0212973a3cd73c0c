import pytest

from corpusprep.operators.preference import (
    filter_pair_length,
    missing_marker_rows,
    split_transcripts,
    wrap_prompt,
)
from corpusprep.sources.files import read_pairs_csv
from model import split_transcript


def test_transcript_fixture_and_several_markers(spark):
    rows = [("\n\nHuman: q\n\nAssistant: x", "\n\nHuman: q\n\nAssistant: y"),
            ("\n\nHuman: a\n\nAssistant: b\n\nHuman: c\n\nAssistant: d", "\n\nHuman: a\n\nAssistant: b\n\nHuman: c\n\nAssistant: e"),
            ("\n\nHuman: q\n\nAssistant: x", "other prefix entirely")]
    df = spark.createDataFrame(rows, "chosen string, rejected string")
    got = split_transcripts(df).collect()
    for r, (c, rej) in zip(got, rows):
        assert (r.prompt, r.chosen, r.rejected) == split_transcript(c, rej)
    assert got[0].prompt.endswith("Assistant:") and got[0].chosen == " x"
    assert [r.prefix_ok for r in got] == [True, True, False]


def test_missing_marker(spark):
    df = spark.createDataFrame([("no marker here", "x"), ("\n\nAssistant: y", "z")], "chosen string, rejected string")
    with pytest.raises(Exception):
        split_transcripts(df).collect()
    assert split_transcripts(df, on_missing="drop").count() == 1
    assert missing_marker_rows(df).count() == 1


def test_wrap_and_length_filter(spark):
    df = spark.createDataFrame([("p", "ab", "abc")], "prompt string, chosen string, rejected string")
    w = wrap_prompt(df)
    assert w.first().prompt == "<reserved_106>p<reserved_107>"
    n = len("<reserved_106>p<reserved_107>")
    assert filter_pair_length(w, n + 3).count() == 1      # rejected exactly at the limit
    assert filter_pair_length(w, n + 2).count() == 0      # only rejected too long


def test_csv_quoted_newlines_and_quotes(spark, tmpdir_path):
    path = f"{tmpdir_path}/pairs.csv"
    with open(path, "w") as f:
        f.write('prompt,chosen,rejected\n"line1\nline2","say ""hi""",\nplain,"a,b",c\n')
    rows = read_pairs_csv(spark, path).collect()
    assert rows[0].prompt == "line1\nline2" and rows[0].chosen == 'say "hi"' and rows[0].rejected is None
    assert rows[1].chosen == "a,b"


def test_null_transcript_is_missing_marker(spark):
    df = spark.createDataFrame([(None, "x"), ("\n\nAssistant: y", "z")], "chosen string, rejected string")
    assert split_transcripts(df, on_missing="drop").count() == 1
    assert missing_marker_rows(df).count() == 1
    with pytest.raises(Exception):
        split_transcripts(df).collect()


def test_csv_columns_by_header_name(spark, tmpdir_path):
    path = f"{tmpdir_path}/reordered.csv"
    with open(path, "w") as f:
        f.write('id,rejected,prompt,chosen\n1,"r","p","c"\n')
    r = read_pairs_csv(spark, path).first()
    assert (r.prompt, r.chosen, r.rejected) == ("p", "c", "r")
    with open(f"{tmpdir_path}/bad.csv", "w") as f:
        f.write("prompt,chosen\np,c\n")
    with pytest.raises(ValueError):
        read_pairs_csv(spark, f"{tmpdir_path}/bad.csv")
