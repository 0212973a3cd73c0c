"""Preference data: pairs from CSV-like tables, or whole transcripts split at the prompt."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.constants import DEFAULT_PAIR_MAX_LENGTH, SANITY_ROWS_PAIRS, SANITY_ROWS_TRANSCRIPTS
from corpusprep.operators.ordering import head_rows
from corpusprep.operators.preference import filter_pair_length, rejected_pairs, split_transcripts, wrap_prompt


def _sanity(df: DataFrame, order_by, rows: int) -> DataFrame:
    """The first rows in order, by comparison with the key of the last of them: no shuffle of the table."""
    return head_rows(df, order_by, rows)


def _wrapped(train, evaluation, order_by, sanity, keep, bucket_key):
    for name, frame in (("train", train), ("validation", evaluation)):
        if frame is not None:
            if sanity:
                frame = _sanity(frame, order_by, SANITY_ROWS_PAIRS)
            yield name, wrap_prompt(frame, keep=keep)


def prepare_pairs(train: DataFrame, evaluation: DataFrame | None = None, *, order_by=None,
                  max_length: int = DEFAULT_PAIR_MAX_LENGTH, sanity: bool = False,
                  filter_eval: bool = True, keep=(), bucket_key=None) -> DataFrame:
    """``split, keep..., prompt, chosen, rejected``: sanity head (first 200 rows, before
    formatting), prompt wrapped in the marker texts, pairs longer than ``max_length``
    characters and pairs with a NULL cell dropped (``quarantined_pairs`` has them with the reason). The
    reference's evaluation filter never drops anything; ``filter_eval=False`` reproduces that."""
    out = None
    for name, w in _wrapped(train, evaluation, order_by, sanity, keep, bucket_key):
        if name == "train" or filter_eval:
            w = filter_pair_length(w, max_length)
        w = w.select(F.lit(name).alias("split"), *w.columns)
        out = w if out is None else out.unionByName(w)
    return out


def quarantined_pairs(train: DataFrame, evaluation: DataFrame | None = None, *, order_by=None,
                      max_length: int = DEFAULT_PAIR_MAX_LENGTH, sanity: bool = False,
                      filter_eval: bool = True, keep=(), bucket_key=None) -> DataFrame:
    """The rows ``prepare_pairs`` leaves out, with ``reason``: both together are all rows."""
    out = None
    for name, w in _wrapped(train, evaluation, order_by, sanity, keep, bucket_key):
        if name == "train" or filter_eval:
            w = rejected_pairs(w, max_length)
            w = w.select(F.lit(name).alias("split"), *w.columns)
            out = w if out is None else out.unionByName(w)
    return out


def prepare_transcripts(df: DataFrame, *, order_by=None, sanity: bool = False, on_missing: str = "error",
                        keep=(), bucket_key=None) -> DataFrame:
    """Whole dialogues -> ``prompt, chosen, rejected`` (first 1000 rows in sanity mode)."""
    if sanity:
        df = _sanity(df, order_by, SANITY_ROWS_TRANSCRIPTS)
    return split_transcripts(df, on_missing=on_missing, keep=keep)


def pairs_from_csv(spark, train_path: str, eval_path: str | None = None, **kw) -> DataFrame:
    """Preference CSV files (``prompt, chosen, rejected``) -> prepared pairs, file order kept
    for the sanity head."""
    from corpusprep.sources.files import csv_by_header, with_file_position
    order = ["file_rank", "file_block", "file_row"]

    def load(path):
        frames = csv_by_header(spark, path)
        files = sorted(_readable(spark, {u for f in frames for u in f.inputFiles()}))
        return reduce(DataFrame.unionByName, [with_file_position(f, files) for f in frames])

    train = load(train_path)
    evaluation = load(eval_path) if eval_path else None
    return prepare_pairs(train, evaluation, order_by=order, bucket_key=F.col("file_pos"), **kw)


def _readable(spark, uris):
    jvm = spark.sparkContext._jvm
    return [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(u)).toString() for u in uris]
