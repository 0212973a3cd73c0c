"""Tokenizing (3.1-3.7).

Two tokenizers:

* ``"codepoint"`` (default): id = code point + 256, written with native column functions, so
  it stays inside the JVM and can be checked with SQL; :class:`CodepointTokenizer` adds a begin token.
* :class:`ModelTokenizer`: a ``tokenizers`` JSON model file shipped to executors with
  ``addFile`` and applied by ``mapInPandas`` in Arrow batches; the model loads once per Python
  worker, never per row.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.constants import DEFAULT_PAD_ID, EOS_ID
from corpusprep.functions.tokens import codepoint_ids, ones_like


@dataclass(frozen=True)
class ModelTokenizer:
    """A tokenizer stored as a ``tokenizers`` JSON file on storage every executor can read
    (or shipped with ``SparkContext.addFile``)."""

    path: str
    eos_id: int = EOS_ID
    pad_id: int = DEFAULT_PAD_ID
    add_special_tokens: bool = True

    def ship(self, spark) -> "ModelTokenizer":
        spark.sparkContext.addFile(self.path)
        return self


@dataclass(frozen=True)
class CodepointTokenizer:
    """The codepoint tokenizer with a begin token: encoding with special tokens puts ``begin_id`` in front."""

    begin_id: int = 1

    def ids(self, text, special: bool = True):
        ids = codepoint_ids(text)
        return F.concat(F.array(F.lit(self.begin_id)), ids) if special else ids


_LOADED: dict[str, object] = {}


def _load(path: str):
    tok = _LOADED.get(path)
    if tok is None:
        from pyspark import SparkFiles
        from tokenizers import Tokenizer

        local = path
        if not os.path.exists(local):
            local = SparkFiles.get(os.path.basename(path))
        tok = Tokenizer.from_file(local)
        _LOADED[path] = tok
    return tok


def _model_tokenize(df: DataFrame, text_col: str, out: str, mask: str | None,
                    tok: ModelTokenizer, keep_text: bool, add_special_tokens: bool | None = None) -> DataFrame:
    fields = [f for f in df.schema.fields if keep_text or f.name != text_col]
    schema = T.StructType(fields + [T.StructField(out, T.ArrayType(T.IntegerType()))]
                          + ([T.StructField(mask, T.ArrayType(T.IntegerType()))] if mask else []))
    path = tok.path
    special = tok.add_special_tokens if add_special_tokens is None else add_special_tokens

    def run(batches):
        model = _load(path)  # once per Python worker
        for pdf in batches:
            texts = pdf[text_col].tolist()
            enc = iter(model.encode_batch([t for t in texts if t is not None], add_special_tokens=special))
            ids = [None if t is None else next(enc).ids for t in texts]
            if not keep_text:
                pdf = pdf.drop(columns=[text_col])
            pdf[out] = ids
            if mask:
                pdf[mask] = [None if x is None else [1] * len(x) for x in ids]
            yield pdf

    return df.mapInPandas(run, schema)


def encode_columns(df: DataFrame, specs: dict, tok: ModelTokenizer, *, drop: bool = True) -> DataFrame:
    """Several text columns encoded by the model in one Arrow pass: ``specs`` maps an output
    column to ``(text column, add_special_tokens)``. The text columns are dropped unless
    ``drop`` is false."""
    inputs = {c for c, _ in specs.values()}
    fields = [f for f in df.schema.fields if not (drop and f.name in inputs)]
    schema = T.StructType(fields + [T.StructField(o, T.ArrayType(T.IntegerType())) for o in specs])
    path = tok.path
    plan = [(o, c, special) for o, (c, special) in specs.items()]

    def run(batches):
        model = _load(path)
        for pdf in batches:
            for o, c, special in plan:
                texts = pdf[c].tolist()
                enc = iter(model.encode_batch([t for t in texts if t is not None], add_special_tokens=special))
                pdf[o] = [None if t is None else next(enc).ids for t in texts]
            if drop:
                pdf = pdf.drop(columns=sorted(inputs))
            yield pdf

    return df.mapInPandas(run, schema)


def encode_messages(df: DataFrame, conversations: str, out: str, tok: ModelTokenizer) -> DataFrame:
    """Token ids of every message ``value`` of a nested conversation column, as
    ``ARRAY<ARRAY<INT>>`` aligned with the messages (one Arrow batch call per partition)."""
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.ArrayType(T.ArrayType(T.IntegerType())))])
    path, special = tok.path, tok.add_special_tokens

    def run(batches):
        model = _load(path)
        for pdf in batches:
            convs = pdf[conversations].tolist()
            values = [m["value"] or "" for c in convs if c is not None for m in c]
            enc = iter(model.encode_batch(values, add_special_tokens=special))
            pdf[out] = [None if c is None else [next(enc).ids for _m in c] for c in convs]
            yield pdf

    return df.mapInPandas(run, schema)


def decode_model_ids(df: DataFrame, ids_col: str, out: str, tok: ModelTokenizer,
                     skip_special_tokens: bool = False) -> DataFrame:
    """Ids -> text with a model file (3.5 for model tokenizers), Arrow batches per partition."""
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.StringType())])
    path = tok.path

    def run(batches):
        model = _load(path)
        for pdf in batches:
            ids = pdf[ids_col].tolist()
            present = [list(x) for x in ids if x is not None]
            dec = iter(model.decode_batch(present, skip_special_tokens=skip_special_tokens))
            pdf[out] = [None if x is None else next(dec) for x in ids]
            yield pdf

    return df.mapInPandas(run, schema)


def resolve_pad_id(pad_id: int | None = None, eos_id: int | None = None, *, pad_with_eos: bool = False) -> int:
    """The pad id to use: the tokenizer's, else eos when asked (the transcript trainer does
    that), else 0."""
    if pad_id is not None:
        return pad_id
    if pad_with_eos and eos_id is not None:
        return eos_id
    return DEFAULT_PAD_ID


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give CPU-heavy per-row work at least ``min_partitions`` tasks (default: the session's
    parallelism). A large input already has more partitions than cores and is returned as is;
    a small one (one parquet row group is one scan task) is repartitioned round-robin.

    Meant for frames read straight from files: there the partition count comes from the file
    listing. On a plan with shuffles, asking for the partition count would run those stages
    early, so it is not applied inside the operators."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def tokenize(df: DataFrame, text_col: str = "text", *, out: str = "input_ids",
             mask: str | None = "attention_mask", tokenizer="codepoint",
             keep_text: bool = False, add_special_tokens: bool | None = None) -> DataFrame:
    """Add token ids (and an all-ones attention mask) for ``text_col``. ``add_special_tokens``
    overrides the tokenizer's setting (targets are encoded without them); ``"codepoint"`` has none,
    ``CodepointTokenizer`` one in front."""
    if tokenizer in (None, "codepoint") or isinstance(tokenizer, CodepointTokenizer):
        special = isinstance(tokenizer, CodepointTokenizer) and add_special_tokens is not False
        res = df.withColumn(out, tokenizer.ids(text_col) if special else codepoint_ids(text_col))
        if mask:
            res = res.withColumn(mask, ones_like(out))
        return res if keep_text else res.drop(text_col)
    if isinstance(tokenizer, ModelTokenizer):
        return _model_tokenize(df, text_col, out, mask, tokenizer, keep_text, add_special_tokens)
    raise ValueError(f"unknown tokenizer {tokenizer!r}")


def token_stats(df: DataFrame, ids_col: str = "input_ids", *, split_col: str | None = "split", length=None) -> DataFrame:
    """Rows, tokens, longest and shortest row per split (or overall). ``length``: a column of token counts that stands for the
    arrays (``token_count(text)`` for the codepoint tokenizer, a stored count for others)."""
    n = F.size(ids_col) if length is None else length
    aggs = [F.count(F.lit(1)).cast("bigint").alias("n_rows"),
            F.sum(n).cast("bigint").alias("n_tokens"),
            F.max(n).cast("bigint").alias("max_tokens"),
            F.min(n).cast("bigint").alias("min_tokens")]
    if split_col:
        return df.groupBy(split_col).agg(*aggs)
    return df.agg(*aggs)


def store_tokens(df: DataFrame, path: str, text_col: str = "text", *, tokenizer="codepoint",
                 count_col: str = "n_tokens", mode: str = "overwrite") -> DataFrame:
    """Tokenize once and keep the result: ``df`` minus ``text_col`` plus ``input_ids``,
    ``attention_mask`` and ``count_col`` (tokens per row) written as parquet at ``path`` (a
    shared folder), read back. Packing the stored arrays with ``pack_corpus_ids(...,
    length_col=count_col)`` then reads only the counts in its pre-pass."""
    toks = tokenize(df, text_col, tokenizer=tokenizer)
    toks.withColumn(count_col, F.size("input_ids").cast("bigint")).write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)
