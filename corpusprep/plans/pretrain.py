"""Pretraining corpus: order -> split -> tokenize -> pack -> limit blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.constants import DEFAULT_BLOCK_SIZE, DEFAULT_ROWS_PER_BATCH, DEFAULT_VALIDATION_PERCENT
from corpusprep.operators.ordering import choose_validation, head_limit, head_percent_split, row_index
from corpusprep.operators.packing import effective_block_size, number_blocks, pack_blocks, pack_corpus_text, pack_text_blocks, pack_whole_splits
from corpusprep.operators.tokenizing import tokenize


def split_corpus(docs: DataFrame, order_by, *, validation: DataFrame | None = None,
                 percent: float = DEFAULT_VALIDATION_PERCENT, bucket_key=None,
                 text_col: str = "text") -> DataFrame:
    """``split, row_idx, text``: row_idx is the position inside the split."""
    if validation is None:
        return head_percent_split(docs.select(*_order_cols(order_by), text_col), order_by, percent,
                                  bucket_key=bucket_key).select("split", "row_idx", text_col)
    parts = []
    for name, frame in (("train", docs), ("validation", validation)):
        idx = row_index(frame.select(*_order_cols(order_by), text_col), order_by, bucket_key=bucket_key)
        parts.append(idx.select(F.lit(name).alias("split"), "row_idx", text_col))
    return parts[0].unionByName(parts[1])


def _order_cols(order_by) -> list:
    cols = order_by if isinstance(order_by, (list, tuple)) else [order_by]
    return [c for c in cols if isinstance(c, str)]


def pretrain_blocks(docs: DataFrame, order_by=("doc_id",), *, validation: DataFrame | None = None,
                    percent: float = DEFAULT_VALIDATION_PERCENT, block_size: int = DEFAULT_BLOCK_SIZE,
                    rows_per_batch: int = DEFAULT_ROWS_PER_BATCH, tokenizer="codepoint",
                    text_col: str = "text", keep_short: bool = True, bucket_key=None,
                    max_train_samples: int | None = None, max_eval_samples: int | None = None,
                    strategy: str = "two_shuffle", length_col: str | None = None,
                    token_store: str | None = None, scope: str = "batch", model_max_length: int | None = None,
                    by_split: bool = False) -> DataFrame:
    """Packed blocks ``split, batch_id, block_no, input_ids, attention_mask, labels`` (plus
    ``block_idx`` when a sample limit is given; the limit counts blocks).

    ``strategy``: ``"two_shuffle"`` orders (``row_index``) and then packs; ``"one_shuffle"`` moves
    the text through one shuffle (``pack_corpus_text``) at the price of a narrow pre-pass that
    reads the key and text lengths. The caller chooses; the size of the input does not. ``length_col``
    (a stored character count, e.g. ``n_chars``) lets the one-shuffle pre-pass skip the text; it is checked per row.

    ``scope``: ``"batch"`` packs every ``rows_per_batch`` rows on their own, ``"corpus"`` the whole of each split
    (``pack_whole_splits``; the result has no ``batch_id``). ``model_max_length`` is the tokenizer's limit:
    ``block_size=None`` takes it, a larger ``block_size`` is cut to it (``effective_block_size``).

    With a model tokenizer the one-shuffle plan needs ``token_store`` (a shared folder): the
    corpus is tokenized once into it (``store_tokens``) and the stored arrays are packed with
    one shuffle, the pre-pass reading only the stored token counts.

    ``by_split`` (codepoint tokenizer, ``two_shuffle``; no effect elsewhere): blocks come in split order from every task,
    as ``write_prepared`` needs them."""
    order_by = list(order_by) if isinstance(order_by, (list, tuple)) else [order_by]
    codepoint = tokenizer in (None, "codepoint")
    if model_max_length is not None or block_size is None:
        block_size = effective_block_size(block_size, model_max_length or DEFAULT_BLOCK_SIZE)
    if scope == "corpus":
        return _pack_whole(docs, order_by, validation, percent, block_size, None if codepoint else tokenizer, text_col, keep_short,
                           bucket_key, {"train": max_train_samples, "validation": max_eval_samples})
    if scope != "batch":
        raise ValueError(f"unknown scope {scope!r}")
    fusable = (codepoint and all(isinstance(c, str) for c in order_by)
               and (bucket_key is not None or len(order_by) == 1))
    if strategy == "one_shuffle" and not codepoint and token_store:
        from corpusprep.operators.packing import pack_corpus_ids
        from corpusprep.operators.tokenizing import store_tokens
        key = order_by if len(order_by) > 1 else order_by[0]
        frames = [("train", docs)] + ([("validation", validation)] if validation is not None else [])
        parts = []
        for name, frame in frames:
            stored = store_tokens(frame.select(*order_by, text_col), f"{token_store.rstrip('/')}/{name}",
                                  text_col, tokenizer=tokenizer)
            packed = pack_corpus_ids(stored, key, block_size, rows_per_batch, bucket_key=bucket_key,
                                     percent=percent if validation is None else None, keep_short=keep_short,
                                     length_col="n_tokens")
            parts.append(packed if validation is None else packed.withColumn("split", F.lit(name)))
        blocks = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return _limit(blocks, max_train_samples, max_eval_samples)
    if strategy == "one_shuffle":
        if not fusable:
            raise ValueError("one_shuffle packing needs the codepoint tokenizer and named order columns "
                             "(a numeric bucket_key when there are several)")
        # one text shuffle: order, split and pack fused on the key buckets
        key = order_by if len(order_by) > 1 else order_by[0]
        if validation is None:
            blocks = pack_corpus_text(docs, key, block_size, rows_per_batch, text_col=text_col,
                                      percent=percent, keep_short=keep_short, bucket_key=bucket_key,
                                      length_col=length_col)
        else:  # each split packed on its own
            parts = [pack_corpus_text(frame, key, block_size, rows_per_batch, text_col=text_col, percent=None,
                                      keep_short=keep_short, bucket_key=bucket_key, length_col=length_col)
                     .withColumn("split", F.lit(name))
                     for name, frame in (("train", docs), ("validation", validation))]
            blocks = parts[0].unionByName(parts[1])
        return _limit(blocks, max_train_samples, max_eval_samples)
    rows = split_corpus(docs, order_by, validation=validation, percent=percent,
                        bucket_key=bucket_key, text_col=text_col)
    if codepoint:
        blocks = pack_text_blocks(rows, block_size, rows_per_batch, text_col=text_col, keep_short=keep_short, by_split=by_split)
    else:
        toks = tokenize(rows, text_col, tokenizer=tokenizer)
        blocks = pack_blocks(toks, block_size, rows_per_batch, keep_short=keep_short)
    return _limit(blocks, max_train_samples, max_eval_samples)


def _pack_whole(docs, order_by, validation, percent, block_size, tokenizer, text_col, keep_short, bucket_key, limits) -> DataFrame:
    named = [c for c in order_by if isinstance(c, str)]
    if len(named) < len(order_by):
        raise ValueError("packing whole splits needs named order columns")
    rows = choose_validation(docs, validation, order_by=named, percent=percent).withColumn("__given", F.lit(None) if bucket_key is None else bucket_key)
    rows = rows.select("split", *named, text_col, "__given")
    if tokenizer is not None:
        rows = tokenize(rows, text_col, tokenizer=tokenizer)
    blocks = pack_whole_splits(rows, named, block_size, text_col=text_col if tokenizer is None else None, keep_short=keep_short,
                               bucket_key=None if bucket_key is None else F.col("__given"))
    return head_limit(blocks, limits, index_col="block_no") if any(limits.values()) else blocks


def _limit(blocks: DataFrame, max_train_samples, max_eval_samples) -> DataFrame:
    """Sample limits count blocks (``block_idx``: dense position in the split, from running sums
    over per-batch block counts)."""
    if not (max_train_samples or max_eval_samples):
        return blocks
    limits = {"train": max_train_samples, "validation": max_eval_samples}
    return head_limit(number_blocks(blocks), limits, index_col="block_idx")


def pretrain_from_files(spark, train_dir: str, validation_dir: str | None = None, *,
                        keep_linebreaks: bool = True, percent: float = DEFAULT_VALIDATION_PERCENT,
                        block_size: int = DEFAULT_BLOCK_SIZE, rows_per_batch: int = DEFAULT_ROWS_PER_BATCH,
                        keep_short: bool = True, strategy: str = "two_shuffle") -> DataFrame:
    """Corpus folders -> packed blocks. Rows keep file order (file rank, split start, position);
    without a validation folder the first ``percent`` of train rows become validation.
    ``strategy`` as for ``pretrain_blocks`` (the one-shuffle plan orders by the file position
    key and buckets on ``file_pos``)."""
    from corpusprep.sources.files import read_corpus
    parts = read_corpus(spark, train_dir, validation_dir, keep_linebreaks=keep_linebreaks)
    order = ["file_rank", "file_block", "file_row"]
    key = F.col("file_pos")
    if strategy == "one_shuffle":
        if "validation" not in parts:
            return pack_corpus_text(parts["train"], order, block_size, rows_per_batch, percent=percent,
                                    bucket_key=key, keep_short=keep_short)
        packed = [pack_corpus_text(frame, order, block_size, rows_per_batch, percent=None, bucket_key=key,
                                   keep_short=keep_short).withColumn("split", F.lit(name))
                  for name, frame in parts.items()]
        return packed[0].unionByName(packed[1])
    if "validation" in parts:
        rows = None
        for name, frame in parts.items():
            idx = row_index(frame, order, bucket_key=key).select(F.lit(name).alias("split"), "row_idx", "text")
            rows = idx if rows is None else rows.unionByName(idx)
    else:
        rows = head_percent_split(parts["train"], order, percent, bucket_key=key).select("split", "row_idx", "text")
    return pack_text_blocks(rows, block_size, rows_per_batch, keep_short=keep_short)
