"""Packing token streams into fixed-size blocks (4.1-4.5).

Semantics: rows are taken in order in batches of ``rows_per_batch``; inside a batch all rows
are concatenated and cut into blocks of ``block_size``. When the batch holds at least one
block the remainder is dropped; when it holds fewer tokens than one block a single short block
is kept (``keep_short``); an empty batch gives nothing. ``labels`` is a copy of ``input_ids``.
No block crosses a split or a batch.

Plan: one hash exchange on ``(split, batch_id)``. A window over the batch gives every row its
token offset; each row is cut once, in one pass over it, into the pieces it contributes to each
block, and only the pieces go on (no row holds more than one block from there on); the pieces are
grouped by ``(split, batch_id, block_no)`` on the same partitioning and concatenated in order.
A batch has at most ``rows_per_batch`` rows and a block at most ``block_size`` tokens, so no
group grows with the data.
"""

from __future__ import annotations

import warnings

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.constants import DEFAULT_ROWS_PER_BATCH, TOKENIZER_LENGTH_WARNING
from corpusprep.functions.tokens import codepoint_ids, ones_like


def effective_block_size(block_size: int | None, model_max_length: int) -> int:
    """``None`` -> the tokenizer's limit (warns above 4096); else ``min(block_size, limit)``
    (warns when the request is cut)."""
    if block_size is None:
        if model_max_length > TOKENIZER_LENGTH_WARNING:
            warnings.warn(f"tokenizer limit {model_max_length} is above {TOKENIZER_LENGTH_WARNING}; "
                          "pass block_size to choose a smaller one")
        return model_max_length
    if block_size > model_max_length:
        warnings.warn(f"block_size {block_size} is above the tokenizer limit {model_max_length}; "
                      f"using {model_max_length}")
    return min(block_size, model_max_length)


def _batch_cols(split_col: str | None) -> list[str]:
    return ([split_col] if split_col else []) + ["batch_id"]


def _kept(total: Column, block_size: int, keep_short: bool) -> Column:
    full = F.floor(total / F.lit(block_size)) * F.lit(block_size)
    return F.when(total >= block_size, full).otherwise(total if keep_short else F.lit(0)).cast("bigint")


def _placed(df: DataFrame, length: Column, block_size: int, rows_per_batch: int,
            index_col: str, split_col: str | None, keep_short: bool) -> DataFrame:
    """Rows with their token offset ``__start`` in the batch stream and ``__end``, where the part
    of them that is kept ends. Rows that give nothing are left out."""
    d = df.withColumn("batch_id", F.floor(F.col(index_col) / F.lit(int(rows_per_batch))).cast("bigint"))
    d = d.withColumn("__n", F.greatest(F.coalesce(length.cast("bigint"), F.lit(0)), F.lit(0)))  # NULL rows: no tokens
    part = _batch_cols(split_col)
    w_batch = Window.partitionBy(*part)
    w_before = Window.partitionBy(*part).orderBy(index_col).rowsBetween(Window.unboundedPreceding, -1)
    d = (d.withColumn("__start", F.coalesce(F.sum("__n").over(w_before), F.lit(0)).cast("bigint"))
          .withColumn("__keep", _kept(F.sum("__n").over(w_batch), int(block_size), keep_short)))
    d = d.withColumn("__end", F.least(F.col("__start") + F.col("__n"), F.col("__keep")))
    return d.where(F.col("__end") > F.col("__start"))


def _text_cuts(text: str, block_size: int) -> Column:
    """The text cut at its block boundaries: the first piece fills the block that ``__start`` lies
    in, all others are whole blocks. One pass over the text."""
    B = int(block_size)
    first = (F.lit(B) - F.col("__start") % F.lit(B)).cast("int")
    rest = F.substring(F.col(text), first + 1, F.length(text))
    return F.concat(F.array(F.substring(F.col(text), F.lit(1), first)),
                    F.when(F.col("__n") > first, F.regexp_extract_all(rest, F.lit(f"(?s).{{1,{B}}}"), F.lit(0)))
                    .otherwise(F.array().cast("array<string>")))


def _array_cuts(columns: list, names: list, block_size: int) -> Column:
    """The arrays cut at their block boundaries (an array of structs of pieces). Elements are taken
    by position, so the work grows with the row's length, not with its square."""
    B = int(block_size)
    begin = F.col("__start")

    def taken(column: str):
        return lambda i: F.get(F.col(column), i)

    def piece(block: Column) -> Column:
        low = (F.greatest(block * F.lit(B), begin) - begin).cast("int")
        high = (F.least((block + 1) * F.lit(B), F.col("__end")) - begin - 1).cast("int")
        return F.struct(*[F.transform(F.sequence(low, high), taken(c)).alias(n) for c, n in zip(columns, names)])

    first, last = F.floor(begin / F.lit(B)).cast("bigint"), F.floor((F.col("__end") - 1) / F.lit(B)).cast("bigint")
    return F.transform(F.sequence(first, last), piece)


def _exploded(d: DataFrame, cuts: Column, block_size: int, keep: list) -> DataFrame:
    """One row per piece: ``keep``, ``block_no``, ``__lo`` / ``__hi`` (its token range in the batch
    stream) and ``__piece``. The whole row's text or arrays go no further."""
    B = F.lit(int(block_size))
    d = d.select(*keep, "__start", "__end", F.posexplode(cuts).alias("__i", "__piece"))
    d = d.withColumn("block_no", (F.floor(F.col("__start") / B) + F.col("__i")).cast("bigint"))
    d = (d.withColumn("__lo", F.greatest(F.col("block_no") * B, F.col("__start")))
          .withColumn("__hi", F.least((F.col("block_no") + 1) * B, F.col("__end"))))
    return d.where(F.col("__hi") > F.col("__lo")).drop("__i", "__start", "__end")


def _text_piece() -> Column:
    """A text piece cut to what is kept of it (at most a block)."""
    return F.substring(F.col("__piece"), F.lit(1), (F.col("__hi") - F.col("__lo")).cast("int"))


def _field(name: str):
    return lambda p: p[name]


def pack_blocks(df: DataFrame, block_size: int, rows_per_batch: int = DEFAULT_ROWS_PER_BATCH, *,
                index_col: str = "row_idx", split_col: str | None = "split",
                columns=("input_ids", "attention_mask"), keep_short: bool = True,
                labels: bool = True) -> DataFrame:
    """Pack tokenized rows (array columns ``columns``, equal lengths per row) into blocks.

    ``index_col`` is the row position inside its split (see ``row_index`` / ``head_percent_split``).
    Output: ``split, batch_id, block_no, <columns...>, labels``.
    """
    cols = list(columns)
    names = [f"c{i}" for i in range(len(cols))]
    d = _placed(df, F.size(cols[0]), block_size, rows_per_batch, index_col, split_col, keep_short)
    d = _exploded(d, _array_cuts(cols, names, block_size), block_size, _batch_cols(split_col))
    pieces = F.struct(F.col("__lo").alias("lo"), *[F.col(f"__piece.{n}").alias(n) for n in names])
    key = _batch_cols(split_col) + ["block_no"]
    g = d.groupBy(*key).agg(F.array_sort(F.collect_list(pieces)).alias("__p"))
    out = g.select(*key, *[F.flatten(F.transform("__p", _field(n))).alias(c) for c, n in zip(cols, names)])
    if labels:
        out = out.withColumn("labels", F.col(cols[0]))
    return out


def pack_text_blocks(df: DataFrame, block_size: int, rows_per_batch: int = DEFAULT_ROWS_PER_BATCH, *,
                     text_col: str = "text", index_col: str = "row_idx",
                     split_col: str | None = "split", keep_short: bool = True,
                     mask: str | None = "attention_mask", labels: bool = True, by_split: bool = False) -> DataFrame:
    """Same blocks as ``tokenize`` + ``pack_blocks`` for the codepoint tokenizer, whose ids
    are a per-character map: tokens(a + b) = tokens(a) + tokens(b). Each text is cut once into
    its pieces and each block is tokenized once, so both shuffles move text (1-2 bytes per
    character) instead of int arrays (4 bytes per token). ``by_split``: every task gives its blocks in split order, sorted
    while they are text, so that a writer partitioned by split has no wide rows to sort."""
    d = _placed(df, F.length(text_col), block_size, rows_per_batch, index_col, split_col, keep_short)
    d = _exploded(d, _text_cuts(text_col, block_size), block_size, _batch_cols(split_col))
    piece = F.struct(F.col("__lo").alias("lo"), _text_piece().alias("t"))
    key = _batch_cols(split_col) + ["block_no"]
    g = d.groupBy(*key).agg(F.array_sort(F.collect_list(piece)).alias("__p"))
    if by_split and split_col:
        g = g.select(*key, F.array_join(F.transform("__p", lambda p: p["t"]), "").alias("__t")).sortWithinPartitions(split_col)
        out = g.select(*key, codepoint_ids("__t").alias("input_ids"))
    else:
        out = g.select(*key, codepoint_ids(F.array_join(F.transform("__p", lambda p: p["t"]), "")).alias("input_ids"))
    if mask:
        out = out.withColumn(mask, ones_like("input_ids"))
    if labels:
        out = out.withColumn("labels", F.col("input_ids"))
    return out


def number_blocks(blocks: DataFrame, *, split_col: str | None = "split", name: str = "block_idx") -> DataFrame:
    """Dense block position inside the split, in (batch_id, block_no) order: the unit of the
    pretraining sample limit. Offsets come from a running sum over per-batch block counts
    (one row per batch), joined back on the batch."""
    from corpusprep.operators.ordering import grouped_scan
    part = _batch_cols(split_col)
    per_batch = blocks.groupBy(*part).agg(F.count(F.lit(1)).alias("__nb"))
    # batch_id is a dense integer step inside the split: three levels, up to 10**9 batches, no extra job
    per_batch = grouped_scan(per_batch, [split_col] if split_col else [], "batch_id",
                             {"__boff": ("sum", "__nb")}, inclusive=False, span=10 ** 9)
    out = blocks.join(per_batch.select(*part, "__boff"), on=part, how="inner")
    return out.withColumn(name, (F.col("__boff") + F.col("block_no")).cast("bigint")).drop("__boff")


def pack_whole_splits(df: DataFrame, key, block_size: int, *, text_col: str | None = "text", columns=("input_ids", "attention_mask"),
                      split_col: str | None = "split", keep_short: bool = True, mask: str | None = "attention_mask",
                      labels: bool = True, bucket_key=None, num_buckets: int | None = None) -> DataFrame:
    """Pack across the whole of each split instead of per batch of rows (``scope='corpus'``): all rows of a split in ``key`` order
    are one token stream, cut into blocks of ``block_size``. The remainder is dropped if there is a full block, else the one short
    block is kept (``keep_short``). Output: ``split, block_no, <columns...>, labels``; ``block_no`` is dense in the split.

    ``text_col`` packs text by the codepoint tokenizer; with ``text_col=None`` the array ``columns`` of equal length per row are
    packed. Rows of NULL text or arrays have no tokens. ``key`` is one column or a list, unique and of any orderable type.

    A row's token offset is its range's offset (a running sum over one row per split and range) plus a running sum inside the
    range, so the rows cross the network once, by range. (Ranges of a whole key are stored with that running sum, and their pieces, not their
    rows, move a second time: only those of the blocks that are asked for.) Blocks that lie inside a range are built there. Only the
    pieces of blocks that span ranges, at most two a range, move again and are put together by block number."""
    from corpusprep.operators.ordering import default_buckets, grouped_scan, ordered_buckets, with_cell

    B, parts = int(block_size), [split_col] if split_col else []
    keys = [key] if isinstance(key, str) else list(key)
    payload = [text_col] if text_col else list(columns)
    fields = [f"__p{i}" for i in range(len(payload))]
    nb = num_buckets or default_buckets(df)
    length = F.length(text_col) if text_col else F.size(payload[0])
    rows = df.select(*parts, *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                     *([bucket_key.alias("__given")] if bucket_key is not None else []),
                     *[F.col(c).alias(f) for c, f in zip(payload, fields)],
                     F.greatest(F.coalesce(length.cast("bigint"), F.lit(0)), F.lit(0)).alias("__n"))
    order = [f"__k{i}" for i in range(len(keys))]
    rows, within = ordered_buckets(rows, order, partition_by=parts, num_buckets=nb,
                                   bucket_key=F.col("__given") if bucket_key is not None else None, sum_of="__n")
    rows = with_cell(rows, parts)
    summed = "__sum" in rows.columns  # over the range, in which several cells may lie one after the other
    cells = rows.groupBy("__cell").agg(F.sum("__n").alias("__t"), *([F.min("__sum").alias("__first")] if summed else []))  # reads keys and lengths only
    cells = grouped_scan(cells.select("*", "__cell.*"), parts, "__bucket", {"__off": ("sum", "__t")}, inclusive=False, span=nb + 1)
    total = F.sum("__t").over(Window.partitionBy(*parts))
    cells = cells.select("__cell", "__off", *(["__first"] if summed else []), (F.col("__off") + F.col("__t")).alias("__stop"), _kept(total, B, keep_short).alias("__keep"))
    if summed:  # a row for each range and split: no row moves for it
        d = rows.join(F.broadcast(cells), "__cell").withColumn("__before", F.col("__sum") - F.col("__first"))
    else:
        before = Window.partitionBy("__cell").orderBy(*within).rowsBetween(Window.unboundedPreceding, -1)
        d = rows.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).join(cells, "__cell")
    d = d.withColumn("__start", (F.col("__off") + F.col("__before")).cast("bigint"))
    d = d.withColumn("__end", F.least(F.col("__start") + F.col("__n"), F.col("__keep"))).where(F.col("__end") > F.col("__start"))

    def spans(block: Column) -> Column:
        """Whether a block has tokens of another range too."""
        low, high = block * F.lit(B), F.least((block + 1) * F.lit(B), F.col("__keep"))
        return (low < F.col("__off")) | (high > F.col("__stop"))

    first, last = F.floor(F.col("__start") / F.lit(B)), F.floor((F.col("__end") - 1) / F.lit(B))
    names = [f"c{i}" for i in range(len(payload))]
    cuts = _text_cuts(fields[0], B) if text_col else _array_cuts(fields, names, B)
    held = [_text_piece().alias("t")] if text_col else [F.col(f"__piece.{n}").alias(n) for n in names]

    def blocks(frame: DataFrame, spanning: bool, on: list[str]) -> DataFrame:
        pieces = _exploded(frame, cuts, B, ["__cell", "__off", "__stop", "__keep"])
        pieces = pieces.where(spans(F.col("block_no")) == F.lit(spanning))
        pieces = pieces if spanning is False else pieces.select("*", *[F.col(f"__cell.{c}").alias(c) for c in parts])
        g = pieces.groupBy(*on).agg(F.array_sort(F.collect_list(F.struct(F.col("__lo").alias("lo"), *held))).alias("__p"))
        return g.select(*[F.col(c if spanning else f"__cell.{c}").alias(c) for c in parts], "block_no", "__p")

    inner = blocks(d, False, ["__cell", "block_no"])  # on the rows' own partitioning
    outer = blocks(d.where(spans(first) | spans(last)), True, [*parts, "block_no"])
    g = inner.unionByName(outer)
    if text_col:
        out = g.select(*parts, "block_no", codepoint_ids(F.array_join(F.transform("__p", lambda p: p["t"]), "")).alias("input_ids"))
        out = out.withColumn(mask, ones_like("input_ids")) if mask else out
    else:
        out = g.select(*parts, "block_no", *[F.flatten(F.transform("__p", _field(n))).alias(c) for n, c in zip(names, payload)])
    return out.withColumn("labels", F.col("input_ids" if text_col else payload[0])) if labels else out


def packing_report(df: DataFrame, block_size: int, rows_per_batch: int = DEFAULT_ROWS_PER_BATCH, *,
                   length=None, index_col: str = "row_idx", split_col: str | None = "split",
                   keep_short: bool = True) -> DataFrame:
    """Per split: rows and tokens in, blocks, tokens kept and dropped, short blocks. Two
    partial aggregations, no window and no packing needed."""
    B = int(block_size)
    n = F.col("input_ids") if length is None else length
    n = F.size(n) if length is None else n
    part = _batch_cols(split_col)
    per_batch = (df.withColumn("batch_id", F.floor(F.col(index_col) / F.lit(int(rows_per_batch))).cast("bigint"))
                   .groupBy(*part).agg(F.count(F.lit(1)).alias("rows"), F.sum(n.cast("bigint")).alias("tokens")))
    T_ = F.col("tokens")
    kept = _kept(T_, B, keep_short)
    blocks = F.when(T_ >= B, F.floor(T_ / F.lit(B))).when((T_ > 0) & F.lit(keep_short), F.lit(1)).otherwise(F.lit(0))
    short = F.when((T_ > 0) & (T_ < B) & F.lit(keep_short), F.lit(1)).otherwise(F.lit(0))
    per_batch = per_batch.select(*part, "rows", "tokens", kept.alias("kept"), blocks.alias("blocks"), short.alias("short"))
    outer = [split_col] if split_col else []
    agg = [F.sum("rows").cast("bigint").alias("rows_in"),
           F.sum("tokens").cast("bigint").alias("tokens_in"),
           F.count(F.lit(1)).cast("bigint").alias("batches"),
           F.sum("blocks").cast("bigint").alias("blocks"),
           F.sum("kept").cast("bigint").alias("tokens_kept"),
           (F.sum("tokens") - F.sum("kept")).cast("bigint").alias("tokens_dropped"),
           F.sum("short").cast("bigint").alias("short_blocks")]
    return per_batch.groupBy(*outer).agg(*agg) if outer else per_batch.agg(*agg)


def pack_corpus_text(df: DataFrame, key, block_size: int, rows_per_batch: int = DEFAULT_ROWS_PER_BATCH, *,
                     text_col: str = "text", percent: float | None = None, keep_short: bool = True,
                     mask: str | None = "attention_mask", labels: bool = True, bucket_key=None,
                     length_col: str | None = None,
                     num_buckets: int | None = None, relative_error: float | None = None) -> DataFrame:
    """Order by ``key`` (a column name or a list of names; unique), cut the first ``percent`` of
    rows off as validation (``None``: everything is train), tokenize (codepoint) and pack —
    moving the text through **one** shuffle. ``bucket_key`` is a numeric column monotone in the
    key (default: the key itself when it is one numeric column), as for ``row_index``.

    The general path (``row_index`` then ``pack_text_blocks``) shuffles the text twice: by key
    bucket for the order, then by batch for the blocks. Here a narrow pass over
    ``(key, length(text))`` first works out, per key bucket, the row and token offsets, the
    batches that straddle a bucket boundary (at most one per boundary) and the key prefix of
    each bucket whose text belongs to a block that starts in an earlier bucket. The text is
    then shuffled once by bucket; those prefix rows (at most about one block of text per
    bucket) are sent to the owning bucket as well. Every block is assembled in the bucket
    where it starts, from rows present in that partition, so the row index, batch offsets,
    pieces and block grouping all run on the one partitioning.

    ``length_col`` names a stored column holding each row's length (characters of the text):
    the pre-pass then reads only the key and that column, so the text is read once in all. The
    main pass checks every stored length against the text and fails on a mismatch.
    """
    return _pack_corpus(df, key, block_size, rows_per_batch, payload=[text_col], text=True, percent=percent,
                        keep_short=keep_short, mask=mask, labels=labels, bucket_key=bucket_key,
                        length_col=length_col, num_buckets=num_buckets, relative_error=relative_error)


def pack_corpus_ids(df: DataFrame, key, block_size: int, rows_per_batch: int = DEFAULT_ROWS_PER_BATCH, *,
                    columns=("input_ids", "attention_mask"), percent: float | None = None,
                    keep_short: bool = True, labels: bool = True, bucket_key=None,
                    length_col: str | None = None,
                    num_buckets: int | None = None, relative_error: float | None = None) -> DataFrame:
    """``pack_corpus_text`` for rows that are already tokenized (array ``columns`` of equal
    length per row, e.g. a stored tokenized corpus): order, split and pack with the arrays
    shuffled once. The narrow pre-pass reads ``size(columns[0])``, or only ``length_col`` (a
    stored token count, checked in the main pass) when given."""
    return _pack_corpus(df, key, block_size, rows_per_batch, payload=list(columns), text=False, percent=percent,
                        keep_short=keep_short, mask=None, labels=labels, bucket_key=bucket_key,
                        length_col=length_col, num_buckets=num_buckets, relative_error=relative_error)


def _pack_corpus(df: DataFrame, key, block_size: int, rows_per_batch: int, *, payload: list, text: bool,
                 percent, keep_short: bool, mask, labels: bool, bucket_key, length_col, num_buckets,
                 relative_error) -> DataFrame:
    from corpusprep.operators.ordering import _bucketize, default_buckets

    B, R = int(block_size), int(rows_per_batch)
    nb = num_buckets or default_buckets(df)
    keys = [key] if isinstance(key, str) else list(key)
    if bucket_key is None:
        if len(keys) != 1:
            raise ValueError("a composite key needs a numeric bucket_key")
        bucket_key = F.col(keys[0])
    # one comparable key value per row: the column itself, or a struct (lexicographic order)
    key_col = F.col(keys[0]) if len(keys) == 1 else F.struct(*[F.col(k) for k in keys])
    fields = [f"__p{i}" for i in range(len(payload))]
    stored = [F.col(length_col).alias("__len")] if length_col else []
    base = df.select(key_col.alias("__key"), bucket_key.alias("__bk"),
                     *[F.col(c).alias(f) for c, f in zip(payload, fields)], *stored)
    based = (_bucketize(base, F.col("__bk"), nb, relative_error)
             .withColumn("__b", F.col("__bucket").cast("int")).drop("__bucket", "__bk"))
    length = F.length(fields[0]) if text else F.size(fields[0])
    n_expr = F.greatest(F.coalesce(length.cast("bigint"), F.lit(0)), F.lit(0))
    if length_col:  # the stored length drives the plan; the main pass checks it row by row
        pre_n = F.greatest(F.coalesce(F.col("__len").cast("bigint"), F.lit(0)), F.lit(0))
        n_expr = F.when(n_expr == pre_n, n_expr).otherwise(
            F.raise_error(F.lit(f"stored length column {length_col!r} does not match the data")))
    else:
        pre_n = n_expr

    # -- narrow pass over (key, bucket, length): about 20 bytes a row, cached (memory, then
    # disk) so the payload is read only here and in the main pass (with ``length_col``: only in
    # the main pass); lost blocks are recomputed.
    narrow = based.select("__key", "__b", pre_n.alias("__n")).persist()
    try:
        return _pack_corpus_body(based, narrow, B, R, percent, keep_short, mask, labels, n_expr,
                                 fields, payload, text)
    finally:
        narrow.unpersist()


def _pack_corpus_body(based: DataFrame, narrow: DataFrame, B: int, R: int, percent, keep_short: bool,
                      mask, labels, n_expr: Column, fields: list, payload: list, text: bool) -> DataFrame:
    # per-bucket totals (partial aggregation, one row per bucket to the driver)
    stats = {r["__b"]: (r["c"], r["t"]) for r in narrow.groupBy("__b").agg(
        F.count(F.lit(1)).alias("c"), F.sum("__n").alias("t")).collect()}
    width = (max(stats) + 1) if stats else 1
    row_off, tok_off, r_acc, t_acc = [], [], 0, 0
    for b in range(width):
        c, t = stats.get(b, (0, 0))
        row_off.append(r_acc)
        tok_off.append(t_acc)
        r_acc, t_acc = r_acc + c, t_acc + (t or 0)
    total_rows = r_acc
    cut = 0 if percent is None else int(round(total_rows * float(percent) / 100.0))  # half-even, like bround

    spark = based.sparkSession
    offsets = spark.createDataFrame([(b, r, t) for b, (r, t) in enumerate(zip(row_off, tok_off))],
                                    "__b int, __ro bigint, __to bigint")  # one row per bucket

    def place(frame: DataFrame, rank: Column, before: Column) -> DataFrame:
        frame = frame.withColumn("__rank", rank).withColumn("__before", before)
        frame = frame.join(F.broadcast(offsets), "__b")
        g = F.col("__ro") + F.col("__rank")
        G = F.col("__to") + F.col("__before")
        split = F.when(g < F.lit(cut), F.lit("validation")).otherwise(F.lit("train"))
        row_idx = F.when(g < F.lit(cut), g).otherwise(g - F.lit(cut))
        return (frame.withColumn("__G", G.cast("bigint")).withColumn("split", split)
                .withColumn("batch_id", F.floor(row_idx / F.lit(R)).cast("bigint")).drop("__rank", "__before", "__ro", "__to"))

    # owner bucket of a global token position: the bucket whose token range holds it
    nonempty = [b for b in range(width) if stats.get(b, (0, 0))[1]]
    owner_splits = [float("-inf")] + [float(tok_off[b]) for b in nonempty[1:]] + [float("inf")]

    owners = spark.createDataFrame([(float(i), b) for i, b in enumerate(nonempty)], "__oi double, __owner int")

    def with_owner(frame: DataFrame) -> DataFrame:
        pos = (F.col("__S") + F.col("block_no") * F.lit(B)).cast("double")
        if len(owner_splits) < 3:
            return frame.withColumn("__owner", F.lit(nonempty[0] if nonempty else 0))
        b = Bucketizer(splits=owner_splits, inputCol="__pos", outputCol="__oi")
        out = b.transform(frame.withColumn("__pos", pos))
        return out.join(F.broadcast(owners), "__oi").drop("__pos", "__oi")

    def kept_part(frame: DataFrame) -> DataFrame:
        keep = _kept(F.col("__E") - F.col("__S"), B, keep_short)
        return (frame.withColumn("__start", F.col("__G") - F.col("__S")).withColumn("__keep", keep)
                .withColumn("__end", F.least(F.col("__start") + F.col("__n"), F.col("__keep")))
                .where(F.col("__end") > F.col("__start")))

    def touched(frame: DataFrame) -> DataFrame:
        """The blocks each (narrow) row gives tokens to."""
        d = kept_part(frame)
        first = F.floor(F.col("__start") / F.lit(B)).cast("bigint")
        last = F.floor((F.col("__end") - 1) / F.lit(B)).cast("bigint")
        return with_owner(d.withColumn("block_no", F.explode(F.sequence(first, last))))

    w_bucket = Window.partitionBy("__b").orderBy("__key")
    before = F.coalesce(F.sum("__n").over(w_bucket.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    nr = place(narrow, F.row_number().over(w_bucket) - 1, before)
    w_batch = Window.partitionBy("split", "batch_id")
    nr = (nr.withColumn("__S", F.min("__G").over(w_batch))
            .withColumn("__E", F.max(F.col("__G") + F.col("__n")).over(w_batch))
            .withColumn("__bmin", F.min("__b").over(w_batch))
            .withColumn("__bmax", F.max("__b").over(w_batch)))
    # One small job for both driver-side tables (both branches read the cached narrow frame):
    # batches that cross a bucket boundary (at most one per boundary), and per bucket the key
    # prefix that continues a block owned by an earlier bucket.
    key_type = narrow.schema["__key"].dataType
    edge_rows = (nr.where(F.col("__bmin") != F.col("__bmax"))
                 .select(F.lit("edge").alias("kind"), "split", "batch_id", "__S", "__E",
                         F.lit(None).cast("int").alias("__b"), F.lit(None).cast(key_type).alias("k"),
                         F.lit(None).cast("int").alias("o"), F.lit(None).cast("bigint").alias("no"))
                 .distinct())
    halo_rows = (touched(nr).where(F.col("__owner") != F.col("__b")).groupBy("__b")
                 .agg(F.max("__key").alias("k"), F.min("__owner").cast("int").alias("o"),
                      F.countDistinct("__owner").alias("no"))
                 .select(F.lit("halo").alias("kind"), F.lit(None).cast("string").alias("split"),
                         F.lit(None).cast("bigint").alias("batch_id"), F.lit(None).cast("bigint").alias("__S"),
                         F.lit(None).cast("bigint").alias("__E"), "__b", "k", "o", "no"))
    small = edge_rows.unionByName(halo_rows).collect()  # at most two rows per bucket
    edges = [(r["split"], r["batch_id"], r["__S"], r["__E"]) for r in small if r["kind"] == "edge"]
    halo = {r["__b"]: (r["k"], r["o"], r["no"]) for r in small if r["kind"] == "halo"}
    if any(v[2] > 1 for v in halo.values()):
        raise AssertionError("a bucket continues blocks of more than one earlier bucket")
    # -- main pass: the text crosses the network once, partitioned by destination bucket
    halo_df = spark.createDataFrame(  # one row per bucket at most: a bounded broadcast
        [(b, k, o) for b, (k, o, _n) in halo.items()],
        T.StructType([T.StructField("__b", T.IntegerType()), T.StructField("__klim", key_type),
                      T.StructField("__hown", T.IntegerType())]))
    dests = F.when(F.col("__klim").isNotNull() & (F.col("__key") <= F.col("__klim")),
                   F.array(F.col("__b"), F.col("__hown"))).otherwise(F.array(F.col("__b")))
    main = (based.join(F.broadcast(halo_df), on="__b", how="left")
            .withColumn("__n", n_expr)
            .withColumn("__dest", F.explode(dests)).drop("__klim", "__hown").repartition("__dest"))
    w_src = Window.partitionBy("__dest", "__b").orderBy("__key")
    before_m = F.coalesce(F.sum("__n").over(w_src.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    m = place(main, F.row_number().over(w_src) - 1, before_m)
    w_local = Window.partitionBy("__dest", "split", "batch_id")
    m = m.withColumn("__Sl", F.min("__G").over(w_local)).withColumn("__El", F.max(F.col("__G") + F.col("__n")).over(w_local))
    edge_df = spark.createDataFrame(edges or [], "split string, batch_id bigint, __Se bigint, __Ee bigint")
    m = m.join(F.broadcast(edge_df), on=["split", "batch_id"], how="left")  # <= one row per bucket boundary
    m = m.withColumn("__S", F.coalesce("__Se", "__Sl")).withColumn("__E", F.coalesce("__Ee", "__El"))
    names = [f"c{i}" for i in range(len(fields))]
    cuts = _text_cuts(fields[0], B) if text else _array_cuts(fields, names, B)
    p = _exploded(kept_part(m), cuts, B, ["__dest", "split", "batch_id", "__S"])
    p = with_owner(p).where(F.col("__owner") == F.col("__dest"))
    parts = [_text_piece().alias("t")] if text else [F.col(f"__piece.{n}").alias(n) for n in names]
    piece = F.struct(F.col("__lo").alias("lo"), *parts)
    g = p.groupBy("__dest", "split", "batch_id", "block_no").agg(F.array_sort(F.collect_list(piece)).alias("__p"))
    if text:
        out = g.select("split", "batch_id", "block_no",
                       codepoint_ids(F.array_join(F.transform("__p", lambda q: q["t"]), "")).alias("input_ids"))
        if mask:
            out = out.withColumn(mask, ones_like("input_ids"))
        first_col = "input_ids"
    else:
        out = g.select("split", "batch_id", "block_no",
                       *[F.flatten(F.transform("__p", _field(n))).alias(c) for n, c in zip(names, payload)])
        first_col = payload[0]
    if labels:
        out = out.withColumn("labels", F.col(first_col))
    return out
