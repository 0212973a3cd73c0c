"""Row-wise preparation over folders that keep receiving files (10.1).

The row-wise steps (instruction formatting, chat formatting on nested input, preference
wrapping and filtering, transcript splitting) are stateless column expressions, so the same
functions run on a ``readStream`` file source; results go to a parquet sink with a checkpoint
(exactly-once file sink). Packing needs whole row batches: ``pack_stream`` packs each
micro-batch on its own (the micro-batch takes the place of the row batch) in ``foreachBatch``
and writes it to a folder named by the batch id, with overwrite, so a replayed micro-batch
replaces its own output instead of adding duplicates.

``pack_numbered_stream`` carries open row batches over micro-batches in Spark's state store, so its blocks do not
depend on which files arrive together or in which order.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpusprep.constants import DEFAULT_BLOCK_SIZE, DEFAULT_ROWS_PER_BATCH
from corpusprep.sources.files import TEXT_SCHEMA, with_file_position


def read_stream(spark: SparkSession, directory: str, schema: T.StructType, *, fmt: str = "json",
                max_files_per_trigger: int | None = None, options: dict | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(directory)


def prepare_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str,
                   transform: Callable[[DataFrame], DataFrame], schema: T.StructType, *,
                   fmt: str = "json", available_now: bool = True, max_files_per_trigger: int | None = None,
                   options: dict | None = None) -> StreamingQuery:
    """Apply a row-wise ``transform`` (e.g. ``format_instructions``) to every new file and
    append the result to parquet at ``out_dir``. ``available_now`` processes what is there
    and stops; otherwise the query keeps running."""
    src = read_stream(spark, in_dir, schema, fmt=fmt, max_files_per_trigger=max_files_per_trigger, options=options)
    writer = (transform(src).writeStream.format("parquet").option("checkpointLocation", checkpoint)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start(out_dir)


def pack_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, *,
                block_size: int = DEFAULT_BLOCK_SIZE, rows_per_batch: int = DEFAULT_ROWS_PER_BATCH,
                schema: T.StructType = TEXT_SCHEMA, text_col: str = "text", fmt: str = "json",
                available_now: bool = True, max_files_per_trigger: int | None = 1000,
                strategy: str = "two_shuffle") -> StreamingQuery:
    """Tokenize (codepoint) and pack each micro-batch: rows in file order, batches of
    ``rows_per_batch``, blocks of ``block_size``. Output columns as ``pack_text_blocks`` plus
    ``stream_batch`` (the micro-batch id). ``strategy`` as for ``pretrain_blocks``. Row batches
    start anew in every micro-batch, so blocks depend on which files arrive together."""
    from corpusprep.operators.ordering import row_index
    from corpusprep.operators.packing import pack_corpus_text, pack_text_blocks

    src = read_stream(spark, in_dir, schema, fmt=fmt, max_files_per_trigger=max_files_per_trigger)
    src = src.select(text_col, F.col("_metadata.file_path").alias("__file"),
                     F.col("_metadata.file_block_start").alias("__block"),
                     F.col("_metadata.file_size").alias("__size"))
    order = ["file_rank", "file_block", "file_row"]

    def pack(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read twice: the file list of this micro-batch, then the rows
        try:
            listed = batch.select("__file", "__size").distinct().collect()  # <= files per trigger
            files = sorted(r[0] for r in listed)
            if not files:
                return
            rows = with_file_position(batch.drop("__size"), files, path_col="__file", block_col="__block")
            if strategy == "one_shuffle":
                blocks = pack_corpus_text(rows, order, block_size, rows_per_batch, text_col=text_col,
                                          bucket_key=F.col("file_pos")).drop("split")
            else:
                rows = row_index(rows, order, bucket_key=F.col("file_pos"))
                blocks = pack_text_blocks(rows.select("row_idx", text_col), block_size, rows_per_batch,
                                          text_col=text_col, split_col=None)
            blocks.withColumn("stream_batch", F.lit(batch_id).cast("bigint")) \
                .write.mode("overwrite").parquet(f"{out_dir}/stream_batch={batch_id}")
        finally:
            batch.unpersist()

    writer = src.writeStream.foreachBatch(pack).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


class OpenBatch:
    """An open row batch: rows are taken in place order, full blocks are cut off at once. What is left is less than a block of
    text, and rows that came before their predecessors."""

    def __init__(self, block_size: int, taken: int = 0, blocks: int = 0, rest: str = "", waiting: str = "{}"):
        self.block_size, self.taken, self.blocks, self.rest = block_size, taken, blocks, rest
        self.waiting: dict[int, str] = {int(k): v for k, v in json.loads(waiting).items()}

    def state(self) -> tuple:
        return self.taken, self.blocks, self.rest, json.dumps(self.waiting)

    def add(self, rows: list[tuple[int, str | None]]) -> list[tuple[int, str]]:
        """The (number, text) of the blocks that these (place, text) rows complete. A place that was taken before is a repeat."""
        self.waiting.update((place, text or "") for place, text in rows if place >= self.taken)
        ready = [self.rest]
        while self.taken in self.waiting:
            ready.append(self.waiting.pop(self.taken))
            self.taken += 1
        text, size = "".join(ready), self.block_size
        full = len(text) // size
        self.rest = text[full * size:]
        out = [(self.blocks + i, text[i * size: (i + 1) * size]) for i in range(full)]
        self.blocks += full
        return out

    def close(self, keep_short: bool) -> list[tuple[int, str]]:
        """The short block of a batch that has no full one; any other remainder is dropped."""
        return [(0, self.rest)] if keep_short and not self.blocks and self.rest else []


_OPEN_STATE = T.StructType([T.StructField("taken", T.LongType()), T.StructField("blocks", T.LongType()),
                            T.StructField("rest", T.StringType()), T.StructField("waiting", T.StringType())])


def _numbered_blocks(pieces: DataFrame, keys: list[str]) -> DataFrame:
    from corpusprep.functions.tokens import codepoint_ids, ones_like

    ids = codepoint_ids("__block")
    return pieces.select(*keys, "batch_id", "block_no", ids.alias("input_ids")).withColumn("attention_mask", ones_like("input_ids")) \
        .withColumn("labels", F.col("input_ids"))


def pack_numbered(rows: DataFrame, block_size: int = DEFAULT_BLOCK_SIZE, rows_per_batch: int = DEFAULT_ROWS_PER_BATCH, *,
                  index_col: str = "row_idx", split_col: str | None = None, text_col: str = "text", keep_short: bool = True) -> DataFrame:
    """Streaming ``pack_text_blocks`` of numbered rows (``index_col``: the dense position, per split if there is one): the same
    blocks, each as soon as its last row has come, whatever the order of arrival and the cut into micro-batches.

    The state store holds one entry per open row batch, keyed by split and batch: places taken, blocks given out, less than
    a block of text, and rows that came early. A batch's entry goes with its last row. Rows of NULL position are left out; a NULL
    text is a row without tokens; a row that comes twice counts once. Batches that never fill stay open: see ``open_batches``."""
    keys = [split_col] if split_col else []
    kinds = [rows.schema[k] for k in keys]
    out = T.StructType([*kinds, T.StructField("batch_id", T.LongType()), T.StructField("block_no", T.LongType()), T.StructField("__block", T.StringType())])
    names = out.names
    d = rows.where(F.col(index_col).isNotNull()).select(
        *keys, F.floor(F.col(index_col) / F.lit(int(rows_per_batch))).cast("bigint").alias("batch_id"),
        (F.col(index_col) % F.lit(int(rows_per_batch))).cast("bigint").alias("__place"), F.col(text_col).alias("__text"))

    def pack(key: tuple, frames: Iterator, state) -> Iterator:
        import pandas as pd

        batch = OpenBatch(block_size, *(state.get if state.exists else ()))
        found = []
        for frame in frames:
            found += batch.add([(int(p), t if isinstance(t, str) else None) for p, t in zip(frame["__place"], frame["__text"])])
        if batch.taken == rows_per_batch:
            found += batch.close(keep_short)
            state.remove()
        else:
            state.update(batch.state())
        yield pd.DataFrame([(*key, *block) for block in found], columns=names)

    blocks = d.groupBy(*keys, "batch_id").applyInPandasWithState(pack, out, _OPEN_STATE, "append", "NoTimeout")
    return _numbered_blocks(blocks, keys)


def pack_numbered_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, *,
                         block_size: int = DEFAULT_BLOCK_SIZE, rows_per_batch: int = DEFAULT_ROWS_PER_BATCH,
                         schema: T.StructType, index_col: str = "row_idx", split_col: str | None = None, text_col: str = "text",
                         keep_short: bool = True, fmt: str = "json", available_now: bool = True,
                         max_files_per_trigger: int | None = 1000) -> StreamingQuery:
    """``pack_numbered`` over a folder that keeps receiving files of numbered rows, into a parquet sink. After a restart
    the open batches come back from the checkpoint's state."""
    src = read_stream(spark, in_dir, schema, fmt=fmt, max_files_per_trigger=max_files_per_trigger)
    blocks = pack_numbered(src, block_size, rows_per_batch, index_col=index_col, split_col=split_col, text_col=text_col, keep_short=keep_short)
    writer = blocks.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start(out_dir)


def open_batches(spark: SparkSession, checkpoint: str, block_size: int = DEFAULT_BLOCK_SIZE, *, split_col: str | None = None) -> DataFrame:
    """The row batches that a ``pack_numbered_stream`` at ``checkpoint`` has not closed, read from its state store: ``[split],
    batch_id, n_rows`` (taken so far), ``n_blocks``, ``n_left`` (tokens left), ``n_early`` (rows that wait for a predecessor), and ``labels``
    etc. of the short block that a batch without a full one gives if no further row comes (NULL otherwise)."""
    keys = [split_col] if split_col else []
    state = spark.read.format("statestore").load(checkpoint)
    value = "value.groupState" if "groupState" in state.schema["value"].dataType.names else "value"
    d = state.select(*[F.col(f"key.{k}").alias(k) for k in keys], F.col("key.batch_id").alias("batch_id"), f"{value}.*")
    short = (F.col("blocks") == 0) & (F.length("rest") > 0)
    d = d.select(*keys, "batch_id", F.col("taken").alias("n_rows"), F.col("blocks").alias("n_blocks"), F.length("rest").cast("bigint").alias("n_left"),
                 F.size(F.map_keys(F.from_json("waiting", "map<string,string>"))).cast("bigint").alias("n_early"),
                 F.lit(0).cast("bigint").alias("block_no"), F.when(short, F.col("rest")).alias("__block"))
    packed = _numbered_blocks(d, [*keys, "n_rows", "n_blocks", "n_left", "n_early"])
    empty = F.col("n_blocks").isNull() | (F.col("n_blocks") > 0) | (F.col("n_left") == 0)
    return packed.select(*keys, "batch_id", "n_rows", "n_blocks", "n_left", "n_early", "block_no",
                         *[F.when(~empty, F.col(c)).alias(c) for c in ("input_ids", "attention_mask", "labels")])
