"""Operator 9: token ids in Re-Pair compressed shard files, read back with random access.

Documents are range-partitioned by id; each partition is a shard, written in ascending id order as
blocks of whole documents. In a block the most frequent pairs of neighbouring symbols are replaced by
new nonterminals, round after round, until no pair occurs ``min_count`` times; the first round
takes pairs at least an eighth as frequent as the most frequent one, each later one pairs a quarter as frequent as the last. A block keeps its rules
(left, right), the first nonterminal of each round, every nonterminal's expansion length and the
remaining sequence, so any range of ids is found by summing lengths and decoded alone.

The files are Parquet tables of binary blocks below the given path: every store Spark reaches will do, and failed tasks are simply
written again. Null text is empty; rows with equal ids are neighbours, ordered by a hash of their
text; null ids come first. Input columns other than id and text are not carried. Empty table: no blocks, empty result."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .vocabulary import default_vocabulary, encoded

_TABLE_BITS = 20


def grouped(pairs: np.ndarray, bucket: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that brings equal pairs together, first of each pair in it) of the pairs in the hot buckets."""
    buckets = np.flatnonzero(hot)
    if len(buckets) > 1 << 16:
        by = np.argsort(pairs, kind="stable")
    else:  # few buckets, of 16 bits: sorted by counting; only those that hold several pairs are sorted by pair
        number = np.zeros(len(hot), np.uint16)
        number[buckets] = np.arange(len(buckets))
        code = number[bucket]
        by = np.argsort(code, kind="stable")
        code, found = code[by], pairs[by]
        mixed = np.zeros(len(buckets), bool)
        mixed[code[1:][(found[1:] != found[:-1]) & (code[1:] == code[:-1])]] = True
        if mixed.any():
            at = np.flatnonzero(mixed[code])
            by[at] = by[at][np.lexsort((found[at], code[at]))]
    found = pairs[by]
    return by, np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(by) else np.zeros(0, np.int64)


def compress(ids: np.ndarray, min_count: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rules [left, right], first nonterminal of each round, expansion lengths, sequence) of an
    array of unsigned 32-bit ids. Nonterminals are numbered from the largest id + 1 on."""
    seq = ids.astype(np.uint32)
    base = symbol = int(seq.max()) + 1 if len(seq) else 0
    rules, rounds, lengths = [], [], [np.zeros(0, np.int64)]
    limit = None
    while len(seq) > 1 and symbol < 2**32 - len(seq):
        left, right = seq[:-1], seq[1:]
        # exact counts of the pairs whose hash bucket could hold a frequent one
        bucket = (((left * np.uint32(0x9E3779B1) ^ right) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - _TABLE_BITS)).astype(np.intp)
        in_bucket = np.bincount(bucket, minlength=1 << _TABLE_BITS)
        limit = max(min_count, int(in_bucket.max()) // 8) if limit is None else max(min_count, limit // 4)
        hot = in_bucket >= limit
        at = np.flatnonzero(hot[bucket])
        pairs = left[at].astype(np.uint64) << np.uint64(32) | right[at]
        by, first = grouped(pairs, bucket[at], hot)
        counts = np.diff(np.append(first, len(at)))
        taken = counts >= limit
        if not taken.any():
            if limit <= min_count:
                break
            continue
        which = np.empty(len(at), np.int64)  # the rule of each place, or -1
        pair = pairs[by[first[taken]]]
        number = np.full(len(first), -1)
        number[np.flatnonzero(taken)[np.argsort(pair)]] = np.arange(len(pair))
        which[by] = np.repeat(number, counts)
        at, which = at[which >= 0], which[which >= 0]
        # of overlapping occurrences every second one of a run is replaced, from its left end
        run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        even = (at - np.repeat(at[run], np.diff(np.append(run, len(at))))) & 1 == 0
        at, which = at[even], which[even]
        pair.sort()
        rule = np.stack([pair >> np.uint64(32), pair & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
        new, kept = seq.copy(), np.ones(len(seq), bool)
        new[at] = which.astype(np.uint32) + np.uint32(symbol)
        kept[at + 1] = False
        seq = new[kept]
        known = np.concatenate(lengths)
        size = lambda s: np.where(s < base, 1, known[np.where(s < base, 0, s.astype(np.int64) - base)] if len(known) else 1)
        lengths.append(size(rule[:, 0]) + size(rule[:, 1]))
        rules.append(rule)
        rounds.append(symbol)
        symbol += len(rule)
    return (np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), np.array([base, *rounds], np.uint32),
            np.concatenate(lengths), seq)


def expand(rules: np.ndarray, rounds: np.ndarray, seq: np.ndarray) -> np.ndarray:
    """The ids of a sequence: the rounds undone from the last to the first."""
    base = int(rounds[0])
    for first in rounds[:0:-1].tolist():
        inner = seq >= first
        rule = rules[seq[inner].astype(np.int64) - base]
        at = np.flatnonzero(inner) + np.arange(len(rule))
        out, first_of = np.empty(len(seq) + len(rule), seq.dtype), np.ones(len(seq) + len(rule), bool)
        first_of[at + 1] = False
        out[first_of] = seq
        out[at], out[at + 1] = rule[:, 0], rule[:, 1]
        seq = out
    return seq


def expand_range(rules: np.ndarray, rounds: np.ndarray, lengths: np.ndarray, seq: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Ids ``start:stop`` alone: only the symbols that cover the range are expanded."""
    base = int(rounds[0])
    size = np.ones(len(seq), np.int64)
    inner = seq >= base
    size[inner] = lengths[seq[inner].astype(np.int64) - base]
    ends = np.cumsum(size)
    a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
    return expand(rules, rounds, seq[a:b])[start - (ends[a - 1] if a else 0):][: max(stop - start, 0)]


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 0, shards: int | None = None,
                      block_tokens: int = 1 << 21, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the shards of ``docs`` to ``path``; ``shards`` defaults to the session's shuffle partitions."""
    spark = docs.sparkSession
    vocabulary = vocabulary or default_vocabulary()
    kind = docs.schema[id_col].dataType.simpleString()
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    end = np.array([end_id], "<u4").tobytes()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        names, held, size, before = [], [], 0, 0

        def block(id_type: pa.DataType) -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            rules, rounds, lengths, seq = compress(ids)
            columns = [pa.array([shard], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()),
                       pa.array([names], pa.list_(id_type)), pa.array([[len(h) // 4 for h in held]], pa.list_(pa.int64())),
                       *(pa.array([x.astype(t).tobytes()], pa.binary()) for x, t in ((rules, "<u4"), (rounds, "<u4"), (lengths, "<i8"), (seq, "<u4")))]
            return pa.RecordBatch.from_arrays(columns, ["shard", "before", "n_ids", "docs", "n_tokens", "rules", "rounds", "lengths", "sequence"])

        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc, ids in encoded(batch, vocabulary):
                ids += end
                if held and size + len(ids) // 4 > block_tokens:
                    yield block(id_type)
                    names, held, size, before = [], [], 0, before + size
                names.append(doc)
                held.append(ids)
                size += len(ids) // 4
        if held:
            yield block(id_type)

    ordered = docs.select(F.col(id_col), F.col(text_col), F.xxhash64(text_col).alias("_tie"))
    ordered = ordered.repartitionByRange(shards, id_col, "_tie").sortWithinPartitions(id_col, "_tie").drop("_tie")
    ordered.mapInArrow(blocks, f"shard int, before bigint, n_ids bigint, docs array<{kind}>, n_tokens array<bigint>, "
                               "rules binary, rounds binary, lengths binary, sequence binary").write.parquet(path)


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per document, from the files: id, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids`` (little-endian unsigned 32-bit)."""
    blocks = spark.read.parquet(path)
    kind = blocks.schema["docs"].dataType.elementType.simpleString()
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # one row per shard
    bases = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                r = {n: batch.column(i)[row] for i, n in enumerate(batch.schema.names)}
                sizes = np.array(r["n_tokens"].as_py(), np.int64)
                rules, rounds, seq = (np.frombuffer(r[k].as_buffer(), "<u4") for k in ("rules", "rounds", "sequence"))
                ids = expand(rules.reshape(-1, 2), rounds, seq).astype("<u4")
                ends = np.cumsum(sizes)
                for a in range(0, len(sizes), 2000):
                    b = min(a + 2000, len(sizes))
                    first = int(ends[a] - sizes[a])
                    cuts = (4 * (np.append(first, ends[a:b]) - first)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [r["docs"].values.slice(a, b - a), pa.array(ends[a:b] - sizes[a:b] + r["start"].as_py()), pa.array(sizes[a:b]),
                         pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(cuts), pa.py_buffer(ids[first: ends[b - 1]])])],
                        [id_col, "start", "n_tokens", "ids"])

    placed = blocks.join(F.broadcast(bases), "shard")  # a row per shard: as many as partitions were written
    return placed.select((F.col("base") + F.col("before")).alias("start"), "docs", "n_tokens", "rules", "rounds", "sequence").mapInArrow(
        decode, f"`{id_col}` {kind}, start bigint, n_tokens bigint, ids binary")
