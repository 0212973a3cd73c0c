"""Operator 4: packing by Karmarkar-Karp multiway differencing.

Each document is tokenized whole and closed by an end id. Every full window of ``capacity`` ids
becomes a sequence of its own; what is left over is cut into items of at most ``capacity / 4`` ids.
Items are gathered into groups of about ``windows`` sequences and partitioned by differencing: each item starts
as a partial partition with one non-empty window; the two partial partitions with the largest
imbalance are merged largest-with-smallest, which cancels their imbalances, until one is left. If any
window of it exceeds the capacity, the number of windows rises by one and the group is partitioned anew.

Groups are made within a scan task, so nothing is shuffled and memory is bounded by one group and
one document. The same input partitions give the same pieces, so a lost executor's tasks can be run again.

Null text is empty: such a document is its end id alone. Rows with equal or null ids are separate documents.
Input columns other than id and text are not carried. Empty table: empty result."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vocabulary import default_vocabulary, encoded


def differencing(sizes: list[int], windows: int) -> tuple[np.ndarray, int]:
    """(window of each item, largest window sum) of a ``windows``-way partition of ``sizes``."""
    heap, trees = [], []
    for i, size in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[0] = size
        heap.append((-size, i, sums))
        trees.append(None)
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)
        _, b, y = heap[0]
        sums = x + y[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        trees.append((a, b, order))
        heapq.heapreplace(heap, (int(sums[-1] - sums[0]), len(trees) - 1, sums))
    label = np.zeros(len(sizes), np.int64)
    todo = [(heap[0][1], np.arange(windows))]
    while todo:
        node, names = todo.pop()
        if trees[node] is None:
            label[node] = names[0]
            continue
        a, b, order = trees[node]
        inner = np.empty_like(names)
        inner[order] = names
        todo += [(a, inner), (b, inner[::-1])]
    return label, int(heap[0][2][0])


def balanced_windows(sizes: list[int], capacity: int) -> tuple[np.ndarray, int]:
    """(window of each item, number of windows), the number raised while a window is too full."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        label, most = differencing(sizes, windows)
        if most <= capacity:
            return label, windows
        windows += 1


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = 1024, end_id: int = 0,
                   windows: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, ``start`` (the document's ids before it), ``length``, ``ids`` (little-endian unsigned 32-bit
    ids), ``doc_tokens``, ``sequence_id`` and ``offset`` in the sequence."""
    path = vocabulary or default_vocabulary()
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    piece = max(1, capacity // 4)
    end = np.array([end_id], "<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 32
        names = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

        def rows(found: list, id_type: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*found)) or [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), *(pa.array(c, t) for c, t in zip(columns[1:], types))], [id_col, *names])

        def packed(items: list, first: int) -> tuple[list, int]:
            label, n = balanced_windows([len(i[2]) // 4 for i in items], capacity)
            at = [0] * n
            out = []
            for (doc, start, ids, total), w in zip(items, label.tolist()):
                out.append((doc, start, len(ids) // 4, ids, total, first + w, at[w]))
                at[w] += len(ids) // 4
            return out, first + n

        items, held, id_type = [], 0, None
        for batch in batches:
            id_type = batch.schema.field(0).type
            found = []
            for doc, ids in encoded(batch, path):
                ids += end
                total = len(ids) // 4
                whole = total - total % capacity
                for start in range(0, whole, capacity):
                    found.append((doc, start, capacity, ids[4 * start: 4 * (start + capacity)], total, sequence, 0))
                    sequence += 1
                for start in range(whole, total, piece):
                    items.append((doc, start, ids[4 * start: 4 * min(start + piece, total)], total))
                held += total - whole
                if held >= windows * capacity:
                    more, sequence = packed(items, sequence)
                    found += more
                    items, held = [], 0
                if len(found) >= 4000:
                    yield rows(found, id_type)
                    found = []
            yield rows(found, id_type)
        if items:
            yield rows(packed(items, sequence)[0], id_type)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(pack, schema)
