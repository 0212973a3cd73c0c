"""Operator 2: near-duplicate vectors by collision-counting projections.

Unit vectors are projected onto many random lines. Groups of ``k`` projections, cut into intervals, form
``tables`` sorted orders of cells; two vectors are compared only where they share a cell. For such a pair the
query-centred window collisions are counted over 64 projections (how often the two lie within half an interval
of one another), and pairs with at least the calibrated count are verified by their cosine in double precision. Both numbers follow
from the normal law of projections at the threshold: ``tables`` so that a pair at exactly the
threshold shares a cell with probability ``recall``, the count so that it passes with probability 0.9999. (A single global
sort per line has windows that hold a constant share of all vectors, so counting there is quadratic.)

Equal vectors are one vector with a weight. Cells of more than ``block`` vectors are split into blocks, and pairs of blocks are
separate groups, so no task holds a whole hot cell and every pair still meets. A pair that shares several
cells counts in the first table only; links are summed per vector, and each group sends one link per vector towards
a spanning forest, never its pairs.

Null vectors, and those that are zero, empty or hold null or non-finite components, link with nothing. Vectors of
different lengths are never linked. Rows with equal ids are separate vectors with one component; a null id links like any other
but is named by no component. Input columns other than id and vector are not carried. Empty table: empty result."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import mix, stored
from .components import components

COUNTED = 64


def _within(width: float, sigma: float) -> float:
    return math.erf(width / sigma / math.sqrt(2))


def _same_interval(width: float, sigma: float) -> float:
    r = width / sigma
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def calibrate(threshold: float, recall: float, k: int, width: float) -> tuple[int, int]:
    """(tables, least count) for pairs at the threshold."""
    sigma = math.sqrt(max(2 - 2 * threshold, 1e-12))
    share = _same_interval(width, sigma) ** k
    tables = 1 if share >= recall else math.ceil(math.log(1 - recall) / math.log(1 - share))
    p, tail, least = _within(width / 2, sigma), 0.0, 0
    for hits in range(COUNTED + 1):
        tail += math.comb(COUNTED, hits) * p**hits * (1 - p) ** (COUNTED - hits)
        if tail > 1e-4:
            least = hits
            break
    return tables, least


class Lines:
    """The random lines for vectors of one length: the same on every worker."""

    def __init__(self, size: int, tables: int, k: int, width: float):
        rng = np.random.default_rng([20240229, size])
        self.counted = rng.standard_normal((size, COUNTED))
        self.sorted = rng.standard_normal((size, tables * k))
        self.shift = rng.random(tables * k) * width
        self.tables, self.k, self.width = tables, k, width
        self.odd = mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
        self.salt = mix(np.arange(tables, dtype=np.uint64) + np.uint64(1000 * size))

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """[vector, table]: the cell, a 64-bit name of the intervals of the table's lines."""
        at = np.floor((unit @ self.sorted + self.shift) / self.width).astype(np.int64).view(np.uint64)
        return mix((at.reshape(len(unit), self.tables, self.k) * self.odd).sum(2, dtype=np.uint64) + self.salt)


def near_vectors(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.999, k: int = 8, width: float = 1.8,
                 block: int = 2048, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row: id, ``n_links`` (other rows linked directly), ``component_id`` and ``kept``."""
    tables, least = calibrate(threshold, recall, k, width)
    wide = isinstance(vectors.schema[vector_col].dataType.elementType, DoubleType)
    kind = "<f8" if wide else "<f4"
    usable = (F.size(vector_col) > 0) & F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists(vector_col, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.when(usable, F.col(vector_col)).alias("vector"))
    rows = rows.withColumns({"k1": F.when(F.col("vector").isNotNull(), F.xxhash64("vector")),
                             "k2": F.when(F.col("vector").isNotNull(), F.xxhash64("vector", F.lit(1)))})
    single = rows.where("vector IS NOT NULL").groupBy("k1", "k2").agg(
        F.first("vector").alias("vector"), F.count("*").alias("weight"), F.min("id").alias("least"))
    # a dense enough name per distinct vector: its two hashes folded
    single = stored(single.select(F.xxhash64("k1", "k2").alias("name"), "k1", "k2", "vector", "weight", "least"), "vectors")
    lines: dict[int, Lines] = {}

    def lines_for(size: int) -> Lines:
        if size not in lines:
            lines[size] = Lines(size, tables, k, width)
        return lines[size]

    def placed(with_vector: bool):
        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = batch.column(1)
                sizes = np.diff(column.offsets.to_numpy())
                flat = column.flatten().to_numpy(zero_copy_only=False)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                for size in np.unique(sizes).tolist():
                    which = np.flatnonzero(sizes == size)
                    raw = np.stack([flat[ends[i]: ends[i + 1]] for i in which])
                    cells = lines_for(size).cells(_unit(raw))
                    count = len(which)
                    for a in range(0, count, 1000):
                        part = which[a: a + 1000]
                        order = pa.array(np.repeat(part, tables))
                        out = [pa.array(np.tile(np.arange(tables, dtype=np.int32), len(part))), pa.array(cells[a: a + 1000].ravel().view(np.int64))]
                        if with_vector:
                            blobs = pa.array([v.tobytes() for v in raw[a: a + 1000].astype(kind)], pa.binary())
                            out += [batch.column(0).take(order), batch.column(2).take(order), blobs.take(pa.array(np.repeat(np.arange(len(part)), tables)))]
                        yield pa.RecordBatch.from_arrays(out, ["t", "cell", "name", "weight", "vector"][: len(out)])
        return place

    source = single.select("name", "vector", "weight")
    large = source.mapInArrow(placed(False), "t int, cell bigint").groupBy("t", "cell").count().where(F.col("count") > block)
    members = source.mapInArrow(placed(True), "t int, cell bigint, name bigint, weight bigint, vector binary")
    members = members.join(large, ["t", "cell"], "left").withColumn("blocks", F.ceil(F.coalesce("count", F.lit(1)) / block).cast("int"))
    members = members.withColumn("own", F.pmod("name", "blocks").cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select("t", "cell", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "name", "weight", "vector")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            keys = [batch.column(i).to_numpy() for i in range(4)]
            if not batch.num_rows:
                continue
            new = np.flatnonzero(np.any([np.diff(x) != 0 for x in keys], 0)) + 1
            last = int(new[-1]) if len(new) else 0
            first = batch.slice(0, 1)
            if held and any(held[-1].column(i)[held[-1].num_rows - 1] != first.column(i)[0] for i in range(4)):
                yield from _links(held, kind, lines_for, threshold, least)
                held = []
            if last:
                held.append(batch.slice(0, last))
                yield from _links(held, kind, lines_for, threshold, least)
                held = []
            held.append(batch.slice(last))
        if held:
            yield from _links(held, kind, lines_for, threshold, least)

    keys = ["t", "cell", "a", "b"]
    links = stored(members.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        compare, "name bigint, n bigint, root bigint"), "vector-links")
    counts = links.groupBy("name").agg(F.sum("n").alias("n"))
    found = components(links.select(F.col("name").alias("a"), F.col("root").alias("b")))
    # components are named by the least id of their rows, not by the folded hash
    joined = single.join(found.withColumnRenamed("id", "name"), "name", "left").join(counts, "name", "left")
    joined = joined.withColumn("component", F.coalesce("component", "name"))
    names = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    by_vector = joined.join(names, "component").select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"), "component_id")
    return rows.select("id", "k1", "k2").join(by_vector, ["k1", "k2"], "left").select(
        F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"), F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(True)).alias("kept"))


def _unit(raw: np.ndarray) -> np.ndarray:
    wide = raw.astype(np.float64)
    wide /= np.abs(wide).max(1, keepdims=True)  # no overflow or underflow in the squares
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


def _links(batches: list[pa.RecordBatch], kind: str, lines_for, threshold: float, least: int) -> Iterator[pa.RecordBatch]:
    """Per vector with links in these groups: the summed weight of its partners, and a group root."""
    table = pa.Table.from_batches(batches).combine_chunks()
    t, cell, a, b, own, name, weight = (table.column(i).to_numpy() for i in range(7))
    starts = np.concatenate([[0], np.flatnonzero((np.diff(t) != 0) | (np.diff(cell) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)) + 1, [len(t)]])
    blobs = table.column(7).to_pylist()
    size = np.diff(starts)
    out: list[tuple[np.ndarray, ...]] = []
    small = [(s, e) for s, e in zip(starts[:-1], starts[1:]) if 1 < e - s <= 64]
    for chunk in [small[i: i + 4000] for i in range(0, len(small), 4000)]:
        # many small groups at once: partners at distance 1, 2, ... in the sorted rows
        rows = np.concatenate([np.arange(s, e) for s, e in chunk])
        group = np.repeat(np.arange(len(chunk)), [e - s for s, e in chunk])
        pairs = []
        for step in range(1, max(e - s for s, e in chunk)):
            i = np.flatnonzero(group[:-step] == group[step:])
            pairs.append(np.stack([i, i + step]))
        i, j = np.concatenate(pairs, 1)
        out += _verified(rows, i, j, t, a, b, own, blobs, name, weight, kind, lines_for, threshold, least)
    for s, e in zip(starts[:-1][size > 64], starts[1:][size > 64]):
        rows = np.arange(s, e)
        for first in range(0, len(rows), 512):
            i, j = np.meshgrid(np.arange(first, min(first + 512, len(rows))), np.arange(len(rows)), indexing="ij")
            later = j > i
            out += _verified(rows, i[later], j[later], t, a, b, own, blobs, name, weight, kind, lines_for, threshold, least)
    if out:
        x, y, w = (np.concatenate(c) for c in zip(*out))
        if len(x):
            who, place = np.unique(np.concatenate([x, y]), return_inverse=True)
            total = np.bincount(place, np.concatenate([w[:, 1], w[:, 0]]), len(who)).astype(np.int64)
            p, q = place[: len(x)], place[len(x):]
            root = np.arange(len(who))
            while True:  # least reachable, by propagation with pointer jumping
                new = root.copy()
                np.minimum.at(new, p, root[q])
                np.minimum.at(new, q, root[p])
                new = np.minimum(new, new[new])
                if (new == root).all():
                    break
                root = new
            yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(total), pa.array(who[root])], ["name", "n", "root"])


def _verified(rows, i, j, t, a, b, own, blobs, name, weight, kind, lines_for, threshold, least) -> list[tuple[np.ndarray, ...]]:
    """Linked pairs (names, weights) of the given pairs of row numbers, each in its first table only."""
    ri, rj = rows[i], rows[j]
    crossing = (a[ri] == b[ri]) | (own[ri] != own[rj])  # within a pair of blocks only pairs across
    i, j = i[crossing], j[crossing]
    out = []
    sizes = np.array([len(blobs[r]) for r in rows])
    for size in np.unique(sizes).tolist():
        same = (sizes[i] == size) & (sizes[j] == size)
        p, q = i[same], j[same]
        if not len(p):
            continue
        members, place = np.unique(np.concatenate([p, q]), return_inverse=True)
        p, q = place[: len(p)], place[len(p):]
        unit = _unit(np.frombuffer(b"".join(blobs[r] for r in rows[members]), kind).reshape(len(members), -1))
        lines = lines_for(unit.shape[1])
        counted = (unit @ lines.counted).astype(np.float32)
        keep = []
        for at in range(0, len(p), 50_000):
            x, y = p[at: at + 50_000], q[at: at + 50_000]
            # half of the lines tell most unrelated pairs apart already
            half = (np.abs(counted[x, :16] - counted[y, :16]) <= lines.width / 2).sum(1) >= least - (COUNTED - 16)
            x, y = x[half], y[half]
            near = (np.abs(counted[x] - counted[y]) <= lines.width / 2).sum(1) >= least
            x, y = x[near], y[near]
            close = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
            keep.append(np.stack([x[close], y[close]]))
        x, y = np.concatenate(keep, 1)
        if len(x):
            linked, place = np.unique(np.concatenate([x, y]), return_inverse=True)
            cells = lines.cells(unit[linked])
            table = t[rows[members[x]]]
            for at in range(0, len(x), 50_000):
                part = slice(at, at + 50_000)
                shared = cells[place[: len(x)][part]] == cells[place[len(x):][part]]
                first = shared.argmax(1) == table[part]
                u, v = rows[members[x[part][first]]], rows[members[y[part][first]]]
                out.append((name[u], name[v], np.stack([weight[u], weight[v]], 1)))
    return out
