"""Operator 12: Merkle manifest of a dataset, with a witness for every row.

A row's leaf is the SHA-256 of its fields. Per group (``source``) the leaves ascend by ``doc_id``; while
several nodes remain, every ``arity`` consecutive ones (the last run may be shorter, even one) become the hash of
their digests. What remains is the group's subroot, and the subroots, ordered by group, give the root likewise.

Witnesses are incremental. ``Append`` takes digests one after the other and keeps one open run a level. A node that
completes a run closes the subtree below it: the run's digests without its own extend the witness of each member, and
the new digest is appended one level up. Leaves are numbered within their group by a distributed row index and dealt to
aligned blocks of ``arity ** depth`` leaves, each one streamed by one task; a block's root is appended to the
group's next blocks as if it were a leaf, until one digest is left, and the subroots are appended the same way. The
partial witness of a block's leaves ends at the block's root; it is extended by that root's own witness, which is joined
from the (``arity ** depth`` times smaller) table above. No task holds more than one block, however many rows
one group has, and the driver holds only counts.

Results: one row per input row. Null fields are hashed as ``-``; a null group is a group of its own and comes first,
null ids come first in their group, rows with equal ids are ordered by their leaf (repeated rows have equal leaves). Text of any
length is hashed where it is read and goes no further. An empty table gives no row. The input's other columns are not read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.operators.ordering import null_safe_join, row_index
from corpusprep.session import drop_stored, scratch_scope, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY, DEPTH = 16, 3
#: Rows that go on as one Arrow batch; a row's witness takes some kilobytes.
ROWS = 512


def leaf_digest(columns: dict[str, Column]) -> Column:
    """SHA-256 (lowercase hex) of the fields: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    told = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")))
            for c in columns.values()]
    return F.sha2(F.concat(*told).cast("binary"), 256)


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Append:
    """An append-only tree. ``witness(i)`` holds what is known so far of leaf i's siblings, as runs from its own upwards:
    ``(place in the run, the other digests)``."""

    def __init__(self, arity: int = ARITY, watch: bool = True):
        self.arity, self.watch = arity, watch
        self.open: list[list[tuple[str, list]]] = []  # by level: the open run's digests, with the witness pieces below them
        self.pieces: list[list] = []

    def add(self, node: str) -> None:
        """Append a leaf, and complete every run that it fills."""
        below: list = []
        if self.watch:
            self.pieces.append([])
            below = [len(self.pieces) - 1, len(self.pieces)]
        self._put(0, node, below)

    def _put(self, level: int, node: str, below: list) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append((node, below))
        if len(self.open[level]) == self.arity:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        nodes = [n for n, _ in run]
        if self.watch:
            for i, (_, (first, after)) in enumerate(run):
                piece = (i, "".join(nodes[:i] + nodes[i + 1:]))  # shared by all leaves below this member
                for leaf in range(first, after):
                    self.pieces[leaf].append(piece)
        below = [run[0][1][0], run[-1][1][1]] if self.watch else []
        self._put(level + 1, digest(nodes), below)

    def close(self, levels: int | None = None) -> str:
        """The root: of the least tree that holds all leaves, or of one of ``levels`` levels. No leaf follows."""
        level = 0
        while True:
            above = any(self.open[level + 1:])
            run = self.open[level] if level < len(self.open) else []
            if not above and len(run) == 1 and (levels is None or level == levels):
                return run[0][0]
            if run:
                self._complete(level)
            level += 1

    def witness(self, leaf: int) -> list[tuple[int, str]]:
        return self.pieces[leaf]


def fold(leaf: str, witness: list[tuple[int, str]]) -> str:
    """The root that a leaf and its witness give."""
    for place, others in witness:
        leaf = digest([others[: 64 * place], leaf, others[64 * place:]])
    return leaf


_PIECES = "array<struct<place:int,others:string>>"


def _blocks(nodes: DataFrame, on: list[str], depth: int, arity: int) -> DataFrame:
    """Nodes ``[group], pos, total, node[, more]`` as one row per aligned block: the nodes in order, and the block's ``root``."""
    size, keys = arity ** depth, [*on, "block"]
    members = F.struct("pos", *[c for c in nodes.columns if c not in ("pos", "total", *on)])
    held = nodes.withColumn("block", F.floor(F.col("pos") / F.lit(size)).cast("bigint")).groupBy(*keys) \
        .agg(F.sort_array(F.collect_list(members)).alias("members"), F.max("total").alias("total"))  # at most arity ** depth
    at = held.columns.index("members")

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for listed, total in zip(batch.column(at), batch.column(at + 1).to_pylist()):
                tree = Append(arity, watch=False)
                for m in listed.as_py():
                    tree.add(m["node"])
                found.append(tree.close(depth if total > size else None))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, "root"])

    return held.mapInArrow(roots, T.StructType([*held.schema.fields, T.StructField("root", T.StringType())]))


def _witnessed(blocks: DataFrame, depth: int, arity: int, keep: list[str]) -> DataFrame:
    """Blocks with the witness ``above`` of their roots as one row per node: ``keep`` and the member's fields, and ``witness``."""
    size = arity ** depth
    member = blocks.schema["members"].dataType.elementType
    fields = [f.name for f in member.fields]
    schema = ", ".join(f"`{c}` {blocks.schema[c].dataType.simpleString()}" for c in keep) + ("," if keep else "")
    schema += ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in member.fields) + f", witness {_PIECES}"
    names = blocks.columns

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(names, batch.columns))
            for k in range(batch.num_rows):
                listed, total = columns["members"][k].as_py(), columns["total"][k].as_py()
                above = [(p["place"], p["others"]) for p in columns["above"][k].as_py() or []]
                tree = Append(arity)
                for m in listed:
                    tree.add(m["node"])
                tree.close(depth if total > size else None)
                for first in range(0, len(listed), ROWS):
                    part = listed[first: first + ROWS]
                    told = [[{"place": p, "others": o} for p, o in tree.witness(first + i) + above] for i in range(len(part))]
                    fixed = [pa.array([columns[c][k].as_py()] * len(part), columns[c].type) for c in keep]
                    own = [pa.array([m[f] for m in part], columns["members"].type.value_type.field(f).type) for f in fields]
                    yield pa.RecordBatch.from_arrays([*fixed, *own, pa.array(told, _PIECES_TYPE)], [*keep, *fields, "witness"])

    return blocks.mapInArrow(rows, schema)


_PIECES_TYPE = pa.list_(pa.struct([("place", pa.int32()), ("others", pa.string())]))


def _trees(nodes: DataFrame, on: list[str], depth: int, arity: int) -> tuple[DataFrame, list[DataFrame]]:
    """(the last node of each group with its digest ``node``, the stored block tables from the leaves up)."""
    levels = []
    while True:
        blocks = stored(_blocks(nodes, on, depth, arity), "merkle-blocks")
        levels.append(blocks)
        more = F.ceil(F.col("total") / F.lit(arity ** depth)).cast("bigint")
        nodes = blocks.select(*on, F.col("block").alias("pos"), more.alias("total"), F.col("root").alias("node"))
        if nodes.where("total > 1").isEmpty():
            return nodes.select(*on, "node"), levels


def _descend(levels: list[DataFrame], tops: DataFrame, on: list[str], keep: list[str], depth: int, arity: int) -> DataFrame:
    """Witnesses of all leaves, from ``tops`` (the columns ``on`` and ``keep``, and ``above``, the witness of each group's root)
    down through the blocks. Only tables that are ``arity ** depth`` times smaller than the leaves are joined to blocks."""
    above = tops.select(*on, "above").withColumn("block", F.lit(0).cast("bigint"))
    for blocks in levels[:0:-1]:
        found = _witnessed(null_safe_join(blocks, above, [*on, "block"]), depth, arity, on)
        above = found.select(*on, F.col("pos").alias("block"), F.col("witness").alias("above"))
    blocks = null_safe_join(levels[0].drop("root"), above, [*on, "block"])
    if keep:
        blocks = null_safe_join(blocks, tops.select(*on, *keep), on)
    return _witnessed(blocks, depth, arity, [*on, *keep])


def merkle_manifest(docs: DataFrame, group: str = "source", order_by: str = "doc_id", fields=FIELDS, extra: dict[str, Column] | None = None,
                    arity: int = ARITY, depth: int = DEPTH) -> DataFrame:
    """``order_by``, ``group``, the columns ``extra`` computes of each row (short ones: they go through the tree's shuffles), ``position`` in
    the group, ``leaf``, ``subroot``, ``root`` and ``witness``: the siblings as runs from the leaf's up to the root's, each with the
    place in the run and the other digests (64 hex digits each) of it."""
    if arity < 2 or depth < 1:
        raise ValueError("a run has at least two nodes, a block at least one level")
    more = extra or {}
    own = [c.alias(f"x{i}") for i, c in enumerate(more.values())]
    with scratch_scope() as made:
        leaves = stored(docs.select(F.col(group).alias("g"), F.col(order_by).alias("id"), leaf_digest({f: F.col(f) for f in fields}).alias("node"),
                                    *own), "merkle-leaves")
        # rows of some hundred bytes: fewer ranges than tasks of the text, and so fewer sampled keys
        ranges = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
        numbered = row_index(leaves, ["id", "node"], partition_by="g", name="pos", total_name="total", num_buckets=ranges)
        subroots, levels = _trees(numbered, ["g"], depth, arity)
        tops, upper = stored(row_index(subroots, ["g"], name="pos", total_name="total"), "merkle-subroots"), []
        root = None
        if not tops.isEmpty():
            last, upper = _trees(tops, [], depth, arity)
            root = last.first()["node"]
        empty = F.array().cast(_PIECES)
        top = docs.sparkSession.range(1).select(empty.alias("above"))  # nothing stands above the root
        witness = _descend(upper, top, [], [], depth, arity) if upper else tops.withColumn("witness", empty)
        tops = stored(witness.select("g", F.col("node").alias("subroot"), F.lit(root).cast("string").alias("root"), F.col("witness").alias("above")),
                      "merkle-tops")
        drop_stored(*[t for t in made if t is not tops and not any(t is x for x in levels)])
    out = _descend(levels, tops, ["g"], ["subroot", "root"], depth, arity)
    return out.select(F.col("id").alias(order_by), F.col("g").alias(group), *[F.col(f"x{i}").alias(k) for i, k in enumerate(more)],
                      F.col("pos").alias("position"), F.col("node").alias("leaf"), "subroot", "root", "witness")


def verify(manifest: DataFrame, leaf: str = "leaf", name: str = "folded_root") -> DataFrame:
    """``manifest`` with the root that the column ``leaf`` and each row's witness give."""
    if name in manifest.columns:
        raise ValueError(f"the input has a column {name!r} already")
    pieces = manifest.columns.index("witness")
    at = manifest.columns.index(leaf)

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                roots = [None if own is None or told is None else fold(own, [(p["place"], p["others"]) for p in told])
                         for own, told in zip(part.column(at).to_pylist(), part.column(pieces).to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(roots, pa.string())], [*part.schema.names, name])

    return manifest.mapInArrow(folded, T.StructType([*manifest.schema.fields, T.StructField(name, T.StringType())]))


def oracle(arity: int = ARITY, group_levels: int = 5, root_levels: int = 3) -> str:
    """DuckDB SQL of the registered query, for groups of up to ``arity ** group_levels`` rows and ``arity ** root_levels`` groups. The
    levels are written out; crc32 is computed bit by bit."""
    def told(text: str) -> str:
        one = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
        return "sha256(" + " || ".join(one(text if f == "text" else f) for f in FIELDS) + ")"

    bit = "list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)"
    crc = ("xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), "
           f"lambda crc, byte: {bit}), 4294967295)")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = told(f"translate(text, '{upper}', '{lower}')")
    parts = [f"""leaves AS (SELECT doc_id, source, leaf, held, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM (SELECT doc_id, source, {told('text')} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {tampered} ELSE {told('text')} END AS held FROM documents))""",
             "a0 AS (SELECT source AS g, place AS pos, leaf AS h FROM leaves)"]

    def tree(name: str, levels: int) -> None:
        for k in range(levels):
            parts.append(f"{name}r{k} AS (SELECT g, pos // {arity} AS run, list(h ORDER BY pos) AS hs, sum(count(*)) OVER (PARTITION BY g) AS n "
                         f"FROM {name}{k} GROUP BY g, pos // {arity})")
            parts.append(f"{name}{k + 1} AS (SELECT g, run AS pos, CASE WHEN n = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {name}r{k})")

    tree("a", group_levels)
    parts.append(f"b0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos, h, g AS source FROM a{group_levels})")
    tree("b", root_levels)
    parts.append(f"f0 AS (SELECT l.*, b.h AS subroot, b.pos AS top, (SELECT h FROM b{root_levels}) AS root, held AS folded, '' AS proof "
                 "FROM leaves l JOIN b0 b ON b.source IS NOT DISTINCT FROM l.source)")
    steps = [("a", k, "source", "place") for k in range(group_levels)] + [("b", k, "0", "top") for k in range(root_levels)]
    for i, (name, k, key, place) in enumerate(steps):
        own = f"(f.{place} // {arity ** k} % {arity})"
        group = f"f.{key}" if key == "source" else key
        parts.append(f"f{i + 1} AS (SELECT f.* EXCLUDE (folded, proof), "
                     f"CASE WHEN r.n = 1 THEN folded ELSE sha256(array_to_string(list_concat(hs[1:{own}], [folded], hs[{own} + 2:]), '')) END AS folded, "
                     f"CASE WHEN r.n = 1 THEN proof ELSE proof || array_to_string(list_concat(hs[1:{own}], hs[{own} + 2:]), '') END AS proof "
                     f"FROM f{i} f JOIN {name}r{k} r ON r.g IS NOT DISTINCT FROM {group} AND r.run = f.{place} // {arity ** (k + 1)})")
    return ("WITH " + ",\n".join(parts) + "\nSELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, "
            f"folded = root AS verified FROM f{len(steps)}")
