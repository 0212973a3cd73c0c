"""Operator 1: n-gram Jaccard join over prefix trees.

A text's set is its distinct ``words``-word shingles, as 64-bit hashes. Two texts link when
``intersection >= threshold * union``. Equal sets are one class; a class stands for all its copies.

* Global order: shingles found to be frequent come last, by the logarithm of their count, the others by hash. Any order gives right
  results; this one keeps frequent shingles out of the prefixes. Frequent are the 2**20 shingles that tasks
  counted most often (with ties as far as they fit), which bounds their table.
* Prefixes: linked sets of n shingles share one of the first n - ceil(threshold * n) + 1. Prefixes travel
  packed, so the shuffle has few rows. A prefix shingle held by up to ``group`` classes makes candidate
  pairs. Their common prefix shingles are counted over all of them: linked sets of a and b shingles
  that need overlap o share at least min(prefix(a) - (a - o), prefix(b) - (b - o)), so pairs with fewer go without being read,
  and so do pairs whose bitmaps (a few bits a shingle) already differ in more places than linked sets can.
* A shingle held by more classes makes units of its classes instead, in order of size, and no count is needed. Only components are asked for,
  so first each block of ``group`` neighbours is judged in itself, and the first classes of the blocks among one another. A family of near copies is one component
  after that. Then the classes outside a shingle's largest component are pivots against all its classes that sizes allow: a pair that
  is not judged lies in one component already. The rows of a family thus grow with its size, not with the square.
* Judging: a unit's ordered sets are stored in a prefix tree with edges of 16 shingles. It is traversed once for all
  pivots: overlaps are kept per node, shared by all sets below it, and a subtree is pruned when its overlap
  and what remains below it cannot reach the needed overlap. Only links of a spanning forest leave a unit.

Null and empty texts, and those without words, have empty sets and link with nothing. Rows with equal
or null ids are separate rows; the component is named by the smallest id in it, null only if there is none. Input
columns other than id and text are not carried. Empty table: empty result."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.operators.ordering import row_index
from corpusprep.session import drop_stored, scratch_scope

from .common import in_map, key_map, mix, shingle_sets, stored, text_buffers, text_slices
from .components import components, forest

EDGE = 16
#: Shingles counted together in a task before the frequent ones among them are sent on.
COUNTED = 1 << 22
#: Shingles that a task counts so often are sent on, and so many of these at most are ordered by their count. Neither changes the result.
OFTEN, FREQUENT = 2, 1 << 20


def set_name(tokens: np.ndarray) -> int:
    """A 64-bit name of a set, as a signed long."""
    both = np.array([int(tokens.sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(tokens)) if len(tokens) else 0], np.uint64)
    return int(mix(mix(both) * np.array([3, 5], np.uint64)).sum(dtype=np.uint64).astype(np.int64))


class Order:
    """The global order of shingles."""

    def __init__(self, frequent: np.ndarray, level: np.ndarray):
        self.frequent, self.level = frequent, level

    def sort(self, tokens: np.ndarray) -> np.ndarray:
        """Ascending distinct hashes in the global order."""
        if not len(self.frequent):
            return tokens
        at = np.minimum(np.searchsorted(self.frequent, tokens), len(self.frequent) - 1)
        held = self.frequent[at] == tokens
        if not held.any():
            return tokens
        return tokens[np.argsort(np.where(held, self.level[at], 0), kind="stable")]


class Needs:
    """Overlaps a threshold asks for, in whole numbers."""

    def __init__(self, threshold: float):
        exact = Fraction(threshold).limit_denominator(10_000)
        self.num, self.den = exact.numerator, exact.denominator

    def prefix(self, n):
        return n - -(-self.num * n // self.den) + 1

    def overlap(self, a, b):
        return -(-self.num * (a + b) // (self.num + self.den))

    def sizes(self, a, b):
        """Whether sizes a <= b allow a link."""
        return self.den * a >= self.num * b


def tree_overlaps(sets: list[np.ndarray], pivots: list[np.ndarray], needs: Needs) -> np.ndarray:
    """[pivot, set]: the overlap, or 0 where a pruned subtree holds the set. Sets in global order."""
    sizes, psizes = np.array([len(s) for s in sets]), np.array([len(p) for p in pivots])
    vocabulary, codes = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    inside = np.zeros((len(pivots), len(vocabulary) + 1), bool)
    for i, p in enumerate(pivots):
        at = np.minimum(np.searchsorted(vocabulary, p), len(vocabulary) - 1)
        inside[i, at[vocabulary[at] == p]] = True
    out = np.zeros((len(pivots), len(sets)), np.int64)
    members = np.arange(len(sets))
    node = np.zeros(len(sets), np.int64)  # of each member still descending
    overlap = np.zeros((len(pivots), 1), np.int64)  # per pivot and node
    depth = 0
    while len(members):
        columns = depth + np.arange(EDGE)
        held = columns < sizes[members][:, None]
        rows = np.where(held, codes[np.minimum((ends - sizes)[members][:, None] + columns, len(codes) - 1)], len(vocabulary))
        name = mix((mix(rows.astype(np.uint64) + np.uint64(1)) * (mix(columns.astype(np.uint64)) | np.uint64(1))).sum(1, dtype=np.uint64) + mix(node.astype(np.uint64)))
        _, first, child = np.unique(name, return_index=True, return_inverse=True)
        overlap = overlap[:, node[first]] + inside[:, rows[first]].sum(2)
        depth += EDGE
        done = sizes[members] <= depth
        out[:, members[done]] = overlap[:, child[done]]
        members, child = members[~done], child[~done]
        if not len(members):
            break
        left, least = np.zeros(overlap.shape[1], np.int64), np.full(overlap.shape[1], 1 << 40)
        np.maximum.at(left, child, sizes[members] - depth)
        np.minimum.at(least, child, sizes[members])
        hope = (overlap + left >= needs.overlap(psizes[:, None], least)).any(0)
        live = hope[child]
        members, child = members[live], child[live]
        kept, node = np.unique(child, return_inverse=True)
        overlap = overlap[:, kept]
    return out


def bitmap(tokens: np.ndarray) -> bytes:
    """Shingles toggle bits of a map of two to four bits each: two sets differ in at least as many
    shingles as their maps differ in bits. A map folds to half its length."""
    size = max(64, 1 << (2 * max(len(tokens), 1) - 1).bit_length())
    return np.packbits(np.bincount((tokens & np.uint64(size - 1)).astype(np.int64), minlength=size) % 2 > 0).tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the number of shingles in which two sets differ, from their maps."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def judge_unit(names: list[int], sets: list[np.ndarray], pivots: np.ndarray, needs: Needs) -> list[tuple[int, int]]:
    """Linked pairs of names between each pivot and every other set of a unit."""
    links = []
    sizes = np.array([len(s) for s in sets])
    for p in np.flatnonzero(pivots) if len(sets) <= 4 else ():
        for m in range(len(sets)):
            if m != p and not (pivots[m] and m < p):
                both = len(np.intersect1d(sets[p], sets[m], assume_unique=True))
                if both >= needs.overlap(int(sizes[p]), int(sizes[m])):
                    links.append((names[p], names[m]))
    if len(sets) > 4:
        which = np.flatnonzero(pivots)
        total = int(sizes.sum())
        step = max(1, min(128, 32_000_000 // max(total, 1)))  # pivots at a time, so that memory is bounded
        for at in range(0, len(which), step):
            part = which[at: at + step]
            found = tree_overlaps(sets, [sets[p] for p in part], needs)
            enough = found >= needs.overlap(sizes[part][:, None], sizes[None, :])
            enough[np.arange(len(part)), part] = False
            links += [(names[part[i]], names[j]) for i, j in zip(*np.nonzero(enough))]
    return links


def _least_count(counts: DataFrame) -> int:
    """The least count that at most ``FREQUENT`` shingles reach."""
    total = counts.agg(F.sum("total")).first()[0] or 0
    sizes = counts.where("n > 0").groupBy(F.least("n", F.lit(1 << 16)).alias("n")).agg(F.count("*").alias("k")).orderBy(F.desc("n")).collect()  # 2**16 rows at most
    least, held = max(1 << 16, total // FREQUENT) + 1, 0
    for r in sizes:
        held += r["k"]
        if held > FREQUENT:
            break
        least = r["n"]
    return least


def maybe_asked(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """``texts`` (row, text) without most of those whose ``row`` is not asked for, so that few texts are shuffled for nothing. They are told
    by a map of 2**25 bits (4 MB whatever the input); the join after it sorts out what the map lets through."""
    shared = texts.sparkSession.sparkContext.broadcast(key_map(asked, "row"))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_map(shared.value, batch.column(0).to_numpy())))

    return texts.mapInArrow(sift, texts.schema)


def jaccard_components(docs: DataFrame, words: int = 4, threshold: float = 0.85, group: int = 128,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id``, ``kept`` (this row stands for its component: least id, nulls first,
    then least ``row_hash``; rows equal in id and text stand together) and ``row_hash`` (xxhash64 of id and text)."""
    with scratch_scope() as made:
        members, named, out = _components(docs, words, threshold, group, id_col, text_col)
        drop_stored(*(t for t in made if t is not members and t is not named))
    return out


def _components(docs: DataFrame, words: int, threshold: float, group: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The stored tables that the result reads, and the result."""
    spark = docs.sparkSession
    needs = Needs(threshold)
    kind = docs.schema[id_col].dataType.simpleString()
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("row", F.xxhash64("id", "text")).select("row", "id", "text")

    def sets_of(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
        for part in text_slices(batch, "text"):
            yield part, list(shingle_sets(*text_buffers(part.column(part.schema.get_field_index("text"))), words))

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, sets in sets_of(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                                                  pa.array([set_name(s) for s in sets], pa.int64()), pa.array([bitmap(s) for s in sets], pa.binary())],
                                                 ["row", "id", "n", "name", "bits"])

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, total = [], 0, 0

        def counted() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            often = counts >= OFTEN
            return pa.RecordBatch.from_arrays([pa.array(np.append(tokens[often].view(np.int64), 0)), pa.array(np.append(counts[often], 0)),
                                               pa.array(np.append(np.zeros(int(often.sum()), np.int64), size))], ["token", "n", "total"])

        for batch in batches:
            for _, sets in sets_of(batch):
                held += sets
                size += sum(map(len, sets))
                if size >= COUNTED:
                    yield counted()
                    held, size = [], 0
        yield counted()

    members = stored(rows.mapInArrow(classes, f"row bigint, id {kind}, n bigint, name bigint, bits binary"), "shingle-classes")
    reps = members.where("n > 0").groupBy("name", "n").agg(
        F.min("row").alias("row"), F.min("id").alias("least"), F.min(F.struct("id", "row")).alias("first"))
    counts = stored(rows.mapInArrow(frequent, "token bigint, n bigint, total bigint").groupBy("token").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")), "shingle-counts")
    often = counts.where(F.col("n") >= _least_count(counts)).select("token", "n").toArrow()  # at most FREQUENT rows
    tokens, ns = often.column(0).to_numpy().view(np.uint64), often.column(1).to_numpy()
    by = np.argsort(tokens)
    order = spark.sparkContext.broadcast(Order(tokens[by], np.log2(np.maximum(ns[by], 1)).astype(np.int8)))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size, seen = 0, set()

        def packed() -> pa.RecordBatch:
            entries = np.concatenate(held)
            place = (entries["token"] % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(place, kind="stable")
            cuts = np.searchsorted(place[by], np.arange(buckets + 1))
            blobs = [(b, entries[by[cuts[b]: cuts[b + 1]]].tobytes()) for b in range(buckets) if cuts[b + 1] > cuts[b]]
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in blobs], pa.int32()), pa.array([x for _, x in blobs], pa.binary())], ["bucket", "entries"])

        for batch in batches:
            for _, sets in sets_of(batch):
                for s in sets:
                    name = set_name(s)
                    if len(s) and (name, len(s)) not in seen:
                        seen.add((name, len(s)))
                        first = order.value.sort(s)[: needs.prefix(len(s))]
                        entry = np.empty(len(first), ENTRY)
                        entry["token"], entry["name"], entry["n"] = first, name, len(s)
                        held.append(entry)
                        size += len(first)
                if size >= COUNTED // 4:
                    yield packed()
                    held, size = [], 0
                    if len(seen) > 1_000_000:  # copies met again later are told apart after the shuffle
                        seen = set()
        if held:
            yield packed()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        now = None
        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != now and held:
                    yield from _meet(np.frombuffer(b"".join(held), ENTRY), group, needs)
                    held = []
                now = bucket
                held.append(blob.as_py())
        if held:
            yield from _meet(np.frombuffer(b"".join(held), ENTRY), group, needs)

    packed = rows.select("row", "id", "text").mapInArrow(prefixes, "bucket int, entries binary")
    met = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(
        meet, "a bigint, na bigint, b bigint, nb bigint, shared bigint, unit bigint, side int")
    met = stored(met, "shingle-meetings")
    drop_stored(counts)
    # the counts of a pair's common prefix shingles, against what a link of their sizes has at least
    pairs = met.where("unit IS NULL").groupBy("a", "na", "b", "nb").agg(F.sum("shared").alias("shared"))
    need = F.ceil((F.col("na") + F.col("nb")) * needs.num / F.lit(needs.num + needs.den))
    prefix = lambda n: F.col(n) - F.ceil(F.col(n) * needs.num / F.lit(needs.den)) + 1
    pairs = candidates = stored(pairs.where(F.col("shared") >= F.least(prefix("na") - (F.col("na") - need), prefix("nb") - (F.col("nb") - need))), "shingle-pairs")
    hot = met.where("unit IS NOT NULL").select(F.col("unit").alias("token"), F.col("a").alias("name"), F.col("na").alias("n"), F.col("side").alias("rank"))
    # pairs are told apart by the bitmaps alone before any text is read again
    paired = pairs.select(F.col("a").alias("name"), F.col("na").alias("n")).unionAll(pairs.select("b", "nb")).distinct()
    maps = stored(members.select("name", "n", "bits").join(paired, ["name", "n"], "left_semi").dropDuplicates(["name", "n"]), "shingle-maps")

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [least_difference(x.as_py(), y.as_py()) <= na + nb - 2 * needs.overlap(na, nb)
                    for na, nb, x, y in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), batch.column(4), batch.column(5))]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:4]], ["a", "na", "b", "nb"])

    bits = lambda i: maps.select(F.col("name").alias("ab"[i]), F.col("n").alias(("na", "nb")[i]), F.col("bits").alias(("x", "y")[i]))
    pairs = pairs.join(bits(0), ["a", "na"]).join(bits(1), ["b", "nb"]).select("a", "na", "b", "nb", "x", "y").mapInArrow(
        possible, "a bigint, na bigint, b bigint, nb bigint")
    pairs = stored(pairs, "shingle-possible")
    drop_stored(candidates, maps)
    # units: a pivot with its partners, or a block of the classes that hold a frequent prefix shingle, all of them pivots
    unit = F.xxhash64("a", "na").alias("unit")
    units = pairs.select(unit, F.col("a").alias("name"), F.col("na").alias("n"), F.lit(0).alias("side")).distinct().unionAll(
        pairs.select(unit, "b", "nb", F.lit(1).alias("side")))
    last, step = hot.agg(F.max("rank")).first()[0], 1
    while last is not None and step <= last:  # blocks of neighbours, then of every ``group``-th class, ...
        level = F.xxhash64("token", F.lit(step), F.floor(F.col("rank") / F.lit(step * group)).cast("bigint")).alias("unit")
        units = units.unionAll(hot.where(F.col("rank") % step == 0).select(level, "name", "n", F.lit(0).alias("side")))
        step *= group

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        found: list[tuple[int, int]] = []  # of all units of a task, so that a family's links leave it once

        def judged() -> list[tuple[int, int]]:
            return judge_unit([h[1] for h in held], [h[3] for h in held], np.array([h[2] == 0 for h in held]), needs)

        def spanning() -> pa.RecordBatch:
            links = forest(found)
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])

        for batch in batches:
            for part, found_sets in sets_of(batch):
                for unit, name, side, n, tokens in zip(*(c.to_pylist() for c in part.columns[:4]), found_sets):
                    if held and held[0][0] != unit:
                        found += forest(judged())
                        held = []
                        if len(found) > 500_000:
                            yield spanning()
                            found = []
                    if (set_name(tokens), len(tokens)) == (name, n):  # not another text of the same hash
                        held.append((unit, name, side, order.value.sort(tokens)))
        if held:
            found += forest(judged())
        yield spanning()

    def linked(units: DataFrame, name: str) -> DataFrame:
        # texts travel, by row and then to their units, and become sets there: a set takes more room, and hashes do not compress
        asked = stored(units.join(reps, ["name", "n"]).select("row", "unit", "name", "side", "n"), "shingle-asked")
        texts = maybe_asked(rows.select("row", "text"), asked).withColumn("again", F.xxhash64(F.lit(1), "text"))
        texts = texts.repartition("row").dropDuplicates(["row", "again"])  # equal rows
        met = texts.join(asked, "row").select("unit", "name", "side", "n", "text")
        links = stored(met.repartition("unit").sortWithinPartitions("unit", "side", "name").mapInArrow(judge, "a bigint, b bigint"), name)
        drop_stored(asked)
        return links

    links = linked(units, "shingle-links")
    drop_stored(pairs)
    found = components(links)
    rest = None if last is None else _apart(hot, found, needs, group)
    if rest is not None:
        found = components(links.unionAll(linked(rest, "shingle-links")))
    classes_found = reps.join(found.withColumnRenamed("id", "name"), "name", "left").withColumn("component", F.coalesce("component", "name"))
    named = stored(classes_found.select("name", "n", "least", "first", "component"), "shingle-components")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"), F.min("first").alias("first"))
    by_class = named.select("name", "n", "component").join(least, "component").select("name", "n", "component_id", "first")
    empty = F.col("n") == 0
    return members, named, members.join(by_class, ["name", "n"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(empty, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        (empty | F.col("first").eqNullSafe(F.struct("id", "row"))).alias("kept"), F.col("row").alias("row_hash"))


def _apart(hot: DataFrame, found: DataFrame, needs: Needs, group: int) -> DataFrame | None:
    """Units for the pairs that share a frequent prefix shingle but no component yet: blocks of the classes outside the shingle's largest
    component against all its classes that their sizes allow. None if there are none."""
    named = found.select(F.col("id").alias("name"), "component")
    held = stored(hot.join(named, "name", "left").withColumn("component", F.coalesce("component", "name")), "shingle-held")
    sizes = held.groupBy("token", "component").agg(F.count(F.lit(1)).alias("k"))
    most = sizes.groupBy("token").agg(F.max(F.struct("k", "component")).alias("most")).select("token", F.col("most.component").alias("largest"))
    others = held.join(most, "token").where("component <> largest").select("token", "name", "n", "rank")
    others = stored(others, "shingle-others")
    if others.isEmpty():
        return None
    pivots = row_index(others, ["rank"], partition_by="token", name="place")
    pivots = stored(pivots.select("token", "name", "n", F.floor(F.col("place") / F.lit(group)).cast("bigint").alias("block")), "shingle-pivots")
    unit = F.xxhash64("token", F.lit(-1), "block", "part").alias("unit")
    reach = pivots.groupBy("token", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    allowed = (F.col("n") * needs.den >= F.col("low") * needs.num) & (F.col("n") * needs.num <= F.col("high") * needs.den)
    # a unit holds one block of pivots and the partners of one part of the ranks, so it is bounded too
    part = F.floor(F.col("rank") / F.lit(8 * group)).cast("bigint").alias("part")
    partners = held.select("token", "name", "n", part).join(reach, "token").where(allowed)
    parts = partners.select("token", "block", "part").distinct()
    partners = partners.join(pivots.select("token", "block", "name", "n"), ["token", "block", "name", "n"], "left_anti")
    return pivots.join(parts, ["token", "block"]).select(unit, "name", "n", F.lit(0).alias("side")).unionAll(
        partners.select(unit, "name", "n", F.lit(1).alias("side")))


def drop_near_copies(docs: DataFrame, words: int = 5, threshold: float = 0.8, group: int = 128, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component; of rows equal in id and text one stays."""
    kept = jaccard_components(docs, words, threshold, group, id_col, text_col).where("kept").select(F.col("row_hash").alias("hash")).distinct()
    rows = docs.select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("row"), F.xxhash64(id_col, F.col(text_col).cast("string")).alias("hash"))
    return rows.join(kept, "hash", "left_semi").dropDuplicates(["hash"]).select("row.*")  # no input column can clash with the hash


ENTRY = np.dtype([("token", "<u8"), ("name", "<i8"), ("n", "<u4")])


def _meet(entries: np.ndarray, group: int, needs: Needs) -> Iterator[pa.RecordBatch]:
    """Candidate pairs with their number of common shingles here, and the classes, ranked by size, of shingles many classes hold."""
    by = np.lexsort((entries["name"], entries["n"], entries["token"]))
    token, name, n = entries["token"][by], entries["name"][by], entries["n"][by].astype(np.int64)
    again = np.zeros(len(token), bool)  # copies of a class from several tasks
    again[1:] = (token[1:] == token[:-1]) & (name[1:] == name[:-1]) & (n[1:] == n[:-1])
    token, name, n = token[~again], name[~again], n[~again]
    starts = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    size = np.diff(np.append(starts, len(token)))
    found = []
    few = np.repeat(size <= group, size)
    i = np.flatnonzero(few[:-1])
    step = 1
    while len(i):
        i = i[i + step < len(token)]
        i = i[(token[i] == token[i + step])]
        i = i[needs.sizes(n[i], n[i + step])]  # sizes ascend within a shingle
        if len(i):
            found.append(np.stack([name[i], n[i], name[i + step], n[i + step]], 1))
        step += 1
    if found:
        pairs = np.concatenate(found)
        turned = pairs[:, 0] > pairs[:, 2]
        pairs[turned] = pairs[turned][:, [2, 3, 0, 1]]
        by = np.lexsort((pairs[:, 3], pairs[:, 1], pairs[:, 2], pairs[:, 0]))
        pairs = pairs[by]
        first = np.flatnonzero(np.append(True, (pairs[1:] != pairs[:-1]).any(1)))
        shared = np.diff(np.append(first, len(pairs)))
        yield _rows(*pairs[first].T, shared, None, None)
    for s, k in zip(starts[size > group].tolist(), size[size > group].tolist()):
        yield _rows(name[s: s + k], n[s: s + k], None, None, None, int(token[s: s + 1].view(np.int64)[0]), np.arange(k))


def _rows(a, na, b, nb, shared, unit, side) -> pa.RecordBatch:
    long = lambda x: pa.nulls(len(a), pa.int64()) if x is None else pa.array(np.broadcast_to(np.asarray(x, np.int64), len(a)))
    sides = pa.nulls(len(a), pa.int32()) if side is None else pa.array(side.astype(np.int32))
    return pa.RecordBatch.from_arrays([long(a), long(na), long(b), long(nb), long(shared), long(unit), sides], ["a", "na", "b", "nb", "shared", "unit", "side"])
