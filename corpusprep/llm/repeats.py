"""Operator 6: removal of long repeated byte strings, by prefix-free parsing.

Texts are parsed at content-chosen triggers: the positions whose rolling hash over ``length - 136`` bytes is
the least of 137 neighbouring positions. So every string of ``length`` bytes holds a trigger phrase whole, and
equal strings hold the same phrase at the same place. The dictionary is the phrases with their
context (136 bytes on either side, all that a string of ``length`` bytes around the phrase can reach), kept
as hashes; the parse is their places.

* A phrase that occurs once lies in no repeated string: it goes after one count.
* Two places with equal phrase and context repeat all strings around the phrase.
* Phrases with several contexts: only the distinct contexts meet, one place each, and for each of the
  137 offsets the strings (that much left context, the rest right) are put in order and neighbours compared.
* A phrase with more than ``many`` distinct contexts (a short line in different surroundings) is not compared in one task: each context sends
  the hash of its string at every offset, the hashes are counted, and those seen twice are joined back to their places.

Copies thus shrink to one place per distinct context before anything is gathered. Long texts are worked
through in steps; matches never cross rows. Rows are named by two 64-bit hashes of id and text, so null and repeated
ids are allowed, and identical rows count as repeats of one another. Null text is empty and stays so.
Input columns other than id and text are not carried. Empty table: empty result."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _powers, mix, stored, text_buffers, text_slices

SIDE = 136
#: Bytes of one text worked through at a time.
STEP = 1 << 19


def triggers(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, phrase hashes, context hashes) of one text's trigger phrases."""
    gram, window = length - SIDE, SIDE + 1
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    n = len(data)
    with np.errstate(over="ignore"):
        for at in range(0, max(n - length + 1, 0), STEP):
            low, high = max(at - SIDE, 0), min(at + STEP + length - 1 + SIDE, n)
            part = data[low:high]
            up, down = _powers(len(part) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
            m = len(part) - gram + 1
            hashes = mix((sums[gram:] - sums[:m]) * down[:m])
            blocks = -(-m // window)
            order = np.full(blocks * window, np.iinfo(np.uint64).max, np.uint64)
            # the position breaks ties, so equal strings agree in periodic text too
            order[:m] = (hashes & ~np.uint64(0xFFFFF)) | np.arange(m, dtype=np.uint64)
            ahead = np.minimum.accumulate(order.reshape(blocks, window)[:, ::-1], 1)[:, ::-1].ravel()
            behind = np.minimum.accumulate(order.reshape(blocks, window), 1).ravel()
            first, last = at - low, min(at + STEP, n - length + 1) - low  # string starts of this step
            least = np.minimum(ahead[first:last], behind[first + SIDE: last + SIDE])
            pos = np.unique(least & np.uint64(0xFFFFF)).astype(np.int64)
            a, b = np.maximum(pos - SIDE, 0), np.minimum(pos + length, len(part))
            context = mix((sums[b] - sums[a]) * down[a] ^ ((pos - a) << 20 | (b - pos)).astype(np.uint64))
            found.append((pos + low, hashes[pos], context))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    pos, key, context = (np.concatenate(x) for x in zip(*found))
    pos, once = np.unique(pos, return_index=True)
    return pos, key[once], context[once]


def offset_hashes(groups: np.ndarray, lefts: list[bytes], rights: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each d, the places that hold a string of ``d`` bytes to the left of a phrase and ``136 - d`` to its right, and hashes of it and the
    group. A context cut short by its text's ends holds fewer strings."""
    n = len(lefts)
    size = np.array([(len(a), len(b)) for a, b in zip(lefts, rights)], np.int64).reshape(n, 2)
    weights = mix(_powers(2 * SIDE)[0][: 2 * SIDE]) | np.uint64(1)
    sums = []
    for side, parts in enumerate(([a[::-1] for a in lefts], rights)):
        grid = np.frombuffer(b"".join(p.ljust(SIDE, b"\0") for p in parts), np.uint8).reshape(n, SIDE)
        hashed = np.zeros((SIDE + 1, n), np.uint64)
        np.cumsum((grid.T.astype(np.uint64) + np.uint64(1)) * weights[side * SIDE: (side + 1) * SIDE, None], 0, out=hashed[1:])
        sums.append(hashed)
    names = mix(groups.astype(np.uint64))
    for d in range(SIDE + 1):
        held = np.flatnonzero((size[:, 0] >= d) & (size[:, 1] >= SIDE - d))
        yield held, mix(sums[0][d][held]) + mix(sums[1][SIDE - d][held] ^ names[held])


def repeated_offsets(groups: np.ndarray, lefts: list[bytes], rights: list[bytes]) -> np.ndarray:
    """[place, d]: whether the string of ``d`` bytes to the left of a phrase and ``136 - d`` to its right
    stands at another place of its group too."""
    out = np.zeros((len(lefts), SIDE + 1), bool)
    for d, (held, string) in enumerate(offset_hashes(groups, lefts, rights)):
        if len(held) > 1:
            by = np.argsort(string)
            string = string[by]
            same = string[1:] == string[:-1]
            out[held[by[1:][same]], d] = True
            out[held[by[:-1][same]], d] = True
    return out


def _spans(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of the runs of set flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()))


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", many: int = 8192) -> DataFrame:
    """Per row: id, ``n_bytes``, ``spans`` (array of start, end: the maximal removed byte ranges), ``n_removed``,
    ``kept`` (binary: the remaining bytes; null if nothing was removed) and ``kept_sha256``."""
    if length < 2 * SIDE:
        raise ValueError(f"length must be at least {2 * SIDE}")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col), text.alias("text")).select(
        F.col(id_col), "text", F.xxhash64(id_col, "text").alias("k1"), F.xxhash64("text", F.lit(1), id_col).alias("k2"))
    name = ["k1", "k2"]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                data, ends = text_buffers(part.column(2))
                found = [triggers(data[a:b], length) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                which = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
                pos, key, context = (np.concatenate([f[i] for f in found]) for i in range(3))
                yield pa.RecordBatch.from_arrays([part.column(0).take(which), part.column(1).take(which), pa.array(pos.astype(np.int32)),
                                                  pa.array(key.view(np.int64)), pa.array(context.view(np.int64))], ["k1", "k2", "pos", "phrase", "context"])

    long_rows = rows.where(F.octet_length("text") >= length)
    places = stored(long_rows.select("k1", "k2", "text").mapInArrow(
        parse, "k1 bigint, k2 bigint, pos int, phrase bigint, context bigint"), "repeat-places")
    phrases = places.groupBy("phrase").agg(F.count("*").alias("n"), F.min("context").alias("lo"), F.max("context").alias("hi")).where("n > 1")
    # stored first: a join alone can be split where one phrase is hot, a join on the aggregate's partitioning cannot
    phrases = stored(phrases.select("phrase", (F.col("lo") != F.col("hi")).alias("mixed")), "repeat-counts")
    repeated = stored(places.join(phrases, "phrase"), "repeat-phrases")
    contexts = repeated.where("mixed").groupBy("phrase", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("k1", "k2", "pos")).alias("place"))
    contexts = stored(contexts, "repeat-contexts")
    # whole: every string around the phrase is repeated; apart: to be held against the other contexts
    whole = repeated.where("NOT mixed").select("k1", "k2", "pos").unionAll(
        repeated.where("mixed").join(contexts.where("n > 1").select("phrase", "context"), ["phrase", "context"]).select("k1", "k2", "pos"))
    # stored for the same reason
    wide = stored(contexts.groupBy("phrase").agg(F.count("*").alias("contexts")).where(F.col("contexts") > many).select("phrase", F.lit(True).alias("wide")), "repeat-wide")
    apart = contexts.join(wide, "phrase", "left").select("place.*", "phrase", (F.col("n") == 1).alias("alone"), F.coalesce("wide", F.lit(False)).alias("wide"))
    null = F.lit(None)
    asked = whole.withColumns({"phrase": null.cast("bigint"), "alone": null.cast("boolean"), "wide": null.cast("boolean")}).unionAll(apart)
    asked = asked.groupBy("k1", "k2").agg(F.collect_list(F.struct("pos", "phrase", "alone", "wide")).alias("asked"))  # at most a text's places
    involved = stored(long_rows.select("k1", "k2", "text").join(asked, name), "repeat-texts")

    def places_of(part: pa.RecordBatch, wide: bool) -> list[tuple]:
        gram, out = length - SIDE, []
        for k1, k2, text, asked in zip(*(part.column(i) for i in range(4))):
            body = memoryview(text.as_buffer())
            for a in asked.as_py():
                if a["alone"] is not None and a["wide"] == wide:
                    p = a["pos"]
                    out.append((a["phrase"], k1.as_py(), k2.as_py(), p, a["alone"],
                                bytes(body[max(p - SIDE, 0): p]), bytes(body[p + gram: p + length])))
        return out

    def cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
        for batch in batches:
            for part in text_slices(batch, "text"):
                out = places_of(part, False)
                columns = zip(*out) if out else [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["phrase", "k1", "k2", "pos", "alone", "lefts", "rights"])

    def hash_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                out = places_of(part, True)
                for at in range(0, len(out), 4096):
                    phrase, k1, k2, pos, alone, lefts, rights = zip(*out[at: at + 4096])
                    names = np.array(phrase, np.int64)
                    found = list(offset_hashes(names.view(np.uint64), lefts, rights))
                    held = np.concatenate([h for h, _ in found])
                    d = np.repeat(np.arange(SIDE + 1, dtype=np.int32), [len(h) for h, _ in found])
                    string = np.concatenate([x for _, x in found]).view(np.int64)
                    start = np.array(pos, np.int64)[held] - d
                    columns = [names[held], d, string, np.array(k1, np.int64)[held], np.array(k2, np.int64)[held], start, np.array(alone, bool)[held]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["phrase", "d", "string", "k1", "k2", "start", "alone"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spans(rows: list[dict]) -> pa.RecordBatch:
            _, groups = np.unique([r["phrase"] for r in rows], return_inverse=True)
            flags = repeated_offsets(groups, [r["lefts"] for r in rows], [r["rights"] for r in rows])
            out = [(r["k1"], r["k2"], r["pos"] - last, r["pos"] - first + length)
                   for r, f in zip(rows, flags) if r["alone"] and f.any() for first, last in _spans(f)]
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(4)], ["k1", "k2", "start", "end"])

        held: list[dict] = []  # whole groups, several thousand places together
        for batch in batches:
            for row in batch.to_pylist():
                if len(held) >= 8192 and held[-1]["phrase"] != row["phrase"]:
                    yield spans(held)
                    held = []
                held.append(row)
        if held:
            yield spans(held)

    met = involved.select("k1", "k2", "text", "asked").mapInArrow(
        cut_contexts, "phrase bigint, k1 bigint, k2 bigint, pos int, alone boolean, lefts binary, rights binary")
    spans = met.repartition("phrase").sortWithinPartitions("phrase").mapInArrow(compare, "k1 bigint, k2 bigint, start bigint, end bigint")
    if not wide.isEmpty():
        strings = involved.where(F.exists("asked", lambda a: F.coalesce(a["wide"], F.lit(False)))).select("k1", "k2", "text", "asked").mapInArrow(
            hash_contexts, "phrase bigint, d int, string bigint, k1 bigint, k2 bigint, start bigint, alone boolean")
        twice = stored(strings.groupBy("phrase", "d", "string").agg(F.count("*").alias("n")).where("n > 1").select("phrase", "d", "string"), "repeat-strings")
        back = strings.where("alone").join(twice, ["phrase", "d", "string"])
        spans = spans.unionAll(back.select("k1", "k2", "start", (F.col("start") + length).alias("end")))
    spans = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end")).alias("parts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                out: dict[str, list] = {k: [] for k in ("spans", "n_removed", "kept", "kept_sha256")}
                for text, asked, parts in zip(*(part.column(i) for i in range(2, 5))):
                    body = np.frombuffer(text.as_buffer(), np.uint8)
                    gone = np.zeros(len(body) + 1, np.int32)
                    for a in asked.as_py():
                        if a["alone"] is None:
                            start, end = max(a["pos"] - SIDE, 0), min(a["pos"] + length, len(body))
                            gone[start] += 1
                            gone[end] -= 1
                    for p in parts.as_py() or ():
                        gone[p["start"]] += 1
                        gone[p["end"]] -= 1
                    gone = np.cumsum(gone[:-1]) > 0
                    kept = body[~gone].tobytes()
                    out["spans"].append([{"start": a, "end": b + 1} for a, b in _spans(gone)])
                    out["n_removed"].append(int(gone.sum()))
                    out["kept"].append(kept)
                    out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(v, t) for v, t in zip(out.values(), _OUT))], ["k1", "k2", *out])

    done = involved.join(spans, name, "left").select("k1", "k2", "text", "asked", "parts").mapInArrow(
        cut, "k1 bigint, k2 bigint, spans array<struct<start:bigint,end:bigint>>, n_removed bigint, kept binary, kept_sha256 string").dropDuplicates(name)
    every = rows.select(F.col(id_col), "k1", "k2", F.octet_length("text").cast("long").alias("n_bytes"),
                        F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return every.join(done, name, "left").select(
        F.col(id_col), "n_bytes", F.coalesce("spans", none).alias("spans"), F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        "kept", F.coalesce("kept_sha256", "sha").alias("kept_sha256"))


_OUT = [pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.int64(), pa.binary(), pa.string()]
