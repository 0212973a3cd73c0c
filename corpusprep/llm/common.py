"""Helpers shared by the operators: stored intermediate tables, Arrow batches cut to a bounded
number of bytes, and word hashes taken straight from Arrow's string buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from corpusprep.session import stored  # noqa: F401  the operators take it from here
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that one numpy step works on; temporary arrays take about 40 times as much.
SLICE_BYTES = 2_000_000
#: Bits of a map of keys (4 MB whatever the input).
MAP_BITS = 1 << 25
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


#: Tables that a Python worker keeps from task to task (vocabularies and what was looked up in them).
_KEPT_BY_WORKER: list[dict] = []


def worker_table() -> dict:
    _KEPT_BY_WORKER.append({})
    return _KEPT_BY_WORKER[-1]


def release_worker_tables() -> None:
    """Workers serve the tasks of several operators: one that needs its memory itself gives back what others kept."""
    for table in _KEPT_BY_WORKER:
        table.clear()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def key_map(asked: DataFrame, column: str) -> np.ndarray:
    """A map of 2**25 bits of the long keys in ``column``: it lets all of them through, and few others while it is sparse."""
    bit = F.col(column).bitwiseAND(MAP_BITS - 1) + 1  # Spark numbers the bits of a part from 1 on
    parts = asked.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    held = np.zeros((MAP_BITS // 32768, 4096), np.uint8)
    for r in parts.collect():
        held[r["part"] - 1] = np.frombuffer(r["bits"], np.uint8)
    return held.ravel()


def in_map(held: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys a ``key_map`` lets through."""
    at = keys.view(np.int64) & (MAP_BITS - 1)
    return (held[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of whole rows, each of at most ``limit`` bytes of text (or one row)."""
    if not batch.num_rows:
        return
    _, ends = text_buffers(batch.column(batch.schema.get_field_index(column)))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(ends, ends[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying the text; null is empty."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), ends


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        with np.errstate(over="ignore"):
            for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                _POWERS[key] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def word_hashes(data: np.ndarray, ends: np.ndarray, limit: int = SLICE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of each text, A-Z lower-cased, and the number
    of words before each text (one more entry than texts). Works through ``limit`` bytes at a time."""
    return placed_words(data, ends, limit)[:2]


def _word_steps(data: np.ndarray, ends: np.ndarray, limit: int, separator: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(place in ``data``, bytes, first byte of each word in them, byte after it) of every ``limit`` bytes."""
    at, stop = int(ends[0]), int(ends[-1])
    while at < stop:
        end = min(at + limit, stop)
        if end < stop and not separator[data[end]]:  # end a step between two words
            gaps = np.flatnonzero(separator[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:
                later = np.flatnonzero(separator[data[end:stop]])
                end = end + int(later[0]) if len(later) else stop
        part = data[at:end]
        cuts = ends[(ends > at) & (ends < end)] - at
        inside = np.empty(len(part) + 2, bool)
        inside[0] = inside[-1] = False
        np.logical_not(separator[part], out=inside[1:-1])
        first = inside[1:-1] & ~inside[:-2]
        last = inside[1:-1] & ~inside[2:]
        first[cuts] = inside[1:-1][cuts]
        last[cuts - 1] = inside[1:-1][cuts - 1]
        yield at, part, np.flatnonzero(first), np.flatnonzero(last) + 1
        at = end


def placed_words(data: np.ndarray, ends: np.ndarray, limit: int = SLICE_BYTES,
                 separator: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``word_hashes``, and the first byte and the byte after each word in ``data`` ([word, 2]).
    ``separator``: for each byte value whether it separates words."""
    found, counts, spans = [], np.zeros(len(ends), np.int64), []
    for at, part, starts, stops in _word_steps(data, ends, limit, separator):
        up, down = _powers(len(part) + 1)
        lower = part + ((part - np.uint8(65) < 26) * np.uint8(32))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
        found.append(mix((sums[stops] - sums[starts]) * down[starts]))
        spans.append(np.stack([starts + at, stops + at], 1))
        which = np.searchsorted(ends, starts + at, side="right")
        counts += np.bincount(which, minlength=len(ends))[: len(ends)]
    if not found:
        return np.zeros(0, np.uint64), np.cumsum(counts), np.zeros((0, 2), np.int64)
    return np.concatenate(found), np.cumsum(counts), np.concatenate(spans)


def word_spans(data: np.ndarray, ends: np.ndarray, limit: int = SLICE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """What ``placed_words`` returns but for the hashes: (words before each text, [word, 2])."""
    spans = [np.stack([starts + at, stops + at], 1) for at, _, starts, stops in _word_steps(data, ends, limit, _SEPARATOR)]
    found = np.concatenate(spans) if spans else np.zeros((0, 2), np.int64)
    return np.searchsorted(found[:, 0], ends), found


_MULTIPLIERS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(data: np.ndarray, ends: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each text's ``words``-word shingles; a shorter text is one
    shingle, a text without words has none."""
    hashes, before = word_hashes(data, ends)
    n = len(hashes)
    m = max(n - words + 1, 0)
    joined = np.zeros(m, np.uint64)
    for k in range(words):
        joined += hashes[k: k + m] * _MULTIPLIERS[k]
    joined = mix(joined)
    for i in range(len(ends) - 1):
        a, b = int(before[i]), int(before[i + 1])
        if b - a >= words:
            yield np.unique(joined[a: b - words + 1])
        elif b > a:
            yield mix(np.array([int((hashes[a:b] * _MULTIPLIERS[: b - a]).sum(dtype=np.uint64)) ^ (b - a)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)

