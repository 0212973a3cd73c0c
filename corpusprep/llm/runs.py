"""Operator 13: periodic runs of words.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that no
neighbouring word extends, of length >= max(least, 3 * q). All runs of a text are found:

* Periods up to ``SMALL`` come from the highly periodic regions, found by comparing the words with
  themselves shifted by each such period.
* Longer periods come from string synchronising sets at dyadic scales. At scale c, with t = c / 8,
  position i is selected if the least of the hashes of the t-word grams at i .. i + t is the first or
  the last of them (equal ones count). Whether i is selected depends on the 2t words from i alone, and of
  any t positions in a row one is selected. Two selected positions that follow each other with the same
  context propose their distance as a period; contexts of c words propose c .. 1.75 c, those of
  1.5 c words 1.5 c .. 2 c. Selected positions inside a known run of a shorter period, a period away
  from its ends, are left out: their context comes again one short period later.

No period q > ``SMALL`` is missed. The infinite word of period q has u + 1 > q / 2 distinct factors of
length u = q // 2, so some factor comes once per period, at x say. One of the t positions up to x is
selected, its context of u + t - 1 <= c words holds that factor, so it comes once per period too. As a
run has 3 q words and c <= q, this position and the one q further lie in it with their contexts, with
no equal context between: they propose q. A proposal is then extended both ways by halving steps on
prefix hashes, and every run found is compared word by word.

Words are ``[^\\x20\\x09-\\x0D]+``, compared exactly. Results: one row per input row (equal and null ids
kept apart); null, empty and blank texts have no words, no runs and the empty collapsed text. Input
columns other than the id and the text are not read. Empty table: empty result. Python works on 2 MB
of text at a time, or on one longer text as a whole: its memory is in proportion to that text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix, text_slices

#: Periods up to here are compared directly. The first scale of the selected positions.
SMALL = 32
_BASE = 0x9E3779B97F4A7C15 | 1
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUN_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"


class _Hashes:
    """Hashes of stretches of ``codes`` by prefix sums; the words' own hashes are mixed numbers."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        self.up = np.full(n + 1, _BASE, np.uint64)
        self.up[0] = 1
        np.cumprod(self.up, out=self.up)
        down = np.full(n + 1, pow(_BASE, -1, 1 << 64), np.uint64)
        down[0] = 1
        self.down = np.cumprod(down, dtype=np.uint64)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(codes) * self.up[:n], out=self.sums[1:])

    def of(self, at: np.ndarray, length) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.down[at]

    def all(self, length: int) -> np.ndarray:
        """Of every stretch of that length."""
        n = len(self.sums) - length
        return (self.sums[length:] - self.sums[:n]) * self.down[:n]


def _selected(grams: np.ndarray, t: int) -> np.ndarray:
    """Positions i where the least of ``grams[i .. i + t]`` stands at i or at i + t."""
    least, width = grams, 1
    while 2 * width <= t + 1:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < t + 1:
        rest = t + 1 - width
        least = np.minimum(least[:-rest], least[rest:])
    return np.flatnonzero((grams[:-t] == least) | (grams[t:] == least))


def _stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, after the last) of the stretches of at least ``least`` true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).view(np.int8)))
    first, after = edges[::2], edges[1::2]
    long = after - first >= least
    return first[long], after[long]


def _factors(q: int) -> list[int]:
    found, f = [], 2
    while f * f <= q:
        if q % f == 0:
            found.append(f)
            while q % f == 0:
                q //= f
        f += 1
    return found + [q] * (q > 1)


def _is_run(codes: np.ndarray, start: int, end: int, q: int) -> bool:
    """Whether ``start .. end`` has smallest period q and cannot be extended, by comparing words. (At three
    periods or more a smaller period would divide q.)"""
    piece = codes[start:end]
    if not (piece[:-q] == piece[q:]).all():
        return False
    if (start and codes[start - 1] == codes[start - 1 + q]) or (end < len(codes) and codes[end] == codes[end - q]):
        return False
    return not any((piece[: -(q // f)] == piece[q // f:]).all() for f in _factors(q))


def _extent(hashes: _Hashes, at: np.ndarray, q: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The widest (start, end) around each ``at`` in which words q apart are equal."""
    def steps(fits, most: np.ndarray) -> np.ndarray:
        found = np.zeros(len(at), np.int64)
        step = 1 << max(int(most.max(initial=0)).bit_length() - 1, 0)
        while step:
            tried = found + step
            ok = tried <= most
            ok[ok] = fits(ok, tried[ok])
            found[ok] = tried[ok]
            step >>= 1
        return found

    right = steps(lambda k, m: hashes.of(at[k], m) == hashes.of(at[k] + q[k], m), n - at - q)
    left = steps(lambda k, m: hashes.of(at[k] - m, m) == hashes.of(at[k] + q[k] - m, m), at.copy())
    return at - left, at + q + right


def find_runs(codes: np.ndarray, lengths: np.ndarray, least: int = 24) -> list[tuple[int, int, int]]:
    """All runs ``(start, end, period)`` of texts whose word codes stand in ``codes`` one after the other, each text
    followed by a code of its own that occurs nowhere else. ``lengths``: words of each text."""
    runs: set[tuple[int, int, int]] = set()
    n = len(codes)
    for q in range(1, min(SMALL, int(lengths.max(initial=0)) // 3) + 1):
        first, after = _stretches(codes[:-q] == codes[q:], max(least, 3 * q) - q)
        for a, b in zip(first.tolist(), after.tolist()):
            if _is_run(codes, a, b + q, q):
                runs.add((a, b + q, q))
    c = SMALL
    inside, where = codes, np.arange(n)
    while True:
        wide = lengths >= 3 * c  # a run of period c or more has 3 * c words
        if not wide.any():
            return sorted(runs)
        kept = np.repeat(wide, lengths + 1)
        inside, where, lengths = inside[kept], where[kept], lengths[wide]
        hashes, t, m = _Hashes(inside), c // 8, len(inside)
        at = _selected(mix(hashes.all(t)), t)
        if runs:
            at = at[~_within(where[at], runs, c)]
        for context, low, high in ((c, c, c + 3 * c // 4), (c + c // 2, c + c // 2, 2 * c)):
            here = at[at + context <= m]
            seen = hashes.of(here, context)
            order = np.argsort(seen, kind="stable")
            pairs = np.flatnonzero(seen[order[1:]] == seen[order[:-1]])
            i, j = here[order[pairs]], here[order[pairs + 1]]
            near = (j - i >= low) & (j - i <= high) & (j + (j - i) <= m)
            i, q = i[near], (j - i)[near]
            same = hashes.of(i, q) == hashes.of(i + q, q)  # in a run a whole period follows the second place
            i, q = i[same], q[same]
            if len(i):
                start, end = _extent(hashes, i, q, m)
                long = end - start >= np.maximum(3 * q, least)
                for a, b, d in set(zip(start[long].tolist(), end[long].tolist(), q[long].tolist())):
                    if _is_run(inside, a, b, d):
                        runs.add((int(where[a]), int(where[a]) + b - a, d))
        c *= 2


def _within(at: np.ndarray, runs: set, c: int) -> np.ndarray:
    """Which places lie in a run of a period below c, a period from its start and a period and 1.5 c words from its end."""
    inner = sorted((a + q, b - q - c - c // 2) for a, b, q in runs if q < c and b - a > 2 * q + c + c // 2)
    out = np.zeros(len(at), bool)
    if inner:
        low = np.array([a for a, _ in inner])
        high = np.maximum.accumulate([b for _, b in inner])
        k = np.searchsorted(low, at, side="right") - 1
        out = (k >= 0) & (at <= high[np.maximum(k, 0)])
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but those that stand in a run after its first period, one blank between two."""
    if not runs:
        return b" ".join(words)
    dropped = np.zeros(len(words), bool)
    for start, end, q in runs:
        dropped[start + q: end] = True
    return b" ".join([words[i] for i in np.flatnonzero(~dropped).tolist()])


class _Codes(dict):
    """A number for each word, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _of_texts(texts: list[bytes], least: int) -> tuple[list[int], list[list], list[bytes]]:
    """(words, runs, collapsed text) of each text."""
    split = [t.split() for t in texts]  # bytes: exactly the six blanks of the word pattern
    table = _Codes()
    lengths = np.array([len(w) for w in split], np.int64)
    codes = np.empty(int(lengths.sum()) + len(split), np.int64)
    ends = np.cumsum(lengths + 1)
    for words, end in zip(split, ends.tolist()):
        codes[end - 1 - len(words): end - 1] = np.fromiter(map(table.__getitem__, words), np.int64, len(words))
    codes[ends - 1] = -1 - np.arange(len(split))  # after each text a code of its own
    runs: list[list] = [[] for _ in split]
    begins = ends - lengths - 1
    for start, end, q in find_runs(codes, lengths, least):
        k = int(np.searchsorted(ends, start, side="right"))
        runs[k].append((start - int(begins[k]), end - int(begins[k]), q))
    return lengths.tolist(), [sorted(r, key=lambda x: (x[0], x[2])) for r in runs], [collapsed(w, r) for w, r in zip(split, runs)]


def periodic_runs(docs: DataFrame, least: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_words``, ``runs`` (array of start, length, period, by start and then period) and ``collapsed`` (the
    text without the words that stand in a run after its first period) of every row."""
    if least < 1:
        raise ValueError("least is a number of words")
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, batch.schema.names[1]):
                texts = [(t.as_py() or "").encode() for t in part.column(1)]
                counts, runs, kept = _of_texts(texts, least)
                told = pa.array([[{"start": a, "length": b - a, "period": q} for a, b, q in r] for r in runs], pa.list_(_RUN))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), told, pa.array(kept, pa.binary()).cast(pa.string())],
                                                 [id_col, "n_words", "runs", "collapsed"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(work, f"`{id_col}` {kind}, n_words bigint, runs {RUN_TYPE}, collapsed string")


def greatest_run(runs: Column) -> Column:
    """The run of greatest length / period, compared exactly; of equal ones the first, then that of the least period.
    Null if there is none."""
    def before(a: Column, b: Column) -> Column:
        less = a["length"] * b["period"] - b["length"] * a["period"]
        return F.when(less != 0, -F.signum(less)).when(a["start"] != b["start"], F.signum(a["start"] - b["start"])) \
            .otherwise(F.signum(a["period"] - b["period"])).cast("int")

    return F.get(F.array_sort(runs, before), F.lit(0))


def with_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input of the registered query: of every document with h % 10 = 0, h the crc32 of its decimal id, the words
    i >= a become word a + (i - a) % p, with g = h div 10, a = g % n, p = 1 + (n - a) div (3 + g % 8); one blank
    between two words then. Other texts, those of null ids and texts without words stay. Column functions only."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.filter(F.split(F.col(text_col), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.size("__words")
    g = F.floor(h / 10).cast("bigint")
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - F.col("__at.a")) / (F.lit(3) + g % 8))).cast("int")
    chosen = docs.select(F.col(id_col), F.col(text_col), F.when(h % 10 == 0, words).alias("__words"))
    chosen = chosen.withColumn("__at", F.when(n > 0, F.struct(a.alias("a"))))
    chosen = chosen.withColumn("__p", F.when(n > 0, p))
    place = lambda w, i: F.when(i < F.col("__at.a"), w).otherwise(
        F.get(F.col("__words"), F.col("__at.a") + (i - F.col("__at.a")) % F.col("__p")))
    text = F.when(n > 0, F.array_join(F.transform("__words", place), " ")).otherwise(F.col(text_col))
    return chosen.select(F.col(id_col), text.alias(text_col))
