"""Operator 3: benchmark decontamination by CGK embedding and bit-sampling LSH.

Texts are words: runs of letters, digits and all non-ASCII characters, A-Z lower-cased. A text holds an item if some stretch
of it is within ``1 - similarity`` edits per item word (insert, delete, replace one word).

* Items are taken in blocks of a bounded number of words, each sent to every task: the stated query set against all rows.
* CGK embedding: a walk over a word string writes the word it stands on and then steps on or stays, by a random
  bit of the step's number and the word. Strings at a small edit distance fall back into step, so edit distance becomes
  Hamming distance. Each repetition (its own walk) samples ``bits`` of the written words.
* A walk takes 64 steps at most, about 32 words. An item is walked from its first word, from every 32nd and from the last
  that leaves a whole walk, so a part of it that has few edits is met wherever it lies in the item. A window of the text that
  starts at any word and a window of an item are candidates if all samples of a repetition agree.
* Windows are only walked where they can match: a stretch within the allowed edits shares a certain number of word q-grams
  with the item (q-gram lemma), so fewer shared ones rule it out without loss.
* Every candidate is verified by the exact edit distance, semi-global over the surrounding words.

Recall (measured in the tests): 1 for copies, above 0.95 at the allowed edits with the default repetitions.

Null texts and items, and those without words, match nothing. Repeated rows and items give repeated matches. Only id and text are read; other
columns are not carried. Empty tables: empty result."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, placed_words, text_buffers, text_slices

_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


class _Class:
    """Items of similar length, and their keys under every repetition."""

    def __init__(self, items: list[np.ndarray], numbers: list[int], share: float, repetitions: int, bits: int):
        self.items, self.numbers = items, numbers
        sizes = [len(x) for x in items]
        self.allowed = [int(share * n + 1e-9) for n in sizes]
        self.reach = max(n + k for n, k in zip(sizes, self.allowed))
        # the largest q of up to 3 for which the q-gram lemma asks for at least one shared q-gram
        self.q = next((q for q in (3, 2) if min(n - q + 1 - q * k for n, k in zip(sizes, self.allowed)) >= 1), 1)
        self.needed = max(1, min(n - self.q + 1 - self.q * k for n, k in zip(sizes, self.allowed)))
        self.grams = np.unique(np.concatenate([_grams(x, self.q) for x in items]))
        self.steps = max(2, min(64, 2 * min(sizes) - 2 * max(self.allowed)))
        rng = np.random.default_rng([7, min(sizes), max(sizes)])
        self.walks = [(np.uint64(int(rng.integers(1 << 63))), np.sort(rng.integers(0, self.steps, bits))) for _ in range(repetitions)]
        self.keys: list[dict[int, list[tuple[int, int]]]] = []
        # (item, offset) of every window; a walk seldom goes further than half its steps and three deviations
        walked = self.steps // 2 + int(1.5 * self.steps**0.5) if self.steps == 64 else self.steps // 2
        windows = [(i, o) for i, n in enumerate(sizes) for o in sorted({*range(0, max(n - walked, 0) + 1, 32), max(n - walked, 0)})]
        self.furthest = max(o for _, o in windows)
        before = np.concatenate([[0], np.cumsum([n + self.steps for n in sizes])])
        first = np.array([before[i] + o for i, o in windows], np.int64)
        flat = np.concatenate([np.concatenate([x, np.zeros(self.steps, np.uint64)]) for x in items])
        for key in self.embed(flat, first):
            table: dict[int, list[tuple[int, int]]] = defaultdict(list)
            for w, k in zip(windows, key.tolist()):
                table[k].append(w)
            self.keys.append(dict(table))
        self.sorted_keys = [np.array(sorted(t), np.uint64) for t in self.keys]

    def embed(self, words: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
        """Per repetition, the sampled key of the walk from each start."""
        last = len(words) - 1
        for salt, sampled in self.walks:
            turn = mix(words ^ salt)
            at, key = starts.copy(), np.zeros(len(starts), np.uint64)
            for step in range(int(sampled[-1]) + 1):
                for _ in range(int((sampled == step).sum())):
                    key = mix(key * np.uint64(3) + words[at])
                at = np.minimum(at + ((turn[at] >> np.uint64(step)) & np.uint64(1)).astype(np.int64), last)
            yield key


def _grams(words: np.ndarray, q: int) -> np.ndarray:
    n = max(len(words) - q + 1, 0)
    out = words[:n].copy()
    for k in range(1, q):
        out = mix(out) + words[k: n + k]
    return out


def _member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted array ``of``; a small bitmap rules most values out first."""
    bitmap = np.zeros(1 << 16, bool)
    bitmap[(of >> np.uint64(48)).astype(np.int64)] = True
    maybe = np.flatnonzero(bitmap[(values >> np.uint64(48)).astype(np.int64)])
    out = np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(of, values[maybe]), len(of) - 1)
    out[maybe] = of[at] == values[maybe]
    return out


def _distances(item: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Least edit distance of the item to a stretch that ends before each word (and at the end) of ``text``."""
    n = len(item)
    steps = np.arange(n + 1)
    column, out = steps.copy(), [n]
    for word in text:
        new = np.empty(n + 1, np.int64)
        new[0] = 0
        new[1:] = np.minimum(column[:-1] + (item != word), column[1:] + 1)
        column = np.minimum.accumulate(new - steps) + steps
        out.append(int(column[n]))
    return np.array(out)


def best_match(item: np.ndarray, text: np.ndarray, allowed: int) -> tuple[int, int, int] | None:
    """(edits, first word, word after the last) of the closest stretch, if within ``allowed``."""
    ends = _distances(item, text)
    end = int(ends.argmin())
    if ends[end] > allowed:
        return None
    back = _distances(item[::-1], text[:end][::-1])
    return int(ends[end]), end - int(np.flatnonzero(back == ends[end])[0]), end


class Index:
    """A block of items, by classes of length."""

    def __init__(self, texts: list[str | None], similarity: float, repetitions: int, bits: int):
        column = pa.array(texts, pa.string())
        data, ends = text_buffers(column)
        words, before, _ = placed_words(data, ends, separator=_SEPARATOR)
        items = [words[a:b] for a, b in zip(before[:-1], before[1:])]
        groups: dict[int, list[int]] = defaultdict(list)
        for i, x in enumerate(items):
            if len(x):
                groups[int(np.log(len(x)) / np.log(1.5))].append(i)
        self.classes = [_Class([items[i] for i in g], g, 1 - similarity, repetitions, bits) for _, g in sorted(groups.items())]

    def search(self, words: np.ndarray, texts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, edits, first word, word after the last): the closest stretch of each text and item that match."""
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        for c in self.classes:
            grams = _grams(words, c.q)
            hits = np.flatnonzero(_member(grams, c.grams))
            if len(hits) < c.needed:
                continue
            # enough shared q-grams within the reach of an item, in the same text
            far = hits[c.needed - 1:] - hits[: len(hits) - c.needed + 1] < c.reach
            same = texts[hits[c.needed - 1:]] == texts[hits[: len(hits) - c.needed + 1]]
            first = hits[: len(hits) - c.needed + 1][far & same]
            if not len(first):
                continue
            # a stretch that holds the hits starts at most ``reach`` words before the last of them, its windows up to ``furthest``
            # words and the edits later, but inside the stretch
            later = min(c.furthest + max(c.allowed), c.reach)
            marks = np.zeros(len(words) + 1, np.int32)
            np.add.at(marks, np.maximum(first - c.reach, 0), 1)
            np.add.at(marks, np.minimum(first + later + 1, len(words)), -1)
            starts = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
            padded = np.concatenate([words, np.zeros(c.steps, np.uint64)])
            tried: set[tuple[int, int]] = set()
            for key, table, ordered in zip(c.embed(padded, starts), c.keys, c.sorted_keys):
                for at in np.flatnonzero(_member(key, ordered)).tolist():
                    start, text = int(starts[at]), int(texts[starts[at]])
                    for i, offset in table[int(key[at])]:
                        n, k = len(c.items[i]), c.allowed[i]
                        block = (start - offset) // n  # where the item starts, in steps of its length
                        place = (i, block)
                        if (place, text) in tried or found.get((text, c.numbers[i]), (1,))[0] == 0:
                            continue
                        tried.add((place, text))
                        low, high = block * n - n - 2 * k, (block + 1) * n + n + 2 * k
                        low = max(low, int(np.searchsorted(texts, text)))
                        high = min(high, int(np.searchsorted(texts, text, side="right")))
                        match = best_match(c.items[i], words[low:high], k)
                        if match:
                            now = (match[0], match[1] + low, match[2] + low)
                            if now < found.get((text, c.numbers[i]), (n + 1, 0, 0)):
                                found[text, c.numbers[i]] = now
        return [(t, i, *m) for (t, i), m in sorted(found.items())]


def find_items(docs: DataFrame, items: DataFrame, similarity: float = 0.8, repetitions: int = 16, bits: int = 3, block_words: int = 1_000_000,
               id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and item that match: ids, ``edits``, ``item_words``, and ``start`` and ``end``, the bytes of the closest stretch."""
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, `{item_col}` {item_kind}, edits int, item_words int, start bigint, end bigint"
    item_type = items.select(item_col).limit(0).toArrow().schema.field(0).type
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def matches(block: list[tuple]) -> DataFrame:
        names = [n for n, _ in block]
        shared = docs.sparkSession.sparkContext.broadcast(Index([t for _, t in block], similarity, repetitions, bits))  # block_words words at most

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sizes = {i: len(x) for c in shared.value.classes for i, x in zip(c.numbers, c.items)}
            for batch in batches:
                for part in text_slices(batch, "text"):
                    rows, spans, ends = _matches(shared.value, part.column(1))
                    column = lambda f, t: pa.array([f(r) for r in rows], t)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(column(lambda r: r[0], pa.int64())), column(lambda r: names[r[1]], item_type),
                         column(lambda r: r[2], pa.int32()), column(lambda r: sizes[r[1]], pa.int32()),
                         column(lambda r: int(spans[r[3], 0] - ends[r[0]]) if r[4] > r[3] else 0, pa.int64()),
                         column(lambda r: int(spans[r[4] - 1, 1] - ends[r[0]]) if r[4] > r[3] else 0, pa.int64())],
                        [id_col, item_col, "edits", "item_words", "start", "end"])

        return texts.mapInArrow(search, schema)

    return reduce(DataFrame.unionAll, map(matches, _blocks(items, item_col, item_text_col, block_words)))


def drop_contaminated(docs: DataFrame, items: DataFrame, similarity: float = 0.8, repetitions: int = 16, bits: int = 3,
                      block_words: int = 1_000_000, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold an item; all columns are kept. One pass per block of items."""
    for block in _blocks(items, item_col, item_text_col, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(Index([t for _, t in block], similarity, repetitions, bits))

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in text_slices(batch, text_col):
                    rows, _, _ = _matches(shared.value, part.column(part.schema.get_field_index(text_col)))
                    keep = np.ones(part.num_rows, bool)
                    keep[[r[0] for r in rows]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs


def _blocks(items: DataFrame, item_col: str, item_text_col: str, block_words: int) -> Iterator[list[tuple]]:
    """(id, text) of the items, in blocks of about ``block_words`` words; one empty block if there are none."""
    block, held = [], 0
    for row in items.select(item_col, F.col(item_text_col).cast("string")).toLocalIterator():
        size = len((row[1] or "").split()) + 1
        if block and held + size > block_words:
            yield block
            block, held = [], 0
        block.append((row[0], row[1]))
        held += size
    yield block


def _matches(index: Index, column: pa.Array) -> tuple[list[tuple[int, int, int, int, int]], np.ndarray, np.ndarray]:
    """The matches in a column of texts, the bytes of its words and the texts' first bytes."""
    data, ends = text_buffers(column)
    words, before, spans = placed_words(data, ends, separator=_SEPARATOR)
    return index.search(words, np.repeat(np.arange(len(column)), np.diff(before))), spans, ends
