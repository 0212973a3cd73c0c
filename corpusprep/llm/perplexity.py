"""Operator 7: quality classifier by an interpolated modified Kneser-Ney n-gram model.

The model is fitted on trusted text: rows that ``labels`` calls good and not toxic. Its grams are four code points (blanks of all
kinds are one), counted over all trusted rows into a stored table; the Kneser-Ney terms come from ``groupBy`` and joins, so no task and
not the driver holds the table, which grows with the text.

Texts are scored in chunks of about 8 MB, worked through 1 MB at a time. Each chunk sends its distinct grams, once each, to the table and
gets their bits back, so a frequent gram is at most one row per chunk. Grams the trusted text lacks back off to shorter ones, in joins of the distinct grams.

A document has a perplexity, over all its characters, and a peak perplexity, over the hundredth (six at least) of its
six-character windows that surprise most after the ``skipped`` most surprising ones, so one odd word is no verdict. It is rejected if either
exceeds that language's quantile among trusted rows. Those are scored by a model fitted on the other seven eighths of the trusted rows (contrast: the other half), so the
quantile is not flattered.

Trusted text alone cannot tell toxic words that are built of ordinary syllables, so the method named for this operator is not enough by itself.
A third score, ``contrast``, is a log-likelihood ratio: word stems (the first 4 to 9 bytes of a word) that toxic rows hold far more often than trusted rows of
the language add the logarithm of that ratio, and every word takes off ``toll``. Its threshold is the same quantile, 0 at
least. Languages without such stems of their own, null included, take those of all languages pooled. The stems are a stored table
that grows with the toxic text; each chunk sends it its distinct stems, as it does its grams, less most of those that a map of 4 MB shows are not in it.

Null, empty and one-character texts have null perplexities and are kept, as are all rows if there are no
trusted rows. A language without trusted rows, null included, takes the thresholds of all languages together. Rows with a null id are
never trusted; a row is trusted only if all its labels agree. All input columns are kept; result columns
``perplexity``, ``peak_perplexity``, ``contrast`` and ``keep`` replace input columns of these names."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from corpusprep.session import drop_stored

from .common import _powers, in_map, key_map, mix, release_worker_tables, stored, text_buffers, text_slices, word_spans

ORDER, CLASSES, FOLDS = 4, 32, 8
GRAMS = CLASSES**ORDER
WINDOW = 6
#: Models: one for each fold, fitted on the others, and one fitted on all trusted text.
MODELS = range(FOLDS + 1)
#: Steps of log2 perplexity in which thresholds are expressed.
STEP = 1 / 256
#: Code points that there can be: the uniform distribution below single ones.
POINTS = 0x110000
#: Bytes of text of a chunk, and of those worked on at a time.
CHUNK_BYTES, STEP_BYTES = 8_000_000, 1_000_000
_EDGE = np.array([32], np.uint32)


def placed_grams(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of UTF-8 texts with a blank on either side of each, the first place of every four-gram, four-grams before each text)."""
    texts = [np.frombuffer(data[a:b].tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
    flat = np.concatenate([x for t in texts for x in (_EDGE, t, _EDGE)])
    flat[(flat >= 9) & (flat <= 13)] = 32
    sizes = np.array([len(t) + 2 for t in texts], np.int64)
    n = np.maximum(sizes - ORDER + 1, 0)
    before = np.concatenate([[0], np.cumsum(n)])
    return flat, np.repeat(np.cumsum(sizes) - sizes - before[:-1], n) + np.arange(before[-1]), before


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in ascending order, the number of every key among them): told apart by hashing, so only the distinct ones are sorted."""
    found = pa.array(keys).dictionary_encode()
    distinct = found.dictionary.to_numpy()
    by = np.argsort(distinct)
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(len(by))
    return distinct[by], rank[found.indices.to_numpy()]


class Grams:
    """The distinct four-grams of some texts and, for every place, the number of its gram."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray):
        letters = np.flatnonzero(np.bincount(flat, minlength=1))
        self.code = np.full(POINTS, -1, np.int64)
        self.code[letters] = np.arange(len(letters))
        self.size, self.triples = np.uint64(len(letters)), None
        codes = self.code[flat].view(np.uint64)
        found = [codes[k: max(len(codes) - ORDER + 1, 0) + k] for k in range(ORDER)]
        if len(letters) > 65535:  # four codes do not fit 64 bits: triples are numbered first
            self.triples = np.unique(self._triple(found))
        self.keys, self.numbers = numbered(self._key(found)[starts])
        triple, d = np.divmod(self.keys, self.size)
        if self.triples is not None:
            triple = self.triples[triple.astype(np.int64)]
        ab, c = np.divmod(triple, self.size)
        self.points = [letters[x.astype(np.int64)] for x in (*np.divmod(ab, self.size), c, d)]

    def _triple(self, codes: list[np.ndarray]) -> np.ndarray:
        a, b, c = codes[:3]
        return (a * self.size + b) * self.size + c

    def _key(self, codes: list[np.ndarray]) -> np.ndarray:
        triple = self._triple(codes)
        if self.triples is not None:
            triple = np.searchsorted(self.triples, triple).astype(np.uint64)
        return triple * self.size + codes[3]

    def columns(self) -> tuple[np.ndarray, np.ndarray]:
        """(first three code points in 63 bits, the fourth) of the distinct grams."""
        a, b, c, d = self.points
        return a << 42 | b << 21 | c, d.astype(np.int32)

    def find(self, before: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the given grams, those of a whole chunk, are among these; their numbers)."""
        codes = [self.code[x] for x in (before >> 42, before >> 21 & 0x1FFFFF, before & 0x1FFFFF, last)]
        at = np.flatnonzero(np.logical_and.reduce([x >= 0 for x in codes]))
        codes = [x[at].view(np.uint64) for x in codes]
        if self.triples is not None:
            triple = self._triple(codes)
            held = self.triples[np.minimum(np.searchsorted(self.triples, triple), len(self.triples) - 1)] == triple
            at, codes = at[held], [x[held] for x in codes]
        key = self._key(codes)
        number = np.searchsorted(self.keys, key)
        held = number < len(self.keys)
        held[held] = self.keys[number[held]] == key[held]
        return at[held], number[held]

    def values(self, found: tuple[np.ndarray, np.ndarray], values: np.ndarray) -> np.ndarray:
        """The value of every distinct gram; ``found``: what ``find`` returned."""
        out = np.full(len(self.keys), np.nan, np.float32)
        out[found[1]] = values[found[0]]
        return out

    def spread(self, found: tuple[np.ndarray, np.ndarray], values: np.ndarray) -> np.ndarray:
        """For every place, the value of its gram."""
        return self.values(found, values)[self.numbers]


def chunked(rows: DataFrame, text_col: str, name: str) -> DataFrame:
    """``rows``, stored by ``_chunk``: neighbours of together about 8 MB of text have the same."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_tables()
        chunk, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for part in text_slices(batch, text_col, STEP_BYTES):
                _, ends = text_buffers(part.column(part.schema.get_field_index(text_col)))
                more = int(ends[-1] - ends[0])
                if size and size + more > CHUNK_BYTES:
                    chunk, size = chunk + 1, 0
                size += more
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(part.num_rows, chunk))], [*part.schema.names, "_chunk"])

    return stored(rows.mapInArrow(number, StructType([*rows.schema.fields, StructField("_chunk", LongType())])), name, by="_chunk")


def _pieces(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(chunk, rows of it with about 1 MB of text): the batches, chunks in the first column, in their order."""
    for batch in batches:
        chunks = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(chunks)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            for part in text_slices(batch.slice(a, b - a), batch.schema.names[text], STEP_BYTES):
                yield int(chunks[a]), part


def chunk_grams(rows: DataFrame, text_col: str) -> DataFrame:
    """The distinct four-grams of every chunk (again where a chunk is read in pieces)."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_tables()
        now, held = None, []

        def distinct() -> pa.RecordBatch:
            before, last = (np.concatenate(x) for x in zip(*held))
            if len(held) > 1:
                by = np.lexsort((last, before))
                before, last = before[by], last[by]
                new = np.append(True, (before[1:] != before[:-1]) | (last[1:] != last[:-1]))[: len(by)]
                before, last = before[new], last[new]
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(last), now)), pa.array(before), pa.array(last)], ["_chunk", "before", "last"])

        for chunk, part in _pieces(batches, 1):
            if chunk != now:
                if held:
                    yield distinct()
                now, held = chunk, []
            flat, starts, _ = placed_grams(*text_buffers(part.column(1)))
            held.append(Grams(flat, starts).columns())
        if held:
            yield distinct()

    return rows.select("_chunk", F.col(f"`{text_col}`").cast("string")).mapInArrow(emit, "_chunk bigint, before bigint, last int")


class GramTables:
    """The Kneser-Ney model as stored tables, one set for each order: ``seen`` has the probability of every gram of the trusted text
    under every model, ``backs`` by context what is left for grams it was not seen with."""

    def __init__(self, counts: DataFrame):
        """``counts``: before, last and the counts n0, n1... of the models."""
        orders = {ORDER: counts}
        for k in range(ORDER - 1, 0, -1):  # lower orders count the different code points in front
            shorter = F.col("before").bitwiseAND((1 << 21 * (k - 1)) - 1).alias("before")
            orders[k] = stored(orders[k + 1].groupBy(shorter, "last").agg(*(F.count_if(F.col(f"n{m}") > 0).alias(f"n{m}") for m in MODELS)), f"grams-{k}")
        self.seen: dict[int, DataFrame] = {}
        self.backs: dict[int, DataFrame] = {}
        for k in range(1, ORDER + 1):
            table = orders[k]
            told = table.agg(*(F.count_if(F.col(f"n{m}") == c).alias(f"c{m}{c}") for m in MODELS for c in range(1, 5))).first()
            taken = [_taken(F.col(f"n{m}"), [float(told[f"c{m}{c}"]) for c in range(1, 5)]) for m in MODELS]
            sums = table.groupBy("before").agg(*(F.sum(f"n{m}").alias(f"t{m}") for m in MODELS), *(F.sum(taken[m]).alias(f"a{m}") for m in MODELS))
            # the share of the lower order; all of it where the context was not seen
            sums = stored(sums.select("before", *(f"t{m}" for m in MODELS), *(F.when(F.col(f"t{m}") > 0, F.col(f"a{m}") / F.col(f"t{m}")).otherwise(1.0).alias(f"b{m}") for m in MODELS)), f"sums-{k}")
            table = table.join(sums.hint("merge"), "before")
            if k > 1:
                shorter = F.col("before").bitwiseAND((1 << 21 * (k - 2)) - 1)
                lower = self.seen[k - 1].select(F.col("before").alias("_before"), "last", *(F.col(f"p{m}").alias(f"l{m}") for m in MODELS))
                table = table.withColumn("_before", shorter).join(lower.hint("merge"), ["_before", "last"])
            else:
                table = table.withColumns({f"l{m}": F.lit(1 / POINTS) for m in MODELS})
            p = [F.when(F.col(f"t{m}") > 0, (F.col(f"n{m}") - taken[m]) / F.col(f"t{m}")).otherwise(0.0) + F.col(f"b{m}") * F.col(f"l{m}") for m in MODELS]
            self.seen[k] = stored(table.select("before", "last", *(p[m].alias(f"p{m}") for m in MODELS)), f"probabilities-{k}")
            self.backs[k] = sums
        drop_stored(*(orders[k] for k in range(1, ORDER)))  # their counts are in the probabilities

    def only(self, model: int) -> "GramTables":
        """The tables of one model alone; those of all models are deleted."""
        left = GramTables.__new__(GramTables)
        left.seen = {k: stored(t.select("before", "last", f"p{model}"), f"probabilities-{k}") for k, t in self.seen.items()}
        left.backs = {k: stored(t.select("before", f"b{model}"), f"sums-{k}") for k, t in self.backs.items()}
        drop_stored(*self.seen.values(), *self.backs.values())
        return left

    def bits(self, asked: DataFrame, models: tuple[int, ...], all_seen: bool = False) -> DataFrame:
        """``asked`` (_chunk, before, last) with the bits ``b0``... of every gram under the given models. ``all_seen``: the trusted text has them all."""
        value = lambda p: (-F.log2(F.greatest(p, F.lit(1e-6)))).cast("float")  # noqa: E731  a floor, as far as single code points never seen go
        top = self.seen[ORDER].select("before", "last", *(F.col(f"p{m}") for m in models))
        if all_seen:
            return asked.join(top.hint("merge"), ["before", "last"]).select("_chunk", "before", "last", *(value(F.col(f"p{m}")).alias(f"b{i}") for i, m in enumerate(models)))
        asked = stored(asked.join(top.hint("merge"), ["before", "last"], "left"), "grams-asked")
        new = asked.where(f"p{models[0]} IS NULL").select("before", "last").distinct()
        new = new.withColumns({f"w{m}": F.lit(1.0) for m in models} | {f"q{m}": F.lit(None).cast("double") for m in models})
        for k in range(ORDER, 0, -1):
            new = new.withColumn("_before", F.col("before").bitwiseAND((1 << 21 * (k - 1)) - 1))
            if k < ORDER:  # the longest gram that was seen
                held = self.seen[k].select(F.col("before").alias("_before"), "last", *(f"p{m}" for m in models))
                new = new.join(held.hint("merge"), ["_before", "last"], "left")
                new = new.withColumns({f"q{m}": F.coalesce(f"q{m}", F.col(f"w{m}") * F.col(f"p{m}")) for m in models}).drop(*(f"p{m}" for m in models))
            back = self.backs[k].select(F.col("before").alias("_before"), *(f"b{m}" for m in models))
            new = new.join(back.hint("merge"), "_before", "left")
            new = new.withColumns({f"w{m}": F.col(f"w{m}") * F.coalesce(f"b{m}", F.lit(1.0)) for m in models}).drop("_before", *(f"b{m}" for m in models))
        new = stored(new.select("before", "last", *(F.coalesce(f"q{m}", F.col(f"w{m}") / POINTS).alias(f"q{m}") for m in models)), "grams-unseen")
        known = asked.where(f"p{models[0]} IS NOT NULL").select("_chunk", "before", "last", *(value(F.col(f"p{m}")).alias(f"b{i}") for i, m in enumerate(models)))
        rest = asked.where(f"p{models[0]} IS NULL").select("_chunk", "before", "last").join(new.hint("merge"), ["before", "last"])
        return known.unionAll(rest.select("_chunk", "before", "last", *(value(F.col(f"q{m}")).alias(f"b{i}") for i, m in enumerate(models))))


def _taken(n: Column, c: list[float]) -> Column:
    """The modified Kneser-Ney discount of a count, from the numbers of grams counted once to four times."""
    y = c[0] / max(c[0] + 2 * c[1], 1.0)
    d = [min(max(k - (k + 1) * y * c[k] / max(c[k - 1], 1.0), 0.0), k) for k in (1, 2, 3)]
    return F.when(n == 1, d[0]).when(n == 2, d[1]).when(n > 2, d[2]).otherwise(0.0)


def kneser_ney(counts: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Interpolated modified Kneser-Ney probabilities of every gram given all but its last class, over an alphabet of ``CLASSES``:
    the plain form that the tests hold ``GramTables`` against."""
    if order > 1:  # lower orders count the different classes in front
        lower = kneser_ney((counts.reshape(CLASSES, -1) > 0).sum(0).astype(np.float64), order - 1).reshape(1, -1, CLASSES)
    else:
        lower = np.full((1, 1, CLASSES), 1 / CLASSES)
    n = [float((counts == k).sum()) for k in (1, 2, 3, 4)]
    y = n[0] / max(n[0] + 2 * n[1], 1.0)
    discount = np.array([0.0] + [min(max(k - (k + 1) * y * n[k] / max(n[k - 1], 1.0), 0.0), k) for k in (1, 2, 3)])
    table = counts.reshape(-1, CLASSES)
    total = table.sum(1, keepdims=True)
    taken = discount[np.minimum(table, 3).astype(np.int64)]
    lower = np.broadcast_to(lower, (table.shape[0] // lower.shape[1], lower.shape[1], CLASSES)).reshape(-1, CLASSES)
    safe = np.maximum(total, 1.0)
    # a floor keeps grams finite whose classes were never seen at all
    p = np.where(total > 0, (table - taken + taken.sum(1, keepdims=True) * lower) / safe, lower)
    return np.maximum(p, 1e-6).ravel()


def surprise(bits: np.ndarray, skipped: int) -> tuple[float, float]:
    """(log2 perplexity, log2 peak perplexity) of a text's gram bits."""
    mean = float(bits.mean(dtype=np.float64))
    if len(bits) < WINDOW:
        return mean, mean
    sums = np.concatenate([[0.0], np.cumsum(bits, dtype=np.float64)])
    windows = (sums[WINDOW:] - sums[:-WINDOW]) / WINDOW
    skip = min(skipped, max(len(windows) - 6, 0))
    most = min(max(6, -(-(len(windows) - skip) // 100)), len(windows) - skip)
    top = np.sort(np.partition(windows, len(windows) - skip - most)[len(windows) - skip - most:])
    return mean, float(top[:most].mean())


STEMS = range(4, 10)
#: In place of a language: all of them together. No language tag holds a NUL.
POOLED = "\0"


def stems(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """([word, length] hashes of each word's first bytes, 0 where it is shorter; words before each text)."""
    before, spans = word_spans(data, ends)
    out = np.zeros((len(spans), len(STEMS)), np.uint64)
    if len(spans):
        first, last = int(spans[0, 0]), int(spans[-1, 1])
        part = data[first:last]
        lower = part + ((part - np.uint8(65) < 26) * np.uint8(32))
        at, sums = spans[:, 0] - first, np.zeros(len(spans), np.uint64)
        size = spans[:, 1] - spans[:, 0]
        for i in range(STEMS[-1]):
            long = np.flatnonzero(size > i)
            sums[long] += (lower[at[long] + i].astype(np.uint64) + np.uint64(1)) * _powers(STEMS[-1])[0][i]
            if i + 1 in STEMS:
                out[long, i + 1 - STEMS[0]] = mix(sums[long] + np.uint64(i + 1))
    return out, before


class StemTable:
    """Stems of one language and what each is worth."""

    def __init__(self, names: np.ndarray, worth: np.ndarray):
        by = np.argsort(names)
        self.names, self.worth = names[by], worth[by]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(names >> np.uint64(44)).astype(np.int64)] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the values that are stems, their numbers)."""
        at = np.flatnonzero(self.maybe[(values >> np.uint64(44)).astype(np.int64)])
        number = np.minimum(np.searchsorted(self.names, values[at]), max(len(self.names) - 1, 0))
        held = self.names[number] == values[at] if len(self.names) else np.zeros(0, bool)
        return at[held], number[held]


class Stems:
    """The worth of stems as a stored table (``number`` of a model and language, ``stem``, ``worth``). ``numbers``: by model and
    language, those that have stems; the models are against the trusted rows of odd folds, of even ones and of both."""

    def __init__(self, table: DataFrame, numbers: dict[tuple[int, str | None], int]):
        self.table, self.numbers = table, numbers
        self.maybe = table.sparkSession.sparkContext.broadcast(key_map(table, "stem")) if numbers else None

    def join(self, bits: DataFrame, rows: DataFrame, text_col: str, lang_col: str, model: Column) -> DataFrame:
        """``bits`` of the chunks of ``rows`` and the stems found in each: ``before`` is the stem, ``last`` is -1 less its number. ``model``: of every row."""
        if not self.numbers:
            return bits.withColumn("worth", F.lit(None).cast("double"))
        numbers, maybe = self.numbers, self.maybe

        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            release_worker_tables()
            now, held = None, {}

            def distinct() -> Iterator[pa.RecordBatch]:
                for number, found in held.items():
                    names = np.unique(np.concatenate(found)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(names), now)), pa.array(names), pa.array(np.full(len(names), -1 - number, np.int32))],
                                                     ["_chunk", "before", "last"])

            for chunk, part in _pieces(batches, 1):
                if chunk != now:
                    yield from distinct()
                    now, held = chunk, {}
                found, before = stems(*text_buffers(part.column(1)))
                which = [_number(numbers, m, lang) for lang, m in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                which = np.repeat(np.array([-1 if k is None else k for k in which]), np.diff(before) * len(STEMS))
                found = found.ravel()
                asked = np.flatnonzero(in_map(maybe.value, found) & (which >= 0))
                for number in np.unique(which[asked]).tolist():
                    held.setdefault(number, []).append(np.unique(found[asked[which[asked] == number]]))
            yield from distinct()

        asked = rows.select("_chunk", F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"), model.alias("model"))
        asked = asked.mapInArrow(emit, "_chunk bigint, before bigint, last int")
        table = self.table.select(F.col("stem").alias("before"), (-1 - F.col("number")).alias("last"), "worth")
        return bits.unionByName(asked.join(table, ["before", "last"]), allowMissingColumns=True)


def _number(numbers: dict, model: int, lang: str | None) -> int | None:
    return numbers.get((model, lang), numbers.get((model, POOLED)))


def _chunk_stems(bits: pa.Table, langs: list, numbers: dict, models: Iterable[int]) -> tuple[pa.Table, list[dict]]:
    """What ``Stems.join`` told of a chunk: (bits of its grams, by model and language its stems)."""
    told = bits.column("last").to_numpy() < 0
    found = bits.filter(pa.array(told))
    number, names, worth = -1 - found.column("last").to_numpy(), found.column("before").to_numpy().view(np.uint64), found.column("worth").to_numpy()
    tables = {k: StemTable(names[number == k], worth[number == k]) for k in np.unique(number).tolist()}
    return bits.filter(pa.array(~told)), [{lang: tables.get(_number(numbers, m, lang)) for lang in set(langs)} for m in models]


def contrasts(data: np.ndarray, ends: np.ndarray, tables: list[StemTable | None], toll: float) -> np.ndarray:
    """Per text, the worth of its words' best stems by its table less ``toll`` for every word."""
    found, before = stems(data, ends)
    out = -toll * np.diff(before).astype(np.float64)
    best = np.zeros(len(found))
    for table in {id(t): t for t in tables if t is not None and len(t.names)}.values():
        words = np.flatnonzero(np.repeat([t is table for t in tables], np.diff(before)))
        at, number = table.find(found[words].ravel())
        word = at // len(STEMS)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        if len(first):
            best[words[word[first]]] = np.maximum.reduceat(table.worth[number], first)
    for i in range(len(out)):
        out[i] += best[before[i]: before[i + 1]].sum()
    return out


def _scores(texts: pa.Array, langs: list, bits: pa.Table, models: list[dict[str | None, StemTable | None]], which: np.ndarray, skipped: int, toll: float) -> list[tuple[float, float, float] | None]:
    """(log2 perplexity, log2 peak perplexity, contrast) of every text of a chunk, by its model. ``bits``: before, last and
    a column for each model."""
    first, last = (bits.column(c).to_numpy() for c in ("before", "last"))
    values = [bits.column(f"b{k}").to_numpy() for k in range(len(models))]
    out: list = [None] * len(langs)
    done = 0
    for part in text_slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text", STEP_BYTES):
        data, ends = text_buffers(part.column(0))
        here = slice(done, done + part.num_rows)
        flat, starts, before = placed_grams(data, ends)
        grams = Grams(flat, starts)
        found = grams.find(first, last)
        model = which[here].tolist()
        worth = contrasts(data, ends, [models[k].get(lang, models[k].get(POOLED)) for k, lang in zip(model, langs[here])], toll)
        each = {k: grams.values(found, values[k]) for k in set(model)}
        for i, k in enumerate(model):
            if before[i + 1] > before[i]:
                out[done + i] = (*surprise(each[k][grams.numbers[before[i]: before[i + 1]]], skipped), float(worth[i]))
        done += part.num_rows
    return out


def _column(table: pa.Table, at: int | str) -> pa.Array:
    found = table.column(at).combine_chunks()
    return found if isinstance(found, pa.Array) else pa.concat_arrays(found.chunks)


class Classifier:
    """A fitted model: ``keep`` the rows of any frame with the text and language columns."""

    def __init__(self, model: tuple[GramTables, Stems] | None, limits: dict[str | None, tuple[int, ...]], overall: tuple[int, ...] | None,
                 skipped: int, toll: float, text_col: str, lang_col: str):
        self.model, self.limits, self.overall = model, limits, overall
        self.skipped, self.toll, self.text_col, self.lang_col = skipped, toll, text_col, lang_col

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``perplexity``, ``peak_perplexity``, ``contrast`` and ``keep``."""
        new = ("perplexity", "peak_perplexity", "contrast", "keep")
        docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in new))
        fields = [StructField(n, DoubleType()) for n in new[:3]] + [StructField(new[3], BooleanType())]
        if self.model is None:
            return docs.withColumns({**{n: F.lit(None).cast("double") for n in new[:3]}, new[3]: F.lit(True)})
        grams, worth = self.model
        limits, overall, skipped, toll, numbers = self.limits, self.overall, self.skipped, self.toll, worth.numbers
        text, lang = docs.columns.index(self.text_col), docs.columns.index(self.lang_col)
        given, docs = docs.columns, docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # no input name can clash
        rows = chunked(docs, f"c{text}", "texts-to-score")

        def judge(chunk: pa.Table, bits: pa.Table) -> pa.Table:
            release_worker_tables()
            chunk = chunk.drop_columns("_chunk")
            langs = chunk.column(lang).to_pylist()
            bits, models = _chunk_stems(bits, langs, numbers, [2])
            found = _scores(_column(chunk, text), langs, bits, models, np.zeros(chunk.num_rows, np.int64), skipped, toll)
            keep = [s is None or all(_step(v) <= m for v, m in zip(s, limits.get(name, overall))) for s, name in zip(found, langs)]
            told = [[None if s is None else f(s) for s in found] for f in (lambda s: 2.0 ** s[0], lambda s: 2.0 ** s[1], lambda s: s[2])]
            return pa.Table.from_arrays([*chunk.columns, *(pa.array(t, pa.float64()) for t in told), pa.array(keep, pa.bool_())], [*chunk.schema.names, *new])

        bits = worth.join(grams.bits(chunk_grams(rows, f"c{text}"), (FOLDS,)), rows, f"c{text}", f"c{lang}", F.lit(2))
        judged = rows.groupBy("_chunk").cogroup(bits.groupBy("_chunk")).applyInArrow(judge, StructType([*docs.schema.fields, *fields]))
        return judged.toDF(*given, *new)


def _step(value: float) -> int:
    return int(np.floor(value / STEP))


def fit(docs: DataFrame, labels: DataFrame, quantile: float = 0.995, skipped: int = 8, toll: float = 0.04,
        id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Classifier:
    """Fit model and thresholds on all rows of ``docs`` that ``labels`` (id, quality 0/1, toxic 0/1) trusts or calls toxic. The labels are
    joined by id: few of them go to every task and no text is shuffled, many are shuffled with the texts."""
    told = labels.select(F.col(id_col).cast(docs.schema[id_col].dataType).alias("_id"), "quality", "toxic").where("_id IS NOT NULL").groupBy("_id").agg(
        F.min("quality").alias("q"), F.max("toxic").alias("t"))
    told = told.select("_id", F.when(F.col("t") == 1, True).when((F.col("q") == 1) & (F.col("t") == 0), False).alias("toxic")).where("toxic IS NOT NULL")
    told = stored(told, "labels-told")  # its size tells Spark which join to take
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), F.col(id_col).alias("_id"))
    fold = F.xxhash64("_id").bitwiseAND(FOLDS - 1).cast("int").alias("fold")
    rows = rows.join(told, "_id").select("text", "lang", fold, "toxic")
    rows = chunked(rows, "text", "labelled-texts")
    drop_stored(told)
    trusted = rows.where("NOT toxic").select("_chunk", "text", "lang", "fold")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", STEP_BYTES):
                flat, starts, places = placed_grams(*text_buffers(part.column(1)))
                found = Grams(flat, starts)
                fold = np.repeat(part.column(3).to_numpy(), np.diff(places))
                before, last = found.columns()
                n = np.bincount(found.numbers * FOLDS + fold, minlength=len(found.keys) * FOLDS).reshape(-1, FOLDS).T
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (before, last, *n)], ["before", "last", *(f"f{f}" for f in range(FOLDS))])

    every = sum((F.col(f"f{f}") for f in range(1, FOLDS)), F.col("f0"))
    counted = trusted.mapInArrow(count, "before bigint, last int, " + ", ".join(f"f{f} bigint" for f in range(FOLDS))).groupBy("before", "last").agg(
        *(F.sum(every - F.col(f"f{f}")).alias(f"n{f}") for f in range(FOLDS)), F.sum(every).alias(f"n{FOLDS}"))
    counted = stored(counted, "grams-4")
    some = counted.agg(*(F.sum(f"n{m}") for m in MODELS)).first()
    if not some[FOLDS]:
        return Classifier(None, {}, None, skipped, toll, text_col, lang_col)
    grams, worth = GramTables(counted), _stem_tables(rows)
    drop_stored(counted)
    numbers = worth.numbers

    def held_out(chunk: pa.Table, bits: pa.Table) -> pa.Table:
        release_worker_tables()
        langs = chunk.column("lang").to_pylist()
        bits, models = _chunk_stems(bits, langs, numbers, [f & 1 for f in range(FOLDS)])
        found = _scores(_column(chunk, "text"), langs, bits, models, chunk.column("fold").to_numpy(), skipped, toll)
        steps = [pa.array([None if s is None else _step(s[i]) for s in found], pa.int32()) for i in range(3)]
        return pa.Table.from_arrays([chunk.column("lang"), *steps], ["lang", "mean", "peak", "contrast"])

    bits = grams.bits(chunk_grams(trusted, "text"), tuple(m if some[m] else FOLDS for m in range(FOLDS)), all_seen=True)
    bits = worth.join(bits, trusted, "text", "lang", F.col("fold").bitwiseAND(1))
    names = ("mean", "peak", "contrast")
    scored = trusted.groupBy("_chunk").cogroup(bits.groupBy("_chunk")).applyInArrow(held_out, "lang string, mean int, peak int, contrast int")
    scored = stored(scored.where("mean IS NOT NULL"), "held-out")
    drop_stored(rows)
    steps = scored.select("lang", F.posexplode(F.array(*names)).alias("score", "step")).groupBy("lang", "score", "step").agg(F.count("*").alias("n"))
    limits = steps.groupBy("score", "lang").agg(F.percentile("step", F.lit(quantile), F.col("n")).cast("int").alias("m"), F.lit(False).alias("all")).unionAll(
        steps.groupBy("score").agg(F.lit(None).cast("string").alias("lang"), F.percentile("step", F.lit(quantile), F.col("n")).cast("int").alias("m"), F.lit(True).alias("all"))
    ).collect()  # three rows per language
    drop_stored(scored)
    found: dict = {}
    for r in limits:
        found.setdefault((r["all"], r["lang"]), [0, 0, 0])[r["score"]] = max(r["m"], 0)
    by_lang = {lang: tuple(m) for (every, lang), m in found.items() if not every}
    return Classifier((grams.only(FOLDS), worth), by_lang, tuple(found[True, None]), skipped, toll, text_col, lang_col)


def _stem_tables(rows: DataFrame, least: int = 3, ratio: float = 3.0, z: float = 5.0) -> Stems:
    """By language and for all ``POOLED``, the stems toxic rows (``least`` of them) hold far more often: three models, against the trusted rows of odd folds, of even ones and of both."""
    texts = {(r["lang"], r["toxic"], r["fold"]): r["n"] for r in rows.groupBy("lang", "toxic", F.col("fold").bitwiseAND(1).alias("fold")).agg(F.count("*").alias("n")).collect()}
    for (_, *rest), n in list(texts.items()):
        texts[POOLED, *rest] = texts.get((POOLED, *rest), 0) + n
    names = {lang: i for i, lang in enumerate(dict.fromkeys(lang for lang, *_ in texts))}
    folds = ((1,), (0,), (0, 1))

    def in_texts(given: DataFrame, maybe: Broadcast | None = None) -> DataFrame:
        """How many texts hold a stem, by language and by whether the fold is odd. ``maybe``: a map of the stems to count."""
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict = {}
            size = 0

            def counted() -> Iterator[pa.RecordBatch]:
                for (name, odd), found in held.items():
                    stem, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(stem), name, np.int32)), pa.array(np.full(len(stem), odd, np.int32)),
                                                      pa.array(stem.view(np.int64)), pa.array(n)], ["name", "odd", "stem", "n"])

            for batch in batches:
                for part in text_slices(batch, "text"):
                    found, before = stems(*text_buffers(part.column(0)))
                    told = found != 0 if maybe is None else (found != 0) & in_map(maybe.value, found)
                    for i, (lang, fold) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                        here = slice(before[i], before[i + 1])
                        once = np.unique(found[here][told[here]])
                        held.setdefault((names[lang], fold & 1), []).append(once)
                        size += len(once)
                    if size > 1 << 22:
                        yield from counted()
                        held, size = {}, 0
            yield from counted()

        return given.select("text", "lang", "fold").mapInArrow(count, "name int, odd int, stem bigint, n bigint")

    toxic = stored(in_texts(rows.where("toxic")).groupBy("name", "stem").agg(F.sum("n").alias("n")), "toxic-stems")
    pooled = lambda t, *n: t.groupBy("stem").agg(*(F.sum(c).alias(c) for c in n)).select(F.lit(names.get(POOLED, -1)).alias("name"), "stem", *n)
    often = stored(pooled(toxic, "n").where(F.col("n") >= least), "toxic-stems-often")
    asked = rows.sparkSession.sparkContext.broadcast(key_map(often, "stem"))
    clean = in_texts(rows.where("NOT toxic"), asked).groupBy("name", "stem").agg(*(F.sum(F.when(F.col("odd") == f, F.col("n")).otherwise(0)).alias(f"n{f}") for f in (0, 1)))
    clean = stored(clean.join(often.select("stem"), "stem", "left_semi").select("name", "stem", "n0", "n1"), "trusted-stems")
    met = toxic.where(F.col("n") >= least).unionAll(often).join(clean.unionAll(pooled(clean, "n0", "n1")), ["name", "stem"], "left").fillna(0, ["n0", "n1"])
    toxic_texts = np.array([sum(texts.get((lang, True, f), 0) for f in (0, 1)) for lang in names])
    clean_texts = [np.array([sum(texts.get((lang, False, f), 0) for f in fs) for lang in names]) for fs in folds]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name, stem, n, *held = (c.to_numpy() for c in batch.columns)
            for model, fs in enumerate(folds):
                share = (sum(held[f] for f in fs) + 0.5) / (clean_texts[model][name] + 1)
                worth = np.log(n / toxic_texts[name] / share)
                clear = (worth >= np.log(ratio)) & (n - toxic_texts[name] * share >= z * np.sqrt(toxic_texts[name] * share))
                yield pa.RecordBatch.from_arrays([pa.array(x[clear]) for x in (name * np.int32(len(folds)) + np.int32(model), stem, worth)], ["number", "stem", "worth"])

    table = stored(met.select("name", "stem", "n", "n0", "n1").mapInArrow(judged, "number int, stem bigint, worth double"), "stems")
    drop_stored(toxic, often, clean)
    held = {r["number"] for r in table.select("number").distinct().collect()}  # three numbers a language at most
    return Stems(table, {(m, lang): k for lang, i in names.items() for m in range(len(folds)) if (k := i * len(folds) + m) in held})
