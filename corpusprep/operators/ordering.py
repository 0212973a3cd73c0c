"""Row order: dense row index, ordered prefix sums, running aggregates within groups,
head splits and limits, repeatable shuffles.

Datasets have a meaningful row order (the validation share is the *first* p percent, limits
keep the *first* n rows, packing concatenates *consecutive* rows). Spark rows have no order,
so every operator here takes an explicit, unique order key.

Scale design
------------
``row_index`` never funnels rows through one task. A numeric *bucket key* that is monotone in
the order (a single numeric order column, or one given) is cut into balanced ranges by
``approxQuantile``; the bounds are planted in the plan as literals, so a stage recomputed after an
executor loss assigns the same buckets. Each row gets its rank inside its bucket from a window
partitioned by bucket, and the bucket's offset from an exclusive prefix sum over the per-bucket counts.

Any other order (strings, several columns, and keys of which one value or NULL fills more than a
bucket) is cut by ranges over the whole key: the rows are range-partitioned by group, key and a
tie-breaking number, sorted, and stored once with their place, so equal keys, NULL keys and one hot
group are dealt over many tasks, and everything later reads the same ranges.

``grouped_scan`` computes running sum/min/max along an integer step inside groups (runs,
conversations) as a tree: windows over fixed-size step chunks, then over the chunk totals, with as
many levels as the longest group needs, so no window holds more than a chunk.

``nth_key`` finds the key of the n-th row by refining a histogram of the key columns; heads and
membership splits are then a comparison with that key, and no row is shuffled for them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.constants import DEFAULT_VALIDATION_PERCENT
from corpusprep.session import stored

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _names(cols) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def default_buckets(df: DataFrame) -> int:
    """Two buckets per shuffle partition (enough to spread hash collisions): with shuffle
    partitions sized to the data a bucket window stays near a partition's size."""
    return max(2, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """``left.join(right, on)`` that also matches NULL keys with NULL keys. ``right`` has one row per key."""
    renamed = right.select(*[F.col(c).alias(f"__on_{c}") if c in on else F.col(c) for c in right.columns])
    match = [left[c].eqNullSafe(renamed[f"__on_{c}"]) for c in on]
    return left.join(renamed, match, how).drop(*[f"__on_{c}" for c in on])


def seeded_order_key(seed: int, id_col) -> Column:
    """Repeatable pseudo-random 60-bit key from ``md5(seed || '-' || id)``.

    Independent of partitioning (unlike ``rand(seed)``) and uniform, so it is also a good
    bucket key. DuckDB: ``('0x' || substr(md5(seed || '-' || id), 1, 15))::BIGINT``.
    """
    text = F.concat(F.lit(f"{seed}-"), _col(id_col).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


SEEDED_KEY_RANGE = (0, 2 ** 60)  # seeded_order_key is uniform on this range


def _bounds(df: DataFrame, bucket_key: Column, num_buckets: int, relative_error: float | None,
            uniform_range: tuple | None = None) -> list[float]:
    """Upper bounds of all buckets but the last. A value that fills several buckets comes several times."""
    if num_buckets <= 1:
        return []
    if uniform_range is not None:  # a key uniform by construction: equal-width bounds, no pass
        lo, hi = uniform_range
        return [lo + (hi - lo) * i / num_buckets for i in range(1, num_buckets)]
    # balance only needs to be approximate: a tenth of a bucket
    err = relative_error if relative_error is not None else 1.0 / (10.0 * num_buckets)
    probs = [i / num_buckets for i in range(1, num_buckets)]
    keys = df.select(_numeric_key(bucket_key).alias("__bk"))
    return keys.approxQuantile("__bk", probs, err)  # one pass over the key column


def _numeric_key(bucket_key: Column) -> Column:
    return F.coalesce(bucket_key.cast("double"), F.lit(float("-inf")))


def _hot(bounds: list[float]) -> bool:
    """Whether one value (or NULL) fills two whole buckets."""
    return any(a == b == c for a, b, c in zip(bounds, bounds[1:], bounds[2:]))


def _in_buckets(df: DataFrame, bucket_key: Column, bounds: list[float]) -> DataFrame:
    """``df`` with ``__bucket``, a number that does not fall along the key."""
    inner = sorted({b for b in bounds if b == b and b not in (float("inf"), float("-inf"))})
    if not inner:  # empty input or a single key value: one bucket
        return df.withColumn("__bucket", F.lit(0.0))
    splits = [float("-inf")] + inner + [float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol="__bk", outputCol="__bucket",
                            handleInvalid="keep")  # NaN sorts last: own last bucket
    return bucketizer.transform(df.withColumn("__bk", _numeric_key(bucket_key))).drop("__bk")


def _bucketize(df: DataFrame, bucket_key: Column, num_buckets: int,
               relative_error: float | None, uniform_range: tuple | None = None) -> DataFrame:
    return _in_buckets(df, bucket_key, _bounds(df, bucket_key, num_buckets, relative_error, uniform_range))


#: Keys that Spark samples to cut ranges (it takes up to three times as many), in all, and the fewest for a range. They go to the driver
#: whole, and a key may be a text; bounds need only be roughly even.
_RANGE_KEYS, _LEAST_KEYS = 12_800, 10


@contextmanager
def _range_sample(spark, num_ranges: int) -> Iterator[None]:
    name = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, min(max(_RANGE_KEYS // num_ranges, _LEAST_KEYS), int(before)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _running_sum(values: Column) -> Column:
    """The sum of ``values`` (longs, none null) of the rows before each in its partition, in the order they come."""
    @F.pandas_udf("bigint")
    def before(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        total = 0
        for part in parts:
            sums = part.cumsum() + total
            yield sums - part
            total = int(sums.iloc[-1]) if len(sums) else total

    return before(values)


def in_ranges(df: DataFrame, order_by: list, num_ranges: int, sum_of: str | None = None) -> DataFrame:
    """``df`` stored in ascending ``order_by`` order, cut into ranges: ``__bucket`` is the range and ``__place``
    the place in it. Any orderable columns; NULLs first. Equal keys get an arbitrary but fixed order and may lie in
    several ranges. The ranges are Spark's sampled ones, taken once: later reads see the files. ``sum_of`` (a column of longs, none
    null): ``__sum`` is its sum over the range's rows before, so that no later window has to move the rows for it."""
    keyed = df.withColumn("__tie", F.monotonically_increasing_id())
    run = keyed.repartitionByRange(num_ranges, *order_by, "__tie").sortWithinPartitions(*order_by, "__tie")
    # after the sort this number is (partition, place in it)
    run = run.drop("__tie").withColumn("__at", F.monotonically_increasing_id())
    run = run.withColumn("__sum", _running_sum(F.col(sum_of))) if sum_of else run
    with _range_sample(df.sparkSession, num_ranges):
        run = stored(run, "ordered")
    return run.withColumn("__bucket", F.shiftright("__at", 33).cast("bigint")) \
        .withColumn("__place", F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__at")


def ordered_buckets(df: DataFrame, order_by, *, partition_by=None, bucket_key=None, num_buckets: int | None = None,
                    relative_error: float | None = None, uniform_range: tuple | None = None, sum_of: str | None = None) -> tuple[DataFrame, list]:
    """``df`` with ``__bucket`` (monotone along ``order_by``, within each group), and the columns that order the rows
    of one bucket. See the module's notes for the two ways; ranges have ``__sum`` too if ``sum_of`` is given (see ``in_ranges``)."""
    given = list(order_by) if isinstance(order_by, (list, tuple)) else [order_by]
    groups, nb = _names(partition_by), num_buckets or default_buckets(df)
    keys = [_col(c) for c in given]
    if bucket_key is None and len(given) == 1 and isinstance(df.select(keys[0]).schema.fields[0].dataType, _NUMERIC):
        bucket_key = keys[0]
    if bucket_key is not None:
        bounds = _bounds(df, _col(bucket_key), nb, relative_error, uniform_range)
        if not _hot(bounds):
            return _in_buckets(df, _col(bucket_key), bounds), keys
    return in_ranges(df, [*groups, *keys], nb, sum_of), [F.col("__place")]


def with_cell(df: DataFrame, groups: list) -> DataFrame:
    """``df`` with ``__cell``, a struct of group and bucket in place of ``__bucket``. Structs are equal where their NULL fields are, so windows,
    aggregates and joins on it share one exchange."""
    return df.withColumn("__cell", F.struct(*groups, F.col("__bucket").cast("bigint").alias("__bucket"))).drop("__bucket")


def row_index(df: DataFrame, order_by, *, name: str = "row_idx", partition_by=None,
              bucket_key=None, prefix_sums: dict | None = None, total_name: str | None = None,
              num_buckets: int | None = None, relative_error: float | None = None,
              uniform_range: tuple | None = None) -> DataFrame:
    """Add ``name``: the dense 0-based position of each row in ascending ``order_by``
    (restarting per ``partition_by`` group), NULL keys first. ``order_by`` must be unique within a group
    for a deterministic result; rows with equal keys get different positions.

    ``order_by`` is any list of orderable columns. ``bucket_key`` is a numeric column, monotone
    non-decreasing along ``order_by``; it defaults to the order column if that is a single numeric one. Without
    one, or when a single value of it fills several buckets, the rows are stored in ranges of the whole key.

    ``prefix_sums`` maps output names to numeric columns: each output is the *exclusive*
    running sum of that column along the same order (e.g. the token offset of a document).
    ``total_name`` adds the group's row count to every row. ``uniform_range=(lo, hi)`` declares
    the bucket key uniform on that range (a hash), so the bounds need no pass over the data.
    """
    groups = _names(partition_by)
    nb = num_buckets or default_buckets(df)
    sums = dict(prefix_sums or {})
    for k, c in sums.items():
        df = df.withColumn(f"__v_{k}", c)
    b, keys = ordered_buckets(df, order_by, partition_by=groups, bucket_key=bucket_key, num_buckets=nb,
                              relative_error=relative_error, uniform_range=uniform_range)
    cell = "__cell" if groups else "__bucket"
    b = with_cell(b, groups) if groups else b
    in_range = "__place" in b.columns

    # per-cell counts and sums (one row per cell): Catalyst prunes this branch to the key
    # columns, so it re-reads only those and aggregates them map-side before its small shuffle
    aggs = [F.count(F.lit(1)).alias("__n")] + [F.sum(f"__v_{k}").alias(f"__s_{k}") for k in sums]
    if in_range:  # the rows of a cell stand one after the other in their range
        aggs.append(F.min("__place").alias("__first"))
    counts = b.groupBy(cell).agg(*aggs)
    if groups:
        counts = counts.select("*", "__cell.*")
    scans = {"__off": ("sum", "__n")} | {f"__o_{k}": ("sum", f"__s_{k}") for k in sums}
    offsets = grouped_scan(counts, groups, "__bucket", scans, inclusive=False, span=nb + 1)
    if total_name:  # over one row per cell
        offsets = offsets.withColumn(total_name, F.sum("__n").over(Window.partitionBy(*groups)))
    offsets = offsets.drop("__n", *[f"__s_{k}" for k in sums])
    if groups:
        offsets = offsets.drop(*groups, "__bucket")
    else:
        offsets = F.broadcast(offsets)  # one row per bucket: a fixed, small bound

    # rank (and running sums) inside each (group, bucket): one exchange on the cell; none for the rank in a range
    w = Window.partitionBy(cell).orderBy(*keys)
    local = b if in_range else b.withColumn("__rank", F.row_number().over(w) - 1)
    for k in sums:
        local = local.withColumn(f"__l_{k}", F.coalesce(
            F.sum(f"__v_{k}").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    out = local.join(offsets, cell)
    rank = F.col("__place") - F.col("__first") if in_range else F.col("__rank")
    out = out.withColumn(name, (F.col("__off") + rank).cast("bigint"))
    for k in sums:
        out = out.withColumn(k, F.col(f"__o_{k}") + F.col(f"__l_{k}"))
    drop = ["__bucket", "__cell", "__rank", "__off", "__place", "__first"] + [f"__{p}_{k}" for k in sums for p in ("o", "l", "v")]
    return out.drop(*drop)


_SCAN_OPS = {
    "sum": (F.sum, lambda prev, cur: F.coalesce(prev, F.lit(0)) + F.coalesce(cur, F.lit(0))),
    "count": (F.sum, lambda prev, cur: F.coalesce(prev, F.lit(0)) + F.coalesce(cur, F.lit(0))),
    "min": (F.min, lambda prev, cur: F.least(prev, cur)),
    "max": (F.max, lambda prev, cur: F.greatest(prev, cur)),
}


def step_span(df: DataFrame, step: str) -> int:
    """How many steps lie between the least and the greatest one."""
    lo, hi = df.agg(F.min(step), F.max(step)).first()
    return 0 if lo is None else int(hi) - int(lo) + 1


def grouped_scan(df: DataFrame, partition_by, step: str, aggs: dict, *,
                 inclusive: bool = True, chunk_size: int = 1024, span: int | None = None) -> DataFrame:
    """Running aggregates along the integer ``step`` (unique within a group) per group.

    ``aggs`` maps an output name to ``(op, column)`` with op in sum / count / min / max. With
    ``inclusive`` the current row counts, else only earlier rows (NULL/0 when none).
    Computed as a tree: windows over chunks of ``chunk_size`` steps, whose totals are scanned the same way,
    with as many levels as ``span`` (the steps between the least and the greatest one, or an upper bound of it; measured
    when not given) needs. So every window holds about ``chunk_size`` rows at most, whatever the group.
    Sum over doubles is re-associated; cast to DECIMAL first when bit-exact sums matter.
    """
    if span is None:
        span = step_span(df, step)
    return _scan(df, _names(partition_by), step, aggs, inclusive, max(int(chunk_size), 2), span, 0)


def _scan(df: DataFrame, groups: list, step: str, aggs: dict, inclusive: bool, chunk_size: int, span: int, level: int) -> DataFrame:
    frame_end = 0 if inclusive else -1
    whole = span <= max(chunk_size, 4)  # the top of the tree: one window a group
    chunk = f"__chunk{level}"
    d = df if whole else df.withColumn(chunk, F.floor(F.col(step) / F.lit(chunk_size)).cast("bigint"))
    cell = groups if whole else groups + [chunk]
    w_in = Window.partitionBy(*cell).orderBy(step).rowsBetween(Window.unboundedPreceding, frame_end)
    tot_aggs, above = [], {}
    name = lambda kind, out: f"__{kind}{level}_{out}"
    for out, (op, c) in aggs.items():
        fn, _ = _SCAN_OPS[op]
        d = d.withColumn(name("val", out), F.lit(1) if op == "count" else _col(c))
        d = d.withColumn(name("loc", out), fn(name("val", out)).over(w_in))
        tot_aggs.append(fn(name("val", out)).alias(name("tot", out)))
        above[name("prev", out)] = ("sum" if op == "count" else op, name("tot", out))
    if not whole:
        # chunk totals (one row per chunk): pruned by Catalyst to the step and value columns
        totals = d.groupBy(*cell).agg(*tot_aggs)
        before = _scan(totals, groups, chunk, above, False, chunk_size, span // chunk_size + 2, level + 1)
        d = null_safe_join(d, before.select(*cell, *above), cell)
    for out, (op, _c) in aggs.items():
        _, combine = _SCAN_OPS[op]
        before_chunk = F.lit(None) if whole else F.col(name("prev", out))
        d = d.withColumn(out, combine(before_chunk, F.col(name("loc", out))))
    return d.drop(chunk, *[name(p, o) for o in aggs for p in ("loc", "prev", "val")])


def head_percent_split(df: DataFrame, order_by, percent: float = DEFAULT_VALIDATION_PERCENT, *,
                       split_col: str = "split", index_col: str = "row_idx", bucket_key=None,
                       keep_index: bool = True) -> DataFrame:
    """The first ``round_half_even(n * percent / 100)`` rows become ``validation``, the rest
    ``train`` (a head cut by position, not a random split). With ``keep_index`` the
    ``index_col`` holds the position inside the row's split.

    Without ``keep_index`` only membership is needed: ``nth_key`` finds the last validation key, and the
    split is a plain comparison — the rows themselves are not shuffled (the key must then be unique)."""
    if not keep_index:
        return _split_by_boundary(df, order_by, percent, split_col)
    idx = row_index(df, order_by, name=index_col, bucket_key=bucket_key, total_name="__total")
    cut = F.bround(F.col("__total") * F.lit(float(percent)) / F.lit(100.0), 0).cast("bigint")
    is_val = F.col(index_col) < cut
    out = idx.withColumn(split_col, F.when(is_val, F.lit("validation")).otherwise(F.lit("train")))
    out = out.withColumn(index_col, F.when(is_val, F.col(index_col)).otherwise(F.col(index_col) - cut))
    return out.drop("__total")


def _split_by_boundary(df: DataFrame, order_by, percent: float, split_col: str) -> DataFrame:
    cut = df.agg(F.bround(F.count(F.lit(1)) * F.lit(float(percent)) / F.lit(100.0), 0).cast("bigint")).first()[0]
    found = nth_key(df, order_by, cut)
    if found is None:
        return df.withColumn(split_col, F.lit("train"))
    return df.withColumn(split_col, F.when(found.up_to, F.lit("validation")).otherwise(F.lit("train")))


#: Keys that one task and the driver hold at most when an order statistic is looked for, and bounds of one histogram.
_HELD_KEYS, _HISTOGRAM = 4096, 32


class NthKey:
    """The key of a row of given position. ``up_to`` / ``before``: conditions on the rows whose key is not greater / is less.
    ``tied``: whether further rows after that position have the same key."""

    def __init__(self, columns: list[str], types: list, values: tuple, tied: bool):
        self.columns, self.values, self.tied = columns, values, tied
        literals = [F.lit(v).cast(t) for v, t in zip(values, types)]
        if len(columns) == 1:
            c = F.col(columns[0])
            self.up_to = c.isNull() | (F.lit(values[0] is not None) & F.coalesce(c <= literals[0], F.lit(False)))
            self.before = F.lit(values[0] is not None) & (c.isNull() | F.coalesce(c < literals[0], F.lit(False)))
        else:
            key, bound = F.struct(*columns), F.struct(*[lit.alias(c) for lit, c in zip(literals, columns)])
            first = F.col(columns[0]).isNull() | F.coalesce(F.col(columns[0]) <= literals[0], F.lit(False))  # may reach the scan
            self.up_to, self.before = first & (key <= bound), first & (key < bound)


def nth_key(df: DataFrame, order_by, n: int) -> NthKey | None:
    """The key of the ``n``-th row (from 1) in ascending ``order_by`` (named columns of any orderable type, NULLs first);
    None if there is no such row.

    Only the key columns are read and nothing is shuffled. While the row is further than ``_HELD_KEYS`` from either end of the
    keys still in question, a random sample of them gives the bounds of a histogram around its rank; one counting pass then
    leaves the keys between two bounds. The sample decides how fast that is, not the answer. The last step is a top-k."""
    columns = _names(order_by)
    if not all(isinstance(c, str) for c in columns):
        raise ValueError("order_by must name columns")
    if n is None or n < 1:
        return None
    types = [df.schema[c].dataType for c in columns]
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)])
    keys = df.select(key.alias("k"))

    def literal(values) -> Column:
        return F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(values, types))])

    rank, rows = n - 1, None  # the row's rank among ``keys``, and how many these are once that is known
    while True:
        if rank < _HELD_KEYS:
            last = keys.orderBy("k").limit(rank + 2).collect()[rank:]
            return NthKey(columns, types, tuple(last[0].k), len(last) > 1 and last[0].k == last[1].k) if last else None
        rows = keys.count() if rows is None else rows
        if rank >= rows:
            return None
        if rows - rank <= _HELD_KEYS:
            last = keys.orderBy(F.desc("k")).limit(rows - rank).collect()[::-1]
            return NthKey(columns, types, tuple(last[0].k), len(last) > 1 and last[0].k == last[1].k)
        sample = [tuple(r.k) for r in keys.withColumn("r", F.rand(17)).orderBy("r").limit(_HELD_KEYS).select("k").orderBy("k").collect()]
        at, spread = rank / rows * len(sample), 2.0 * len(sample) ** 0.5
        picked = [int(at + spread * (2 * i / (_HISTOGRAM - 1) - 1)) for i in range(_HISTOGRAM)]
        bounds = list(dict.fromkeys(sample[min(max(i, 0), len(sample) - 1)] for i in picked))
        counts = keys.agg(*[F.count_if(F.col("k") < literal(b)).alias(f"l{i}") for i, b in enumerate(bounds)],
                          *[F.count_if(F.col("k") <= literal(b)).alias(f"e{i}") for i, b in enumerate(bounds)]).first()
        low, high, start, end = None, None, 0, rows
        for i, b in enumerate(bounds):
            less, up_to = counts[f"l{i}"], counts[f"e{i}"]
            if less <= rank < up_to:
                return NthKey(columns, types, b, rank + 1 < up_to)
            if up_to <= rank:
                low, start = b, up_to
            elif high is None:
                high, end = b, less
        if low is not None:
            keys = keys.where(F.col("k") > literal(low))
        if high is not None:
            keys = keys.where(F.col("k") < literal(high))
        rank, rows = rank - start, end - start


def choose_validation(train: DataFrame, validation: DataFrame | None = None, *, order_by=None,
                      percent: float = DEFAULT_VALIDATION_PERCENT, split_col: str = "split",
                      bucket_key=None) -> DataFrame:
    """Use the given validation table, else cut the first ``percent`` of train off."""
    if validation is not None:
        return (train.withColumn(split_col, F.lit("train"))
                .unionByName(validation.withColumn(split_col, F.lit("validation"))))
    if order_by is None:
        raise ValueError("order_by is required to cut validation rows off train")
    return head_percent_split(train, order_by, percent, split_col=split_col, bucket_key=bucket_key,
                              keep_index=False)


def head_limit(df: DataFrame, n, *, index_col: str = "row_idx", split_col: str = "split") -> DataFrame:
    """Keep rows with position < n; NULL or n <= 0 keeps all rows. Needs a row index column
    (position within the split when the index restarts per split). ``n`` may be a dict
    ``{split value: n}`` to limit each split on its own."""
    if isinstance(n, dict):
        cond = F.lit(False)
        for value, lim in n.items():
            keep = F.lit(True) if lim is None or lim <= 0 else F.col(index_col) < F.lit(int(lim))
            cond = cond | ((F.col(split_col) == F.lit(value)) & keep)
        return df.where(cond)
    if n is None or n <= 0:
        return df
    return df.where(F.col(index_col) < F.lit(int(n)))


def head_rows(df: DataFrame, order_by, n: int | None) -> DataFrame:
    """The first ``n`` rows in ``order_by`` order (``None`` or <= 0: every row), by comparison with the key of the ``n``-th: no
    row is shuffled. NULL keys come first; of rows with equal keys exactly as many are taken as ``n`` allows (then,
    and only then, the rows of that one key are counted off in an arbitrary order)."""
    if n is None or n <= 0:
        return df
    found = nth_key(df, order_by, int(n))
    if found is None:  # fewer rows than that
        return df
    if not found.tied:
        return df.where(found.up_to)
    before = df.where(found.before)
    ties = df.where(found.up_to & ~found.before)
    left = int(n) - before.count()
    ties = row_index(ties, _names(order_by), name="__tied").where(F.col("__tied") < left).drop("__tied")
    return before.unionByName(ties)


def first_rows(df: DataFrame, order_by, n: int | None, *, name: str = "row_idx", bucket_key=None) -> DataFrame:
    """The first ``n`` rows in ``order_by`` order with their position ``name`` (``None``: every row): ``head_rows``, then a row
    index of these rows alone. Columns that are not named (expressions) are ordered by a row index and a filter."""
    if n is not None and n > 0 and all(isinstance(c, str) for c in _names(order_by)):
        df = head_rows(df, order_by, n)
    return head_limit(row_index(df, order_by, name=name, bucket_key=bucket_key), n, index_col=name)


def seeded_shuffle(df: DataFrame, seed: int, id_col: str, *, name: str = "shuffle_idx",
                   partition_by=None, num_buckets: int | None = None) -> DataFrame:
    """Repeatable permutation: position of each row when ordered by the md5 key of
    ``(seed, id)``, ``id`` breaking ties."""
    keyed = df.withColumn("__skey", seeded_order_key(seed, id_col))
    out = row_index(keyed, ["__skey", id_col], name=name, partition_by=partition_by,
                    bucket_key=F.col("__skey"), uniform_range=SEEDED_KEY_RANGE, num_buckets=num_buckets)
    return out.drop("__skey")


def split_counts(df: DataFrame, split_col: str = "split", name: str = "n_rows") -> DataFrame:
    return df.groupBy(split_col).agg(F.count(F.lit(1)).cast("bigint").alias(name))
