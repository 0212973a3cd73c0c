"""Batches and collating (8.1-8.7).

A batch is the set of rows sharing ``batch_no``, ordered by ``pos``. What decides how a batch is collated (lengths, NULL
flags of its first row) is aggregated from narrow columns and joined back; arrays are only padded or copied after that.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.constants import DEFAULT_PAD_ID, IGNORE_INDEX
from corpusprep.functions.arrays import pad_right
from corpusprep.operators.ordering import null_safe_join, seeded_shuffle


def assign_batches(df: DataFrame, batch_size: int, seed: int, id_col: str, *,
                   split_col: str | None = None, shuffle: bool = True) -> DataFrame:
    """Shuffled (repeatable) order cut into batches: ``batch_no = idx div bs``,
    ``pos = idx mod bs``; the last batch may be short."""
    part = [split_col] if split_col else None
    if shuffle:
        d = seeded_shuffle(df, seed, id_col, name="__idx", partition_by=part)
    else:
        from corpusprep.operators.ordering import row_index
        d = row_index(df, [id_col], name="__idx", partition_by=part)
    return (d.withColumn("batch_no", F.floor(F.col("__idx") / F.lit(int(batch_size))).cast("bigint"))
             .withColumn("pos", (F.col("__idx") % F.lit(int(batch_size))).cast("bigint"))
             .drop("__idx"))


def skip_batches(df: DataFrame, k: int, batch_col: str = "batch_no") -> DataFrame:
    """Leave out the first ``k`` batches (resuming inside an epoch)."""
    return df.where(F.col(batch_col) >= F.lit(int(k)))


def _judged(narrow: DataFrame, batch_cols: list, pos_col: str, sizes: dict, present: dict) -> DataFrame:
    """Per batch, by one partial aggregation over narrow columns: the first position, for each array of ``sizes`` its longest
    (``__max_i``), ``__ragged``, and for each column of ``present`` whether the first row has it (``__has_i``)."""
    longest = [F.max(n).alias(f"__max_{i}") for i, n in enumerate(sizes.values())]
    least = [F.min(n).alias(f"__min_{i}") for i, n in enumerate(sizes.values())]
    first = [F.min_by(has, F.col(pos_col)).alias(f"__has_{i}") for i, has in enumerate(present.values())]
    stats = narrow.groupBy(*batch_cols).agg(F.min(pos_col).alias("__first"), *longest, *least, *first)
    ragged = F.lit(False)
    for i in range(len(sizes)):
        ragged = ragged | F.coalesce(F.col(f"__min_{i}") != F.col(f"__max_{i}"), F.lit(False))
    return stats.withColumn("__ragged", ragged).drop(*[f"__min_{i}" for i in range(len(sizes))])


class _Columns:
    """Which columns of a frame are collated, and the narrow facts that decide how."""

    def __init__(self, df: DataFrame, keys: set, lengths: dict | None, derived: dict | None = None):
        df = df.withColumns(derived or {})
        self.fields = {f.name: f.dataType for f in df.schema.fields}
        self.others = [c for c, t in self.fields.items() if c not in keys and c not in ("label", "label_ids", *(lengths or {}).values())
                       and not isinstance(t, T.StringType)]
        self.arrays = [c for c in self.others if isinstance(self.fields[c], T.ArrayType)]
        self.marked = self.others + [c for c in ("label", "label_ids") if c in self.fields]
        size = lambda c: F.col(lengths[c]) if c in (lengths or {}) else F.size(c)
        self.sizes = {c: size(c).cast("int") for c in self.arrays}
        self.present = {c: F.col((lengths or {}).get(c, c)).isNotNull() for c in self.marked}  # an array is NULL where its length is

    def facts(self) -> list[Column]:
        """The facts as columns of their own, so that no array goes where only they are needed."""
        return [n.alias(f"__n_{i}") for i, n in enumerate(self.sizes.values())] + [p.alias(f"__p_{i}") for i, p in enumerate(self.present.values())]

    def judged(self, narrow: DataFrame, batch_cols: list, pos_col: str, on_ragged: str) -> DataFrame:
        sizes = {c: F.col(f"__n_{i}") for i, c in enumerate(self.arrays)}
        present = {c: F.col(f"__p_{i}") for i, c in enumerate(self.marked)}
        stats = _judged(narrow, batch_cols, pos_col, sizes, present)
        fell = F.col("__ragged")
        if on_ragged == "error":
            fell = F.when(fell, F.raise_error(F.lit("ragged batch"))).otherwise(fell)
        return stats.withColumn("fell_back", fell).drop("__ragged")

    def has(self, c: str) -> Column:
        return F.col(f"__has_{self.marked.index(c)}")

    def labels(self) -> list[Column]:
        whole = (T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.BooleanType)
        out = []
        if "label" in self.fields:
            kind = "bigint" if isinstance(self.fields["label"], whole) else "double"
            out.append(F.when(self.has("label"), F.col("label").cast(kind)).alias("labels"))
        if "label_ids" in self.fields:
            kind = "bigint" if isinstance(self.fields["label_ids"].elementType, whole) else "double"
            ids = F.col("label_ids").cast(f"array<{kind}>")
            if "label" in self.fields:  # label wins; label_ids only where the first label is NULL
                out.append(F.when(~self.has("label") & self.has("label_ids"), ids).alias("labels_seq"))
            else:
                out.append(F.when(self.has("label_ids"), ids).alias("labels"))
        return out

    def collated(self, on_ragged: str, pad: dict | None) -> list[Column]:
        outs = []
        for c in self.others:
            value = F.col(c)
            if on_ragged == "pad" and c in self.arrays:
                filler = (pad or {}).get(c, IGNORE_INDEX if c == "labels" else DEFAULT_PAD_ID)
                value = pad_right(c, F.col(f"__max_{self.arrays.index(c)}"), filler)
            outs.append(F.when(self.has(c), value).alias(c))
        return outs


def collate(df: DataFrame, *, batch_cols=("batch_no",), pos_col: str = "pos",
            on_ragged: str = "error", pad: dict | None = None, lengths: dict | None = None,
            derived: dict | None = None) -> DataFrame:
    """Column-wise collation of each batch, judged on the batch's first row.

    * ``labels``: from ``label`` when the first row's label is set (LONG for integer labels,
      DOUBLE otherwise — the column type decides), else from ``label_ids``, else absent (NULL).
    * every other column that is not a string and is set in the first row is stacked; columns
      NULL in the first row are dropped for the batch (NULL in the output).
    * ragged batch (an array column whose sizes differ inside the batch):
      ``repeat_first`` - every row becomes a copy of the first row (labels excepted), as the
      reference's fallback does, flagged ``fell_back``; ``pad`` - arrays padded to the batch's
      longest (``pad`` maps column -> pad value, default pad id 0 / -100 for labels);
      ``error`` (default) - the job fails instead of silently repeating rows.

    What decides is aggregated from lengths and NULL flags alone (``lengths`` maps an array column to a stored column of
    its length) and joined back to the rows; no window holds an array. ``derived`` maps names to columns that are computed of a
    row once it has its batch, e.g. ids of its text, so that only the text moves.
    """
    batch = list(batch_cols)
    cols = _Columns(df, set(batch) | {pos_col}, lengths, derived)
    stats = cols.judged(df.withColumns(derived or {}).select(*batch, pos_col, *cols.facts()), batch, pos_col, on_ragged)
    rows = null_safe_join(df, stats, batch).withColumns(derived or {})
    return _collated(rows, cols, batch, pos_col, on_ragged, pad)


def _collated(rows: DataFrame, cols: _Columns, batch: list, pos_col: str, on_ragged: str, pad: dict | None) -> DataFrame:
    """Rows with their batch's facts -> the collated columns."""
    if on_ragged not in ("error", "pad", "repeat_first"):
        raise ValueError(f"unknown on_ragged {on_ragged!r}")
    keys = [*batch, pos_col]
    if on_ragged != "repeat_first":
        return rows.select(*keys, *cols.collated(on_ragged, pad), *cols.labels(), "fell_back")
    even = rows.where(~F.col("fell_back")).select(*keys, *cols.collated(on_ragged, pad), *cols.labels(), "fell_back")
    # rows of a ragged batch keep their labels only; the rest is their first row's, which alone goes on whole
    first = rows.where(F.col("fell_back") & (F.col(pos_col) == F.col("__first"))).select(*batch, *cols.collated(on_ragged, pad))
    first = first.select(*batch, *[F.col(c).alias(f"__f_{c}") for c in cols.others])
    copies = rows.where("fell_back").select(*keys, *cols.labels(), "fell_back")
    copies = null_safe_join(copies, first, batch).select(*keys, *[F.col(f"__f_{c}").alias(c) for c in cols.others],
                                                         *[c for c in copies.columns if c not in keys and c != "fell_back"], "fell_back")
    return even.unionByName(copies)


def pad_to_longest(df: DataFrame, *, batch_cols=("batch_no",), columns: dict | None = None, lengths: dict | None = None,
                   derived: dict | None = None) -> DataFrame:
    """Pad each array column to the longest in its batch (ids with pad id, labels with -100). ``lengths`` and ``derived`` as for
    ``collate``; the columns of lengths go."""
    cols = columns or {"input_ids": DEFAULT_PAD_ID, "labels": IGNORE_INDEX}
    size = lambda c: F.col(lengths[c]) if c in (lengths or {}) else F.size(c)
    longest = df.withColumns(derived or {}).groupBy(*batch_cols).agg(*[F.max(size(c)).alias(f"__max_{i}") for i, c in enumerate(cols)])
    out = null_safe_join(df, longest, list(batch_cols)).withColumns(derived or {})
    for i, (c, v) in enumerate(cols.items()):
        out = out.withColumn(c, pad_right(c, F.col(f"__max_{i}"), v))
    return out.drop(*[f"__max_{i}" for i in range(len(cols))], *(lengths or {}).values())


def epoch_plan(df: DataFrame, batch_size: int, *, split_col: str | None = "split",
               accumulation: int = 1, epochs: int = 1, processes: int = 1,
               max_steps: int | None = None) -> DataFrame:
    """Per split: examples, batches = ceil(n / bs), batches per process = ceil(batches / processes)
    (the loader is spread over them), updates per epoch = ceil(batches per process / accum), total updates = epochs * updates (or ``max_steps`` when given), total batch size =
    bs * processes * accum."""
    aggs = [F.count(F.lit(1)).cast("bigint").alias("n_examples")]
    g = df.groupBy(split_col).agg(*aggs) if split_col else df.agg(*aggs)
    batches = F.ceil(F.col("n_examples") / F.lit(int(batch_size))).cast("bigint")
    g = g.withColumn("batches", batches)
    share = F.ceil(F.col("batches") / F.lit(int(processes)))
    updates = F.ceil(share / F.lit(int(accumulation))).cast("bigint")
    g = g.withColumn("updates_per_epoch", updates)
    total = F.lit(int(max_steps)).cast("bigint") if max_steps else (F.col("updates_per_epoch") * F.lit(int(epochs))).cast("bigint")
    g = g.withColumn("total_updates", total)
    g = g.withColumn("epochs", F.when(F.col("updates_per_epoch") > 0,
                                      F.ceil(F.col("total_updates") / F.col("updates_per_epoch"))).cast("bigint"))
    return g.withColumn("total_batch_size", F.lit(int(batch_size) * int(processes) * int(accumulation)).cast("bigint"))


def epoch_plan_local(n: int, batch_size: int, accumulation: int = 1, epochs: int = 1) -> dict:
    """Plain-Python form of ``epoch_plan`` for one split (used in tests and sizing)."""
    batches = math.ceil(n / batch_size)
    updates = math.ceil(batches / accumulation)
    return {"batches": batches, "updates_per_epoch": updates, "total_updates": epochs * updates}


def collate_by_id(df: DataFrame, batch_size: int, seed: int, id_col: str, *, split_col: str | None = None,
                  on_ragged: str = "error", pad: dict | None = None, lengths: dict | None = None,
                  derived: dict | None = None, num_buckets: int | None = None) -> DataFrame:
    """``assign_batches`` followed by ``collate``, with the whole rows shuffled once (by ``id_col``, unique within a split).

    Order, batches and all that decides the collation need only ids, lengths, NULL flags and the seeded key: these narrow
    rows are indexed and aggregated, and join back to the whole rows. Ragged batches that repeat their first row send that one row on
    to the others. The driver holds nothing.
    """
    groups = [split_col] if split_col else []
    batch = [*groups, "batch_no"]
    cols = _Columns(df, set(groups), lengths, derived)
    narrow = df.withColumns(derived or {}).select(*groups, id_col, *cols.facts())
    narrow = seeded_shuffle(narrow, seed, id_col, name="__idx", partition_by=groups, num_buckets=num_buckets)
    narrow = (narrow.withColumn("batch_no", F.floor(F.col("__idx") / F.lit(int(batch_size))).cast("bigint"))
              .withColumn("pos", (F.col("__idx") % F.lit(int(batch_size))).cast("bigint")).drop("__idx"))
    stats = cols.judged(narrow, batch, "pos", on_ragged)
    narrow = null_safe_join(narrow.select(*batch, "pos", id_col), stats, batch)
    # a merge join: the whole rows are dealt out by id, not sent to the tasks of a few narrow rows
    rows = null_safe_join(df.hint("merge"), narrow, [*groups, id_col]).withColumns(derived or {})
    return _collated(rows, cols, batch, "pos", on_ragged, pad)


def _collated_in_place(df: DataFrame, *, batch_cols, pos_col: str, on_ragged: str, pad: dict | None) -> DataFrame:
    """``collate`` by windows over whole batches, for rows that already lie where their batch is built: no further exchange."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    keys = set(batch_cols) | {pos_col}
    w = Window.partitionBy(*batch_cols)
    first_w = Window.partitionBy(*batch_cols).orderBy(pos_col).rowsBetween(Window.unboundedPreceding,
                                                                            Window.unboundedFollowing)

    def first(c):
        return F.first(F.col(c), ignorenulls=False).over(first_w)

    d = df
    label_cols = []
    whole = (T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.BooleanType)
    if "label" in fields:
        ltype = "bigint" if isinstance(fields["label"], whole) else "double"
        label_cols.append(F.when(first("label").isNotNull(), F.col("label").cast(ltype)).alias("labels"))
    if "label_ids" in fields:
        ltype = "bigint" if isinstance(fields["label_ids"].elementType, whole) else "double"
        ids = F.col("label_ids").cast(f"array<{ltype}>")
        if "label" in fields:  # label wins; label_ids only where the first label is NULL
            label_cols.append(F.when(first("label").isNull() & first("label_ids").isNotNull(), ids).alias("labels_seq"))
        else:
            label_cols.append(F.when(first("label_ids").isNotNull(), ids).alias("labels"))
    others = [c for c, t in fields.items()
              if c not in keys and c not in ("label", "label_ids") and not isinstance(t, T.StringType)]
    arrays = [c for c in others if isinstance(fields[c], T.ArrayType)]
    ragged = F.lit(False)
    for c in arrays:
        ragged = ragged | (F.min(F.size(c)).over(w) != F.max(F.size(c)).over(w))
    d = d.withColumn("fell_back", ragged)
    if on_ragged == "error":
        d = d.withColumn("fell_back", F.when(F.col("fell_back"), F.raise_error(F.lit("ragged batch")))
                         .otherwise(F.col("fell_back")))
    outs = []
    for c in others:
        kept = F.when(first(c).isNotNull(), F.col(c))
        if on_ragged == "repeat_first":
            kept = F.when(first(c).isNotNull(), F.when(F.col("fell_back"), first(c)).otherwise(F.col(c)))
        elif on_ragged == "pad" and c in arrays:
            value = (pad or {}).get(c, IGNORE_INDEX if c == "labels" else DEFAULT_PAD_ID)
            kept = F.when(first(c).isNotNull(), pad_right(c, F.max(F.size(c)).over(w), value))
        outs.append(kept.alias(c))
    sel = [F.col(c) for c in batch_cols] + [F.col(pos_col)] + outs + label_cols
    return d.select(*sel, "fell_back")


def collate_batches(df: DataFrame, batch_size: int, seed: int, id_col: str, *, split_col: str | None = None,
                    on_ragged: str = "error", pad: dict | None = None,
                    num_buckets: int | None = None) -> DataFrame:
    """``assign_batches`` followed by ``collate``, with the rows shuffled once.

    Rows are bucketed on the seeded key (uniform, so buckets are balanced). The row counts per
    bucket (one row per bucket, to the driver) fix where every batch starts; a bucket that
    begins in the middle of a batch sends its first rows of that batch (fewer than
    ``batch_size``) to the bucket where the batch starts, found by one narrow job that returns
    at most one key per bucket. Each row is then kept only in the partition that owns its
    batch, and the collation windows run on that same partitioning: one exchange in the plan, at the price of jobs
    beforehand and of one row per bucket on the driver. ``collate_by_id`` has neither.
    """
    from pyspark.sql import types as T_
    from corpusprep.operators.ordering import SEEDED_KEY_RANGE, _bucketize, default_buckets, seeded_order_key

    bs = int(batch_size)
    spark = df.sparkSession
    groups = [split_col] if split_col else []
    nb = num_buckets or default_buckets(df)
    keyed = df.withColumn("__skey", seeded_order_key(seed, id_col))
    based = (_bucketize(keyed, F.col("__skey"), nb, None, SEEDED_KEY_RANGE)
             .withColumn("__b", F.col("__bucket").cast("int")).drop("__bucket"))
    key = F.struct(F.col("__skey"), F.col(id_col))

    # per (group, bucket) counts -> where each bucket starts inside its group
    counts = {tuple(r[:-1]): r[-1] for r in based.groupBy(*groups, "__b").agg(F.count(F.lit(1)).alias("c")).collect()}
    offsets, heads, by_group = {}, {}, {}
    for k in sorted(counts, key=lambda k: k[-1]):
        by_group.setdefault(k[:-1], []).append(k[-1])
    for g in by_group:
        acc, owner = 0, None  # owner: the bucket in which the batch that is open at ``acc`` starts
        for b in by_group[g]:
            n = counts[g + (b,)]
            offsets[g + (b,)] = acc
            first = (acc // bs) * bs
            if first < acc:  # the bucket begins inside a batch that started earlier
                heads[g + (b,)] = (min(n, first + bs - acc), owner)
            acc += n
            if (acc - 1) // bs * bs >= acc - n:  # the last batch begins in this bucket
                owner = b
    off_df = spark.createDataFrame([(*k, v) for k, v in offsets.items()],
                                   based.select(*groups, "__b").schema.add("__off", T_.LongType()))

    limits = {}
    if heads:
        need = spark.createDataFrame([(*k, h) for k, (h, _o) in heads.items()],
                                     based.select(*groups, "__b").schema.add("__h", T_.LongType()))
        w = Window.partitionBy(*groups, "__b").orderBy("__skey", id_col)
        ranked = (based.select(*groups, "__b", "__skey", id_col).join(F.broadcast(need), on=[*groups, "__b"])
                  .withColumn("__r", F.row_number().over(w)))
        limits = {tuple(r[:-1]): r[-1] for r in ranked.where(F.col("__r") == F.col("__h"))
                  .select(*groups, "__b", key.alias("__klim")).collect()}  # <= one key per bucket
    halo_df = spark.createDataFrame(
        [(*k, limits[k], heads[k][1]) for k in limits],
        based.select(*groups, "__b").schema.add("__klim", based.select(key.alias("k")).schema["k"].dataType)
        .add("__owner", T_.IntegerType()))
    dests = F.when(F.col("__klim").isNotNull() & (key <= F.col("__klim")),
                   F.array(F.col("__b"), F.col("__owner"))).otherwise(F.array(F.col("__b")))
    rows = (based.join(F.broadcast(halo_df), on=[*groups, "__b"], how="left")
            .withColumn("__dest", F.explode(dests)).drop("__klim", "__owner").repartition("__dest"))
    w_src = Window.partitionBy("__dest", *groups, "__b").orderBy("__skey", id_col)
    rows = rows.join(F.broadcast(off_df), on=[*groups, "__b"], how="inner")  # one row per bucket
    idx = F.col("__off") + F.row_number().over(w_src) - 1
    rows = (rows.withColumn("__idx", idx)
            .withColumn("batch_no", F.floor(F.col("__idx") / F.lit(bs)).cast("bigint"))
            .withColumn("pos", (F.col("__idx") % F.lit(bs)).cast("bigint")))
    # keep a row where its batch is built: halo copies, and own rows of batches starting here
    own = (F.col("__dest") != F.col("__b")) | (F.col("__idx") - F.col("pos") >= F.col("__off"))
    rows = rows.where(own).drop("__skey", "__b", "__off", "__idx")
    out = _collated_in_place(rows, batch_cols=(*groups, "__dest", "batch_no"), pos_col="pos", on_ragged=on_ragged, pad=pad)
    return out.drop("__dest")
