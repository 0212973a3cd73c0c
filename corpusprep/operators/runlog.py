"""Run-log analytics (9.1-9.11).

Input tables:

* train log: ``run, epoch, micro_step, loss, sync`` - one row per micro-step; ``micro_step``
  counts micro-steps of the run across epochs (dense, from 0); ``sync`` marks a gradient sync.
* eval log: ``run, epoch, completed_steps, batch_no, n, loss`` - one row per evaluation batch.
* checkpoints: ``run, name`` (``epoch_N``, ``step_N``, ...).

Running values per run use :func:`grouped_scan`, a tree of windows, so a run with a third of all
rows is still spread over many tasks; everything else is partial (map-side) aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.constants import CHECKPOINT_RING_SIZE
from corpusprep.functions.arrays import argmax
from corpusprep.operators.ordering import grouped_scan, null_safe_join, step_span


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _exact(c: Column, scale: int | None) -> Column:
    return c if scale is None else c.cast(f"decimal(38,{scale})")


def perplexity(loss) -> Column:
    """``exp(loss)``; overflow gives +Infinity, as the reference's OverflowError branch."""
    return F.exp(_col(loss))


def eval_loss(eval_log: DataFrame, group=("run", "epoch", "completed_steps"), *, loss: str = "loss",
              n: str = "n", exact_scale: int | None = None) -> DataFrame:
    """Mean of batch losses, each batch weighted by its number of examples:
    ``sum(loss * n) / sum(n)`` per evaluation, plus ``perplexity``. With ``exact_scale`` the
    products are summed as DECIMAL (exact, independent of summation order)."""
    g = list(group)
    weighted = _exact(F.col(loss), exact_scale) * F.col(n)
    counted = F.when(F.col(loss).isNotNull(), F.col(n))  # a batch without a loss adds no weight
    agg = eval_log.groupBy(*g).agg(F.sum(weighted).alias("__lw"), F.sum(counted).cast("bigint").alias("n_examples"))
    el = (F.col("__lw").cast("double") / F.col("n_examples").cast("double"))
    return agg.select(*g, "n_examples", el.alias("eval_loss"), perplexity(el).alias("perplexity"))


def completed_steps(train_log: DataFrame, *, run: str = "run", step: str = "micro_step",
                    sync: str = "sync", name: str = "completed_steps", chunk_size: int = 1024,
                    span: int | None = None) -> DataFrame:
    """Optimizer steps done up to and including each micro-step (one per sync). ``span`` as for ``grouped_scan``."""
    d = train_log.withColumn("__sync", F.col(sync).cast("bigint"))
    out = grouped_scan(d, [run], step, {name: ("sum", "__sync")}, inclusive=True, chunk_size=chunk_size, span=span)
    return out.withColumn(name, F.col(name).cast("bigint")).drop("__sync")


def running_train_loss(train_log: DataFrame, *, run: str = "run", epoch: str = "epoch",
                       step: str = "micro_step", loss: str = "loss", sync: str = "sync",
                       denominator: str = "completed", exact_scale: int | None = None,
                       chunk_size: int = 1024) -> DataFrame:
    """``train_loss`` = losses summed since the start of the epoch / optimizer steps.

    ``denominator='completed'`` divides by the steps completed over *all* epochs (what the
    reference logs); ``'epoch'`` by the steps completed in this epoch. NULL while no step is
    complete (the reference divides by zero there)."""
    span = step_span(train_log, step)
    d = completed_steps(train_log, run=run, step=step, sync=sync, chunk_size=chunk_size, span=span)
    d = d.withColumn("__l", _exact(F.col(loss), exact_scale)).withColumn("__s", F.col(sync).cast("bigint"))
    d = grouped_scan(d, [run, epoch], step, {"epoch_loss_sum": ("sum", "__l"), "__es": ("sum", "__s")},
                     inclusive=True, chunk_size=chunk_size, span=span)
    den = F.col("completed_steps") if denominator == "completed" else F.col("__es")
    if denominator not in ("completed", "epoch"):
        raise ValueError(f"unknown denominator {denominator!r}")
    tl = F.when(den > 0, F.col("epoch_loss_sum").cast("double") / den.cast("double"))
    return d.withColumn("train_loss", tl).withColumn("epoch_loss_sum", F.col("epoch_loss_sum").cast("double")) \
        .drop("__l", "__s", "__es")


def cadence(log: DataFrame, every: int, *, run: str = "run", steps: str = "completed_steps",
            step: str = "micro_step", keep=("epoch",)) -> DataFrame:
    """Points where ``completed_steps % every == 0`` (``completed_steps > 0``), once per
    completed step: its first micro-step. The reference tests this at every micro-step, so it
    repeats while accumulating and divides by zero at step 0; here each point appears once."""
    d = log.where((F.col(steps) > 0) & (F.col(steps) % F.lit(int(every)) == 0))
    firsts = [F.min_by(F.col(k), F.col(step)).alias(k) for k in keep]
    return d.groupBy(run, steps).agg(F.min(step).alias(step), *firsts)


def best_so_far(evals: DataFrame, *, run: str = "run", step: str = "completed_steps",
                loss: str = "eval_loss", chunk_size: int = 1024) -> DataFrame:
    """``is_best``: strictly lower than every earlier loss of the run (NaN is never best and
    is ignored by the running minimum); ``best_before``: that minimum (NULL at first)."""
    d = evals.withColumn("__l", F.when(F.isnan(loss), F.lit(None)).otherwise(F.col(loss)))
    d = grouped_scan(d, [run], step, {"best_before": ("min", "__l")}, inclusive=False, chunk_size=chunk_size)
    is_best = F.col("__l").isNotNull() & (F.col("best_before").isNull() | (F.col("__l") < F.col("best_before")))
    return d.withColumn("is_best", is_best).drop("__l")


def final_best(evals: DataFrame, *, run: str = "run", step: str = "completed_steps",
               loss: str = "eval_loss") -> DataFrame:
    """Best evaluation per run: the lowest loss, the earliest such step on ties (a later
    equal loss is not strictly lower, so the first one stays best)."""
    d = evals.where(F.col(loss).isNotNull() & ~F.isnan(loss))  # a missing loss is never best
    best = F.min(F.struct(F.col(loss).alias("l"), F.col(step).alias("s"))).alias("__b")
    return d.groupBy(run).agg(best).select(run, F.col("__b.l").alias("best_loss"), F.col("__b.s").alias("best_step"))


def checkpoint_ring(saves: DataFrame, save_steps: int, *, run: str = "run", step: str = "completed_steps",
                    ring: int = CHECKPOINT_RING_SIZE) -> DataFrame:
    """A save at step s goes to slot ``int(s / save_steps) % ring``; a later save overwrites
    the slot, so the survivors are the last save of every slot."""
    slot = (F.floor(F.col(step) / F.lit(int(save_steps))) % F.lit(int(ring))).cast("bigint")
    d = saves.withColumn("slot", slot)
    return d.groupBy(run, "slot").agg(F.max(step).alias(step)) \
        .withColumn("name", F.concat(F.lit("last_step_"), F.col("slot").cast("string")))


def epoch_summary(evals: DataFrame, *, run: str = "run", epoch: str = "epoch",
                  step: str = "completed_steps", loss: str = "eval_loss") -> DataFrame:
    """Evaluation at the end of each epoch (its last one), with ``is_final`` on the run's last
    epoch: the run's reported perplexity."""
    per_epoch = evals.groupBy(run, epoch).agg(F.max_by(F.col(loss), F.col(step)).alias(loss),
                                             F.max(step).alias(step))
    last = per_epoch.groupBy(run).agg(F.max(epoch).alias("__last"))
    out = null_safe_join(per_epoch, last, [run])
    return out.select(run, epoch, step, loss, perplexity(loss).alias("perplexity"),
                      (F.col(epoch) == F.col("__last")).alias("is_final"))


def resume_point(checkpoints: DataFrame, *, name: str = "name", accum=1, batches_per_epoch=None,
                 updates_per_epoch=None) -> DataFrame:
    """Checkpoint name -> where training resumes.

    ``epoch_N``: epoch N+1 from its start, ``completed = (N+1) * updates_per_epoch``.
    ``step_N``: ``r = N * accum`` micro-steps; epoch ``r div batches_per_epoch``, completed
    ``r div accum``, and ``r mod batches_per_epoch`` batches to skip. Other names get NULLs and
    a reason. ``accum`` / ``batches_per_epoch`` / ``updates_per_epoch`` are ints or columns."""
    def c(v):
        return F.col(v) if isinstance(v, str) else F.lit(v)
    nm = F.col(name)
    ep = F.regexp_extract(nm, r"^epoch_([0-9]+)$", 1)
    st = F.regexp_extract(nm, r"^step_([0-9]+)$", 1)
    is_epoch, is_step = ep != "", st != ""
    rstep = st.cast("bigint") * c(accum)
    start_epoch = F.when(is_epoch, ep.cast("bigint") + 1).when(is_step, F.floor(rstep / c(batches_per_epoch)))
    completed = F.when(is_epoch, (ep.cast("bigint") + 1) * c(updates_per_epoch)) \
        .when(is_step, F.floor(rstep / c(accum)))
    skip = F.when(is_epoch, F.lit(0)).when(is_step, rstep - F.floor(rstep / c(batches_per_epoch)) * c(batches_per_epoch))
    reason = F.when(is_epoch | is_step, F.lit(None).cast("string")).otherwise(F.lit("unparsable checkpoint name"))
    return checkpoints.select("*", start_epoch.cast("bigint").alias("start_epoch"),
                              completed.cast("bigint").alias("completed_steps"),
                              skip.cast("bigint").alias("skip_batches"), reason.alias("reason"))


def argmax_prediction(df: DataFrame, logits: str = "logits", name: str = "prediction") -> DataFrame:
    """Index of the largest logit, the first one on ties."""
    return df.withColumn(name, argmax(logits))


def next_token_accuracy(df: DataFrame, *, labels: str = "labels", preds: str = "preds",
                        group=()) -> DataFrame:
    """Share of positions where ``labels[i + 1] == preds[i]`` over all rows (flattened), as
    the commented-out metric does; no -100 masking. Per-row counts, then one aggregate."""
    n = F.size(labels) - 1
    pairs = F.arrays_zip(F.slice(F.col(labels), 2, F.greatest(n, F.lit(0))),
                         F.slice(F.col(preds), 1, F.greatest(n, F.lit(0))))
    hits = F.size(F.filter(pairs, lambda z: z.getField("0") == z.getField("1")))
    d = df.select(*group, hits.cast("bigint").alias("__h"), F.greatest(n, F.lit(0)).cast("bigint").alias("__n"))
    aggs = [F.sum("__h").alias("correct"), F.sum("__n").alias("compared")]
    g = d.groupBy(*group).agg(*aggs) if group else d.agg(*aggs)
    return g.withColumn("accuracy", F.when(F.col("compared") > 0, F.col("correct") / F.col("compared")))
