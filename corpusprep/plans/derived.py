"""Inputs of the preparation steps, derived by Spark from the driver tables.

The driver tables hold conversations, documents, events and vectors; the preparation steps want
instruction triples, chat messages, preference pairs, transcripts, run logs and logits. These
functions build them with joins on composite keys (``conv_id, turn``), so no single
conversation or run becomes a hot key. Every matching DuckDB form lives next to its query in
``catalog``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.operators.ordering import row_index

# fixed parameters of the derived run logs
STEPS_PER_EPOCH = 30        # micro-steps (batches) per epoch
ACCUMULATION = 4            # micro-steps per optimizer step
EVAL_EPOCH_DAYS = 10        # eval log: days per epoch
SEQUENCE_LENGTH = 16        # logits: positions per sequence

ROLE_TO_FROM = {"user": "human", "assistant": "gpt", "system": "system"}


def exchanges(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, user, answer``: a user turn and the assistant turn right after it."""
    u = conversations.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("user"))
    a = conversations.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return u.join(a, on=["conv_id", "turn"], how="inner")


def system_prompts(conversations: DataFrame) -> DataFrame:
    """``conv_id, system``: the first system turn of each conversation (partial aggregation)."""
    return (conversations.where(F.col("role") == "system").groupBy("conv_id")
            .agg(F.min_by("text", "turn").alias("system")))


def instruction_triples(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, instruction, input, output``: user turn, the conversation's system
    text (NULL when none) and the answer."""
    ex = exchanges(conversations)
    return (ex.join(system_prompts(conversations), on="conv_id", how="left")
            .select("conv_id", "turn", F.col("user").alias("instruction"), F.col("system").alias("input"),
                    F.col("answer").alias("output")))


def chat_messages(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, from, value`` with speaker names as in conversation files."""
    mapping = F.create_map(*[F.lit(x) for kv in ROLE_TO_FROM.items() for x in kv])
    return conversations.select("conv_id", "turn", F.coalesce(mapping[F.col("role")], F.col("role")).alias("from"),
                                F.col("text").alias("value"))


def preference_pairs(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, prompt, chosen, rejected``: rejected is the answer given at the same
    turn of the next conversation."""
    ex = exchanges(conversations)
    other = ex.select((F.col("conv_id") - 1).alias("conv_id"), "turn", F.col("answer").alias("rejected"))
    return ex.join(other, on=["conv_id", "turn"], how="inner").select(
        "conv_id", "turn", F.col("user").alias("prompt"), F.col("answer").alias("chosen"), "rejected")


def transcripts(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, chosen, rejected`` as whole dialogues ``\\n\\nHuman: ...\\n\\nAssistant: ...``
    including the exchange before (when there is one); rejected ends with the next
    conversation's answer at the same turn."""
    pairs = preference_pairs(conversations)
    ex = exchanges(conversations)
    prev = ex.select("conv_id", (F.col("turn") + 2).alias("turn"),
                     F.concat(F.lit("\n\nHuman: "), F.col("user"), F.lit("\n\nAssistant: "), F.col("answer")).alias("history"))
    j = pairs.join(prev, on=["conv_id", "turn"], how="left")
    head = F.concat(F.coalesce(F.col("history"), F.lit("")), F.lit("\n\nHuman: "), F.col("prompt"), F.lit("\n\nAssistant: "))
    return j.select("conv_id", "turn", F.concat(head, F.col("chosen")).alias("chosen"),
                    F.concat(head, F.col("rejected")).alias("rejected"))


def _micros(df: DataFrame) -> DataFrame:
    """Microseconds since the epoch, independent of the session time zone."""
    from pyspark.sql import types as T
    if isinstance(df.schema["ts"].dataType, T.TimestampNTZType):
        us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    else:
        us = F.unix_micros(F.col("ts"))
    return df.withColumn("__us", us.cast("bigint"))


def train_log(events: DataFrame, *, materialize: bool = True) -> DataFrame:
    """``run, epoch, micro_step, loss, sync``: each user's events in time order are the
    micro-steps of one run; loss = value / 100; a sync every ``ACCUMULATION`` micro-steps and at
    the end of every epoch of ``STEPS_PER_EPOCH`` micro-steps.

    ``micro_step`` is a per-run row index over ranges of ``(run, time, event)``, so a run with
    most of the events is still cut over many ranges. The narrow result is checkpointed (to
    the session's shared checkpoint folder) because the running scans read it several times.
    """
    from corpusprep.session import checkpoint_dir
    e = _micros(events).select(F.col("user_id").alias("run"), "__us", "event_id", "value")
    d = row_index(e, ["__us", "event_id"], name="micro_step", partition_by=["run"])
    in_epoch = F.col("micro_step") % F.lit(STEPS_PER_EPOCH)
    sync = ((in_epoch + 1) % F.lit(ACCUMULATION) == 0) | (in_epoch == STEPS_PER_EPOCH - 1)
    out = d.select("run", F.floor(F.col("micro_step") / F.lit(STEPS_PER_EPOCH)).cast("int").alias("epoch"),
                   F.col("micro_step").cast("bigint").alias("micro_step"),
                   (F.col("value") / F.lit(100.0)).alias("loss"), sync.alias("sync"))
    if materialize:
        checkpoint_dir(events.sparkSession)
        out = out.checkpoint(eager=True)
    return out


def eval_log(events: DataFrame) -> DataFrame:
    """``run, epoch, completed_steps, batch_no, n, loss``: one evaluation per run and hour of
    the event stream (``completed_steps`` = hour number from the first event, from 1), one
    batch per event with ``n = props.k + 1`` examples and loss = value / 100; epochs of
    ``EVAL_EPOCH_DAYS`` days."""
    e = _micros(events)
    t0 = e.agg(F.min("__us")).first()[0]
    hours = F.floor((F.col("__us") - F.lit(t0)) / F.lit(3600 * 10**6))
    epoch = F.floor((F.col("__us") - F.lit(t0)) / F.lit(EVAL_EPOCH_DAYS * 86400 * 10**6))
    n = (F.get_json_object("props", "$.k").cast("bigint") + 1)
    return e.select(F.col("user_id").alias("run"), epoch.cast("int").alias("epoch"),
                    (hours + 1).cast("bigint").alias("completed_steps"), F.col("event_id").alias("batch_no"),
                    n.alias("n"), (F.col("value") / F.lit(100.0)).alias("loss"))


def logit_sequences(embeddings: DataFrame) -> DataFrame:
    """``seq, labels, preds``: vectors in id order form sequences of ``SEQUENCE_LENGTH``
    positions; a vector's argmax is the prediction at its position, its label the target."""
    from corpusprep.functions.arrays import argmax
    d = embeddings.select(F.floor(F.col("vec_id") / F.lit(SEQUENCE_LENGTH)).alias("seq"), "vec_id",
                          F.col("label").cast("bigint").alias("label"), argmax("embedding").alias("pred"))
    g = d.groupBy("seq").agg(F.array_sort(F.collect_list(F.struct("vec_id", "label", "pred"))).alias("__p"))
    return g.select("seq", F.transform("__p", lambda p: p["label"]).alias("labels"),
                    F.transform("__p", lambda p: p["pred"]).alias("preds"))
