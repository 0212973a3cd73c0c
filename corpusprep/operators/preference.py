"""Preference pairs (7.1-7.4). Lengths here count characters, not tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.constants import ANSWER_TEXT, ASSISTANT_MARKER, DEFAULT_PAIR_MAX_LENGTH, QUESTION_TEXT


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wrap_prompt(df: DataFrame, prompt: str = "prompt", chosen: str = "chosen",
                rejected: str = "rejected", keep=()) -> DataFrame:
    """``prompt`` -> question marker text + prompt + answer marker text; only the three
    columns (and ``keep``) are kept."""
    return df.select(*keep, F.concat(F.lit(QUESTION_TEXT), F.col(prompt), F.lit(ANSWER_TEXT)).alias("prompt"),
                     F.col(chosen).alias("chosen"), F.col(rejected).alias("rejected"))


def pair_length_ok(prompt="prompt", chosen="chosen", rejected="rejected",
                   max_length: int = DEFAULT_PAIR_MAX_LENGTH) -> Column:
    p = F.length(_col(prompt))
    return (p + F.length(_col(chosen)) <= max_length) & (p + F.length(_col(rejected)) <= max_length)


def filter_pair_length(df: DataFrame, max_length: int = DEFAULT_PAIR_MAX_LENGTH, *,
                       prompt: str = "prompt", chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Keep pairs with ``len(prompt) + len(chosen) <= L`` and the same for rejected. A native
    predicate, so Catalyst can evaluate it right after the scan."""
    return df.where(pair_length_ok(prompt, chosen, rejected, max_length))


def rejected_pairs(df: DataFrame, max_length: int | None = DEFAULT_PAIR_MAX_LENGTH, *, prompt: str = "prompt",
                   chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Quarantine for ``filter_pair_length`` on wrapped pairs: the rows it leaves out, each with a ``reason`` (a NULL
    cell, or too long). ``max_length=None``: only NULL cells count. Kept and quarantined rows together are all rows."""
    reason = F.lit(None).cast("string")
    if max_length is not None:
        reason = F.when(~pair_length_ok(prompt, chosen, rejected, max_length), F.lit("pair too long"))
    for c in (rejected, chosen, prompt):
        reason = F.when(F.col(c).isNull(), F.lit(f"{c} is NULL")).otherwise(reason)
    return df.withColumn("reason", reason).where(F.col("reason").isNotNull())


def prompt_length(transcript, marker: str = ASSISTANT_MARKER) -> Column:
    """Characters up to and including the last ``marker``; 0 when the marker is absent."""
    t = _col(transcript)
    return F.when(F.instr(t, marker) > 0,
                  F.length(t) - F.length(F.substring_index(t, marker, -1))).otherwise(F.lit(0))


def split_transcripts(df: DataFrame, chosen: str = "chosen", rejected: str = "rejected", *,
                      marker: str = ASSISTANT_MARKER, on_missing: str = "error",
                      keep=()) -> DataFrame:
    """Whole dialogues -> ``prompt`` (chosen up to its last marker), ``chosen`` and
    ``rejected`` with that many leading characters removed. Rejected is not checked to share
    the prompt; ``prefix_ok`` tells whether it does. Rows without the marker: ``error`` fails
    the job, ``drop`` leaves them out (see ``missing_marker_rows``)."""
    n = prompt_length(chosen, marker)
    c = F.col(chosen)
    missing = c.isNull() | (F.instr(c, marker) == 0)
    d = df
    if on_missing == "error":
        d = d.withColumn(chosen, F.when(missing, F.raise_error(F.lit(f"transcript without {marker!r}"))).otherwise(c))
    elif on_missing == "drop":
        d = d.where(~missing)
    else:
        raise ValueError(f"unknown on_missing {on_missing!r}")
    d = d.withColumn("__plen", n)
    prompt = F.substring(F.col(chosen), F.lit(1), F.col("__plen"))
    return d.select(*keep,
                    F.when(F.col("__plen") > 0, prompt).otherwise(F.lit("")).alias("prompt"),
                    F.expr(f"substring(`{chosen}`, __plen + 1)").alias("chosen"),
                    F.expr(f"substring(`{rejected}`, __plen + 1)").alias("rejected"),
                    F.startswith(F.col(rejected), prompt).alias("prefix_ok"))


def missing_marker_rows(df: DataFrame, chosen: str = "chosen", marker: str = ASSISTANT_MARKER) -> DataFrame:
    """Quarantine for ``split_transcripts(on_missing='drop')``."""
    c = F.col(chosen)
    return df.where(c.isNull() | (F.instr(c, marker) == 0)).withColumn("reason", F.lit("marker not found"))
