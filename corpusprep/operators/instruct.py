"""Instruction triples -> ids and masked labels (5.1-5.8, 3.2, 3.3).

Format (markers style)::

    input_ids = [Q] + tokens(source) + [A] + tokens(output) + [eos]          cut to S + T
    labels    = [eos] + [-100] * (len(source) + 1) + tokens(output) + [eos]  cut to S + T

``plain`` style: ``ids = source + target``, ``labels = [-100] * len(source) + target``.
Rows whose source has more than ``max_source`` tokens or whose target (eos counted) has more
than ``max_target`` are dropped *before* the markers are added, so a row at both limits loses
its last two tokens. All of it is native column code; for the codepoint tokenizer the length
test runs on ``length(text)`` before any array is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.constants import (
    ANSWER_ID,
    DEFAULT_MAX_SOURCE,
    DEFAULT_MAX_TARGET,
    EOS_ID,
    IGNORE_INDEX,
    QUESTION_ID,
    TEMPLATES,
)
from corpusprep.functions.arrays import all_equal_to, repeat, take
from corpusprep.functions.tokens import codepoint_ids, token_count
from corpusprep.operators.tokenizing import CodepointTokenizer


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def build_source(instruction, input_) -> Column:
    """``instruction`` plus ``'\\n' + input`` when input is neither NULL nor empty."""
    ins, inp = _col(instruction), _col(input_)
    return F.when(inp.isNotNull() & (inp != ""), F.concat(ins, F.lit("\n"), inp)).otherwise(ins)


def build_target_ids(output, eos_id: int = EOS_ID) -> Column:
    """Target tokens without special tokens, then eos."""
    return F.concat(codepoint_ids(output), F.array(F.lit(eos_id)))


def apply_null_policy(df: DataFrame, instruction: str, output: str, policy: str) -> DataFrame:
    """``drop`` (default): rows with NULL instruction or output are left out (see
    ``null_rows`` for the quarantine); ``error``: fail the job on such a row; ``reference``:
    NULL output becomes the text 'None', NULL instruction fails."""
    ins, out = F.col(instruction), F.col(output)
    if policy == "drop":
        return df.where(ins.isNotNull() & out.isNotNull())
    if policy == "error":
        bad = ins.isNull() | out.isNull()
        return df.withColumn(instruction, F.when(bad, F.raise_error(F.lit("NULL instruction or output")))
                             .otherwise(ins))
    if policy == "reference":
        return (df.withColumn(output, F.coalesce(out, F.lit("None")))
                  .withColumn(instruction, F.when(ins.isNull(), F.raise_error(F.lit("NULL instruction")))
                              .otherwise(ins)))
    raise ValueError(f"unknown null policy {policy!r}")


def null_rows(df: DataFrame, instruction: str = "instruction", output: str = "output") -> DataFrame:
    """Quarantine: rows the ``drop`` policy leaves out, with the reason."""
    ins, out = F.col(instruction), F.col(output)
    reason = F.when(ins.isNull(), F.lit("instruction is NULL")).otherwise(F.lit("output is NULL"))
    return df.where(ins.isNull() | out.isNull()).withColumn("reason", reason)


def format_instructions(df: DataFrame, *, instruction: str = "instruction", input_col: str = "input",
                        output: str = "output", max_source: int = DEFAULT_MAX_SOURCE,
                        max_target: int = DEFAULT_MAX_TARGET, style: str = "markers",
                        null_policy: str = "drop", drop_all_masked: bool = True,
                        keep=(), eos_id: int = EOS_ID, tokenizer="codepoint") -> DataFrame:
    """Instruction triples -> ``keep... , input_ids, labels`` (ARRAY<INT>, equal length).

    ``tokenizer``: ``"codepoint"`` or ``CodepointTokenizer`` (native), or a ``ModelTokenizer``: the source is encoded with
    the tokenizer's special tokens, the target without them, then eos is appended."""
    d = apply_null_policy(df, instruction, output, null_policy)
    d = d.select(*keep, build_source(instruction, input_col).alias("__src"), F.col(output).alias("__out"))
    if tokenizer in (None, "codepoint") or isinstance(tokenizer, CodepointTokenizer):
        # 5.3 early exit: codepoint lengths are string lengths, so filter before tokenizing
        special = isinstance(tokenizer, CodepointTokenizer)  # in front of the source; the target has none
        d = d.where((token_count("__src") + int(special) <= max_source) & (token_count("__out") + 1 <= max_target))
        source = tokenizer.ids("__src") if special else codepoint_ids("__src")
        d = d.select(*keep, source.alias("__s"), build_target_ids("__out", eos_id).alias("__t"))
    else:
        from corpusprep.operators.tokenizing import encode_columns
        d = encode_columns(d, {"__s": ("__src", tokenizer.add_special_tokens), "__t0": ("__out", False)}, tokenizer)
        d = d.select(*keep, "__s", F.concat("__t0", F.array(F.lit(eos_id))).alias("__t"))
        d = d.where((F.size("__s") <= max_source) & (F.size("__t") <= max_target))
    s, t = F.col("__s"), F.col("__t")
    if style == "markers":
        limit = max_source + max_target
        ids = F.concat(F.array(F.lit(QUESTION_ID)), s, F.array(F.lit(ANSWER_ID)), t)
        labels = F.concat(F.array(F.lit(eos_id)), repeat(IGNORE_INDEX, F.size(s) + 1), t)
        d = d.select(*keep, take(ids, limit).alias("input_ids"), take(labels, limit).alias("labels"))
    elif style == "plain":
        limit = max_source + max_target
        d = d.select(*keep, take(F.concat(s, t), limit).alias("input_ids"),
                     take(F.concat(repeat(IGNORE_INDEX, F.size(s)), t), limit).alias("labels"))
    else:
        raise ValueError(f"unknown style {style!r}")
    if drop_all_masked:
        d = drop_all_masked_rows(d)
    return d


def drop_all_masked_rows(df: DataFrame, labels: str = "labels") -> DataFrame:
    """Drop rows whose labels are all ignored (an empty array counts as all ignored)."""
    return df.where(~all_equal_to(labels, IGNORE_INDEX))


def template_table(spark):
    """The registered prompt templates as a small DataFrame."""
    return spark.createDataFrame(
        [(n, sp, tpl, list(roles), sep) for n, sp, tpl, roles, sep in TEMPLATES],
        "name string, system_prompt string, template string, roles array<string>, sep string")


def render_template(df: DataFrame, template: str | None = None, *, template_col: str | None = None,
                    instruction: str = "instruction", source: str = "source",
                    out: str = "prompt") -> DataFrame:
    """``template.format(query=system_prompt + instruction + (sep if instruction != '') + source)``.

    With ``template`` (a registered name) the template is planted as literals; with
    ``template_col`` each row names its template and the registry (a handful of rows) is
    broadcast-joined. Unknown names fail.
    """
    ins = F.coalesce(F.col(instruction), F.lit(""))
    src = F.coalesce(F.col(source), F.lit(""))
    if template is not None:
        found = [t for t in TEMPLATES if t[0] == template]
        if not found:
            raise KeyError(f"unknown template {template!r}")
        _, system_prompt, tpl, _roles, sep = found[0]
        query = F.concat(F.lit(system_prompt), ins, F.when(ins != "", F.lit(sep)).otherwise(F.lit("")), src)
        return df.withColumn(out, F.replace(F.lit(tpl), F.lit("{query}"), query))
    if template_col is None:
        raise ValueError("give template or template_col")
    reg = F.broadcast(template_table(df.sparkSession).withColumnRenamed("name", "__tname"))
    j = df.join(reg, F.col(template_col) == F.col("__tname"), "left")
    query = F.concat(F.col("system_prompt"), ins, F.when(ins != "", F.col("sep")).otherwise(F.lit("")), src)
    rendered = F.when(F.col("__tname").isNull(),
                      F.raise_error(F.concat(F.lit("unknown template "), F.col(template_col).cast("string"))))\
        .otherwise(F.replace(F.col("template"), F.lit("{query}"), query))
    return j.withColumn(out, rendered).drop("__tname", "system_prompt", "template", "roles", "sep")
