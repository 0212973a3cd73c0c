"""Multi-turn conversations -> ids, labels and attention mask (6.1-6.6).

Per message: a human turn gives ``[Q] + ids`` / labels ``[eos] + [-100] * len(ids)``; any other
turn (system included) gives ``[A] + ids`` / labels ``[-100] + ids``. After the last message one
eos goes to both. Ids are cut to ``max_source`` and padded with pad; labels are cut to
``max_target`` and padded with -100; the mask is ``id != pad``.

Two entry points:

* :func:`chat_examples_nested` — one row holds ``ARRAY<STRUCT<from, value>>`` (JSON input);
  pure per-row array expressions.
* :func:`chat_examples` — one row per message (``conv_id, turn, from, value``). Each message's
  token offset inside its conversation comes from a running sum (``grouped_scan``), messages that start
  past the limits are left out, and only then are the pieces gathered per conversation, so the
  gathered array never exceeds the limits, whatever a conversation's length. This is also how
  a conversation is assembled from rows (6.1): no step ever gathers a whole conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.constants import ANSWER_ID, DEFAULT_MAX_SOURCE, EOS_ID, HUMAN_ROLE, IGNORE_INDEX, QUESTION_ID
from corpusprep.functions.arrays import all_equal_to, not_equal_mask, pad_right, repeat, take
from corpusprep.functions.tokens import codepoint_ids
from corpusprep.operators.ordering import grouped_scan, step_span
from corpusprep.operators.tokenizing import resolve_pad_id


def _check_limits(max_source: int, max_target: int, allow_unequal: bool) -> None:
    if max_source != max_target and not allow_unequal:
        raise ValueError(f"max_source ({max_source}) != max_target ({max_target}): ids and labels "
                         "would differ in length; pass allow_unequal=True to keep that")


def _is_human(role: Column, human_roles) -> Column:
    return role.isin(list(human_roles))


def message_pieces(role: Column, ids: Column, human_roles=(HUMAN_ROLE,), eos_id: int = EOS_ID):
    """(ids piece, labels piece) of one message."""
    human = _is_human(role, human_roles)
    piece_ids = F.concat(F.array(F.when(human, F.lit(QUESTION_ID)).otherwise(F.lit(ANSWER_ID))), ids)
    piece_labels = F.when(human, F.concat(F.array(F.lit(eos_id)), repeat(IGNORE_INDEX, F.size(ids))))\
        .otherwise(F.concat(F.array(F.lit(IGNORE_INDEX)), ids))
    return piece_ids, piece_labels


def _finish(ids: Column, labels: Column, max_source: int, max_target: int, pad_id: int, eos_id: int):
    eos = F.array(F.lit(eos_id))
    ids = pad_right(take(F.concat(ids, eos), max_source), max_source, pad_id)
    labels = pad_right(take(F.concat(labels, eos), max_target), max_target, IGNORE_INDEX)
    return ids, labels


def chat_examples_nested(df: DataFrame, conversations: str = "conversations", *,
                         max_source: int = DEFAULT_MAX_SOURCE, max_target: int = DEFAULT_MAX_SOURCE,
                         pad_id: int | None = None, eos_id: int = EOS_ID, pad_with_eos: bool = False,
                         human_roles=(HUMAN_ROLE,), skip_roles=(), allow_unequal: bool = False,
                         keep=(), drop_all_masked: bool = True, tokenizer="codepoint") -> DataFrame:
    """``conversations ARRAY<STRUCT<from, value>>`` -> ``input_ids, labels, attention_mask``.
    With a ``ModelTokenizer`` every message is encoded by the model (Arrow batches)."""
    _check_limits(max_source, max_target, allow_unequal)
    pad_id = resolve_pad_id(pad_id, eos_id, pad_with_eos=pad_with_eos)
    src = df.withColumn(conversations, F.coalesce(F.col(conversations), F.array().cast(df.schema[conversations].dataType)))
    if skip_roles:
        src = src.withColumn(conversations, F.filter(conversations, lambda m: ~m["from"].isin(list(skip_roles))))
    if tokenizer in (None, "codepoint"):
        pieces = F.transform(conversations, lambda m: F.struct(*[p.alias(n) for n, p in zip(
            ("i", "l"), message_pieces(m["from"], codepoint_ids(F.coalesce(m["value"], F.lit(""))),
                                       human_roles, eos_id))]))
    else:
        from corpusprep.operators.tokenizing import encode_messages
        src = encode_messages(src, conversations, "__vids", tokenizer)
        pieces = F.transform(conversations, lambda m, i: F.struct(*[p.alias(n) for n, p in zip(
            ("i", "l"), message_pieces(m["from"], F.col("__vids")[i], human_roles, eos_id))]))
    d = src.select(*keep, pieces.alias("__p"))
    ids, labels = _finish(F.flatten(F.transform("__p", lambda p: p["i"])),
                          F.flatten(F.transform("__p", lambda p: p["l"])),
                          max_source, max_target, pad_id, eos_id)
    out = d.select(*keep, ids.alias("input_ids"), labels.alias("labels"))
    out = out.withColumn("attention_mask", not_equal_mask("input_ids", pad_id))
    if drop_all_masked:
        out = out.where(~all_equal_to("labels", IGNORE_INDEX))
    return out


def chat_examples(messages: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn",
                  from_col: str = "from", value_col: str = "value",
                  max_source: int = DEFAULT_MAX_SOURCE, max_target: int = DEFAULT_MAX_SOURCE,
                  pad_id: int | None = None, eos_id: int = EOS_ID, pad_with_eos: bool = False, human_roles=(HUMAN_ROLE,),
                  skip_roles=(), allow_unequal: bool = False, drop_all_masked: bool = True,
                  chunk_size: int = 1024, tokenizer="codepoint") -> DataFrame:
    """One row per message -> one example per conversation (``conv_col`` kept). With a
    ``ModelTokenizer`` the messages are encoded first (Arrow batches) and their token counts
    drive the offsets."""
    _check_limits(max_source, max_target, allow_unequal)
    pad_id = resolve_pad_id(pad_id, eos_id, pad_with_eos=pad_with_eos)
    m = messages.withColumn(value_col, F.coalesce(F.col(value_col), F.lit("")))  # NULL text: empty message
    if skip_roles:
        m = m.where(~F.col(from_col).isin(list(skip_roles)))
    codepoint = tokenizer in (None, "codepoint")
    span = step_span(messages, turn_col)
    if codepoint:  # lengths without tokenizing: the scan's exchange moves text, not int arrays
        m = m.select(conv_col, turn_col, from_col, value_col,
                     (F.length(value_col) + 1).cast("bigint").alias("__n"))
    else:
        from corpusprep.operators.tokenizing import tokenize
        m = tokenize(m.select(conv_col, turn_col, from_col, value_col), value_col, out="__ids", mask=None,
                     tokenizer=tokenizer)
        m = m.withColumn("__n", (F.size("__ids") + 1).cast("bigint"))
    m = grouped_scan(m, [conv_col], turn_col, {"__off": ("sum", "__n")}, inclusive=False,
                     chunk_size=chunk_size, span=span)
    reach = max(max_source, max_target)
    m = m.where(F.col("__off") < reach)  # a message starting past both limits adds nothing
    ids = codepoint_ids(value_col) if codepoint else F.col("__ids")  # only kept messages are tokenized
    pi, pl = message_pieces(F.col(from_col), ids, human_roles, eos_id)
    piece = F.struct(F.col(turn_col).alias("turn"),
                     take(pi, F.lit(max_source) - F.col("__off")).alias("i"),
                     take(pl, F.lit(max_target) - F.col("__off")).alias("l"))
    g = m.groupBy(conv_col).agg(F.array_sort(F.collect_list(piece)).alias("__p"))
    ids, labels = _finish(F.flatten(F.transform("__p", lambda p: p["i"])),
                          F.flatten(F.transform("__p", lambda p: p["l"])),
                          max_source, max_target, pad_id, eos_id)
    out = g.select(conv_col, ids.alias("input_ids"), labels.alias("labels"))
    out = out.withColumn("attention_mask", not_equal_mask("input_ids", pad_id))
    if drop_all_masked:
        out = out.where(~all_equal_to("labels", IGNORE_INDEX))
    return out
