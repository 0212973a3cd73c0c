"""Supervised fine-tuning data: split -> limit rows -> shuffle train -> format -> filter.

The order of steps is part of the meaning: the sample limits count raw rows before
formatting, only the train split is shuffled, and the reported sample counts are taken
before the length filter drops rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.constants import DEFAULT_MAX_SOURCE, DEFAULT_MAX_TARGET, DEFAULT_VALIDATION_PERCENT
from corpusprep.operators.chat import chat_examples
from corpusprep.operators.instruct import format_instructions
from corpusprep.operators.ordering import first_rows, head_percent_split, seeded_shuffle, split_counts


def split_and_limit(rows: DataFrame, order_by, *, validation: DataFrame | None = None,
                    percent: float = DEFAULT_VALIDATION_PERCENT, max_train_samples: int | None = None,
                    max_eval_samples: int | None = None, bucket_key=None) -> DataFrame:
    """``split`` and ``row_idx`` (position inside the split), first rows kept per split.

    The split itself needs only membership (a boundary key, rows not shuffled); each split then
    keeps its first rows with ``first_rows``: a comparison with the last one's key, then an index of those."""
    if validation is None:
        members = head_percent_split(rows, order_by, percent, bucket_key=bucket_key, keep_index=False)
        parts = [first_rows(members.where(F.col("split") == name).drop("split"), order_by, limit,
                            bucket_key=bucket_key).withColumn("split", F.lit(name))
                 for name, limit in (("train", max_train_samples), ("validation", max_eval_samples))]
        return parts[0].unionByName(parts[1])
    else:  # each split limited on its own
        parts = [first_rows(frame, order_by, limit, bucket_key=bucket_key).withColumn("split", F.lit(name))
                 for name, frame, limit in (("train", rows, max_train_samples),
                                            ("validation", validation, max_eval_samples))]
        return parts[0].unionByName(parts[1])


def order_for_training(limited: DataFrame, seed: int, *, name: str = "position") -> DataFrame:
    """Train rows get a seeded shuffled position; validation keeps its order."""
    train = seeded_shuffle(limited.where(F.col("split") == "train"), seed, "row_idx", name=name)
    val = limited.where(F.col("split") == "validation").withColumn(name, F.col("row_idx"))
    return train.unionByName(val)


def prepare_instructions(triples: DataFrame, order_by, *, validation: DataFrame | None = None,
                         percent: float = DEFAULT_VALIDATION_PERCENT, max_train_samples: int | None = None,
                         max_eval_samples: int | None = None, seed: int = 42,
                         max_source: int = DEFAULT_MAX_SOURCE, max_target: int = DEFAULT_MAX_TARGET,
                         style: str = "markers", keep=(), bucket_key=None,
                         text_cols=("instruction", "input", "output")) -> tuple[DataFrame, DataFrame]:
    """Instruction triples -> (examples ``split, position, keep..., input_ids, labels``,
    sample counts per split before filtering).

    Split, limits and the seeded shuffle only need the order key, so they run on the table
    without its text columns; the text joins back once on the (unique) order key. The text
    therefore crosses the network once, and not at all when AQE finds the limited key side
    small enough to broadcast."""
    keys = [c for c in (order_by if isinstance(order_by, (list, tuple)) else [order_by])]
    if not all(isinstance(c, str) for c in keys):
        raise ValueError("order_by must name columns (they are the join key back to the text)")
    frames = [("train", triples), ("validation", validation)]
    narrow = {n: (f.drop(*text_cols) if f is not None else None) for n, f in frames}
    limited = split_and_limit(narrow["train"], keys, validation=narrow["validation"], percent=percent,
                              max_train_samples=max_train_samples, max_eval_samples=max_eval_samples,
                              bucket_key=bucket_key)
    ordered = order_for_training(limited, seed).select(*keys, "split", "position")
    if validation is None:
        full = triples.join(ordered, on=keys, how="inner")
    else:
        full = (triples.withColumn("split", F.lit("train"))
                .unionByName(validation.withColumn("split", F.lit("validation")))
                .join(ordered, on=[*keys, "split"], how="inner"))
    examples = format_instructions(full, max_source=max_source, max_target=max_target, style=style,
                                   keep=("split", "position", *keep))
    return examples, split_counts(limited, name="samples")


def prepare_chats(messages: DataFrame, *, max_source: int = DEFAULT_MAX_SOURCE,
                  max_target: int = DEFAULT_MAX_SOURCE, allow_unequal: bool = False, **kw) -> DataFrame:
    """One example per conversation from the long message form (see ``chat_examples``)."""
    return chat_examples(messages, max_source=max_source, max_target=max_target,
                         allow_unequal=allow_unequal, **kw)


_FILE_ORDER = ["file_rank", "file_block", "file_row"]


def _read_split_files(spark, train_dir: str, validation_dir: str | None, schema):
    from corpusprep.sources.files import read_corpus
    parts = read_corpus(spark, train_dir, validation_dir, schema=schema)
    return parts["train"], parts.get("validation")


def instructions_from_files(spark, train_dir: str, validation_dir: str | None = None, **kw) -> tuple[DataFrame, DataFrame]:
    """Instruction JSON / JSON-lines folders (``instruction, input, output``) -> examples and
    sample counts, rows in file order (see ``prepare_instructions`` for the options)."""
    from corpusprep.sources.files import INSTRUCTION_SCHEMA
    train, val = _read_split_files(spark, train_dir, validation_dir, kw.pop("schema", INSTRUCTION_SCHEMA))
    return prepare_instructions(train, _FILE_ORDER, validation=val, bucket_key=F.col("file_pos"), **kw)


def chats_from_files(spark, train_dir: str, validation_dir: str | None = None, *,
                     percent: float = DEFAULT_VALIDATION_PERCENT, max_train_samples: int | None = None,
                     max_eval_samples: int | None = None, seed: int = 42, **kw) -> DataFrame:
    """Conversation JSON folders (``conversations: [{from, value}, ...]`` per row) -> split,
    limited, train shuffled, formatted per row (``chat_examples_nested``)."""
    from corpusprep.operators.chat import chat_examples_nested
    from corpusprep.sources.files import CONVERSATION_SCHEMA
    train, val = _read_split_files(spark, train_dir, validation_dir, CONVERSATION_SCHEMA)
    limited = split_and_limit(train, _FILE_ORDER, validation=val, percent=percent,
                              max_train_samples=max_train_samples, max_eval_samples=max_eval_samples,
                              bucket_key=F.col("file_pos"))
    ordered = order_for_training(limited, seed)
    return chat_examples_nested(ordered, keep=("split", "position"), **kw)
