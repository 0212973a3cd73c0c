"""Column expressions: ``Column -> Column`` builders, JVM-side."""

from corpusprep.functions.arrays import all_equal_to, argmax, not_equal_mask, pad_right, repeat, take
from corpusprep.functions.tokens import (
    codepoint_ids,
    decode_ids,
    empty_int_array,
    ids_text,
    labels_for_display,
    ones_like,
    token_count,
)

__all__ = [
    "all_equal_to", "argmax", "not_equal_mask", "pad_right", "repeat", "take",
    "codepoint_ids", "decode_ids", "empty_int_array", "ids_text", "labels_for_display",
    "ones_like", "token_count",
]
