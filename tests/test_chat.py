import random

import pytest

from corpusprep.operators.chat import chat_examples, chat_examples_nested
from model import chat


def test_fixture(spark):
    msgs = spark.createDataFrame([(1, 0, "human", "a"), (1, 1, "gpt", "b")], "conv_id long, turn long, from string, value string")
    r = chat_examples(msgs, max_source=8, max_target=8).first()
    assert r.input_ids == [195, 353, 196, 354, 2, 0, 0, 0]
    assert r.labels == [2, -100, -100, 354, 2, -100, -100, -100]
    assert r.attention_mask == [True] * 5 + [False] * 3


@pytest.mark.parametrize("limits,chunk", [((8, 8), 2), ((40, 40), 1024), ((30, 12), 3)])
def test_long_and_nested_forms_match_model(spark, limits, chunk):
    rnd = random.Random(sum(limits))
    roles = ["human", "gpt", "system"]
    rows = []
    convs = {}
    for c in range(25):
        n = rnd.randint(1, 7)
        convs[c] = []
        for t in range(n):
            frm = roles[rnd.randint(0, 2)] if t == 0 else ("human" if t % 2 else "gpt")
            val = "".join(rnd.choice("abcé😀") for _ in range(rnd.randint(0, 9)))
            rows.append((c, t, frm, val))
            convs[c].append((frm, val))
    msgs = spark.createDataFrame(rows, "conv_id long, turn long, from string, value string").repartition(3)
    S, T = limits
    long_form = {r.conv_id: (r.input_ids, r.labels, r.attention_mask)
                 for r in chat_examples(msgs, max_source=S, max_target=T, allow_unequal=True,
                                        drop_all_masked=False, chunk_size=chunk).collect()}
    nested = spark.createDataFrame([(c, [(f, v) for f, v in m]) for c, m in convs.items()],
                                   "conv_id long, conversations array<struct<from:string,value:string>>")
    nested_form = {r.conv_id: (r.input_ids, r.labels, r.attention_mask)
                   for r in chat_examples_nested(nested, max_source=S, max_target=T, allow_unequal=True,
                                                 keep=("conv_id",), drop_all_masked=False).collect()}
    for c, m in convs.items():
        i, lab, mask = chat(m, S, T)
        assert long_form[c] == (i, lab, mask)
        assert nested_form[c] == (i, lab, mask)


def test_unequal_limits_need_permission(spark):
    msgs = spark.createDataFrame([(1, 0, "human", "a")], "conv_id long, turn long, from string, value string")
    with pytest.raises(ValueError):
        chat_examples(msgs, max_source=8, max_target=4)


def test_empty_list_token_equal_to_pad_and_skip_roles(spark):
    df = spark.createDataFrame([([],), ([("human", "a"), ("system", "s"), ("gpt", "b")],)],
                               "conversations array<struct<from:string,value:string>>")
    rows = chat_examples_nested(df, max_source=6, max_target=6, drop_all_masked=False).collect()
    assert rows[0].input_ids == [2, 0, 0, 0, 0, 0]           # empty conversation: eos only
    skipped = chat_examples_nested(df, max_source=6, max_target=6, skip_roles=("system",),
                                   drop_all_masked=False).collect()
    assert skipped[1].input_ids == [195, 353, 196, 354, 2, 0]
    # a real token equal to pad is masked too
    pad_df = spark.createDataFrame([([("gpt", "b")],)], "conversations array<struct<from:string,value:string>>")
    r = chat_examples_nested(pad_df, max_source=4, max_target=4, pad_id=354).first()
    assert r.attention_mask == [True, False, True, False]


def test_null_message_value_counts_as_empty(spark):
    msgs = spark.createDataFrame([(1, 0, "human", None), (1, 1, "gpt", "b")], "conv_id long, turn long, from string, value string")
    r = chat_examples(msgs, max_source=6, max_target=6).first()
    assert r.input_ids == chat([("human", ""), ("gpt", "b")], 6, 6)[0]
    nested = spark.createDataFrame([([("human", None), ("gpt", "b")],), (None,)],
                                   "conversations array<struct<from:string,value:string>>")
    rows = chat_examples_nested(nested, max_source=6, max_target=6, drop_all_masked=False).collect()
    assert rows[0].input_ids == r.input_ids and rows[1].input_ids == [2, 0, 0, 0, 0, 0]
