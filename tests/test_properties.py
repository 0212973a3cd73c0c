"""Randomized invariants (hypothesis): packing conserves tokens, blocks never exceed the block
size, and results do not depend on the partition count; running scans equal plain loops."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusprep.operators.ordering import grouped_scan, row_index
from corpusprep.operators.packing import pack_text_blocks, packing_report
from model import ids, pack

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(lengths=st.lists(st.integers(0, 60), min_size=1, max_size=40),
       block=st.integers(1, 32), rows_per_batch=st.integers(1, 12), parts=st.sampled_from([1, 4, 17]),
       keep_short=st.booleans())
def test_packing_invariants(spark, lengths, block, rows_per_batch, parts, keep_short):
    data = [("train", i, "".join(chr(0x61 + (i + j) % 26) for j in range(n))) for i, n in enumerate(lengths)]
    df = spark.createDataFrame(data, "split string, row_idx long, text string").repartition(parts)
    blocks = [(r.batch_id, r.block_no, list(r.input_ids))
              for r in pack_text_blocks(df, block, rows_per_batch, keep_short=keep_short).collect()]
    assert sorted(blocks) == sorted(pack([ids(t) for _, _, t in data], block, rows_per_batch, keep_short))
    assert all(0 < len(b) <= block for _, _, b in blocks)
    rep = packing_report(df, block, rows_per_batch, length=F.length("text"), keep_short=keep_short).first()
    assert rep.tokens_kept + rep.tokens_dropped == rep.tokens_in == sum(lengths)
    assert rep.tokens_kept == sum(len(b) for _, _, b in blocks) and rep.blocks == len(blocks)


@SETTINGS
@given(values=st.lists(st.tuples(st.integers(0, 3), st.integers(-9, 9)), min_size=1, max_size=60),
       chunk=st.integers(1, 8), parts=st.sampled_from([1, 5]))
def test_scan_and_index_equal_loops(spark, values, chunk, parts):
    rows = [(g, i, v) for i, (g, v) in enumerate(values)]
    df = spark.createDataFrame(rows, "g long, s long, v long").repartition(parts)
    scanned = {(r.g, r.s): (r.run, r.low) for r in grouped_scan(
        df, ["g"], "s", {"run": ("sum", "v"), "low": ("min", "v")}, chunk_size=chunk).collect()}
    indexed = {(r.g, r.s): r.row_idx for r in row_index(df, ["s"], partition_by=["g"], num_buckets=3).collect()}
    for g in {g for g, _, _ in rows}:
        mine = [(s, v) for gg, s, v in rows if gg == g]
        run, low = 0, None
        for pos, (s, v) in enumerate(mine):
            run += v
            low = v if low is None else min(low, v)
            assert scanned[(g, s)] == (run, low)
            assert indexed[(g, s)] == pos
