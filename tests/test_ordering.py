import random

import pytest
from pyspark.sql import functions as F

from corpusprep.operators.ordering import (
    grouped_scan,
    head_limit,
    head_percent_split,
    row_index,
    seeded_shuffle,
)


@pytest.mark.parametrize("buckets", [1, 3, 17])
def test_row_index_dense_and_ordered(spark, buckets):
    rnd = random.Random(buckets)
    keys = rnd.sample(range(10_000), 500)
    df = spark.createDataFrame([(k, k % 7) for k in keys], "k long, v long").repartition(5)
    out = row_index(df, ["k"], num_buckets=buckets, prefix_sums={"before": F.col("v")}, total_name="n").collect()
    expect = {k: i for i, k in enumerate(sorted(keys))}
    running, before = 0, {}
    for k in sorted(keys):
        before[k] = running
        running += k % 7
    for r in out:
        assert r.row_idx == expect[r.k]
        assert r.before == before[r.k]
        assert r.n == 500


def test_row_index_per_group_with_hot_group(spark):
    # one group holds most rows: the bucket key spreads it over buckets
    rows = [("hot" if i % 10 else "cold", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, k long")
    out = row_index(df, ["k"], partition_by=["g"], num_buckets=8).collect()
    seen = {}
    for g in ("hot", "cold"):
        ks = sorted(k for gg, k in rows if gg == g)
        seen.update({(g, k): i for i, k in enumerate(ks)})
    assert all(r.row_idx == seen[(r.g, r.k)] for r in out)


def test_row_index_by_strings(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "s string")
    assert sorted((r.row_idx, r.s) for r in row_index(df, ["s"]).collect()) == [(0, None), (1, "a"), (2, "a"), (3, "b")]


@pytest.mark.parametrize("n,expect", [(1010, 50), (30, 2), (10, 0), (50, 2), (70, 4)])
def test_head_percent_split_rounds_half_even(spark, n, expect):
    df = spark.range(n).withColumnRenamed("id", "k")
    out = head_percent_split(df, ["k"], 5)
    val = out.where("split = 'validation'").collect()
    assert len(val) == expect
    assert sorted(r.k for r in val) == list(range(expect))
    train = out.where("split = 'train'").orderBy("k").collect()
    assert [r.row_idx for r in train] == list(range(n - expect))


def test_head_limit_null_and_dict(spark):
    df = spark.range(20).withColumnRenamed("id", "row_idx").withColumn("split", F.lit("train"))
    assert head_limit(df, None).count() == 20
    assert head_limit(df, 0).count() == 20
    assert head_limit(df, 5).count() == 5
    assert head_limit(df, {"train": 3}).count() == 3


def test_seeded_shuffle_is_a_repeatable_permutation(spark):
    df = spark.range(300).withColumnRenamed("id", "doc_id")
    a = {r.doc_id: r.shuffle_idx for r in seeded_shuffle(df, 42, "doc_id").collect()}
    b = {r.doc_id: r.shuffle_idx for r in seeded_shuffle(df.repartition(7), 42, "doc_id").collect()}
    c = {r.doc_id: r.shuffle_idx for r in seeded_shuffle(df, 7, "doc_id").collect()}
    assert a == b
    assert sorted(a.values()) == list(range(300))
    assert a != c


@pytest.mark.parametrize("chunk", [1, 3, 1024])
def test_grouped_scan_matches_running_values(spark, chunk):
    rnd = random.Random(chunk)
    rows = [(g, s, rnd.randint(-5, 9)) for g in range(4) for s in range(rnd.randint(1, 60))]
    df = spark.createDataFrame(rows, "g long, s long, v long")
    out = grouped_scan(df, ["g"], "s", {"cum": ("sum", "v"), "mn": ("min", "v"), "cnt": ("count", None)},
                       chunk_size=chunk).collect()
    got = {(r.g, r.s): (r.cum, r.mn, r.cnt) for r in out}
    ex = grouped_scan(df, ["g"], "s", {"prev": ("sum", "v"), "pmin": ("min", "v")}, inclusive=False,
                      chunk_size=chunk).collect()
    got_ex = {(r.g, r.s): (r.prev, r.pmin) for r in ex}
    for g in range(4):
        vals = sorted((s, v) for gg, s, v in rows if gg == g)
        run, mn = 0, None
        for i, (s, v) in enumerate(vals):
            assert got_ex[(g, s)] == (run, mn)
            run += v
            mn = v if mn is None else min(mn, v)
            assert got[(g, s)] == (run, mn, i + 1)


def test_choose_validation_given_or_cut(spark):
    from corpusprep.operators.ordering import choose_validation
    tr = spark.range(40).withColumnRenamed("id", "k")
    va = spark.range(3).withColumnRenamed("id", "k")
    given = choose_validation(tr, va)
    assert given.where("split = 'validation'").count() == 3 and given.where("split = 'train'").count() == 40
    cut = choose_validation(tr, None, order_by=["k"], percent=5)
    assert sorted(r.k for r in cut.where("split = 'validation'").collect()) == [0, 1]


def test_null_groups_steps_and_keys_stay(spark):
    from corpusprep.operators.ordering import first_rows, grouped_scan, row_index
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("a", 1, 7), ("a", None, 8)], "g string, s long, v long")
    got = sorted((str(r.g), str(r.s), r.row_idx) for r in row_index(df, ["s"], partition_by="g").collect())
    assert got == [("None", "1", 0), ("None", "2", 1), ("a", "1", 1), ("a", "None", 0)]
    got = sorted((str(r.g), str(r.s), r.t) for r in grouped_scan(df, ["g"], "s", {"t": ("sum", "v")}).collect())
    assert [x[:2] for x in got] == [("None", "1"), ("None", "2"), ("a", "1"), ("a", "None")] and [x[2] for x in got[:2]] == [5, 11]
    keys = spark.createDataFrame([(None,), (1,), (1,), (1,), (2,)], "k long")
    for n in (1, 2, 3, 5):
        assert [r.k for r in sorted(first_rows(keys, ["k"], n).collect(), key=lambda r: r.row_idx)] == [None, 1, 1, 1, 2][:n]
    many = spark.createDataFrame([(None, "x")] + [(i, "x") for i in range(39)], "k long, text string")
    a = head_percent_split(many, ["k"], 5).select("k", "split")
    b = head_percent_split(many, ["k"], 5, keep_index=False).select("k", "split")
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_first_rows_small_and_large(spark):
    from corpusprep.operators.ordering import first_rows
    df = spark.range(500).withColumnRenamed("id", "k").repartition(7)
    small = first_rows(df, ["k"], 20)
    assert [(r.k, r.row_idx) for r in small.orderBy("k").collect()] == [(i, i) for i in range(20)]
    big = first_rows(df, ["k"], 300)
    assert sorted(r.row_idx for r in big.collect()) == list(range(300))
    assert first_rows(df, ["k"], None).count() == 500


@pytest.mark.parametrize("n,pct", [(37, 10), (10, 4), (200, 50)])
def test_membership_split_equals_indexed_split(spark, n, pct):
    rnd = random.Random(n)
    rows = [(rnd.randint(0, 5), i, f"t{i}") for i in rnd.sample(range(10_000), n)]
    df = spark.createDataFrame(rows, "a long, b long, text string").repartition(3)
    key = F.col("a") * F.lit(10_000) + F.col("b")
    full = {(r.a, r.b): r.split for r in head_percent_split(df, ["a", "b"], pct, bucket_key=key).collect()}
    only = head_percent_split(df, ["a", "b"], pct, bucket_key=key, keep_index=False)
    assert "row_idx" not in only.columns
    assert {(r.a, r.b): r.split for r in only.collect()} == full


def _keys_of(spark):
    rnd = random.Random(8)
    rows = [(rnd.choice([None, "a", "b", "bb", "", "é"]), rnd.choice([None, rnd.randint(-3, 3)]), i) for i in range(900)]
    rows += [("hot", 7, 10_000 + i) for i in range(600)]  # one key in the first two columns holds two fifths of all rows
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(rows, "s string, k int, i long").repartition(5)


def _nulls_first(row):
    return [(v is not None, v if v is not None else 0) for v in row]


def test_row_index_by_any_key_and_group(spark):
    rows, df = _keys_of(spark)
    want = {r[2]: i for i, r in enumerate(sorted(rows, key=_nulls_first))}
    got = row_index(df, ["s", "k", "i"], num_buckets=9, prefix_sums={"before": F.col("i")}, total_name="n").collect()
    assert {r.i: r.row_idx for r in got} == want and {r.n for r in got} == {len(rows)}
    run, before = 0, {}
    for r in sorted(rows, key=_nulls_first):
        before[r[2]], run = run, run + r[2]
    assert {r.i: r.before for r in got} == before
    got = row_index(df, ["k", "i"], partition_by="s", num_buckets=9).collect()
    for g in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: _nulls_first(r[1:]))
        assert {r.i: r.row_idx for r in got if r.s == g} == {r[2]: i for i, r in enumerate(mine)}
    assert row_index(df.where("false"), ["s"]).count() == 0


def test_ties_nulls_and_hot_keys_are_dealt_over_many_ranges(spark):
    rows, df = _keys_of(spark)
    from corpusprep.operators.ordering import in_ranges, ordered_buckets
    for order in (["s", "k"], ["k"]):
        held = in_ranges(df, [F.col(c) for c in order], 12)
        assert held.groupBy("__bucket").count().agg({"count": "max"}).first()[0] < len(rows) / 4
        index = sorted((r.row_idx, r.s, r.k) for r in row_index(df, order, num_buckets=12).collect())
        assert [i for i, _, _ in index] == list(range(len(rows)))
        keys = [_nulls_first((s, k) if order[0] == "s" else (k,)) for _, s, k in index]
        assert keys == sorted(keys)
    one = spark.range(1000).withColumn("k", F.lit(5))  # a numeric key of one value: no single bucket
    assert ordered_buckets(one, ["k"], num_buckets=8)[0].groupBy("__bucket").count().count() > 4
    assert sorted(r.row_idx for r in row_index(one, ["k"], num_buckets=8).collect()) == list(range(1000))


@pytest.mark.parametrize("order", [["i"], ["s", "i"], ["k", "s", "i"], ["s"], ["k"]])
def test_nth_key_and_head_rows(spark, order, monkeypatch):
    from corpusprep.operators import ordering
    monkeypatch.setattr(ordering, "_HELD_KEYS", 40)
    monkeypatch.setattr(ordering, "_HISTOGRAM", 4)
    rows, df = _keys_of(spark)
    at = ["s", "k", "i"].index
    ranked = sorted(([r[at(c)] for c in order] for r in rows), key=_nulls_first)
    for n in (1, 2, 39, 40, 41, 500, 899, 1200, len(rows) - 41, len(rows) - 1, len(rows)):
        found = ordering.nth_key(df, order, n)
        assert list(found.values) == ranked[n - 1], (order, n)
        assert found.tied == (n < len(rows) and ranked[n] == ranked[n - 1])
        assert df.where(found.before).count() == sum(_nulls_first(r) < _nulls_first(ranked[n - 1]) for r in ranked)
        if n in (1, 500, 1200, len(rows)):
            got = ordering.head_rows(df, order, n).select(*order).collect()
            assert sorted(map(list, got), key=_nulls_first) == ranked[:n]
    assert ordering.nth_key(df, order, len(rows) + 1) is None and ordering.nth_key(df, order, 0) is None
    assert ordering.head_rows(df, order, 5000).count() == len(rows)
    assert ordering.nth_key(df.where("false"), order, 1) is None


def test_heads_move_no_rows(spark):
    from corpusprep.operators.ordering import head_rows
    df = spark.range(5000).withColumn("text", F.lit("t" * 50)).repartition(4).checkpoint()
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(head_rows(df, ["id"], 1000))
    assert "Exchange" not in plan(head_percent_split(df, ["id"], 5, keep_index=False))


@pytest.mark.parametrize("span", [None, 10 ** 9])
def test_grouped_scan_in_three_levels_and_more(spark, span):
    """Chunks of 4: the hot group's 400 steps take five levels, and no window holds more than a chunk."""
    rnd = random.Random(4)
    rows = [(g, s, rnd.randint(-9, 9)) for g, n in ((None, 7), (1, 400), (2, 65)) for s in rnd.sample(range(n), n * 3 // 4)]
    df = spark.createDataFrame(rows, "g int, s long, v long")
    out = grouped_scan(df, ["g"], "s", {"cum": ("sum", "v"), "mn": ("min", "v"), "mx": ("max", "v"), "n": ("count", None)},
                       chunk_size=4, span=span)
    got = {(r.g, r.s): (r.cum, r.mn, r.mx, r.n) for r in out.collect()}
    for g in (None, 1, 2):
        seen = []
        for s, v in sorted((s, v) for gg, s, v in rows if gg == g):
            seen.append(v)
            assert got[(g, s)] == (sum(seen), min(seen), max(seen), len(seen))
    if span is None:
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Window [") >= 4


def test_ranges_take_few_keys_to_the_driver(spark, monkeypatch):
    from corpusprep.operators import ordering
    name, told = "spark.sql.execution.rangeExchange.sampleSizePerPartition", []
    before, write = spark.conf.get(name), ordering.stored
    monkeypatch.setattr(ordering, "stored", lambda df, at: (told.append(int(spark.conf.get(name))), write(df, at))[1])
    df = spark.range(300).selectExpr("concat('key ', id % 100) AS k", "id")
    for ranges in (3, 256, 1300):
        ordering.in_ranges(df, ["k", "id"], ranges)
    assert told == [100, 50, 10] and spark.conf.get(name) == before
    got = ordering.row_index(df, ["k", "id"], num_buckets=256).orderBy("row_idx").collect()
    assert [(r.k, r.id) for r in got] == sorted((f"key {i % 100}", i) for i in range(300))


def test_stored_ranges_have_running_sums(spark):
    from corpusprep.operators.ordering import in_ranges
    df = spark.range(400).selectExpr("concat('k', id % 7) AS k", "id", "id % 5 AS n").repartition(6)
    rows = in_ranges(df, ["k", "id"], 5, sum_of="n").orderBy("__bucket", "__place").collect()
    assert [(r.k, r.id) for r in rows] == sorted((f"k{i % 7}", i) for i in range(400)) and len({r["__bucket"] for r in rows}) > 1
    sums = {}
    for r in rows:
        assert r["__sum"] == sums.get(r["__bucket"], 0)
        sums[r["__bucket"]] = r["__sum"] + r.n
