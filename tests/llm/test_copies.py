"""Operators 1, 2 and 6 against brute force."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from corpusprep.llm.components import components
from corpusprep.llm.ngram_join import Needs, drop_near_copies, jaccard_components, tree_overlaps
from corpusprep.llm.projections import near_vectors
from corpusprep.llm.repeats import remove_repeats


def _shingles(text, k):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())
    words = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]
    return frozenset(tuple(words[i: i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])


def _components(names, links):
    parent = {n: n for n in names}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in names}


def _brute(rows, k, num, den):
    sets = {i: _shingles(t, k) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:] if sets[a] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in _components(ids, links).items()}


def _family(n, seed, edits=4):
    """Near copies of one text, some of them exact, and unrelated texts that share a passage."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = rng.choices(words, k=120)
    passage = rng.choices(words, k=30)
    rows = []
    for i in range(n):
        text = list(base) if i % 2 else rng.choices(words, k=rng.randint(3, 90)) + passage
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("group", [128, 5])
def test_jaccard_components_equal_brute_force(table, group):
    rows = _family(120, 1) + [(1000, None), (1001, ""), (1002, "Two words"), (1003, "two WORDS")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(table(rows), group=group).collect()}
    assert got == _brute(rows, 4, 85, 100)


@pytest.mark.parametrize("kind", ["dense", "chains", "strangers"])
def test_classes_of_a_frequent_shingle(table, kind):
    """Many classes share prefix shingles: one near family, long chains of neighbours, or texts that share a line and little else."""
    rng = random.Random(kind)
    words = [f"w{i}" for i in range(3000)]
    rows, line = [], " ".join(rng.choices(words, k=9))
    if kind == "dense":
        rows = _family(400, 3, 5)
    elif kind == "chains":  # each text is the one before with two words changed: only neighbours link
        for c in range(3):
            text = line.split() + rng.choices(words, k=110)
            for i in range(100):
                rows.append((1000 * c + i, " ".join(text)))
                for _ in range(2):
                    text[rng.randrange(9, len(text))] = rng.choice(words)
    else:
        for i in range(0, 300, 2):
            text = line.split() + rng.choices(words, k=rng.randint(5, 60))
            rows.append((i, " ".join(text)))
            text[rng.randrange(len(text))] = "other"
            rows.append((i + 1, " ".join(text)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(table(rows), group=6).collect()}
    assert got == _brute(rows, 4, 85, 100)


def test_jaccard_components_of_corpus(table, corpus):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(table(corpus)).collect()}
    assert got == _brute(corpus, 4, 85, 100)


def test_jaccard_odd_rows(table, odd):
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in jaccard_components(table(odd)).collect())
    assert got == sorted([("1", 0, "1", True), ("2", 0, "2", True), ("3", 0, "3", True), ("None", 1, "None", True), ("5", 1, "5", True), ("5", 1, "5", True),
                          ("6", 1, "5", False), ("7", 1, "7", True), ("8", 1, "8", True), ("9", 1, "9", True), ("None", 0, "None", True)])
    assert jaccard_components(table([])).count() == 0


def test_drop_near_copies_keeps_one_of_each(table):
    rows = _family(60, 2)
    kept = [r.doc_id for r in drop_near_copies(table(rows)).collect()]
    assert sorted(kept) == sorted({c for _, c in _brute(rows, 5, 80, 100).values()})
    assert drop_near_copies(table(rows)).columns == table(rows).columns


def test_tree_prunes_only_hopeless_sets():
    rng = np.random.default_rng(0)
    needs = Needs(0.85)
    base = np.sort(rng.integers(0, 1 << 60, 200).astype(np.uint64))
    sets = [np.sort(np.concatenate([base[rng.random(200) < share], rng.integers(0, 1 << 60, 20).astype(np.uint64)])) for share in rng.random(40)]
    found = tree_overlaps(sets, sets, needs)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            need = needs.overlap(len(a), len(b))
            assert found[i, j] == both if both >= need else found[i, j] < need


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (7, 7)], "a bigint, b bigint")
    assert {r.id: r.component for r in components(links).collect()} == {**{i: 0 for i in range(41)}, 99: 99, 100: 99}


def _vectors(seed, n=300, size=32):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, size))
    near = base[: n // 3] + rng.standard_normal((n // 3, size)) * 0.2  # around the threshold
    hot = base[0] + rng.standard_normal((60, size)) * 0.05
    return np.concatenate([base, near, hot, base[:5]]).astype(np.float32)


@pytest.mark.parametrize("block", [2048, 16])
def test_near_vectors_against_brute_force(spark, block):
    x = _vectors(1)
    rows = [(i, [float(v) for v in r], 1) for i, r in enumerate(x)] + [(900, None, 1), (901, [0.0] * 32, 1), (902, [float("nan")] * 32, 1), (903, [], 1), (904, [1.0, None], 1), (905, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, n_links int").repartition(3)
    got = {r.vec_id: r for r in near_vectors(df, block=block).collect()}
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= linked.sum(1)).all() and found.sum() >= 0.99 * linked.sum()
    names = _components(range(len(x)), list(zip(*np.nonzero(np.triu(linked)))))
    assert np.mean([got[i].component_id == names[i] for i in range(len(x))]) >= 0.99
    for i in range(900, 906):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert near_vectors(df.limit(0)).count() == 0


def _repeats(rows, length=400):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i: i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(rows, texts):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k: k + length]] > 1:
                gone[k: k + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((str(i), len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def _removed(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in remove_repeats(df).collect())


def test_repeats_equal_brute_force(table, corpus):
    rng = random.Random(4)
    body = "".join(rng.choices("abcdé \n", k=900))
    extra = [(5000, body), (5001, "x" + body[100:700] + "y"), (5002, body[300:699]), (5003, body[:400] + "q" + body[:400]), (5004, body[200:700] + body[650:])]
    extra += [(5005, "ab" * 450), (5006, "z" * 399), (5007, "z" * 1000)]  # periodic texts repeat within themselves
    rows = corpus[:60] + extra
    assert _removed(table(rows)) == _repeats(rows)


def test_repeats_of_odd_rows(table, odd):
    rows = [(i, t if i != 9 else "long " * 900) for i, t in odd] + [(9, "long " * 900)]
    assert _removed(table(rows)) == _repeats(rows)
    assert remove_repeats(table([])).count() == 0


def test_a_phrase_with_many_contexts_is_counted_by_its_strings(table):
    rng = random.Random(8)
    line = "".join(rng.choices("abcdefgh ", k=330))
    other = lambda n: "".join(rng.choices("ijklmnop ", k=n))
    ends = [other(90), other(90)]
    rows = [(i, other(300) + rng.choice(ends) + line + rng.choice([ends[0], other(90)]) + other(300)) for i in range(60)]
    rows += [(100 + i, other(300) + line) for i in range(5)] + [(200, rows[0][1])]
    told = lambda many: sorted((r.doc_id, r.n_removed, str(r.spans), r.kept_sha256) for r in remove_repeats(table(rows), many=many).collect())
    want = told(1 << 30)
    assert sum(n > 0 for _, n, _, _ in want) > 50
    assert told(3) == want
    assert _removed(table(rows)) == _repeats(rows)


def test_columns_named_like_the_hash_stay(spark):
    from corpusprep.llm.ngram_join import drop_near_copies

    text = " ".join(f"w{i}" for i in range(60))
    rows = spark.createDataFrame([(1, text, "a", "h"), (2, text, "b", "i"), (3, "other words that are their own " * 5, "c", "j")],
                                 "doc_id bigint, text string, row_hash string, hash string")
    kept = drop_near_copies(rows)
    assert kept.columns == rows.columns
    assert sorted((r.doc_id, r.row_hash, r.hash) for r in kept.collect()) == [(1, "a", "h"), (3, "c", "j")]
