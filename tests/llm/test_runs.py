"""Operator 13 against a plain search over every start and period."""
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from corpusprep.llm import queries, runs as module
from corpusprep.llm.runs import _of_texts, _selected, periodic_runs, with_periods

WORD = re.compile("[^\x20\x09-\x0d]+")


def _plain(words, least=24):
    """Every run by its definition."""
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, end = i, j + q
            if j > i and end - start >= max(least, 3 * q):
                if not any(all(words[k] == words[k + d] for k in range(start, end - d)) for d in range(1, q)):
                    found.append((start, end - start, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def _collapsed(words, found):
    out = set()
    for s, length, q in found:
        out |= set(range(s + q, s + length))
    return " ".join(w for i, w in enumerate(words) if i not in out)


def _check(texts, least=24):
    counts, got, kept = _of_texts([t.encode() for t in texts], least)
    for text, n, r, k in zip(texts, counts, got, kept):
        words = WORD.findall(text)
        want = _plain(words, least)
        assert n == len(words)
        assert [(a, b - a, q) for a, b, q in r] == want, text[:200]
        assert k.decode() == _collapsed(words, want)


def _periodic(rng, kinds, n):
    """A text of repeated roots, some with repeats inside, and noise between them."""
    words = []
    while len(words) < n:
        q = rng.choice([1, 2, 3, 5, 8, 12, 24, 31, 32, 33, 40, 47, 48, 49, 55, 56, 57, 63, 64, 65, 80, 95, 96, 97, 112, 127, 128, 130, 170])
        root = [str(rng.randrange(kinds)) for _ in range(q)]
        if rng.random() < 0.4:  # a root that is itself periodic but for its end
            inner = root[: rng.choice([1, 2, 3, 5, 7])]
            root = (inner * q)[: max(q - 1, 1)] + root[-1:]
        times = rng.choice([1.5, 2.9, 3, 3, 3.1, 4, 6])
        words += (root * 7)[: int(round(times * len(root)))]
        words += [str(rng.randrange(kinds)) for _ in range(rng.choice([0, 0, 1, 3]))]
    return " ".join(words)


@pytest.mark.parametrize("kinds", [2, 3, 1000])
def test_all_runs_of_repetitive_texts(kinds):
    rng = random.Random(kinds)
    _check([_periodic(rng, kinds, rng.choice([30, 200, 500, 900])) for _ in range(40)])


@pytest.mark.parametrize("q", [*range(1, 12), 31, 32, 33, 47, 48, 55, 56, 57, 63, 64, 65, 95, 96, 97, 111, 112, 113, 127, 128, 129, 200])
def test_exactly_three_periods(q):
    """The shortest run of each period, with roots whose windows are locally periodic, inside other words."""
    rng = random.Random(q)
    roots = [["a"] * (q - 1) + ["b"], ["a"] * (q // 2) + ["b"] + ["a"] * (q - q // 2 - 1), (["a", "b"] * q)[: q - 1] + ["c"],
             [str(rng.randrange(2)) for _ in range(q)], [str(i) for i in range(q)]]
    length = max(24, 3 * q)
    texts = []
    for root in roots:
        texts.append(" ".join(["x"] + (root * 25)[:length] + ["y"] + (root * 25)[: length - 1] + ["z"]))
        texts.append(" ".join((root * 25)[1: length + 1]))
    _check(texts)


def test_fibonacci_and_powers():
    a, b = "a", "a b"
    while len(b.split()) < 700:
        a, b = b, b + " " + a
    _check([b, "w " * 400, "p q " * 150 + "p p q " * 60, ("k " * 50 + "l ") * 9, ("k " * 100 + "l " + "k " * 50 + "l ") * 4])
    _check([b, "w " * 40, "a b c a b c a b c d"], least=3)


def test_hash_collisions_are_no_runs(monkeypatch):
    """With hashes that are all equal every proposal is compared and refused."""
    rng = random.Random(5)
    texts = [" ".join(str(rng.randrange(10 ** 6)) for _ in range(300)) for _ in range(5)]
    monkeypatch.setattr(module._Hashes, "of", lambda self, at, length: np.zeros(len(at), np.uint64))
    _check(texts)


def test_selected_positions_are_dense_and_consistent():
    rng = np.random.default_rng(3)
    for t in (1, 2, 4, 8, 16):
        grams = rng.integers(0, 50, 3000).astype(np.uint64)
        at = _selected(grams, t)
        assert np.diff(at).max() <= t and at[0] < t
        again = _selected(np.concatenate([rng.integers(0, 50, 7).astype(np.uint64), grams]), t) - 7
        assert at.tolist() == again[again >= 0].tolist()


def test_odd_rows(table, odd):
    rows = [*odd, (30, "é\x85è " * 90), (31, "\x1c\x1d " * 80)]
    got = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(table(rows)).collect())
    want = []
    for i, t in rows:
        words = WORD.findall(t or "")
        found = [(0, len(words), 1)] if len(words) > 5000 else _plain(words)
        want.append((str(i), len(words), found, _collapsed(words, found)))
    assert got == sorted(want)
    assert periodic_runs(table([])).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(table([]), least=0)


def _rewritten(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query_on_the_whole_table(spark):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        words = _rewritten(r.doc_id, r.text)
        found = [(a, b - a, q) for a, b, q in _of_texts([" ".join(words).encode()], 24)[1][0]] if len(words) > 1500 else _plain(words)
        best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((r.doc_id, len(found), *told, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(_collapsed(words, found))))
    got = queries.op13_periodic_runs(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sum(w[1] > 0 for w in want) >= 10


def test_planted_periods_of_odd_rows(table, odd):
    rows = [*odd, *((i, " ".join(f"w{k}" for k in range(i % 50))) for i in range(100, 400))]
    got = {(str(r.doc_id), r.text) for r in with_periods(table(rows)).collect()}
    changed = lambda i, t: " ".join(_rewritten(i, t)) if i is not None and t and zlib.crc32(str(i).encode()) % 10 == 0 and WORD.search(t) else t
    assert got == {(str(i), changed(i, t)) for i, t in rows}
