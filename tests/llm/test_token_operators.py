"""Operators 4, 5 and 9 against the tokenizers library itself."""
import random
import zlib

import numpy as np
import pytest

from corpusprep.llm.packing import balanced_windows, differencing, pack_documents
from corpusprep.llm.token_counts import Transducer, token_counts
from corpusprep.llm.token_files import compress, expand, expand_range, read_token_files, write_token_files
from corpusprep.llm.vocabulary import default_vocabulary, encoder


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(default_vocabulary())


def _odd_strings(n, seed):
    rng = random.Random(seed)
    parts = [" ", "  ", "\n", "\t", "'s", "'ll", "'", "a", "Z", "é", "9", "½", "٣", "\x1c", "\x85", "\xa0", "\u3000", "-", "漢", "😀",
             "<|endoftext|>", "<|", "_", "the", "ing", "=====", " word"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(n)]


def test_encoder_equals_library(library):
    texts = _odd_strings(3000, 1)
    for text, ids in zip(texts, encoder(default_vocabulary()).ids(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_transducer_and_state_maps_equal_library(library):
    machine = Transducer(default_vocabulary())
    for text in _odd_strings(2000, 2):
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert machine.count(text) == n, repr(text)
        for size in (1, 3, 7):
            maps = [machine.state_map(text[i: i + size]) for i in range(0, max(len(text), 1), size)]
            left = maps[0]
            for m in maps[1:]:
                left = machine.compose(left, m)
            while len(maps) > 1:
                maps = [machine.compose(*maps[i: i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
            assert machine.finish(left) == machine.finish(maps[0]) == n, (text, size)


def test_transducer_refuses_other_vocabularies():
    import public_tokenizers
    with pytest.raises(ValueError):
        Transducer(public_tokenizers.path("word_bpe_49k.json"))


def test_counts_of_odd_rows(table, odd, library):
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in token_counts(table(odd), chunk_chars=1000).collect())
    assert got == sorted((str(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in odd)
    assert token_counts(table([])).count() == 0


def test_counts_of_corpus(table, corpus, library):
    got = {r.doc_id: r.n_tokens for r in token_counts(table(corpus), chunk_chars=500).collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in corpus}


@pytest.mark.parametrize("ids", [[], [1], [1] * 9, [5] * 1000, list(range(10)) * 50, [1, 1, 2] * 400, list(range(3000))])
def test_grammar_round_trip(ids):
    ids = np.array(ids, np.uint32)
    rules, rounds, lengths, seq = compress(ids, 2)
    assert expand(rules, rounds, seq).tolist() == ids.tolist()
    assert len(seq) <= len(ids)
    for a, b in ((0, 1), (3, 8), (0, len(ids)), (len(ids) // 2, len(ids))):
        if b <= len(ids):
            assert expand_range(rules, rounds, lengths, seq, a, b).tolist() == ids[a:b].tolist()


def test_grammar_compresses_repeats():
    assert len(compress(np.array([7, 8, 9, 10] * 5000, np.uint32), 2)[3]) < 100


def _expected(rows, library):
    out, at = [], 0
    for i, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_token_files(spark, table, corpus, library, tmpdir_path):
    write_token_files(table(corpus), f"{tmpdir_path}/f", shards=5, block_tokens=3000)
    got = read_token_files(spark, f"{tmpdir_path}/f").collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in got) == _expected(sorted(corpus), library)


def test_token_files_of_odd_rows(spark, table, odd, library, tmpdir_path):
    write_token_files(table(odd), f"{tmpdir_path}/f", shards=3, block_tokens=10)
    got = sorted(read_token_files(spark, f"{tmpdir_path}/f").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in odd), key=lambda i: (i is not None, i or 0))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:])) and got[0].start == 0
    assert sorted(zlib.crc32(r.ids) for r in got) == sorted(x[3] for x in _expected(odd, library))
    write_token_files(table([]), f"{tmpdir_path}/e", shards=3)
    assert read_token_files(spark, f"{tmpdir_path}/e").count() == 0


def test_differencing_is_balanced():
    rng = random.Random(3)
    sizes = [rng.randint(1, 256) for _ in range(700)]
    label, most = differencing(sizes, 70)
    sums = np.bincount(label, sizes, 70)
    assert sums.max() == most and sums.max() - sums.min() <= 8
    label, n = balanced_windows(sizes, 1024)
    assert np.bincount(label, sizes, n).max() <= 1024 and n <= -(-sum(sizes) // 1024) + 2
    assert balanced_windows([1024, 1024, 1], 1024)[1] == 3


def _check_packing(pieces, rows, library, capacity):
    docs = {}
    for key in {(r.doc_id, r.doc_tokens) for r in pieces}:
        docs[key] = sorted((r for r in pieces if (r.doc_id, r.doc_tokens) == key), key=lambda r: r.start)
    sequences = {}
    for r in pieces:
        sequences.setdefault(r.sequence_id, []).append(r)
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at and len(r.ids) == 4 * r.length
            at += r.length
        assert at <= capacity
    assert sum(r.length for r in pieces) == sum(x[2] for x in _expected(rows, library))
    return docs, sequences


def test_packing(table, corpus, library):
    pieces = pack_documents(table(corpus)).collect()
    docs, sequences = _check_packing(pieces, corpus, library, 1024)
    expected = {i: crc for i, _, _, crc in _expected(corpus, library)}
    assert {i: zlib.crc32(b"".join(r.ids for r in rs)) for (i, _), rs in docs.items()} == expected
    for rs in docs.values():
        assert all(a.start + a.length == b.start for a, b in zip(rs, rs[1:])) and rs[0].start == 0
    total = sum(r.length for r in pieces)
    assert len(sequences) <= total / 1024 * 1.03 + 4  # near-equal windows: little padding


def test_packing_of_odd_rows(table, odd, library):
    _check_packing(pack_documents(table(odd), capacity=64).collect(), odd, library, 64)
    assert pack_documents(table([])).count() == 0
