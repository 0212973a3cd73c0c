"""Operator 11 against the tokenizers library itself."""
import hashlib
import random

import pytest

from corpusprep.llm import queries
from corpusprep.llm.word_bpe import KEPT, PIECE, SHORT, WordBpe, decode_words, default_word_vocabulary, encode_words, word_bpe


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_word_vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


def _ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def _odd_strings(n, seed):
    rng = random.Random(seed)
    parts = [" ", "  ", "\n", "\t", "'s", "'LL", "'", "a", "Z", "É", "é", "́", "9", "½", "٣", "\x1c", "\x85", "\xa0", "　", " ", "-", "漢", "😀",
             "<|endoftext|>", "<|startoftext|>", "<|", "_", "the", "ING", "=====", " word", "İ", "ΣΑΣ", "ﬁ", "Å", "\U00010d50", "Ɤ", "͸", "\x00"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(n)]


def test_ids_and_text_equal_the_library(library):
    coder = WordBpe(default_word_vocabulary())
    for text in _odd_strings(4000, 11):
        ids = coder.encode(text).tolist()
        assert ids == _ids(library, text), repr(text)
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_latin_rule_equals_the_library(library):
    coder = WordBpe(default_word_vocabulary())
    assert coder.latin
    for a in range(256):
        text = " ".join(chr(a) + chr(b) + "x1" for b in range(256))
        assert coder.encode(text).tolist() == _ids(library, text), a


def test_scanned_and_linked_ranks_agree(library, monkeypatch):
    monkeypatch.setattr("corpusprep.llm.word_bpe.ROW_WORDS", 70)
    coder, rng = WordBpe(default_word_vocabulary()), random.Random(12)
    words = ["".join(rng.choices("aaabehlnorst", k=rng.randint(1, SHORT))) for _ in range(900)] + ["a" * n for n in range(1, SHORT + 1)]
    for word, ids in zip(words, coder.merged(words)):
        assert ids == coder._merged_by_heap(word), word
        assert list(memoryview(ids).cast("I")) == _ids(library, word), word
    for word in ("a" * 1000, "ab" * 700, "".join(rng.choices("aeinorst", k=30_000))):
        assert coder.encode(word).tolist() == _ids(library, word)
    assert coder.merged([]) == []


def test_text_is_cut_at_blanks_and_strings_are_found_before(library, monkeypatch):
    monkeypatch.setattr("corpusprep.llm.word_bpe.PIECE", 7)
    coder = WordBpe(default_word_vocabulary())
    for text in _odd_strings(600, 13):
        assert coder.encode(text).tolist() == _ids(library, text), repr(text)
    assert PIECE > 1000 and KEPT > 1000


def test_a_full_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr("corpusprep.llm.word_bpe.KEPT", 3)
    coder = WordBpe(default_word_vocabulary())
    for text in _odd_strings(300, 14):
        assert coder.encode(text).tolist() == _ids(library, text)
    assert len(coder.words) == len(coder.kept) == 3


def test_unknown_ids_are_left_out(library):
    coder = word_bpe(default_word_vocabulary())
    assert coder.decode([]) == "" and coder.decode([343, 10 ** 6, -1, 344]) == "x</w> y</w>"


def test_other_files_are_refused():
    import public_tokenizers
    with pytest.raises(ValueError):
        WordBpe(public_tokenizers.path("byte_bpe_50k.json"))


def test_odd_rows(table, odd, library):
    rows = [*odd, (20, "<|endoftext|>" * 40), (21, "x" * 70_000), (22, "\n" * 5000)]
    got = decode_words(encode_words(table(rows))).collect()
    want = [(i, _ids(library, t)) for i, t in rows]
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in got) == sorted((str(i), ids, library.decode(ids, skip_special_tokens=False)) for i, ids in want)
    assert decode_words(encode_words(table([]))).count() == 0


def test_decoding_keeps_other_columns_and_null_ids(spark):
    rows = spark.createDataFrame([(1, None, "a"), (2, [343], "b"), (3, [], None)], "n int, ids array<int>, text string")
    assert sorted(map(tuple, decode_words(rows).collect())) == [(1, None, "a", None), (2, [343], "b", "x</w>"), (3, [], None, "")]
    with pytest.raises(ValueError):
        decode_words(rows, name="text")


def test_query_on_the_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = []
    for r in docs:
        ids = _ids(library, r.text)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    got = queries.op11_word_bpe(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
