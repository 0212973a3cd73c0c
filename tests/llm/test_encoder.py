"""Batches of texts encoded together, and the pair counts of operator 9."""
import numpy as np

from corpusprep.llm import vocabulary
from corpusprep.llm.token_files import grouped
from corpusprep.llm.vocabulary import Encoder, default_vocabulary


def test_new_words_are_encoded_many_at_a_time(monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(default_vocabulary())
    words = ["".join(chr(97 + (i * 7 + k * k + i // 26) % 26) for k in range(3 + i % 9)) for i in range(400)]
    texts = [" ".join(words), " ".join(w + "," for w in words), "Über " + " ".join(w + "'s ñ" + w for w in words), " x  y\n", "", " ", " don't 12ab <|endoftext|> z"]
    encode = Encoder(default_vocabulary())
    alone = []
    one = encode._new_piece
    monkeypatch.setattr(encode, "_new_piece", lambda piece: (alone.append(piece), one(piece))[1])
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encode.ids(texts) == want
    assert len(alone) < 20  # it was one call for every word
    assert encode.ids(texts[::-1]) == want[::-1]


def test_tables_that_are_full_change_no_ids(monkeypatch):
    monkeypatch.setattr(vocabulary, "KEPT_PIECES", 2)
    texts = ["ab cd, ef gh. ij kl'm", "cd, ab ef zz gh. \tq", "gh. gh. ij"]
    full = Encoder(default_vocabulary())
    assert full.ids(texts) == [Encoder(default_vocabulary()).ids([t])[0] for t in texts] == [full.ids([t])[0] for t in texts]


def test_known_parts_are_not_taken_apart_again(monkeypatch):
    texts = ["ab cd, ef. \tq gh", "cd, ef. ab's 12 \u00e9t\u00e9! x", "", "one"]
    encode = Encoder(default_vocabulary())
    want = [np.array(encode.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    taken, apart = [], encode._spaced
    monkeypatch.setattr(encode, "_spaced", lambda new: (taken.extend(new), apart(new))[1])
    assert encode.ids(texts) == want and len(taken) == len(set(taken)) > 5
    taken.clear()
    assert encode.ids(texts[::-1]) == want[::-1] and not taken  # words with marks came again before


def test_a_small_batch_after_a_large_one(monkeypatch):
    encode = Encoder(default_vocabulary())
    many = [" ".join(f"w{i}, v{chr(97 + i % 26)}x{i}." for i in range(500))]
    texts = [*many, "no such words", "w499, w0, w499,"]
    want = [np.array(encode.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert [encode.ids([t])[0] for t in texts] == want == encode.ids(texts)
    assert len(encode.words) == len(set(encode.words.to_pylist()))
    monkeypatch.setattr(vocabulary, "KEPT_SPACED", 3)
    full = Encoder(default_vocabulary())
    assert [full.ids([t])[0] for t in texts] == want and len(full.words) == 3


def test_words_whose_tokens_would_meet_are_encoded_one_by_one(monkeypatch):
    encode = Encoder(default_vocabulary())
    want = [encode._new_piece(" ab"), encode._new_piece(" cd")]
    encode.sizes = encode.sizes + 1  # as if tokens reached over the blanks
    assert list(encode._new_words(["ab", "cd"])) == want


def test_pairs_are_grouped_within_hot_buckets():
    rng = np.random.default_rng(3)
    pairs = rng.integers(0, 40, 3000).astype(np.uint64)
    bucket = (pairs % 7).astype(np.intp)  # several pairs in a bucket
    hot = np.zeros(8, bool)
    hot[:7] = True
    by, first = grouped(pairs, bucket, hot)
    assert sorted(by.tolist()) == list(range(3000))
    found = pairs[by]
    assert len(first) == len(np.unique(pairs)) == len(set(found[first].tolist()))
    assert all((np.diff(by[a:b]) > 0).all() for a, b in zip(first, [*first[1:], 3000]))  # equal pairs in the order of their places
    alone, _ = grouped(pairs[:0], bucket[:0], hot)
    assert len(alone) == 0
