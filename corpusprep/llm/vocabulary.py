"""Token ids of whole texts by a byte-level BPE file of the ``tokenizers`` library.

The library's own splitting rule lets a text be cut before every white-space character that follows
another character, and each such piece encoded by itself. Pieces repeat, so their ids are kept in
bounded tables per Python worker: the library encodes each distinct piece about once per worker, and
the new words of a batch of texts many at a time. Arrow finds the words that are known and gathers the ids of the texts, so only
new words become Python objects."""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import text_buffers, worker_table

#: White space of the splitting rule (Unicode White_Space).
WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Each match is a run of whole pre-tokens: the splitting rule with letters and digits as one kind.
PIECES = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[^\W_]+| ?(?:[^\w{WS}]|_)+|[{WS}]+(?![^{WS}])|[{WS}]+")
#: Marks that often stand behind a word.
MARKS = ".,;:!?)\""
#: White space before a space, Latin-1 and any.
BLANK_SPACE = tuple(c + " " for c in " \n\t\r\x0b\x0c\x85\xa0")
WIDE_BLANK_SPACE = re.compile(f"[{WS}] ")
#: Bytes that may end white space in UTF-8.
MAYBE_BLANK = np.zeros(256, bool)
MAYBE_BLANK[[*range(9, 14), 32, *range(128, 256)]] = True
#: Pieces kept per worker and table, the first ones met, so the frequent ones (a cache: results do not change).
KEPT_PIECES, KEPT_SPACED = 300_000, 600_000
#: New words given to the library as one string, and code points of texts encoded together.
JOINED, TOGETHER = 128, 1 << 23
_ENCODERS: dict[str, "Encoder"] = worker_table()


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())
        split = spec.get("pre_tokenizer") or {}
        plain = (spec["model"]["type"] == "BPE" and not spec.get("normalizer") and split.get("type") == "ByteLevel"
                 and split.get("use_regex") and not split.get("add_prefix_space")
                 and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]))
        self.specials = [t["content"] for t in spec["added_tokens"]] if plain else None
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # byte-level alphabet: these bytes as they are
        hidden = [b for b in range(256) if b not in set(shown)]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.pieces: dict[str, bytes] = {}
        # words of letters and other parts of texts between spaces, by what follows the space, and their ids
        self.words, self.word_ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.firsts: dict[str, bytes] = {}  # words of letters that other parts start with
        self.bare = None
        if plain and not any(spec["model"].get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            # the library's merges alone, and how many bytes each id stands for
            self.bare = Tokenizer.from_str(json.dumps(spec | {"pre_tokenizer": None, "post_processor": None, "added_tokens": [], "truncation": None, "padding": None}))
            self.sizes = np.zeros(max(spec["model"]["vocab"].values()) + 1, np.int64)
            for token, i in spec["model"]["vocab"].items():
                self.sizes[i] = len(token)

    def _new_piece(self, piece: str) -> bytes:
        if piece.lstrip(" ").isalpha():  # one pre-token: the library's merges alone
            ids = [t.id for t in self.library.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))]
        else:
            ids = self.library.encode(piece, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _new_words(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words of letters, each with a blank before it, many in one string. Merges stay within a word
        unless a token holds the end of one and the blank after it; then the words are encoded one by one."""
        groups = [words[at: at + JOINED] for at in range(0, len(words), JOINED)] if self.bare else []
        texts = [" " + " ".join(group) for group in groups]
        shown = [text.encode().decode("latin-1").translate(self.letters) for text in texts]
        blank = self.letters[32]
        for group, text, found in zip(groups, shown, self.bare.encode_batch_fast(shown, add_special_tokens=False) if groups else ()):
            ids = np.array(found.ids, "<u4")
            ends = np.cumsum(self.sizes[ids])
            stops = np.cumsum([len(part) + 1 for part in text[1:].split(blank)])
            cuts = np.searchsorted(ends, stops)
            if len(ids) and ends[-1] == len(text) and (ends[cuts] == stops).all():
                body, cuts = ids.tobytes(), (4 * cuts + 4).tolist()
                yield from (body[a:b] for a, b in zip([0, *cuts], cuts))
            else:
                yield from (self._new_piece(" " + word) for word in group)
        if not groups:
            yield from (self._new_piece(" " + word) for word in words)

    def _between_boundaries(self, text: str) -> bytes:
        """Ids of a text that starts and ends where the splitting rule always cuts."""
        return self._joined(PIECES.findall(text))

    def _joined(self, pieces: list[str]) -> bytes:
        out = []
        for piece in pieces:
            ids = self.pieces.get(piece)
            if ids is None:
                ids = self._new_piece(piece)
                if len(self.pieces) < KEPT_PIECES:
                    self.pieces[piece] = ids
            out.append(ids)
        return b"".join(out)

    def ids(self, texts: Iterable[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, as ``encode(add_special_tokens=False)``."""
        texts = list(texts)
        given = pa.array(texts, pa.large_string())
        data, ends = text_buffers(given)
        data = data[: ends[-1]]
        doubtful = set((np.searchsorted(ends, np.flatnonzero(MAYBE_BLANK[data[:-1]] & (data[1:] == 32)), side="right") - 1).tolist())
        out: list = [self._unsplit(text, i in doubtful) for i, text in enumerate(texts)]
        parts = [i for i, ids in enumerate(out) if ids is None]
        if not parts:
            return out
        split = pc.split_pattern(given.take(pa.array(parts)) if len(parts) < len(texts) else given, " ")
        cuts = split.offsets.to_numpy()
        known = self.words.slice(0, 2 * len(split.values))  # Arrow hashes it for every batch: few words do not pay for many
        which = pc.index_in(split.values, value_set=known).fill_null(-1).to_numpy().astype(np.int64)
        which[cuts[:-1]] = 0  # no space before the first word of a text
        missing = which < 0
        new = split.values.filter(pa.array(missing)).dictionary_encode()
        names = new.dictionary.to_pylist()
        ids = self._spaced(names) if names else {}
        made = pa.array([ids[name] for name in names], pa.large_binary())
        firsts = pa.array([self._between_boundaries(texts[i].split(" ", 1)[0]) for i in parts], pa.large_binary())
        table = pa.concat_arrays([self.word_ids.slice(0, len(known)), made, firsts])
        which[missing] = new.indices.to_numpy() + np.int64(len(known))
        which[cuts[:-1]] = len(known) + len(names) + np.arange(len(parts))
        if len(known) == len(self.words) and (room := max(KEPT_SPACED - len(known), 0)):
            self.words = pa.concat_arrays([self.words, new.dictionary.slice(0, room)])
            self.word_ids = pa.concat_arrays([self.word_ids, made.slice(0, room)])
        _, ends, data = table.take(pa.array(which)).buffers()
        ends, data = np.frombuffer(ends, np.int64)[cuts].tolist(), memoryview(data)
        for i, start, end in zip(parts, ends, ends[1:]):
            out[i] = data[start:end].tobytes()
        return out

    def _unsplit(self, text: str, doubtful: bool = True) -> bytes | None:
        """The ids of a text, or None if the rule cuts before every space, as it does if the text is not ``doubtful``."""
        if self.specials is None or any(s in text for s in self.specials):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if doubtful and (any(s in text for s in BLANK_SPACE) or (_wide(text) and WIDE_BLANK_SPACE.search(text))):
            return self._between_boundaries(text)
        return None

    def _spaced(self, new: list[str]) -> dict[str, bytes]:
        """Ids of parts of texts with a space before each: words of letters, or such words and what stands between and behind them."""
        ids, pieces = {}, {}
        words = {part: None for part in new if part.isalpha()}
        for part in new:
            if part in words:
                continue
            first = part.rstrip(MARKS)
            if first.isalpha():
                pieces[part] = first, [part[len(first):]]  # marks behind a word are one piece
            else:
                inside = PIECES.findall(" " + part)
                first = inside[0][1:]
                pieces[part] = (first, inside[1:]) if first.isalpha() else (None, inside)
        known = self.firsts
        words |= {first: None for first, _ in pieces.values() if first is not None and first not in known}
        ids |= zip(words, self._new_words(list(words)))
        for part, (first, inside) in pieces.items():
            if first is None:
                ids[part] = self._joined(inside)
                continue
            before = known.get(first)
            if before is None:
                before = ids[first]
                if len(known) < KEPT_PIECES:
                    known[first] = before
            ids[part] = before + (len(inside) == 1 and self.pieces.get(inside[0]) or self._joined(inside))
        return ids


def encoded(batch: pa.RecordBatch, path: str) -> Iterator[tuple[object, bytes]]:
    """(first column, ids of the text in the second) of each row; null text is empty. Texts of about 8 MB are encoded together."""
    encode = encoder(path)
    names, texts, size = [], [], 0
    for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        names.append(name)
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= TOGETHER:
            yield from zip(names, encode.ids(texts))
            names, texts, size = [], [], 0
    yield from zip(names, encode.ids(texts))


def _wide(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return True
    return False


def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    if path not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
