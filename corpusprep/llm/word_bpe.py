"""Operator 11: encoding and decoding by a word-level BPE file of the ``tokenizers`` library.

A word's parts lie in one contiguous array, entry i being the part between the boundaries i and i + 1,
with the merge ranks of neighbouring parts in a second one. The least rank is looked for again and
again (the leftmost of equal ones), the boundary between its two parts is deleted, both arrays close
up, and the ranks of the new part with its neighbours are refreshed. The words of some megabytes of
text that a worker has not met are merged side by side: their arrays are the rows of two matrices, and each step
scans, deletes and refreshes in every row that still has a rank. That is quadratic in the word, so words of more than
``SHORT`` characters keep the same ranks in a heap over linked parts. The result is the same.

The file's white space separates words and is dropped, so a text is worked on in pieces of about
``PIECE`` characters cut at white space, and the ids of words and of short stretches between two blanks are kept in
bounded tables per Python worker. Unicode's rules (composition, lower case, letters and digits) are
the file's own normaliser and splitter; for Latin-1 the file's rule is restated. Its special strings are found in the raw text first.

Results: one row per input row, rows with equal or null ids kept apart; null text is empty and has no
ids; no ids decode to the empty text; a null ``ids`` array decodes to null. Only the id and the text
are read, so other columns cannot clash. Empty table: empty result. A task holds one Arrow batch and
the ids of 2 MB of text or of one longer text at a time; a stretch without any blank is never cut."""

from __future__ import annotations

import heapq
import json
import re
import struct
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_slices, worker_table
from .vocabulary import WS

#: Characters of a word up to which its ranks are scanned; longer words use a heap.
SHORT = 64
#: Words that are merged side by side at most.
ROW_WORDS = 1 << 15
#: Characters of text that are cut into words at a time.
PIECE = 1 << 20
#: Words, and stretches between blanks, whose ids a worker keeps, and their greatest length (a cache: results do not change).
KEPT, KEPT_CHARS = 300_000, 32
#: Rows that are decoded into one Arrow batch.
ROWS = 256
#: ``str.split`` takes these for blanks too; the file does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_STRETCH = re.compile(f"[^{WS}]+")
_BLANK = re.compile(f"[{WS}]")
_NEVER = np.int32(2 ** 31 - 1)
#: Normaliser and splitter of the known file, and the letters that stand for bytes.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_KNOWN_RULE = json.dumps([
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}], sort_keys=True)
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTERS = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(_SHOWN))}
#: The pattern in Latin-1 (Python's ``\d`` has only 0-9 there), and the blank that stands between two texts.
_WORDS = re.compile(" |'(?:[stmd]|re|ve|ll)|[^\\W\\d_²³¹¼½¾]+|[0-9²³¹¼½¾]|(?:[^\\w\\s]|_)+")


class WordBpe:
    """Encoder and decoder of one file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())
        model, added = spec["model"], spec["added_tokens"]
        first = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        if (model["type"] != "BPE" or model.get("unk_token") or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges")
                or model.get("continuing_subword_prefix") or spec.get("decoder") or spec.get("post_processor")
                or first.get("type") != "Split" or first.get("behavior") != "Removed" or not first.get("invert")
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)):
            raise ValueError("a BPE file is needed whose words are matches of a pattern, without a decoder")
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab = model["vocab"]
        pairs = [tuple(m if isinstance(m, list) else m.split(" ", 1)) for m in model["merges"]]
        shown = [chr(b) for b in _SHOWN] + list(_LETTERS.values())
        if not all(c in vocab and c + self.suffix in vocab for c in shown):
            raise ValueError("a file is needed that names every byte, inside and at the end of a word")
        # letters, as parts inside and at the end of a word
        self.inner, self.last = (np.full(max(map(ord, shown)) + 1, -1, np.int64) for _ in range(2))
        for c in shown:
            self.inner[ord(c)], self.last[ord(c)] = vocab[c], vocab[c + self.suffix]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        self.merges = np.array([vocab[a + b] for a, b in pairs], np.int64)  # by rank
        key = left << 32 | right
        order = np.argsort(key, kind="stable")
        keep = order[np.concatenate([[True], np.diff(key[order]) != 0])] if len(order) else order
        self.pairs, self.ranks = key[keep], keep.astype(np.int32)
        self.rank_of = dict(zip(self.pairs.tolist(), self.ranks.tolist()))
        self.special = {t["content"]: t["id"] for t in added}
        longest = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        names = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        self.names = [names.get(i) for i in range(max(names, default=-1) + 1)]
        self.gaps = None in self.names
        self.there = np.array([n is not None for n in self.names], bool)
        self.tokens = pa.array(["" if n is None else n for n in self.names], pa.string())
        self.normal = self.library.normalizer
        # the splitting rule that ``_WORDS`` restates for Latin-1, where composing changes nothing
        self.latin = json.dumps([spec["normalizer"], spec["pre_tokenizer"]], sort_keys=True) == _KNOWN_RULE
        self.kept: dict[str, bytes] = {s: struct.pack("<I", i) for s, i in self.special.items()}
        self.words: dict[str, bytes] = {}

    def _known(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of parts; places after a word's end hold -1 and have none."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], _NEVER)

    def merged(self, words: list[str]) -> list[bytes]:
        """Ids (little-endian 32 bits) of each word, given in the file's byte letters."""
        out: list[bytes] = [b""] * len(words)
        lengths = np.array(list(map(len, words)), np.int64)
        for low, high in ((0, 8), (8, 16), (16, SHORT)):
            mine = np.flatnonzero((lengths > low) & (lengths <= high))
            for at in range(0, len(mine), ROW_WORDS):
                rows = mine[at: at + ROW_WORDS]
                for k, ids in zip(rows.tolist(), self._merged_rows([words[k] for k in rows.tolist()], high)):
                    out[k] = ids
        for k in np.flatnonzero(lengths > SHORT).tolist():
            out[k] = self._merged_by_heap(words[k])
        return out

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(first part of every letter of all words, letters of each word)."""
        lengths = np.array(list(map(len, words)), np.int64)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        parts, ends = self.inner[codes], np.cumsum(lengths) - 1
        parts[ends] = self.last[codes[ends]]
        return parts, lengths

    def _merged_rows(self, words: list[str], width: int) -> list[bytes]:
        letters, lengths = self._letters(words)
        columns = np.arange(width + 1)
        parts = np.full((len(words), width + 1), -1, np.int64)  # the last column stays empty
        parts[columns < lengths[:, None]] = letters
        ranks = self._known(parts[:, :-1], parts[:, 1:])
        done, row = np.full((len(words), width), -1, np.int64), np.arange(len(words))
        while len(row):
            i = ranks.argmin(axis=1)
            here = np.arange(len(row))
            least = ranks[here, i]
            over = least == _NEVER
            if over.any():
                done[row[over]] = parts[over, :-1]
                go = ~over
                row, parts, ranks, i, least, here = row[go], parts[go], ranks[go], i[go], least[go], here[: int(go.sum())]
                if not len(row):
                    break
            close = columns + (columns > i[:, None])  # without entry i + 1
            close[:, -1] = width
            parts = np.take_along_axis(parts, np.minimum(close, width), 1)
            parts[here, i] = self.merges[least]
            ranks = np.take_along_axis(ranks, np.minimum(columns[:-1] + (columns[:-1] >= i[:, None]), width - 1), 1)
            ranks[:, -1] = _NEVER
            ranks[here, i] = self._known(parts[here, i], parts[here, i + 1])
            inside = i > 0
            ranks[here[inside], i[inside] - 1] = self._known(parts[here[inside], i[inside] - 1], parts[here[inside], i[inside]])
        full = done >= 0
        flat, ends = done[full].astype("<u4").tobytes(), (4 * np.cumsum(full.sum(axis=1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _merged_by_heap(self, word: str) -> bytes:
        parts = self._letters([word])[0].tolist()
        after, before = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
        known, new = self.rank_of.get, self.merges
        todo = [(r, i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := known(a << 32 | b)) is not None]
        heapq.heapify(todo)
        while todo:
            rank, i, a, b = heapq.heappop(todo)
            j = after[i]
            if j < 0 or parts[i] != a or parts[j] != b:
                continue  # one of the two is another part by now
            parts[i], parts[j] = int(new[rank]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (r := known(parts[k] << 32 | parts[after[k]])) is not None:
                    heapq.heappush(todo, (r, k, parts[k], parts[after[k]]))
        return np.array([p for p in parts if p >= 0], "<u4").tobytes()

    def _words(self, stretches: list[str]) -> tuple[list[str], np.ndarray]:
        """All words of texts without blanks inside, as byte letters, and how many each text has."""
        plain = " ".join(stretches)
        if self.latin and not _SEPARATORS.search(plain) and (plain.isascii() or max(plain) <= "\xff"):
            found = _WORDS.findall(plain.lower())  # with the blanks between the texts
            cuts = np.flatnonzero(np.fromiter((w == " " for w in found), bool, len(found)))
            words = [w for w in found if w != " "]
            if not (plain.isascii() and plain.isprintable()):  # letters that are shown stand for themselves
                words = [w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(_LETTERS) for w in words]
            return words, np.diff(np.concatenate([[-1], cuts, [len(found)]])) - 1
        split = [[w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.normal.normalize_str(t) if self.normal else t)] for t in stretches]
        return [w for words in split for w in words], np.array(list(map(len, split)), np.int64)

    def _new(self, stretches: list[str]) -> dict[str, bytes]:
        """Ids of texts without blanks inside that are not in the table."""
        found: dict[str, bytes] = {}
        kinds: list[list[str]] = [[], [], []]
        for s in stretches:  # one text of another kind would send all others to the file's own rule
            kinds[0 if s.isascii() else 1 if max(s) <= "\xff" else 2].append(s)
        for kind in filter(None, kinds):
            words, counts = self._words(kind)
            ids = self._by_word(words)
            ends = np.cumsum(counts).tolist()
            found |= {s: b"".join(ids[a:b]) for s, a, b in zip(kind, [0, *ends], ends)}
        self._keep(self.kept, found)
        return found

    def _by_word(self, words: list[str]) -> list[bytes]:
        unknown = list({w for w in words if w not in self.words})
        fresh = dict(zip(unknown, self.merged(unknown)))
        known = self.words.get
        ids = [fresh[w] if (own := known(w)) is None else own for w in words]
        self._keep(self.words, fresh)
        return ids

    def _keep(self, table: dict, more: dict) -> None:
        room = KEPT - len(table)
        if room > 0:
            table.update(islice(((k, v) for k, v in more.items() if len(k) <= KEPT_CHARS), room))

    def _pieces(self, text: str) -> Iterator[str]:
        """The text between its special strings, and those, cut at blanks into pieces of bounded length."""
        for part in self.specials.split(text) if self.specials else [text]:
            at = 0
            while len(part) - at > PIECE:
                cut = _BLANK.search(part, at + PIECE)
                if cut is None:
                    break
                yield part[at: cut.start()]
                at = cut.start()
            yield part[at:] if at else part

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, ids of each text), as the library's ``encode(add_special_tokens=False)``."""
        counts = np.zeros(len(texts), np.int64)
        parts: list[np.ndarray] = []
        held: list[str] = []
        owners: list[tuple[int, int]] = []
        size = 0
        for k, text in enumerate(texts):
            for piece in self._pieces(text):
                before = len(held)
                if piece in self.special:
                    held.append(piece)
                else:
                    held += _STRETCH.findall(piece) if _SEPARATORS.search(piece) else piece.split()
                owners.append((k, len(held) - before))
                size += len(piece)
                if size >= 2 * PIECE:
                    parts.append(self._encode(held, owners, counts))
                    held, owners, size = [], [], 0
        parts.append(self._encode(held, owners, counts))
        return np.concatenate(parts), counts

    def _encode(self, stretches: list[str], owners: list[tuple[int, int]], counts: np.ndarray) -> np.ndarray:
        """Ids of the stretches; each distinct one is looked up once. ``counts`` of their texts grow."""
        if not stretches:
            return np.zeros(0, np.int32)
        coded = pa.array(stretches, pa.large_string()).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        ids = list(map(self.kept.get, distinct))
        if None in ids:
            new = self._new([s for s, i in zip(distinct, ids) if i is None])
            ids = [new[s] if i is None else i for s, i in zip(distinct, ids)]
        sizes = np.array(list(map(len, ids)), np.int64) // 4
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
        which = coded.indices.to_numpy(zero_copy_only=False)
        lengths = sizes[which]
        ends = np.cumsum(lengths)
        places = np.repeat((np.cumsum(sizes) - sizes)[which] - (ends - lengths), lengths) + np.arange(int(ends[-1]))
        own = np.cumsum([n for _, n in owners])
        totals = np.concatenate([[0], ends])[own]
        np.add.at(counts, [k for k, _ in owners], np.diff(totals, prepend=0))
        return flat[places]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode_all(self, ids: pa.Array) -> pa.Array:
        """Texts of a list array of ids, as the library's ``decode(skip_special_tokens=False)`` without a decoder: the tokens'
        strings, one blank between two. Ids that the file does not have are left out; a null list gives null."""
        lengths = pc.list_value_length(ids).fill_null(0).to_numpy(zero_copy_only=False)
        rows, flat = np.repeat(np.arange(len(ids)), lengths), pc.list_flatten(ids).to_numpy(zero_copy_only=False)
        known = (flat >= 0) & (flat < len(self.names))
        if self.gaps:
            known[known] = self.there[flat[known].astype(np.int64)]
        ends = np.concatenate([[0], np.cumsum(np.bincount(rows[known], minlength=len(ids)))]).astype(np.int32)
        tokens = self.tokens.take(pa.array(flat[known].astype(np.int64)))
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), tokens), " ")
        return pc.if_else(pc.is_null(ids), pa.scalar(None, pa.string()), texts)

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(pa.array([ids], pa.list_(pa.int64()))).to_pylist()[0]


_OPEN: dict[str, WordBpe] = worker_table()


def word_bpe(path: str) -> WordBpe:
    """One per worker and file."""
    if path not in _OPEN:
        _OPEN[path] = WordBpe(path)
    return _OPEN[path]


def default_word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_words(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids`` (array of int, never null) of every row of ``docs``."""
    path = vocabulary or default_word_vocabulary()
    kind = docs.schema[id_col].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_bpe(path)
        for batch in batches:
            for part in text_slices(batch, batch.schema.names[1]):
                flat, counts = coder.encode_all([text or "" for text in part.column(1).to_pylist()])
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], [id_col, "ids"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(encode, f"`{id_col}` {kind}, ids array<int>")


def decode_words(encoded: DataFrame, vocabulary: str | None = None, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ``ids_col`` in ``name`` (which it must not have yet)."""
    path = vocabulary or default_word_vocabulary()
    if name in encoded.columns:
        raise ValueError(f"the input has a column {name!r} already")
    at = encoded.columns.index(ids_col)
    schema = T.StructType([*encoded.schema.fields, T.StructField(name, T.StringType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_bpe(path)
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                yield pa.RecordBatch.from_arrays([*part.columns, coder.decode_all(part.column(at))], [*part.schema.names, name])

    return encoded.mapInArrow(decode, schema)
