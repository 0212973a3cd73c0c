"""Operator 5: token counts by a compiled finite-state transducer.

The byte-level BPE of a vocabulary file is compiled, state by state as texts need them, into one
deterministic transducer over bytes. Reading a byte moves to the next state and emits how many
tokens the encoding gains (a merge may take some back). A state is the longest suffix of the word
that can still grow into a vocabulary entry, with the last token and the relative count at each of
its positions: finitely many, whatever the text. That is exact because the encoding of a prefix
is the encoding of the prefix without its last token, followed by that token, and a token may follow
another exactly if the two stay apart when encoded together.

Long texts are cut into chunks at any character. A chunk's state map is what it does from every state in
which it can be entered: text up to its first certain boundary (a blank after another character),
the tokens between the first and the last such boundary, and the text after the last. Maps compose
associatively, so chunks are summarised independently and composed in order per document.

Results: one row per input row, null text counted as empty, rows with equal or null ids kept apart; input columns other than the id are not
carried, so clashing names cannot arise. Empty table: empty result."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import worker_table
from .vocabulary import PIECES, WS, default_vocabulary

#: Transitions and words kept by a compiled transducer before it is compiled anew (a cache).
KEPT = 1_000_000
BOUNDARY = re.compile(rf"(?<=[^{WS}])(?=[{WS}])")


class Transducer:
    """Counts of a byte-level BPE ``.json`` vocabulary."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        spec = json.loads(library.to_str())
        split = spec.get("pre_tokenizer") or {}
        if (spec["model"]["type"] != "BPE" or split.get("type") != "ByteLevel" or not split.get("use_regex")
                or split.get("add_prefix_space") or spec.get("normalizer")
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])):
            raise ValueError(f"{path}: the transducer compiles plain byte-level BPE vocabularies")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # byte-level alphabet: these bytes as they are
        hidden = [b for b in range(256) if b not in set(shown)]
        self.char = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        back = {ord(c): b for b, c in self.char.items()}
        specials = [t["content"] for t in spec["added_tokens"]]
        self.tokens = {bytes(back[ord(c)] for c in t) for t in spec["model"]["vocab"] if t not in specials}
        self.prefixes = {t[:i] for t in self.tokens for i in range(1, len(t))}
        self.model = library.model
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        self.words = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WS}\p{{L}}\p{{N}}]+|[{WS}]+(?![^{WS}])|[{WS}]+")
        self.apart = lru_cache(KEPT)(self._apart)
        self._clear()

    def _clear(self) -> None:
        self.states: list[tuple] = [(b"", (None,), (0,))]
        self.numbers = {self.states[0]: 0}
        self.moves: dict[int, tuple[int, int]] = {}
        self.known: dict[str, int] = {}

    def _apart(self, a: bytes | None, b: bytes) -> bool:
        """Whether ``b`` may follow ``a``: encoded together they stay two tokens (``a`` None: one)."""
        both = "".join(map(self.char.__getitem__, (a or b"") + b))
        got = self.model.tokenize(both)
        return len(got) == (1 if a is None else 2) and len(got[-1].value) == len(b)

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        """The transition of ``state`` under ``byte``: (next state, tokens gained)."""
        window, lasts, counts = self.states[state]
        window += bytes([byte])
        for size in range(1, len(window) + 1):
            token, at = window[-size:], len(lasts) - size
            if token in self.tokens and self.apart(lasts[at], token):
                break
        gain = counts[at] + 1
        keep = next((k for k in range(len(window), 0, -1) if window[-k:] in self.prefixes), 0)
        new = (window[len(window) - keep:], (*lasts, token)[-(keep + 1):], tuple(c - gain for c in (*counts, gain)[-(keep + 1):]))
        number = self.numbers.get(new)
        if number is None:
            number = self.numbers[new] = len(self.states)
            self.states.append(new)
        self.moves[state << 8 | byte] = move = (number, gain)
        return move

    def word(self, word: str) -> int:
        """Tokens of one pre-token: the emissions along its path from the first state."""
        state = total = 0
        moves = self.moves
        for byte in word.encode():
            move = moves.get(state << 8 | byte) or self._compile(state, byte)
            state = move[0]
            total += move[1]
        return total

    def count(self, text: str) -> int:
        """Tokens of a whole text, or of a text between two certain boundaries."""
        if self.special:
            total = len(self.special.findall(text))
            if total:
                return total + sum(map(self.count, self.special.split(text)))
        pieces = PIECES.findall(text)
        try:
            return sum(map(self.known.__getitem__, pieces))
        except KeyError:
            if len(self.known) > KEPT or len(self.moves) > KEPT:
                self._clear()
            for piece in dict.fromkeys(pieces):
                if piece not in self.known:
                    self.known[piece] = sum(map(self.word, self.words.findall(piece)))
            return sum(map(self.known.__getitem__, pieces))

    def state_map(self, chunk: str) -> tuple[bool, str, int, str]:
        """(has a certain boundary, text before the first, tokens between, text from the last on)."""
        cuts = [m.start() for m in BOUNDARY.finditer(chunk)]
        if not cuts:
            return False, chunk, 0, ""
        return True, chunk[:cuts[0]], self.count(chunk[cuts[0]:cuts[-1]]), chunk[cuts[-1]:]

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of ``a`` followed by ``b``; associative. A boundary between them may be new."""
        if not a[0] and not b[0]:
            return self.state_map(a[1] + b[1])
        if not a[0]:
            return self._extend(self.state_map(a[1] + b[1]), b[2], b[3])
        glued = self.state_map(a[3] + b[1])  # starts at a boundary of its own
        if not b[0]:
            if not glued[0]:
                return True, a[1], a[2], a[3] + b[1]
            return True, a[1], a[2] + self.count(glued[1]) + glued[2], glued[3]
        return True, a[1], a[2] + self.count(a[3] + b[1]) + b[2], b[3]

    def _extend(self, front: tuple, count: int, tail: str) -> tuple:
        """``front`` followed by a certain boundary, ``count`` tokens and ``tail``."""
        if not front[0]:
            return True, front[1], count, tail
        return True, front[1], front[2] + self.count(front[3]) + count, tail

    def finish(self, m: tuple) -> int:
        """Tokens of a whole text from its map: the start and the end of a text are boundaries too."""
        return self.count(m[1]) + m[2] + self.count(m[3])


_COMPILED: dict[str, Transducer] = worker_table()


def transducer(path: str) -> Transducer:
    if path not in _COMPILED:
        _COMPILED[path] = Transducer(path)
    return _COMPILED[path]


def token_counts(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 chunk_chars: int = 1 << 15) -> DataFrame:
    """``id_col``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row of ``docs``."""
    path = vocabulary or default_vocabulary()
    kind = docs.schema[id_col].dataType.simpleString()
    key = F.struct(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                   F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                if len(text) <= chunk_chars:
                    chunks = [(True, "", machine.count(text), "")]
                else:
                    chunks = [machine.state_map(text[at: at + chunk_chars]) for at in range(0, len(text), chunk_chars)]
                rows += [row] * len(chunks)
                found += [{"chunk": i, "has": h, "head": a, "n": n, "tail": t} for i, (h, a, n, t) in enumerate(chunks)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(found, _MAP)], ["key", "map"])

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            totals = []
            for listed in batch.column(1):
                todo = [(m["has"], m["head"], m["n"], m["tail"]) for m in listed.as_py()]
                while len(todo) > 1:  # a balanced tree: the composition is associative
                    todo = [machine.compose(*todo[i: i + 2]) if i + 1 < len(todo) else todo[i] for i in range(0, len(todo), 2)]
                totals.append(machine.finish(todo[0]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(totals, pa.int64())], ["key", "n_tokens"])

    keyed = f"key struct<row:bigint,id:{kind},n_bytes:bigint>"
    summaries = docs.select(key.alias("key"), F.col(text_col).alias("text")).mapInArrow(
        maps, f"{keyed}, map struct<chunk:int,has:boolean,head:string,n:bigint,tail:string>")
    ordered = summaries.groupBy("key").agg(F.sort_array(F.collect_list("map")).alias("maps"))
    return ordered.mapInArrow(composed, f"{keyed}, n_tokens bigint").select(
        F.col("key.id").alias(id_col), F.col("key.n_bytes").alias("n_bytes"), "n_tokens")


_MAP = pa.struct([("chunk", pa.int32()), ("has", pa.bool_()), ("head", pa.string()), ("n", pa.int64()), ("tail", pa.string())])
