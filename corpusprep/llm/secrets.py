"""Operator 10: secret scan by a randomness test battery.

Base spans are fixed patterns: assignments, access keys and hexadecimal strings. The method adds runs of at
least ``min_length`` characters of ``[A-Za-z0-9+/_=-]`` that look random. For each run an encoding is inferred
(the smallest alphabet that holds it), and three tests look for structure: chi-squared uniformity over
the alphabet, a Wald-Wolfowitz runs test around the alphabet's middle, and lag-one serial correlation. A run that
their combination (Fisher) rejects as not random is no candidate. What is left is weighed against ordinary text:
the likelihood ratio of the uniform alphabet to the document's own character frequencies is an
e-value (its mean is at most 1 if the run is ordinary text), and within each length class the candidates are
selected by the e-value form of the Benjamini-Hochberg procedure over all documents, which bounds the share of
false discoveries by ``fdr``. The class histograms have a bounded number of bins.

Positions are code points, ends exclusive. Null text is empty, without spans. Rows with equal or null
ids are separate. Input columns other than id and text are not carried. Empty table: empty result."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, stored, text_buffers, text_slices

#: Fixed patterns of the base scan.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ["assign", "access", "hex", "random"]
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
_RUN_BYTE = np.zeros(256, bool)
_RUN_BYTE[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True
_ASSIGN_BYTE = np.zeros(256, bool)
_ASSIGN_BYTE[[ord(":"), ord("=")]] = True
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings from the smallest alphabet up.
ALPHABETS = {"decimal": _DIGITS, "hex": _DIGITS + "abcdef", "HEX": _DIGITS + "ABCDEF", "letters": _LOWER, "LETTERS": _UPPER,
             "base32": _UPPER + "234567", "alnum36": _DIGITS + _LOWER, "ALNUM36": _DIGITS + _UPPER, "mixed": _UPPER + _LOWER,
             "base62": _DIGITS + _UPPER + _LOWER, "base64": _UPPER + _LOWER + _DIGITS + "+/", "base64url": _UPPER + _LOWER + _DIGITS + "-_",
             "any": _UPPER + _LOWER + _DIGITS + "+/-_="}
_SETS = {k: frozenset(v) for k, v in ALPHABETS.items()}
#: Usual text: letters fall off by rank, other characters are rare.
_USUAL = {c: 2.0 for c in ALPHABETS["any"]} | {c: max(4.0, 120 * 0.87**i) for i, c in enumerate("etaoinshrdlcumwfgypbvkjxqz")}
_USUAL_TOTAL = sum(_USUAL.values()) * 1.25  # blanks and punctuation
MAX_EVIDENCE = 400  # bins of log2 evidence; larger values count as this


def base_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns. ``runs``: all runs of 20 and more run characters, which
    hold every access key and hexadecimal string long enough."""
    found = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    for a, b in runs:
        part = text[a:b]
        found += [(a + m.start(), "access", a + m.end()) for m in ACCESS.finditer(part) if len(m[0]) >= 20]
        found += [(a + m.start(), "hex", a + m.end()) for m in HEX.finditer(part) if len(m[0]) >= 24]
    return found


def encoding(run: str) -> str:
    used = frozenset(run)
    return next(k for k, s in _SETS.items() if used <= s)


def _normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(run: str) -> tuple[str, float]:
    """(encoding, combined p-value of the hypothesis that the run is random over it)."""
    body = run.rstrip("=") or run
    kind = encoding(body)
    letters = ALPHABETS[kind]
    n, k = len(body), len(letters)
    where = {c: i for i, c in enumerate(letters)}
    x = [where[c] for c in body]
    chi = sum(c * c for c in Counter(x).values()) * k / n - n
    # Wilson-Hilferty: the chi-squared statistic's cube root is near normal
    df = k - 1
    uniform = 0.5 * math.erfc((((max(chi, 1e-9) / df) ** (1 / 3)) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)) / math.sqrt(2))
    side = [v >= k / 2 for v in x]
    ups = sum(side)
    downs = n - ups
    if ups and downs:
        runs = 1 + sum(a != b for a, b in zip(side, side[1:]))
        mean = 1 + 2 * ups * downs / n
        var = (mean - 1) * (mean - 2) / max(n - 1, 1)
        turns = _normal_tail((runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        turns = 2.0 ** (1 - n)
    mean = sum(x) / n
    var = sum((v - mean) ** 2 for v in x)
    serial = _normal_tail(sum((a - mean) * (b - mean) for a, b in zip(x, x[1:])) / var * math.sqrt(n)) if var else 0.0
    t = -2 * sum(math.log(max(p, 1e-300)) for p in (uniform, turns, serial))
    return kind, math.exp(-t / 2) * (1 + t / 2 + (t / 2) ** 2 / 2)  # chi-squared tail, 6 degrees


def evidence(run: str, kind: str, frequency: Counter, total: int) -> int:
    """log2 of the likelihood ratio of the uniform alphabet to ordinary text: the document's other characters, on top of
    usual letter frequencies that carry short documents."""
    k, body = len(ALPHABETS[kind]), run.rstrip("=") or run
    bits = -len(body) * math.log2(k) - sum(math.log2((frequency[c] + _USUAL[c]) / (total + _USUAL_TOTAL)) for c in body)
    return max(-1, min(MAX_EVIDENCE, math.floor(bits)))


def scan_secrets(docs: DataFrame, fdr: float = 0.001, reject: float = 1e-4, id_col: str = "doc_id", text_col: str = "text", matches: bool = True) -> DataFrame:
    """Per document: id and ``spans``, an array of (kind, start, end, match) by start, then kind as in ``KINDS``. Without ``matches`` there is no
    ``match``, and no secret's text is written to the scratch table that the result reads."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = stored(texts.mapInArrow(_scanner(reject, matches), f"id {docs.schema[id_col].dataType.simpleString()}, spans array<{SPAN}>"), "secret-spans")
    least = _least_evidence(found, fdr)
    needed = F.create_map(*(F.lit(v) for item in least.items() for v in item)) if least else None
    enough = (lambda s: s["bits"] >= needed[s["size"]]) if least else (lambda s: F.lit(False))
    kept = F.filter("spans", lambda s: (s["rank"] < 3) | F.coalesce(enough(s), F.lit(False)))
    names = F.array(*(F.lit(k) for k in KINDS))
    return found.select(F.col("id").alias(id_col), F.transform(F.sort_array(kept), lambda s: F.struct(
        names[s["rank"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), *([s["match"].alias("match")] if matches else []))).alias("spans"))


def redact_secrets(docs: DataFrame, fdr: float = 0.001, reject: float = 1e-4, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by ``<kind>`` (overlapping spans by the first one's kind). Every
    row and column stays. One pass finds the thresholds, a second one rewrites."""
    texts = docs.select(F.lit(0).alias("id"), F.col(text_col).cast("string").alias("text"))
    least = _least_evidence(texts.mapInArrow(_scanner(reject), f"id int, spans array<{SPAN}>"), fdr)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text_col):
                at = part.schema.get_field_index(text_col)
                texts = part.column(at).to_pylist()
                for row in _rows_to_read(*text_buffers(part.column(at))):
                    spans = [s for s in _spans(texts[row], reject) if s["rank"] < 3 or s["bits"] >= least.get(s["size"], MAX_EVIDENCE + 1)]
                    texts[row] = _redacted(texts[row], spans)
                yield part.set_column(at, text_col, pa.array(texts, part.schema.field(at).type))

    return docs.mapInArrow(rewrite, docs.schema)


def _redacted(text: str | None, spans: list[dict]) -> str | None:
    out, done = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], s["rank"])):
        if s["start"] >= done:
            out += [text[done: s["start"]], f"<{KINDS[s['rank']]}>"]
        done = max(done, s["end"])
    return "".join(out) + text[done:] if out else text


SPAN = "struct<start:int,rank:int,end:int,match:string,size:int,bits:int>"


def _scanner(reject: float, matches: bool = False):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                interesting = _rows_to_read(*text_buffers(part.column(1)))
                texts = [part.column(1)[row].as_py() if row in interesting else None for row in range(part.num_rows)]
                column = [_spans(t, reject) for t in texts]
                for text, spans in zip(texts, column):
                    for s in spans if matches else ():
                        s["match"] = text[s["start"]: s["end"]]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(column, _SPANS)], ["id", "spans"])

    return scan


def _least_evidence(found: DataFrame, fdr: float) -> dict[int, int]:
    runs = found.select(F.explode("spans").alias("s")).where("s.rank = 3")
    return _thresholds([tuple(r) for r in runs.groupBy("s.size", "s.bits").count().collect()], fdr)  # at most 16 classes of MAX_EVIDENCE + 2 bins


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32()), ("match", pa.string()), ("size", pa.int32()), ("bits", pa.int32())]))


def _rows_to_read(data: np.ndarray, ends: np.ndarray) -> set[int]:
    """Rows with a run of 20 run characters, or with one of ``:=``. In steps, so that memory is bounded."""
    rows: set[int] = set()
    for at in range(int(ends[0]), int(ends[-1]), SLICE_BYTES):
        part = data[max(at - 20, 0): min(at + SLICE_BYTES, int(ends[-1]))]
        start = max(at - 20, 0)
        other = np.flatnonzero(~_RUN_BYTE[part])
        edges = np.concatenate([[-1], other, [len(part)]])
        hits = edges[:-1][np.diff(edges) > 20] + 1
        hits = np.concatenate([hits, hits + 19, np.flatnonzero(_ASSIGN_BYTE[part])]) + start
        # a run may cross a text's end: any text it touches is read in full
        first = np.searchsorted(ends, hits, side="right") - 1
        rows.update(first.tolist())
        longer = np.flatnonzero(np.diff(edges) > 20)
        for a, b in zip((edges[longer] + 1 + start).tolist(), (edges[longer + 1] - 1 + start).tolist()):
            rows.update(range(int(np.searchsorted(ends, a, side="right")) - 1, int(np.searchsorted(ends, b, side="right"))))
    return rows


def _spans(text: str | None, reject: float) -> list[dict]:
    text = text or ""
    runs = [m.span() for m in RUN.finditer(text)]
    base = base_spans(text, runs)
    found = [{"start": s, "rank": KINDS.index(k), "end": e, "size": 0, "bits": 0} for s, k, e in base]
    starts = sorted(s for s, _, _ in base)
    furthest = list(accumulate((e for _, _, e in sorted(base)), max))  # of the spans up to each start
    free = [(a, b) for a, b in runs if not (k := bisect_left(starts, b)) or furthest[k - 1] <= a]
    if free:
        frequency = Counter(text)
        for a, b in free:
            kind, p = battery(text[a:b])
            if p >= reject:
                own = frequency.copy()
                own.subtract(text[a:b])
                found.append({"start": a, "rank": 3, "end": b, "size": min((b - a) // 16, 15),
                              "bits": evidence(text[a:b], kind, own, len(text) - (b - a))})
    return found


def _thresholds(histogram: list[tuple[int, int, int]], fdr: float) -> dict[int, int]:
    """The least evidence selected in each length class, by the e-value Benjamini-Hochberg procedure."""
    out: dict[int, int] = {}
    for size in {h[0] for h in histogram}:
        bins = sorted(((b, n) for s, b, n in histogram if s == size), reverse=True)
        total, above = sum(n for _, n in bins), 0
        for bits, n in bins:
            above += n
            if bits > 0 and 2.0 ** min(bits, 1000) >= total / (fdr * above):
                out[size] = bits
    return out
