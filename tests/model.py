"""Plain-Python models of the preparation rules, written from the survey's definitions.
Used as the expected side of the unit tests."""

from __future__ import annotations

IGNORE, Q, A, EOS, PAD, OFF = -100, 195, 196, 2, 0, 256


def ids(text: str) -> list[int]:
    return [ord(c) + OFF for c in text]


def pack(rows: list[list[int]], block: int, rows_per_batch: int, keep_short: bool = True):
    """rows in order -> list of (batch_id, block_no, tokens)."""
    out = []
    for b in range(0, len(rows), rows_per_batch):
        stream = [t for r in rows[b:b + rows_per_batch] for t in r]
        total = len(stream)
        if total >= block:
            total = (total // block) * block
        elif not keep_short:
            total = 0
        for k, i in enumerate(range(0, total, block)):
            out.append((b // rows_per_batch, k, stream[i:i + block]))
    return out


def instruction(instr, inp, output, max_source, max_target, style="markers"):
    source = instr + "\n" + inp if inp is not None and inp != "" else instr
    s, t = ids(source), ids(f"{output}") + [EOS]
    if len(s) > max_source or len(t) > max_target:
        return None
    limit = max_source + max_target
    if style == "markers":
        sm = [Q] + s + [A]
        i, lab = sm + t, [EOS] + [IGNORE] * (len(sm) - 1) + t
    else:
        i, lab = s + t, [IGNORE] * len(s) + t
    i, lab = i[:limit], lab[:limit]
    if all(x == IGNORE for x in lab):
        return None
    return i, lab


def chat(messages, max_source, max_target, human=("human",)):
    i, lab = [], []
    for frm, value in messages:
        v = ids(value)
        if frm in human:
            i += [Q] + v
            lab += [EOS] + [IGNORE] * len(v)
        else:
            i += [A] + v
            lab += [IGNORE] + v
    i.append(EOS)
    lab.append(EOS)
    i, lab = i[:max_source], lab[:max_target]
    i += [PAD] * (max_source - len(i))
    lab += [IGNORE] * (max_target - len(lab))
    return i, lab, [x != PAD for x in i]


def split_transcript(chosen: str, rejected: str, marker: str = "\n\nAssistant:"):
    k = chosen.rfind(marker)
    assert k != -1
    prompt = chosen[:k + len(marker)]
    return prompt, chosen[len(prompt):], rejected[len(prompt):]
