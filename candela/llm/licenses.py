"""License scan by ordered signature rules (operator 2).

A text is read as its words in lower case, one blank between them. The
rules of ``license_rules`` are tried in order, each only where all its gate
words occur among the text's words (a set inclusion). Detections that
overlap are resolved by priority and interval containment: a detection is
suppressed if its words lie within those of another detection of higher or
equal priority (of equal intervals and priorities the first rule's stays).
The base phrases are counted beside the rules and never suppressed.

``score`` is the noisy-or of the labels' confidences, a label's confidence
being the priority of its strongest detection over 100.

Defined results: NULL text reads as empty (no words, empty labels, score
0); whole texts are scanned; rows are independent, so repeated rows repeat
their result; other columns are untouched.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from candela.llm.common import empty_if_null, text_slices
from candela.llm.license_rules import RULES

# The base phrases and their labels.
BASE_PHRASES = {b"cc by": "cc-by", b"general public license": "gpl", b"all rights reserved": "reserved"}

#: Bytes of words: digits, letters (lower-cased first) and everything beyond ASCII; the rest separates.
_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)

RESULT = (
    "struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:string,labels:string,"
    "detections:array<struct<label:string,priority:int,start:bigint,end:bigint>>,score:double>"
)


@dataclass(frozen=True)
class Signature:
    label: str
    priority: int
    gates: frozenset[bytes]
    pattern: re.Pattern


def parse_rules(table: str) -> list[Signature]:
    rules = []
    for line in table.splitlines():
        if line.strip() and not line.startswith("#"):
            label, priority, gates, pattern = (x.strip() for x in line.split("|", 3))
            rules.append(
                Signature(
                    label, int(priority), frozenset(gates.encode().split()),
                    re.compile(b"(?<= )(?:" + pattern.encode() + b")(?= )"),
                )
            )
    return rules


SIGNATURES = parse_rules(RULES)
_BASE = [(re.compile(b"(?<= )" + phrase + b"(?= )"), phrase.split()[0], label) for phrase, label in BASE_PHRASES.items()]
_BY_GATE: dict[bytes, list[int]] = {}
for _k, _rule in enumerate(SIGNATURES):
    _BY_GATE.setdefault(max(sorted(_rule.gates), key=len), []).append(_k)
_GATES = frozenset(_BY_GATE)


def suppress(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Keep (start, end, priority, rule) detections that no other of at least their priority contains.

    One sweep by start (longer, then stronger, then earlier rules first)
    with the furthest end seen so far per priority.
    """
    furthest: dict[int, int] = {}
    kept = []
    for d in sorted(found, key=lambda d: (d[0], -d[1], -d[2], d[3])):
        if not any(end >= d[1] for p, end in furthest.items() if p >= d[2]):
            kept.append(d)
        furthest[d[2]] = max(furthest.get(d[2], -1), d[1])
    return kept


def scan_text(text: bytes) -> dict:
    """Words, base phrases and detections of one UTF-8 text."""
    words = text.translate(_WORDS).split()
    have = set(words)
    base: list[tuple[int, str]] = []
    kept: list[tuple[int, int, int, int]] = []
    gates = have & _GATES
    if gates or any(first in have for _, first, _ in _BASE):
        line = b" " + b" ".join(words) + b" "
        starts = list(accumulate((len(w) + 1 for w in words), initial=1))
        for pattern, first, label in _BASE:
            if first in have:
                base += [(bisect_left(starts, m.start()), label) for m in pattern.finditer(line)]
        found = []
        for k in sorted(k for g in gates for k in _BY_GATE[g]):
            rule = SIGNATURES[k]
            if rule.gates <= have:
                for m in rule.pattern.finditer(line):
                    start = bisect_left(starts, m.start())
                    found.append((start, start + m.group().count(b" ") + 1, rule.priority, k))
        kept = suppress(found)
    best: dict[str, int] = {}
    for _, _, priority, k in kept:
        best[SIGNATURES[k].label] = max(priority, best.get(SIGNATURES[k].label, 0))
    base_labels = {label for _, label in base}
    for label in base_labels:
        best.setdefault(label, 50)
    miss = 1.0
    for label in sorted(best):
        miss *= 1 - min(best[label], 99) / 100
    return {
        "n_words": len(words),
        "n_base": len(base),
        "first_word": min((at for at, _ in base), default=None),
        "last_word": max((at for at, _ in base), default=None),
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(best)),
        "detections": [
            {"label": SIGNATURES[k].label, "priority": p, "start": a, "end": b} for a, b, p, k in kept
        ],
        "score": 1 - miss,
    }


def scan(text: str | Column) -> Column:
    """Struct column of the scan's results (see RESULT)."""
    detection = pa.struct([("label", pa.string()), ("priority", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
    kinds = {
        "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
        "base_labels": pa.string(), "labels": pa.string(), "detections": pa.list_(detection), "score": pa.float64(),
    }

    @F.arrow_udf(RESULT)
    def license_scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in (part for whole in batches for part in text_slices(whole)):
            rows = [scan_text(t) for t in batch.cast(pa.binary()).to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([r[k] for r in rows], type=kind) for k, kind in kinds.items()], names=list(kinds)
            )

    return license_scan(empty_if_null(text))
