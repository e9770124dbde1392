"""Secrets in texts: keyword automaton, anchored patterns at its hits, checksums.

One pass of an Aho-Corasick automaton over the lower-cased text finds every
keyword. A pattern is tried only at (or right before) a hit of one of its
keywords, never searched for over the text; then a checksum built into the
secret decides, where it has one. Runs of hexadecimal digits have no keyword;
they alone are found by a plain scan for 32 digits.

Kinds, in order: assign, access and hex are the base kinds. The method adds
``token`` (prefix, 30 characters, CRC-32 in base 62), ``iban`` (after the word
iban; remainder 97), ``card`` (after the word card; Luhn) and ``key`` (header of
a private key). Spans are [start, end) in code points, leftmost and not
overlapping within a kind.

Null and empty texts have no spans. Each row is scanned on its own: repeated
rows each get a row, an empty table gives none.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache
from hashlib import sha256
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listing_lake.llm.common import slices


class Rule(NamedTuple):
    kind: str
    words: tuple[str, ...]  # lower case
    pattern: re.Pattern
    valid: Callable[[re.Match], bool]


def _crc_fits(found: re.Match) -> bool:
    """The last six characters are the CRC-32 of the thirty before, in base 62."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    value, text = zlib.crc32(found[1].encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        text = digits[digit] + text
    return text == found[2]


def _iban_fits(found: re.Match) -> bool:
    code = found[1].replace(" ", "")
    moved = code[4:] + code[:4]
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _luhn_fits(found: re.Match) -> bool:
    digits = [int(c) for c in reversed(found[1]) if c.isdigit()]
    doubled = [d * 2 - 9 * (d > 4) for d in digits[1::2]]
    return 13 <= len(digits) <= 19 and (sum(digits[::2]) + sum(doubled)) % 10 == 0


BASE = ("assign", "access", "hex")
RULES = (
    Rule(
        "assign",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        re.compile(
            r"""(?:(?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
        ),
        lambda found: len(found[1]) >= 8,
    ),
    Rule("access", ("akia",), re.compile("AKIA[A-Z0-9]+"), lambda found: len(found[0]) >= 16),
    Rule(
        "token",
        ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"),
        re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
        _crc_fits,
    ),
    Rule(
        "iban",
        ("iban",),
        re.compile(r"(?ai:iban)[\x20:=]{1,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Z0-9])"),
        _iban_fits,
    ),
    Rule(
        "card",
        ("card",),
        re.compile(r"(?ai:card)(?ai:\x20(?:number|no\.?))?[\x20:=#]{1,3}([0-9](?:[\x20-]?[0-9]){12,18})(?![0-9])"),
        _luhn_fits,
    ),
    Rule(
        "key",
        ("-----begin ",),
        re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
        lambda found: True,
    ),
)
KINDS = (*BASE, *(rule.kind for rule in RULES if rule.kind not in BASE))
_HEX = re.compile("[0-9a-f]{32,}")  # the longest run from the leftmost place: runs of 32 or more


@cache
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for number, rule in enumerate(RULES):
        for word in rule.words:
            found.add_word(word, (number, len(word)))
    found.make_automaton()
    return found


def spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret, by start, then by the order of kinds."""
    if not text:
        return []
    plain = text.encode().lower().decode()  # A-Z only; keeps the number of code points
    hits: list[list[int]] = [[] for _ in RULES]
    for last, (number, length) in _automaton().iter(plain):
        hits[number].append(last + 1 - length)
    found = [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    for rule, starts in zip(RULES, hits):
        free = 0
        for start in sorted(starts):
            if start >= free and (m := rule.pattern.match(text, start)):
                free = m.end()
                if rule.valid(m):
                    found.append((start, free, rule.kind))
    return sorted(found, key=lambda span: (span[0], KINDS.index(span[2])))


def _joined(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        each = [spans(text) for text in part.column(1).to_pylist()]
        base = [[s for s in found if s[2] in BASE] for found in each]
        columns = [part.column(0)]
        columns += [pa.array([sum(s[2] == kind for s in found) for found in base], pa.int64()) for kind in BASE]
        columns.append(pa.array([sha256(_joined(found).encode()).hexdigest() for found in base], pa.string()))
        columns.append(pa.array([_joined(found) for found in each], pa.string()))
        yield pa.RecordBatch.from_arrays(columns, _COLUMNS)


_COLUMNS = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]


def scan(docs: DataFrame) -> DataFrame:
    """One row for each row of docs (doc_id, text): counts, digest and spans."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return rows.mapInArrow(
        _scan,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )
