"""Secret scan: an Aho-Corasick pass finds keywords, regular expressions are tried only where one begins, checksums decide.

Kinds, in order: ``assign``, ``access``, ``hex`` (base kinds), then ``github`` and ``npm``, whose tokens end in a base-62
CRC-32 of their body and are kept only if it fits. Matches are leftmost and do not overlap within a kind. Spans count code
points, ends exclusive. A null or empty text has no spans. Whole texts are scanned in one narrow pass without a shuffle. Rows that repeat an id keep a row each; an empty
table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns and the shortest matches kept.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "github", "npm")
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
    "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm",
}
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def checksum(body: str) -> str:
    """The six base-62 digits that such a token carries for its body."""
    rest, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        rest, digit = divmod(rest, 62)
        digits = _BASE62[digit] + digits
    return digits


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (len(word), kind))
    found.make_automaton()
    return found


_KEPT = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= ASSIGN_LEAST),
    "access": (ACCESS, lambda m: len(m[0]) >= ACCESS_LEAST),
    "github": (GITHUB, lambda m: checksum(m[1]) == m[2]),
    "npm": (NPM, lambda m: checksum(m[1]) == m[2]),
}


def scan(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then by the order of kinds."""
    low = text.lower()
    if len(low) != len(text):  # a letter that grows when lower-cased would move the hits
        low = text.translate(_ASCII)
    spans, past = [], dict.fromkeys(_KEPT, 0)
    for last, (size, kind) in automaton.iter(low):
        start = last + 1 - size
        if start < past[kind]:
            continue
        pattern, fits = _KEPT[kind]
        if match := pattern.match(text, start):
            past[kind] = match.end()
            if fits(match):
                spans.append((start, match.end(), kind))
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    spans.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return spans


def scan_secrets(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id and spans (array of kind, start, end; by start, then kind) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b} for a, b, k in scan(t.as_py() or "", automaton)] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))], ["doc_id", "spans"])

    return docs.select(F.col(key).alias("doc_id"), text).mapInArrow(run, f"doc_id {docs.schema[key].dataType.simpleString()}, spans array<struct<kind: string, start: long, end: long>>")
