"""Secret scans: Aho-Corasick prefilter, anchored patterns near its hits, embedded checksums.

Two automata read each whole text once. The first finds keywords in its ASCII-lowered bytes; the
second reads the same bytes mapped to character classes and finds 16 lowercase hexadecimal digits in a row,
because a bare key has no keyword. Only at their hits is a pattern tried, anchored there. Kinds
that carry a checksum in themselves are kept only if it holds.

Defined results: null and empty texts have no spans; a repeated row is scanned each time; spans are
in code points with an exclusive end; columns other than the text are never read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass
from functools import cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.llm.common import free_name, whole

# The three base kinds, their patterns and least lengths.
ASSIGN = re.compile(
    rb"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = b"123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 12, 18, 16


def _base62_crc(match: re.Match) -> bool:
    """Six base-62 digits at the end are the CRC-32 of the characters between prefix and them."""
    body, digits = match[1][:-6], match[1][-6:]
    value = 0
    for c in digits:
        value = value * 62 + BASE62.index(c)
    return value == zlib.crc32(body)


def _base58_check(match: re.Match) -> bool:
    """The last four of the decoded bytes are the start of a double SHA-256 of the others."""
    value = 0
    for c in match[0]:
        value = value * 58 + BASE58.index(c)
    raw = value.to_bytes((value.bit_length() + 7) // 8, "big")
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def _long_value(match: re.Match) -> bool:
    return len(match[2]) >= LEAST_VALUE


@dataclass(frozen=True)
class Kind:
    name: str
    words: tuple[str, ...]  # lowered keywords that start a match; none: the class automaton
    pattern: re.Pattern
    valid: object


KINDS = (
    Kind("assign", ASSIGN_WORDS, ASSIGN, _long_value),
    Kind("access", ("akia",), ACCESS, lambda m: len(m[0]) >= LEAST_ACCESS),
    Kind("hex", (), HEX, lambda m: len(m[0]) >= LEAST_HEX),
    Kind("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(rb"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), _base62_crc),
    Kind("npm", ("npm_",), re.compile(rb"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), _base62_crc),
    Kind("xprv", ("xprv",), re.compile(rb"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![A-Za-z0-9])"), _base58_check),
)
BASE_KINDS = 3
HEX_KIND = 2
CLASS_OF = bytes(ord("h") if chr(b) in "0123456789abcdef" else ord(" ") for b in range(256))


@cache
def _automata():
    words, runs = ahocorasick.Automaton(), ahocorasick.Automaton()
    for i, kind in enumerate(KINDS):
        for word in kind.words:
            words.add_word(word, (i, len(word)))
    runs.add_word("h" * LEAST_HEX, LEAST_HEX)
    words.make_automaton()
    runs.make_automaton()
    return words, runs


def find_secrets(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of every secret of one whole text, in order."""
    data = text.encode("utf-8", "replace")
    words, runs = _automata()
    # Latin-1 gives one character per byte, so automaton positions are byte positions.
    tries = [(end - size + 1, k) for end, (k, size) in words.iter(data.lower().decode("latin-1"))]
    tries.sort()
    tried_to = [0] * len(KINDS)
    found = []

    def attempt(k: int, at: int) -> None:
        if at >= tried_to[k] and (m := KINDS[k].pattern.match(data, at)):
            tried_to[k] = m.end()
            if KINDS[k].valid(m):
                found.append((m.start(), k, m.end()))

    for at, k in tries:
        attempt(k, at)
    for end, size in runs.iter(data.translate(CLASS_OF).decode("latin-1")):
        attempt(HEX_KIND, end - size + 1)
    found.sort()
    if found and len(data) != len(text):
        starts = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
        point = lambda at: int(starts[at - 1]) if at else 0
        found = [(point(a), k, point(b)) for a, k, b in found]
    return found


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each run of touching spans becomes the name of its first kind in brackets."""
    out, at = [], 0
    for start, k, end in spans:
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], f"[{KINDS[k].name}]"]
        at = end
    return "".join([*out, text[at:]])


FOUND = "struct<spans:array<struct<kind:string,start:long,end:long>>,redacted:string>"


def _scan(texts: pd.Series) -> pd.DataFrame:
    spans, redacted = [], []
    for i, text in enumerate(whole(texts)):
        found = find_secrets(text)
        spans.append([{"kind": KINDS[k].name, "start": a, "end": b} for a, k, b in found])
        redacted.append(redact(text, found) if found else texts.iloc[i])
    return pd.DataFrame({"spans": spans, "redacted": redacted})


def scan(docs: DataFrame, text: str = "text", output: str = "secrets") -> DataFrame:
    """``docs`` with one more column: the spans found and the text with them blanked.

    No shuffle; every row is read alone, so a hot key cannot matter. A null text keeps a null
    ``redacted``.
    """
    return docs.withColumn(output, F.pandas_udf(_scan, FOUND)(F.col(text)))


def report(docs: DataFrame) -> DataFrame:
    """The digest columns of the query, from the spans of ``scan``."""
    name = free_name(docs, "secrets")
    spans = F.col(f"{name}.spans")
    base = [k.name for k in KINDS[:BASE_KINDS]]
    joined = lambda xs: F.array_join(
        F.transform(xs, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter(spans, lambda s: s.kind == kind)).cast("long")
    return scan(docs.select("doc_id", "text"), output=name).select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(joined(F.filter(spans, lambda s: s.kind.isin(base))).cast("binary"), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )
