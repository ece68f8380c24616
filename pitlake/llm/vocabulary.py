"""What a byte-level BPE file of the tokenizers library says, and how it cuts text into pre-tokens.

The file is read on the driver and broadcast (its size is bounded by the vocabulary); nothing here
merges symbols, that is each operator's own work.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import public_tokenizers
import regex
from pyspark.sql import SparkSession

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"
# The pre-token patterns. White space is Unicode's property, as in the library.
WHITE = r"\p{White_Space}"
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + WHITE + r"\p{L}\p{N}]+|"
    + WHITE + r"+(?![^" + WHITE + r"])|" + WHITE + r"+"
)


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte: itself if printable in Latin-1, else from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Vocabulary:
    """Parsed file: merges by rank, symbols of bytes, special strings, pre-token pattern."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.ids.items(), *self.specials.items()]}
        self.byte_decoder = (spec["decoder"] or {}).get("type") == "ByteLevel"
        self.alphabet = byte_alphabet()
        self.byte_ids = {b: self.ids[c] for b, c in self.alphabet.items()}
        self.last_byte_ids = {b: self.ids[c + self.suffix] for b, c in self.alphabet.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: (left id, right id, id of the two together), by rank
        self.merges = [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in pairs]
        self.normalises = spec["normalizer"] is not None
        pre = spec["pre_tokenizer"]
        if pre["type"] == "Sequence":
            pattern = pre["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", WHITE)
        else:
            pattern = BYTE_LEVEL_PATTERN
        self.find = regex.compile(pattern).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials))) + ")")

    def pieces(self, text: str, chars: int = 100_000):
        """(piece, special id or None) for one whole text, pieces about ``chars`` long at most.

        A cut is made only before a white-space run that follows other text, where neither
        normalisation nor a pre-token can span it; a text without one stays in one piece.
        """
        if any(s in text for s in self.specials):
            for i, part in enumerate(self.special.split(text)):
                if i % 2:
                    yield part, self.specials[part]
                elif part:
                    yield from ((p, None) for p in _cut(part, chars))
        elif text:
            yield from ((p, None) for p in _cut(text, chars))

    def chunks(self, piece: str) -> list[str]:
        """Parts of a normalised piece that its pre-tokens do not cross; most texts repeat them often."""
        if self.normalises:
            if not piece.isascii():
                piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
            piece = piece.lower()
            # str.split also parts at four control characters that are not white space here.
            return [piece] if _CONTROLS.search(piece) else piece.split()
        # Between two other characters one space starts a new pre-token; any other gap may not.
        if uneven(piece):
            return [piece]
        first, *rest = piece.split(" ")
        return [first, *[" " + x for x in rest]]

    def pretokens(self, piece: str) -> list[str]:
        return [w for chunk in self.chunks(piece) for w in self.words(chunk)]

    def words(self, chunk: str) -> list[str]:
        """Pre-tokens of one chunk; the pattern is not needed for a word with at most one mark after it."""
        body = chunk[1:] if chunk[:1] == " " else chunk
        if body.isalpha():
            return [chunk]
        if body[-1:] in _MARKS and body[:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
        return self.find(chunk)


_MARKS = frozenset(".,;:!?")
_CONTROLS = re.compile("[\x1c-\x1f]")
WHITE_SPACE = [c for c in map(chr, range(1 << 16)) if c.isspace()]


def uneven(piece: str) -> bool:
    """Is a space at an end or beside other white space? Searching for each character is faster than a pattern."""
    return piece[:1] == " " or piece[-1:] == " " or any(c in piece and (c + " " in piece or " " + c in piece) for c in WHITE_SPACE)


_GAP = regex.compile(r"(?<=[^\p{White_Space}])\p{White_Space}")


def _cut(text: str, chars: int):
    at = 0
    while len(text) - at > chars:
        m = _GAP.search(text, at + chars)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


@lru_cache(maxsize=4)
def parsed(content: str) -> Vocabulary:
    return Vocabulary(content)


def load(spark: SparkSession, path: str):
    """Broadcast of a tokenizer file's text; ``parsed(b.value)`` gives the vocabulary in a task."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def public_path(name: str) -> str:
    return public_tokenizers.path(name)
