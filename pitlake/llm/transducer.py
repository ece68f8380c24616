"""BPE encoding and decoding as bounded-lookahead streaming transducers.

**Lookahead.** Apply the merges one rank at a time, each from left to right. Take two inputs that agree on
their first n symbols, and let D be the end of the last token up to which both token sequences agree; D
starts at n. A merge (u, v) can make them differ earlier only by joining the agreed token that ends at
D, which is u, to what follows, so D falls by the length of u. From then on every token that starts at the new D
has u at its left edge. The next merge (u', v') that moves D therefore has a higher rank, and u lies on
the left spine of v' (v', its left part, that one's left part, and so on). The longest such
chain, weighted by the lengths of its left parts, bounds n - D. ``sufficient_lookahead`` computes it from the merge list in
one pass. The argument needs a list where each token is made by one merge, after its
parts; ``Encoder`` checks that.

**Encoding.** Symbols of a pre-token flow into a window. When it is full, it is merged, and the tokens that end at
least the lookahead before its end are stable: no further input can change them, so they are emitted and
their symbols leave the window. Stable tokens do not depend on how far the window reached, so what follows
is encoded again from the symbols after them. Memory is the window, however long the pre-token.

**Decoding.** Tokens become bytes; the state is the at most three bytes of an unfinished UTF-8 character.

Defined results: null and empty texts give no ids and an empty text. Nothing but the text is read.
"""

from __future__ import annotations

import codecs
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.llm import vocabulary
from pitlake.llm.common import free_name, give_back, whole

NEVER = 1 << 60
CACHED = 150_000  # strings whose ids a worker remembers


def sufficient_lookahead(merges: list[tuple[int, int, int]]) -> int:
    """Symbols beyond a token's end that fix it, whatever follows them."""
    left: dict[int, int] = {}
    size: dict[int, int] = {}
    reach: dict[int, int] = {}  # heaviest chain so far whose last left part is the key
    longest = 0
    for u, v, product in merges:
        before, part = 0, v
        while part is not None:
            before = max(before, reach.get(part, 0))
            part = left.get(part)
        here = before + size.get(u, 1)
        reach[u] = max(reach.get(u, 0), here)
        longest = max(longest, here)
        left[product] = u
        size[product] = size.get(u, 1) + size.get(v, 1)
    return longest


class Encoder:
    """Streaming encoder for the pre-tokens of one vocabulary."""

    def __init__(self, vocab: vocabulary.Vocabulary, least_window: int = 256):
        self.vocab = vocab
        self.rank = {(u, v): r for r, (u, v, _) in enumerate(vocab.merges)}
        self.product = [p for _, _, p in vocab.merges]
        made: set[int] = set()
        parts = {p for _, _, p in vocab.merges}
        self.size: dict[int, int] = {}
        for u, v, p in vocab.merges:
            if p in made or (u in parts and u not in made) or (v in parts and v not in made):
                raise ValueError("the merge list makes a token twice, or before its parts")
            made.add(p)
            self.size[p] = self.size.get(u, 1) + self.size.get(v, 1)
        self.lookahead = sufficient_lookahead(vocab.merges)
        self.window = max(least_window, 2 * self.lookahead)

    def _merge(self, symbols: list[int]) -> list[int]:
        """Lowest rank first, leftmost first, until no pair of neighbours is a merge."""
        rank, product, tokens = self.rank.get, self.product, list(symbols)
        ranks = [rank(pair, NEVER) for pair in zip(tokens, tokens[1:])]
        while ranks and (best := min(ranks)) != NEVER:
            i = ranks.index(best)
            tokens[i] = token = product[best]
            del tokens[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank((token, tokens[i + 1]), NEVER)
            if i:
                ranks[i - 1] = rank((tokens[i - 1], token), NEVER)
        return tokens

    def stream(self, symbols):
        """Token ids of one pre-token's symbols, each given out once it is stable."""
        held: list[int] = []
        for s in symbols:
            held.append(s)
            if len(held) >= self.window:
                stable, end = held_prefix(self._merge(held), self.size, len(held) - self.lookahead)
                yield from stable
                del held[:end]
        yield from self._merge(held)

    def symbols(self, word: str):
        """A pre-token's bytes; its last one carries the suffix of word ends, if the file has one."""
        data = word.encode("utf-8", "replace")
        symbols = list(map(self.vocab.byte_ids.__getitem__, data))
        symbols[-1] = self.vocab.last_byte_ids[data[-1]]
        return symbols

    def word(self, word: str) -> bytes:
        symbols = self.symbols(word)
        tokens = self.stream(symbols) if len(symbols) >= self.window else self._merge(symbols)
        return array("I", tokens).tobytes()


def held_prefix(tokens: list[int], size: dict[int, int], limit: int) -> tuple[list[int], int]:
    """The first tokens that end by ``limit`` symbols, and where they end."""
    end = 0
    for i, t in enumerate(tokens):
        if end + size.get(t, 1) > limit:
            return tokens[:i], end
        end += size.get(t, 1)
    return tokens, end


class _Seen(dict):
    """Ids of strings met before, as bytes; emptied when full. Long strings are not kept."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED:
            self.clear()
        if len(word) > 64:
            return self.encode(word)
        ids = self[word] = self.encode(word)
        return ids


class Codec:
    """Encodes texts piece by piece and decodes ids chunk by chunk."""

    def __init__(self, vocab: vocabulary.Vocabulary):
        self.vocab = vocab
        self.encoder = Encoder(vocab)
        self.words = _Seen(self.encoder.word)
        self.chunks = _Seen(lambda chunk: b"".join(map(self.words.__getitem__, vocab.words(chunk))))
        byte_of = {c: b for b, c in vocab.alphabet.items()}
        self.joint = b"" if vocab.byte_decoder else b" "
        self.token_bytes = {}
        self.plain_bytes = {}
        for i, t in vocab.tokens.items():
            special = t in vocab.specials
            body = t.removesuffix(vocab.suffix) if vocab.suffix and not special else t
            raw = t.encode() if special else bytes(byte_of[c] for c in body)
            self.plain_bytes[i] = raw + b" " * (body != t)
            self.token_bytes[i] = self.plain_bytes[i] if vocab.byte_decoder else t.encode()

    def encode(self, text: str):
        """Chunks of little-endian 32-bit ids of one whole text."""
        for piece, special in self.vocab.pieces(text):
            if special is not None:
                yield array("I", [special]).tobytes()
            else:
                yield b"".join(map(self.chunks.__getitem__, self.vocab.chunks(piece)))

    def decoder(self, plain: bool = False) -> TextState:
        """``plain``: the text the bytes stand for; else as the file's decoder writes it."""
        return TextState(self.plain_bytes, b"") if plain else TextState(self.token_bytes, self.joint)


class TextState:
    """Bytes to text, holding only the bytes of an unfinished character."""

    def __init__(self, bytes_of: dict[int, bytes], joint: bytes):
        self.bytes_of, self.joint, self.begun = bytes_of, joint, False
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: bytes) -> str:
        if not ids:
            return ""
        data = self.joint.join(map(self.bytes_of.__getitem__, array("I", ids)))
        if self.begun:
            data = self.joint + data
        self.begun = True
        return self.state.decode(data)

    def end(self) -> str:
        return self.state.decode(b"", True)


@lru_cache(maxsize=2)
def codec(content: str) -> Codec:
    return Codec(vocabulary.parsed(content))


def _digest(shared):
    @F.pandas_udf("struct<n_tokens:long,ids_sha256:string,decoded_sha256:string>")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        # The tables and caches end with the task, so that later stages find the worker's memory free.
        give_back()
        own = Codec(vocabulary.Vocabulary(shared.value))
        for texts in batches:
            rows = []
            for text in whole(texts):
                n, ids_hash, text_hash, state = 0, hashlib.sha256(), hashlib.sha256(), own.decoder()
                for ids in own.encode(text):
                    n += len(ids) // 4
                    ids_hash.update(ids)
                    text_hash.update(state.feed(ids).encode())
                text_hash.update(state.end().encode())
                rows.append((n, ids_hash.hexdigest(), text_hash.hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
        del own
        give_back()

    return digest


def with_ids(docs: DataFrame, path: str, text: str = "text", output: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each whole text."""
    shared = vocabulary.load(docs.sparkSession, path)

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        own = codec(shared.value)
        return pd.Series([array("i", b"".join(own.encode(t))) for t in whole(texts)], dtype=object)

    return docs.withColumn(output, encode(F.col(text)))


def with_text(tokens: DataFrame, path: str, ids: str = "ids", output: str = "decoded", plain: bool = True) -> DataFrame:
    """``tokens`` with the text of its ids; null ids give null."""
    shared = vocabulary.load(tokens.sparkSession, path)

    @F.pandas_udf("string")
    def decode(rows: pd.Series) -> pd.Series:
        own, out = codec(shared.value), []
        for row in rows:
            if row is None:
                out.append(None)
                continue
            state = own.decoder(plain)
            out.append(state.feed(array("I", [int(i) for i in row]).tobytes()) + state.end())
        return pd.Series(out, dtype=object)

    return tokens.withColumn(output, decode(F.col(ids)))


def round_trip(docs: DataFrame, path: str, text: str = "text", output: str = "bpe") -> DataFrame:
    """``docs`` with token count and digests of ids and decoded text, in constant memory a row."""
    return docs.withColumn(output, _digest(vocabulary.load(docs.sparkSession, path))(F.col(text)))


def report(docs: DataFrame, path: str) -> DataFrame:
    name = free_name(docs, "bpe")
    return round_trip(docs.select("doc_id", "text"), path, output=name).select("doc_id", f"{name}.*")
