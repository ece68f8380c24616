"""Token-id output: documents in id order become coded blocks, are written, and are read back.

A dataset is a folder of Spark-written files whose rows are blocks of ``rangecoder`` (own header, model and
checksum) with the ids and ends of the documents that end in them. Rows are numbered (part, seq) in document order;
Spark's commit protocol makes a lost executor's half-written file disappear.

Texts are range-partitioned by id and sorted before anything is encoded, so no token crosses the
network; a task holds about one block of ids. Only one token total per part comes to the driver.

Defined results: null and empty texts give the end id alone; rows without an id come first; rows
that repeat an id keep their own entries, next to each other.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitlake.llm import rangecoder, vocabulary
from pitlake.llm.common import blocks, whole
from pitlake.session import work_folder

END = 2
CACHED = 1_000_000  # words, about 200 MB
CHARS = 4_000_000  # of texts that are cut together
ASKED = 1_000  # parts that the library gets at a time
LATER = "\u0250"  # below, no version of Unicode changes what is a letter, a number or white space
BLOCK_TYPE = "part long, seq long, n_ids long, payload binary, doc_ids array<long>, ends array<long>"


def _lines_apart(piece: str) -> str:
    """A piece with a space before each line feed, if no line feed has white space beside it: it then is one pre-token."""
    apart = "\n" in piece and "\n\n" not in piece and not any(c in piece for c in vocabulary.WHITE_SPACE if c not in " \n")
    return piece.replace("\n", " \n") if apart else piece


def _whole(word: str) -> str:
    """A word with the space that belongs to it; one from after ``_lines_apart`` begins with its line feed instead."""
    return word if word[0] == "\n" else " " + word


class LibraryIds:
    """Ids as the tokenizers library gives them; it is asked once for each word that texts repeat.

    Texts are cut where a pre-token must begin, so the ids of the parts side by side are those of the text.
    """

    def __init__(self, content: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.vocab = vocabulary.parsed(content)
        self.library = Tokenizer.from_str(content)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.known: dict[str, bytes] = {}  # of ``_whole`` words
        self.inner: dict[str, bytes] = {}  # of pre-tokens inside words

    def _ask(self, parts: list[str]):
        for i in range(0, len(parts), ASKED):
            for found in self.library.encode_batch_fast(parts[i : i + ASKED], add_special_tokens=False):
                yield array("H", found.ids).tobytes()

    def _merged(self, symbols: str) -> bytes:
        """What the library's model makes of one pre-token; the library need not look for it."""
        return array("H", [t.id for t in self.model.tokenize(symbols)]).tobytes()

    def _learn(self, words: list[str]) -> None:
        """Ids of new words. Where all versions of Unicode agree on their pre-tokens, each of those is merged once."""
        known, inner, others, symbols = self.known, self.inner, [], self.vocab.alphabet
        space = symbols[ord(" ")]
        for word in words:
            ascii_ = word.isascii()
            if not ascii_ and max(word) >= LATER:
                others.append(word)
                continue
            if word.isalpha():  # letters of ASCII stand for themselves
                known[word] = self._merged(space + (word if ascii_ else "".join(map(symbols.__getitem__, word.encode()))))
                continue
            ids = []
            for part in self.vocab.words(_whole(word)):
                store, name = (known, part[1:]) if part[0] == " " else (inner, part)
                if name not in store:
                    store[name] = self._merged("".join(map(symbols.__getitem__, part.encode())))
                ids.append(store[name])
            known[word] = b"".join(ids)
        known.update(zip(others, self._ask(list(map(_whole, others))), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > CACHED:
            self.known.clear()
            self.inner.clear()
        pieces, of = [], []  # parts without an uneven gap or a special string inside, or whole parts that have one
        for i, text in enumerate(texts):
            for piece, special in self.vocab.pieces(text):
                pieces.append((piece, special is None and not vocabulary.uneven(piece)))
                of.append(i)
        pieces = [(_lines_apart(p) if even else p, even) for p, even in pieces]
        cut = pc.split_pattern(pa.array([p if even else "" for p, even in pieces], pa.large_string()), " ")
        begin = cut.offsets.to_numpy()
        coded = cut.values.dictionary_encode()
        number, words = coded.indices.to_numpy().copy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        # What begins a piece follows no space, so it has a number of its own.
        first = [p.partition(" ")[0] if even else p for p, even in pieces]
        others = {p: len(words) + i for i, p in enumerate(dict.fromkeys(first))}
        number[begin[:-1]] = [others[p] for p in first]
        used = np.bincount(number, minlength=len(words)) > 0
        asked = [w if u else "" for w, u in zip(words, used.tolist(), strict=False)]
        self._learn([w for w in asked if w and w not in self.known])
        ids = [self.known[w] if w else b"" for w in asked] + list(self._ask(list(others)))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
        held, starts = np.frombuffer(b"".join(ids), np.uint16), np.cumsum(sizes) - sizes
        each = sizes[number]
        until = np.concatenate([[0], np.cumsum(each)])
        out = held[np.repeat(starts[number] - until[:-1], each) + np.arange(until[-1])]
        cuts = until[begin[np.searchsorted(of, np.arange(len(texts) + 1))]].tolist()
        return [out[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]


@lru_cache(maxsize=2)
def library_ids(content: str) -> LibraryIds:
    return LibraryIds(content)


class _Stream:
    """Ids of consecutive documents, cut into blocks."""

    def __init__(self, part: int):
        self.part, self.seq, self.ids, self.size = part, 0, [], 0
        self.doc_ids: list = []
        self.ends: list[int] = []  # from the first id still held

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.size += len(ids)
        self.doc_ids.append(doc_id)
        self.ends.append(self.size)

    def coded(self, last: bool) -> pd.DataFrame:
        """All whole blocks held, and at the end the unfinished one."""
        n = self.size if last else self.size - self.size % rangecoder.BLOCK
        held = np.concatenate([*self.ids, np.empty(0, np.uint16)])
        parts = [held[i : min(i + rangecoder.BLOCK, n)] for i in range(0, n, rangecoder.BLOCK)]
        payloads = rangecoder.encode_blocks(parts)
        # A document ends in the block that holds its last id.
        done = int(np.searchsorted(self.ends, n, side="right"))
        of = (np.array(self.ends[:done], np.int64) - 1) // rangecoder.BLOCK
        cut = np.searchsorted(of, np.arange(len(parts) + 1))
        rows = pd.DataFrame({
            "part": self.part, "seq": self.seq + np.arange(len(parts)), "n_ids": [len(p) for p in parts], "payload": payloads,
            "doc_ids": [self.doc_ids[a:b] for a, b in zip(cut, cut[1:], strict=False)],
            "ends": [[e - i * rangecoder.BLOCK for e in self.ends[a:b]] for i, (a, b) in enumerate(zip(cut, cut[1:], strict=False))],
        })
        self.seq += len(parts)
        self.ids, self.size = [held[n:]], self.size - n
        self.doc_ids, self.ends = self.doc_ids[done:], [e - n for e in self.ends[done:]]
        return rows


def _encoder(shared):
    def encode(batches):
        from pyspark import TaskContext

        own, stream = library_ids(shared.value), _Stream(TaskContext.get().partitionId())
        for batch in batches:
            at = 0
            for texts in blocks(whole(batch["text"]), CHARS):
                for ids in own.encode(texts):
                    doc_id = batch["doc_id"].iloc[at]
                    stream.add(None if pd.isna(doc_id) else int(doc_id), np.append(np.frombuffer(ids, np.uint16), np.uint16(END)))
                    at += 1
                if stream.size >= rangecoder.BLOCK:
                    yield stream.coded(last=False)
        if stream.size:
            yield stream.coded(last=True)

    return encode


def write(docs: DataFrame, folder: str, path: str) -> None:
    """Encode ``docs`` (doc_id, text) with the tokenizer at ``path`` and write the blocks to ``folder``."""
    shared = vocabulary.load(docs.sparkSession, path)
    tie = F.xxhash64("text")
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    ordered.mapInPandas(_encoder(shared), BLOCK_TYPE).write.parquet(folder)


def _decode(batches):
    """(part, doc_id, ids before it in the part, its ids, their CRC) of blocks in order."""
    part, before, begun, crc = None, 0, 0, 0
    for batch in batches:
        for row in batch.itertuples():
            if row.part != part:
                part, before, begun, crc = row.part, 0, 0, 0
            (ids,) = rangecoder.decode_blocks([row.payload])
            data, start, out = ids.astype("<u4").tobytes(), 0, []
            for doc_id, end in zip(row.doc_ids, row.ends, strict=True):
                crc = zlib.crc32(data[4 * start : 4 * end], crc)
                out.append((part, doc_id, begun, before + end - begun, crc))
                begun, start, crc = before + end, int(end), 0
            crc = zlib.crc32(data[4 * start :], crc)
            before += len(ids)
            yield pd.DataFrame(out, columns=["part", "doc_id", "begin", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})


def read(spark, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files of one dataset."""
    coded = spark.read.schema(BLOCK_TYPE).parquet(folder)
    totals = coded.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    starts, at = [], 0
    for r in totals:
        starts.append((r.part, at))
        at += r.n
    offsets = spark.createDataFrame(starts, "part long, offset long")
    ordered = coded.repartition(max(1, len(starts)), "part").sortWithinPartitions("part", "seq")
    found = ordered.mapInPandas(_decode, "part long, doc_id long, begin long, n_tokens long, ids_crc32 long")
    return found.join(offsets, "part").select("doc_id", (F.col("offset") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def report(docs: DataFrame, path: str) -> DataFrame:
    folder = f"{work_folder(docs.sparkSession)}/ids-{uuid.uuid4().hex[:12]}"
    write(docs, folder, path)
    return read(docs.sparkSession, folder)
