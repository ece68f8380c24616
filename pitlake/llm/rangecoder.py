"""Adaptive range coder for token ids that blends orders 2, 1 and 0, over the lanes of a block at once.

A block starts from nothing and shares nothing, so any one can be decoded alone; it carries the CRC-32 of its ids,
checked after decoding. Its ids lie in lanes, runs of ``STEPS`` ids; one array operation does the same step of all lanes.
All lanes learn one model, which grows when 1, 2, 4, 8, ... steps are done. An id is coded by what the model knows:

order 2: is it the id that last followed the previous two? Adaptive counts, chosen by how often that guess
has been right and wrong, say how likely that is;
order 1: else its share of all ids that have followed the previous id, or an escape as likely as that id has had
different followers;
order 0: else its share of all ids so far, every id of the format counting a little.

All steps narrow one range a lane, which gives out 16-bit words. Ranges are whole numbers below 2**49, held as float64,
which is exact; a carry goes into the word before it when a block is done.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC, VERSION, HEADER = b"IDRC", 2, "<4sBBxxIII"  # version, bits of an id; ids, crc, words
BLOCK = 1 << 20
STEPS = 512
LOT = 32  # steps that a writer prepares at a time
BITS = 16
IDS = 1 << BITS
SLOTS = 1 << 16  # of the guesses of order 2
LEVELS, FLAG = 6, 4096.0  # levels of right and of wrong guesses, total of the first step
WEIGHT = 32  # of a seen id in order 0; an unseen one has 1
PLACES = 1 << 20  # of the pairs that a writer finds without a search
ALL = slice(None)
FULL, LOW, WORD = float(1 << 48), float(1 << 32), float(1 << 16)
LEVEL = np.array([min(n.bit_length(), LEVELS - 1) for n in range(256)], np.uint8)


def _slots(before: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    return (before * 2654435761 + earlier * (40503 * 65599) >> 8) % SLOTS


class _Model:
    """What all lanes of a block have learned so far; it stays as it is between two calls of ``learn``."""

    def __init__(self):
        self.guess, self.kind = np.zeros(SLOTS, np.uint16), np.zeros(SLOTS, np.uint8)  # kind 0: no guess
        self.right, self.wrong = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
        self.hits, self.tried = np.zeros(1 + LEVELS * LEVELS), np.zeros(1 + LEVELS * LEVELS)
        self.seen, self.pairs_seen = np.zeros(IDS, np.int64), np.zeros(1, np.uint32)
        self._build()

    def learn(self, before: np.ndarray, slots: np.ndarray, ids: np.ndarray, hit: np.ndarray) -> None:
        """Take in the ids of some steps, the ids before them, their slots and whether the guess was right."""
        kinds = self.kind[slots]
        self.tried += np.bincount(kinds, minlength=len(self.tried))
        self.hits += np.bincount(kinds[hit], minlength=len(self.hits))
        self.right = np.minimum(self.right + np.bincount(slots[hit], minlength=SLOTS), 255)
        self.wrong = np.minimum(self.wrong + np.bincount(slots[~hit & (kinds > 0)], minlength=SLOTS), 255)
        fresh = ~hit & (self.right[slots] <= self.wrong[slots])
        self.guess[slots[fresh]] = ids[fresh]
        self.kind[slots] = 1
        held = np.flatnonzero(self.kind)
        self.kind[held] = 1 + LEVEL[self.right[held]] * LEVELS + LEVEL[self.wrong[held]]
        self.seen += np.bincount(ids, minlength=IDS)
        self.pairs_seen = np.sort(np.concatenate([self.pairs_seen, (before << BITS | ids).astype(np.uint32)]))
        self._build()

    def _build(self) -> None:
        share = np.clip(np.round(FLAG * (self.hits + 0.4) / (self.tried + 0.8)), 1, FLAG - 1)
        share[0] = 0
        self.share = share
        seen = self.pairs_seen
        starts = np.flatnonzero(np.concatenate([[True], seen[1:] != seen[:-1]]))
        self.pairs = seen[starts]
        sizes = np.diff(np.append(starts, len(seen)))
        row = self.pairs >> BITS
        kinds = np.bincount(row, minlength=IDS)
        self.in_row = np.bincount(row, sizes, IDS)
        row_starts = np.cumsum(self.in_row) - self.in_row
        self.escape = np.maximum(kinds, 1).astype(np.float64)
        self.total = self.in_row + self.escape
        self.begin, self.size = starts - row_starts[row], sizes.astype(np.float64)
        self.row_starts = row_starts.astype(np.int64)
        self.sizes = sizes
        self.until = np.concatenate([[0], np.cumsum(WEIGHT * self.seen + 1)]).astype(np.float64)

    def finder(self):
        """For the writer: places of pairs among the known ones, and which are known."""
        mixed = lambda pair: pair * np.uint32(2654435769) >> np.uint32(12)
        place = np.zeros(PLACES, np.int32)
        place[mixed(self.pairs)] = np.arange(len(self.pairs), dtype=np.int32)

        def find(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = place.take(mixed(pair))
            known = self.pairs.take(at) == pair
            others = np.flatnonzero(~known)  # unknown, or its place is another pair's
            found = np.minimum(np.searchsorted(self.pairs, pair[others]), len(self.pairs) - 1)
            at[others], known[others] = found, self.pairs[found] == pair[others]
            return at, known

        return find

    def of_place(self) -> tuple[np.ndarray, np.ndarray]:
        """For the reader: the pair that holds each place of the rows side by side, and its second id."""
        return np.repeat(np.arange(len(self.pairs), dtype=np.int32), self.sizes), (self.pairs_seen & (IDS - 1)).astype(np.uint16)


class _Writer:
    def __init__(self, lanes: int, steps: int):
        # A step of an id narrows by 12, 21 and 26 bits at most.
        self.width = 4 * steps + 4
        self.words = np.zeros(lanes * self.width, np.uint32)
        self.at = np.arange(lanes) * self.width
        self.low, self.range = np.zeros(lanes), np.full(lanes, FULL)

    def narrow(self, lanes: np.ndarray | slice, start: np.ndarray, size: np.ndarray, total) -> None:
        unit = np.floor(self.range[lanes] / total)
        low, span = self.low[lanes] + start * unit, unit * size
        small = np.flatnonzero(span < LOW)
        while len(small):
            own, some = small if lanes is ALL else lanes[small], low[small]
            word = np.floor(some / LOW)
            at = self.at[own]
            self.words[at] = word
            self.at[own] = at + 1
            low[small] = (some - word * LOW) * WORD
            span[small] *= WORD
            small = small[span[small] < LOW]
        self.low[lanes], self.range[lanes] = low, span

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """Words of all lanes side by side, and how many each has."""
        last = np.ceil(self.low / WORD)
        self.words[self.at] = np.floor(last / WORD)
        self.words[self.at + 1] = last % WORD
        sizes = self.at + 2 - np.arange(len(self.at)) * self.width
        held = np.arange(self.width) < sizes[:, None]
        words = self.words.reshape(held.shape)[held]
        while len(over := np.flatnonzero(words >= IDS)):
            words[over] -= IDS
            words[over - 1] += 1
        return words.astype("<u2"), sizes.astype("<u2")


class _Reader:
    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        self.words = words.astype(np.float64)
        self.at = np.cumsum(sizes, dtype=np.int64) - sizes
        self.code, self.range = np.zeros(len(sizes)), np.full(len(sizes), FULL)  # code: from the range's low end
        for _ in range(3):
            self.code = self.code * WORD + self.words.take(self.at, mode="clip")
            self.at += 1

    def target(self, lanes: np.ndarray, total) -> tuple[np.ndarray, np.ndarray]:
        """Where in 0..total-1 the code of each lane lies, and how long one part of its range is."""
        unit = np.floor(self.range[lanes] / total)
        return np.minimum(np.floor(self.code[lanes] / unit), total - 1), unit

    def below(self, share: np.ndarray) -> np.ndarray:
        """Code the first step of all lanes: does the code lie in the first ``share`` parts of ``FLAG``?"""
        unit = np.floor(self.range / FLAG)
        hit = self.code < share * unit
        self.narrow(ALL, np.where(hit, 0, share), np.where(hit, share, FLAG - share), unit)
        return hit

    def narrow(self, lanes: np.ndarray | slice, start: np.ndarray, size: np.ndarray, unit: np.ndarray) -> None:
        code, span = self.code[lanes] - start * unit, unit * size
        small = np.flatnonzero(span < LOW)
        while len(small):
            own = small if lanes is ALL else lanes[small]
            at = self.at[own]
            code[small] = code[small] * WORD + self.words.take(at, mode="clip")
            self.at[own] = at + 1
            span[small] *= WORD
            small = small[span[small] < LOW]
        self.code[lanes], self.range[lanes] = code, span


def _turns(steps: int) -> list[tuple[int, int]]:
    """Runs of steps between which the model learns."""
    ends = [0, *(1 << k for k in range(steps.bit_length()) if 1 << k < steps), steps]
    return list(zip(ends, ends[1:], strict=False))


def _write(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and words a lane of ids laid out as (steps, lanes)."""
    steps, lanes = ids.shape
    out, model = _Writer(lanes, steps), _Model()
    padded = np.concatenate([np.zeros((2, lanes), np.int64), ids])
    for begin, end in _turns(steps):
        find, done = model.finder(), []
        for lot in range(begin, end, LOT):
            until = min(lot + LOT, end)
            done.append(_write_lot(out, model, find, padded[lot : until + 2]))
        if end < steps:
            slots, hit = map(np.concatenate, zip(*done, strict=True))
            model.learn(padded[begin + 1 : end + 1].ravel(), slots, padded[begin + 2 : end + 2].ravel(), hit)
    return out.finish()


def _write_lot(out: _Writer, model: _Model, find, padded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code some steps, of which the two before are known, and return their slots and whether the guess was right."""
    lanes = padded.shape[1]
    token, before = padded[2:].ravel(), padded[1:-1].ravel()
    slots = _slots(before, padded[:-2].ravel())
    kind = model.kind.take(slots)
    hit = (model.guess.take(slots) == token) & (kind > 0)
    share = model.share.take(kind)
    flag_start, flag_size = np.where(hit, 0, share), np.where(hit, share, FLAG - share)
    miss = np.flatnonzero(~hit)
    row, wanted = before.take(miss), token.take(miss)
    at, known = find((row << BITS | wanted).astype(np.uint32))
    start1 = np.where(known, model.begin.take(at), model.in_row.take(row))
    size1 = np.where(known, model.size.take(at), model.escape.take(row))
    total1, lane1 = model.total.take(row), miss % lanes
    unknown = np.flatnonzero(~known)
    rare, lane0 = wanted.take(unknown), lane1.take(unknown)
    start0 = model.until.take(rare)
    size0 = model.until.take(rare + 1) - start0
    cut = np.arange(0, len(token) + 1, lanes)
    cut1 = np.searchsorted(miss, cut).tolist()
    cut0 = np.searchsorted(miss.take(unknown), cut).tolist()
    for t in range(len(cut) - 1):
        now = slice(t * lanes, (t + 1) * lanes)
        out.narrow(ALL, flag_start[now], flag_size[now], FLAG)
        now = slice(cut1[t], cut1[t + 1])
        out.narrow(lane1[now], start1[now], size1[now], total1[now])
        now = slice(cut0[t], cut0[t + 1])
        if now.start < now.stop:
            out.narrow(lane0[now], start0[now], size0[now], model.until[-1])
    return slots, hit


def _read(words: np.ndarray, sizes: np.ndarray, steps: int) -> np.ndarray:
    coder, model, lanes = _Reader(words, sizes), _Model(), len(sizes)
    padded = np.zeros((steps + 2, lanes), np.int64)
    for begin, end in _turns(steps):
        of_place, second = model.of_place()
        hits, slots = np.zeros((end - begin, lanes), bool), np.zeros((end - begin, lanes), np.int64)
        for t in range(begin, end):
            before = padded[t + 1]
            slot = slots[t - begin] = _slots(before, padded[t])
            hit = hits[t - begin] = coder.below(model.share.take(model.kind.take(slot)))
            token = model.guess.take(slot).astype(np.int64)
            miss = np.flatnonzero(~hit)
            row = before.take(miss)
            total, in_row = model.total.take(row), model.in_row.take(row)
            target, unit = coder.target(miss, total)
            known = target < in_row
            place = model.row_starts.take(row) + target.astype(np.int64)
            at = of_place.take(place, mode="clip")
            coder.narrow(miss, np.where(known, model.begin.take(at), in_row), np.where(known, model.size.take(at), model.escape.take(row)), unit)
            token[miss] = second.take(place, mode="clip")
            rare = miss[~known]
            if len(rare):
                target, unit = coder.target(rare, model.until[-1])
                found = np.clip(np.searchsorted(model.until, target, side="right") - 1, 0, IDS - 1)
                coder.narrow(rare, model.until[found], model.until[found + 1] - model.until[found], unit)
                token[rare] = found
            padded[t + 2] = token
        if end < steps:
            model.learn(padded[begin + 1 : end + 1].ravel(), slots.ravel(), padded[begin + 2 : end + 2].ravel(), hits.ravel())
    return padded[2:]


def _encode(ids: np.ndarray) -> bytes:
    ids = np.asarray(ids)
    if len(ids) and int(ids.max()) >= IDS:
        raise ValueError("an id needs more digits than the format has")
    crc, words, sizes = zlib.crc32(ids.astype("<u4").tobytes()), np.empty(0, "<u2"), np.empty(0, "<u2")
    if len(ids):
        steps = min(len(ids), STEPS)
        lanes = -(-len(ids) // steps)
        filled = np.concatenate([ids, np.full(lanes * steps - len(ids), ids[-1])])
        words, sizes = _write(np.ascontiguousarray(filled.reshape(lanes, steps).T, np.int64))
    return struct.pack(HEADER, MAGIC, VERSION, BITS, len(ids), crc, len(words)) + sizes.tobytes() + words.tobytes()


def _decode(payload: bytes) -> np.ndarray:
    begin = struct.calcsize(HEADER)
    if len(payload) < begin:
        raise ValueError("not a block of this format")
    magic, version, bits, n, crc, held = struct.unpack_from(HEADER, payload)
    steps = min(n, STEPS)
    lanes = -(-n // steps) if n else 0
    if (magic, version, bits) != (MAGIC, VERSION, BITS) or len(payload) != begin + 2 * (lanes + held):
        raise ValueError("not a block of this format")
    ids = np.empty(0, np.uint32)
    if n:
        sizes, words = np.split(np.frombuffer(payload, "<u2", offset=begin), [lanes])
        with np.errstate(all="ignore"):  # damaged words may lead anywhere before the checksum tells
            ids = np.ascontiguousarray(_read(words, sizes, steps).T).ravel()[:n].astype(np.uint32)
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("a block's ids do not match its checksum")
    return ids


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """One self-contained payload for each array of ids below 65,536."""
    return [_encode(b) for b in blocks]


def decode_blocks(payloads: list[bytes]) -> list[np.ndarray]:
    """The ids of every payload; a payload that does not match its checksum raises."""
    return [_decode(p) for p in payloads]
