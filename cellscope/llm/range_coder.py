"""Adaptive context-mixing range coder for blocks of token ids.

Each block starts with empty models and lists its different ids; a token is
coded in the block's own alphabet. Three models predict it: order 2 and order
1 keep the id that last followed the two ids, the id, before, with a
confidence; order 0 counts ids, and its sums take the counts up every few
tokens. Their mixture has TOTAL units: the shares of the order-2 and order-1
predictions are learned hit rates for their confidences, order 0 has the rest.
The mixture drives a range coder with 48 bits of state and 16-bit output, whose
carries are settled when the block is done.

Many blocks are coded in step: token t of all blocks is one set of array
operations, so that the work is whole-array arithmetic. All shares are made of
integers and products of doubles rounded down, which every IEEE machine
computes alike.
"""

from __future__ import annotations

import zlib

import numpy as np

#: Tokens of a block at most (its alphabet is no larger), blocks coded in step.
BLOCK, LANES = 4096, 2048
TOTAL = 1 << 16
#: What a count rises by; order 0 keeps more than 4096 + 4 * 4096 units, so that no id has none.
STEP = 4
#: Highest hit rates of order 2 and order 1, and the lowest and the first one, in units.
CAPS, LEAST, FIRST = np.array([[22_000], [18_000]], np.int16), np.int16(64), 6000
#: Slots of the order-2 table.
SLOTS = 2048
#: An entry is an id and, above its 12 bits, a confidence: 0 (nothing seen: the first id of the alphabet) to 7.
_ID, _ONE, _CONF, _EIGHT = (np.uint16(x) for x in (0x0FFF, 0x1000, 12, 8))
#: Confidence bits after a miss at 0 to 7, a hit at 0 to 7; 0: none is left, the new id takes the entry.
_LATER = np.array([s >> 1 << 12 for s in range(8)] + [min(s + 1, 7) << 12 for s in range(8)], np.uint16)
_UNIT, _TOP, _FULL = 2.0 ** 16, 2.0 ** 32, 2.0 ** 48 - 1


class _Models:
    """Models of up to LANES blocks in step; ``size``: alphabet of each, ``syms``: their symbols so far (steps x lanes)."""

    def __init__(self, size: np.ndarray, syms: np.ndarray) -> None:
        n, width = len(size), int(size.max(initial=1))
        self.n, self.m, self.t, self.taken, self.due = n, n, 0, 0, 0
        self.size, self.syms = size, syms
        # Order 0: an id a row, so that the lanes stand side by side; ids past an alphabet have no units.
        self.seen = (np.arange(width)[:, None] < size[None, :]).astype(np.uint16)
        self.coarse, self.width = -(-width // 32), width
        self.sums = np.full((width + self.coarse + 1, n), 0xFFFF, np.uint16)
        self.sums[0] = 0
        self.rows = list(zip(self.sums, self.seen, self.sums[1:]))
        self.halves, left = [], self.coarse
        while left > 1:
            self.halves.append(left // 2)
            left -= left // 2
        self.table = np.zeros(n * (SLOTS + width), np.uint16)
        self.rate = np.full(16 * n, FIRST, np.int16)
        self.rate[::8] = LEAST
        self.lane = np.arange(n)
        self.base2, self.base1 = self.lane * SLOTS, n * SLOTS + self.lane * width
        self.rates = 8 * np.arange(2 * n).reshape(2, n)
        self.caps = np.repeat(CAPS, n, axis=1)
        self.last, self.slot = np.zeros(n, np.uint16), np.stack([self.base2, self.base1])

    def _narrow(self, m: int) -> None:
        self.m = m
        for name in ("size", "lane", "base2", "base1", "rates", "caps", "last", "slot", "counted"):
            setattr(self, name, getattr(self, name)[..., :m])

    def _count(self) -> None:
        """Order 0's sums take up the symbols since the last time: 8 times while their number doubles."""
        for t in range(self.taken, self.t, 16):
            new = self.syms[t:min(t + 16, self.t), :self.m] * np.int64(self.n) + self.lane
            np.add.at(self.seen.reshape(-1), new.reshape(-1), np.uint16(STEP))
        for before, row, after in self.rows:
            np.add(before, row, after)
        self.counted = (self.size + STEP * self.t).astype(np.float64)
        self.taken, self.due = self.t, self.t + min(max(8, self.t >> 3), 256)

    def shares(self, m: int) -> None:
        """Sets the mixture of the first ``m`` lanes: predictions and their units, order 0's scale."""
        if self.t == self.due:
            self._count()
        if m < self.m:
            self._narrow(m)
        entry = self.table.take(self.slot)
        self.guess, self.sure = entry & _ID, entry >> _CONF
        self.at = self.rates + self.sure
        self.old = self.rate.take(self.at)
        self.w2, self.w1 = self.old.astype(np.float64)
        np.putmask(self.w1, self.guess[0] == self.guess[1], 0.0)  # the same id twice: order 2 has it
        self.w12 = self.w2 + self.w1
        self.scale = (_UNIT - self.w12) / self.counted

    def _interval(self, at: np.ndarray, in2: np.ndarray, in1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, units) of order 2's, order 1's prediction or else of the symbols at ``at`` in order 0's sums."""
        sums = self.sums.reshape(-1)
        start = np.floor(sums.take(at) * self.scale)
        units = np.floor(sums.take(at + self.n) * self.scale)
        units -= start
        start += self.w12
        for those, first, share in ((in1, self.w2, self.w1), (in2, 0.0, self.w2)):
            np.putmask(start, those, first)
            np.putmask(units, those, share)
        return start, units

    def interval(self, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, units) of each lane's symbol."""
        hit = self.guess == sym
        return self._interval(sym * np.int64(self.n) + self.lane, hit[0], hit[1])

    def symbol(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The symbol in whose interval each lane's value lies, and that interval."""
        in2, in12 = value < self.w2, value < self.w12
        above = np.maximum(value - self.w12, 0.0)
        above += 1.0
        # The largest sum c with c * scale < above: the quotient, raised by more than its error, or one less.
        c = above / self.scale
        c *= 1 + 2.0 ** -40
        c = np.floor(c)
        c -= c * self.scale >= above
        c = c.astype(np.uint16)
        # The last id whose sum is at most c: among every coarse-th id first, then by halves.
        steps = (self.sums[self.coarse:self.width:self.coarse, :self.m] <= c).view(np.uint8)
        at = np.add.reduce(steps, axis=0, dtype=np.uint8) * np.int64(self.coarse * self.n)
        at += self.lane
        sums = self.sums.reshape(-1)
        for half in self.halves:
            at += (sums.take(at + half * self.n) <= c) * np.int64(half * self.n)
        sym = (at // self.n).astype(np.uint16)
        start, units = self._interval(at, in2, in12)
        np.putmask(sym, in12, self.guess[1])
        np.putmask(sym, in2, self.guess[0])
        return sym, start, units

    def update(self, sym: np.ndarray) -> None:
        hit = self.guess == sym
        rate = hit * self.caps
        rate -= self.old
        rate >>= 4
        rate += self.old
        self.rate[self.at] = np.maximum(rate, LEAST, out=rate)
        # A miss halves the confidence.
        later = _LATER.take(hit * _EIGHT + self.sure)
        fresh = later == 0
        later |= self.guess
        self.table[self.slot] = later ^ (later ^ (sym | _ONE)) * fresh
        prev = sym * np.uint16(31)
        prev += self.last
        prev &= np.uint16(SLOTS - 1)
        np.add(self.base2, prev, out=self.slot[0])
        np.add(self.base1, sym, out=self.slot[1])
        self.last = sym * np.uint16(1237)
        self.t += 1


def _active(lengths: np.ndarray) -> list[int]:
    """Number of lanes that have a token at each step; lanes are ordered by falling length."""
    return np.searchsorted(-lengths, -np.arange(int(lengths.max(initial=0))), "left").tolist()


def _encode_lanes(syms: np.ndarray, lengths: np.ndarray, size: np.ndarray) -> list[bytes]:
    """Code of each lane; lanes are ordered by falling length. ``syms``: steps x lanes."""
    n = len(lengths)
    models = _Models(size, syms)
    # State: whole numbers below 2^49, exact as doubles. A word has 16 bits and a carry; at most one a token.
    all_low, all_rng, all_at = np.zeros(n), np.full(n, _FULL), np.arange(n)
    out = np.zeros((len(syms) + 4, n), np.uint32)
    flat = out.reshape(-1)
    for t, m in enumerate(_active(lengths)):
        low, rng, at, sym = all_low[:m], all_rng[:m], all_at[:m], syms[t, :m]
        models.shares(m)
        start, units = models.interval(sym)
        models.update(sym)
        rng *= 2.0 ** -16
        np.floor(rng, out=rng)
        start *= rng
        low += start
        rng *= units
        # Below 2^32: the top word goes out; else it is written over later.
        word = np.floor(low * 2.0 ** -32)
        flat[at] = word.astype(np.uint32)
        go = rng < _TOP
        word *= go * _TOP
        low -= word
        scale = go * (_UNIT - 1)
        scale += 1.0
        low *= scale
        rng *= scale
        at += go * np.int64(n)
    for k in (32, 16, 0):
        word = np.floor(all_low * 2.0 ** -k)
        flat[all_at] = word.astype(np.uint32)
        all_low -= word * 2.0 ** k
        all_at += n
    used = all_at // n
    out = out[:used.max(initial=0)]
    for word, later in zip(out[-2::-1], out[:0:-1]):
        word += later >> 16
    words = np.ascontiguousarray(out.astype("<u2").T)
    return [words[i, :k].tobytes() for i, k in enumerate(used.tolist())]


def _decode_lanes(codes: list[bytes], lengths: np.ndarray, size: np.ndarray) -> np.ndarray:
    n = len(lengths)
    lanes = np.zeros((n, max(len(c) for c in codes) // 2 + 4), np.uint16)
    for i, c in enumerate(codes):
        lanes[i, :len(c) // 2] = np.frombuffer(c, "<u2")
    words = np.ascontiguousarray(lanes.T)
    flat = words.reshape(-1)
    syms = np.zeros((int(lengths.max(initial=0)), n), np.uint16)
    models = _Models(size, syms)
    all_rng, all_at = np.full(n, _FULL), 3 * n + np.arange(n)
    all_code = words[0] * _TOP + words[1] * _UNIT + words[2]  # less the low end
    for t, m in enumerate(_active(lengths)):
        code, rng, at = all_code[:m], all_rng[:m], all_at[:m]
        models.shares(m)
        rng *= 2.0 ** -16
        np.floor(rng, out=rng)
        sym, start, units = models.symbol(np.minimum(np.floor(code / rng), _UNIT - 1))
        syms[t, :m] = sym
        models.update(sym)
        start *= rng
        code -= start
        rng *= units
        go = rng < _TOP
        scale = go * (_UNIT - 1) + 1.0
        rng *= scale
        code *= scale
        code += flat.take(at) * go
        at += go * np.int64(n)
    return syms


def _alphabet(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the different ids in rising order, each id's place among them)."""
    rising = np.sort(ids)
    names = rising[np.concatenate([np.ones(min(len(ids), 1), bool), rising[1:] != rising[:-1]])]
    if len(names) and names[-1] < 1 << 18:
        place = np.empty(int(names[-1]) + 1, np.uint16)
        place[names] = np.arange(len(names))
        return names, place.take(ids)
    return names, np.searchsorted(names, ids)


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Each block of up to BLOCK ids (below 2^32) as checksummed bytes, in the order given.

    Layout (little-endian): crc32 of the rest, number of tokens, size of the
    alphabet (4 bytes each), the alphabet in rising order as differences of 7
    bits a byte, the code.
    """
    out: list[bytes] = [b""] * len(blocks)
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    for lo in range(0, len(order), LANES):
        part = order[lo:lo + LANES]
        lengths = np.array([len(blocks[i]) for i in part])
        syms, alphabets = np.zeros((int(lengths.max(initial=0)), len(part)), np.uint16), []
        for lane, i in enumerate(part):
            ids, inverse = _alphabet(blocks[i])
            alphabets.append(ids)
            syms[:len(inverse), lane] = inverse
        codes = _encode_lanes(syms, lengths, np.array([len(a) for a in alphabets]))
        lists = _varints([np.diff(ids.astype(np.int64), prepend=0) for ids in alphabets])
        for i, ids, names, code in zip(part, alphabets, lists, codes):
            body = np.array([len(blocks[i]), len(ids)], "<u4").tobytes() + names + code
            out[i] = zlib.crc32(body).to_bytes(4, "little") + body
    return out


def decode_blocks(blobs: list[bytes]) -> list[np.ndarray]:
    """The ids of each block; a block whose checksum differs raises ValueError."""
    heads = []
    for blob in blobs:
        if zlib.crc32(blob[4:]) != int.from_bytes(blob[:4], "little"):
            raise ValueError("a block's checksum does not match its bytes")
        n, size = np.frombuffer(blob[4:12], "<u4").astype(int)
        steps, used = _read_varints(blob[12:], size)
        heads.append((n, np.cumsum(steps), blob[12 + used:]))
    out: list[np.ndarray] = [np.array([], np.uint32)] * len(blobs)
    order = sorted(range(len(blobs)), key=lambda i: -heads[i][0])
    for lo in range(0, len(order), LANES):
        part = order[lo:lo + LANES]
        lengths = np.array([heads[i][0] for i in part])
        syms = _decode_lanes([heads[i][2] for i in part], lengths, np.array([len(heads[i][1]) for i in part]))
        for lane, i in enumerate(part):
            out[i] = heads[i][1][syms[:heads[i][0], lane]].astype(np.uint32)
    return out


def _varints(lists: list[np.ndarray]) -> list[bytes]:
    """Each list in 7 bits a byte, of which all but a number's last have the eighth bit."""
    x = np.concatenate([np.array([], np.int64), *lists])
    size = 1 + (x > 0x7F) + (x > 0x3FFF) + (x > 0x1FFFFF) + (x > 0xFFFFFFF)
    first = np.cumsum(size) - size
    raw = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        has = np.flatnonzero(size > k)
        raw[first[has] + k] = (x[has] >> 7 * k & 127) | (size[has] > k + 1) * 128
    ends = np.append(first, len(raw))[np.cumsum([0, *map(len, lists)])].tolist()
    data = raw.tobytes()
    return [data[i:j] for i, j in zip(ends, ends[1:])]


def _read_varints(data: bytes, n: int) -> tuple[np.ndarray, int]:
    raw = np.frombuffer(data[:5 * n], np.uint8)
    ends = np.nonzero(raw < 128)[0][:n]
    used = int(ends[-1]) + 1 if n else 0
    owner = np.searchsorted(ends, np.arange(used))
    place = np.arange(used) - np.concatenate([[0], ends[:-1] + 1])[owner] if n else np.array([], int)
    return np.bincount(owner, (raw[:used] & 127).astype(np.int64) << 7 * place, n).astype(np.int64), used
