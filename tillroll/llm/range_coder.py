"""Adaptive context-mixing range coder for token ids below 2**16.

Ids are coded in blocks that start from a fresh model, so each can be decoded
alone with the chunk's table of order 0, which stands behind the blocks.  A
model has three parts: the id that last followed the two preceding ids (order
2), the id that last followed the preceding one (order 1; both in hashed slots
that know their context by a tag, so another context's id is no prediction),
and the chunk's ids by their frequencies (order 0).  Each prediction of the
first two carries a confidence, how often it came true in a row; for each
confidence a block learns how likely such a prediction is right, and by these
odds the three are mixed into one interval: order 2's id, order 1's id where it
is another, else order 0, whose id follows in an interval of its own.

The arithmetic coder keeps 48 bits of low and range and puts out 16 bits at a
time; carries are kept in the words' upper halves and added at the end.  All
blocks of a chunk are worked in step, one id of each per step, so every
operation is an array operation over the blocks.  The operations of a step write
into arrays made once, and their constants are arrays too: with a thousand
blocks, making either costs as much as the operation.
"""
from __future__ import annotations

import zlib

import numpy as np

BLOCK = 1 << 13       # most ids a block
SHORTEST = 1 << 11    # least ids a block: fewer teach a model too little
LANES = 1 << 12       # blocks a chunk aims at: with few, calls cost more than their work
CHUNK = 1 << 23       # ids a chunk aims at
SLOTS = 10            # bits of a context's slot
SCALE = 15            # bits of the mixing weights
MOST = (1 << SCALE) - (1 << 9)  # most that orders 2 and 1 may weigh
RATE = 5              # odds move by a part of 2**RATE
GAIN = 31 << SCALE - 10         # what a prediction come true adds to its odds
# odds of a prediction of confidence 0 (none) .. 7 in a fresh block
ODDS2 = [0, 8000, 14000, 18000, 21000, 23000, 25000, 28000]
ODDS1 = [0, 3000, 5000, 7000, 9000, 11000, 13000, 17000]
TOTAL = 18            # bits of the shares of order 0
I64, U64 = np.int64, np.uint64
_C1, _C2 = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)
_LOW32 = (1 << 32) - 1
# A slot holds, from the lowest bit, 3 bits of confidence, 12 of its context's hash, 17 of id + 1; 0: empty.
_ONE, _SIX, _SEVEN, _TAG, _ID = (np.array(v, I64) for v in (1, 6, 7, 0x7FF8, 15))
_SCALE, _TOTAL, _MOST, _RATE, _GAIN = (np.array(v, I64) for v in (SCALE, TOTAL, MOST, RATE, GAIN))
# A span of order 0 holds its start above 20 bits of its width.
_ZERO, _FOUR, _WIDE, _WIDTH, _WORD, _SHORT = (np.array(v, I64) for v in (0, 4, 20, (1 << 20) - 1, 32, 1 << 32))
_TOP = np.array(64 - SLOTS, U64)


def block_size(n: int) -> int:
    """Ids a block for a chunk of n ids."""
    return min(BLOCK, max(SHORTEST, -(-n // LANES)))


class _Order:
    """The predictions of one order: id + 1 or 0 (``told``), and their odds."""

    def __init__(self, lanes: int, odds: list[int]):
        self.slots, self.odds = np.zeros(lanes << SLOTS, np.uint32), np.tile(np.array(odds, I64), lanes)

    def narrow(self, n: int) -> None:
        self.base, self.row = np.arange(n, dtype=I64) << SLOTS, np.arange(n, dtype=I64) << 3
        self.at, self.v, self.sure, self.told, self.p, self.t, self.tag = (np.empty(n, I64) for _ in range(7))
        self.v32, self.same, self.top = np.empty(n, np.uint32), np.empty(n, bool), np.empty(n, U64)

    def look(self, key: np.ndarray) -> None:
        v, t, tag = self.v, self.t, self.tag
        np.right_shift(key, _TOP, out=self.top)
        np.add(self.top.view(I64), self.base, out=self.at)
        self.slots.take(self.at, out=self.v32, mode="clip")
        v[:] = self.v32
        np.bitwise_and(key.view(I64), _TAG, out=tag)
        np.bitwise_and(v, _TAG, out=t)
        np.equal(t, tag, out=self.same)
        t[:] = self.same
        v *= t
        np.right_shift(v, _ID, out=self.told)
        np.bitwise_and(v, _SEVEN, out=self.sure)

    def weigh(self) -> np.ndarray:
        np.add(self.sure, self.row, out=self.t)
        self.odds.take(self.t, out=self.p, mode="clip")
        return self.p

    def learn(self, fresh: np.ndarray, hit: np.ndarray, right: np.ndarray) -> None:
        """``fresh``: what the slot holds after a miss, without the tag; ``hit``: the
        prediction came true; ``right``: it was asked as well, which moves its odds."""
        v, p, s = self.v, self.p, self.sure
        s[:] = right
        s *= _GAIN
        p += s
        np.right_shift(p, _RATE, out=s)
        p -= s
        self.odds[self.t] = p
        np.bitwise_and(v, _SEVEN, out=s)
        np.minimum(s, _SIX, out=self.told)
        s -= self.told
        v -= s
        v += _ONE  # one more, seven at most
        self.tag |= fresh
        np.copyto(self.tag, v, where=hit)
        self.v32[:] = self.tag
        self.slots[self.at] = self.v32


class _Model:
    def __init__(self, lanes: int):
        self.two, self.one = _Order(lanes, ODDS2), _Order(lanes, ODDS1)
        self.last, self.before = np.zeros(lanes, U64), np.zeros(lanes, U64)

    def narrow(self, n: int) -> None:
        """From now on the first n lanes go on."""
        self.two.narrow(n)
        self.one.narrow(n)
        self.last, self.before = self.last[:n].copy(), self.before[:n].copy()
        self.key, self.both = np.empty(n, U64), np.empty(n, I64)
        self.differ, self.is2, self.is1 = (np.empty(n, bool) for _ in range(3))

    def predict(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights, of 2**SCALE, of order 2 and of orders 2 and 1 together."""
        one, two = self.one, self.two
        one.look(self.last)
        np.multiply(self.before, _C2, out=self.key)
        self.key += self.last
        two.look(self.key)
        np.not_equal(one.told, two.told, out=self.differ)
        one.t[:] = self.differ
        one.sure *= one.t
        np.add(two.weigh(), one.weigh(), out=self.both)
        np.minimum(self.both, _MOST, out=self.both)
        return two.p, self.both

    def check(self, x1: np.ndarray) -> None:
        """Which predictions name the ids + 1."""
        np.equal(x1, self.two.told, out=self.is2)
        np.equal(x1, self.one.told, out=self.is1)

    def learn(self, x1: np.ndarray) -> None:
        np.left_shift(x1, _ID, out=self.both)
        self.both += _ONE
        self.differ &= self.is1
        self.two.learn(self.both, self.is2, self.is2)
        self.one.learn(self.both, self.is1, self.differ)
        self.before, self.last = self.last, self.before
        np.multiply(x1.view(U64), _C1, out=self.last)


def _layout(n: int, block: int) -> tuple[int, int]:
    """(blocks, ids of the last)."""
    blocks = -(-n // block)
    return blocks, n - (blocks - 1) * block


def shares(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct ids, the share of 2**TOTAL of each: by its frequency, at least 1)."""
    counts = np.bincount(ids, minlength=1 << 16)
    kinds = np.flatnonzero(counts)
    counts = counts[kinds]
    room = (1 << TOTAL) - len(kinds)
    want = np.maximum(counts * ((1 << TOTAL) / len(ids)) - 1, 0)
    share = 1 + np.floor(want * min(1, room / max(want.sum(), 1))).astype(I64)
    share[np.argmax(counts)] += (1 << TOTAL) - share.sum()
    return kinds, share


def _pack(kinds: np.ndarray, share: np.ndarray) -> bytes:
    gaps = np.diff(kinds, prepend=-1) - 1
    return zlib.compress(b"".join([gaps.astype("<u2").tobytes(), *((share >> i & 255).astype(np.uint8).tobytes() for i in (0, 8, 16))]), 9)


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    plain = zlib.decompress(packed)
    n = len(plain) // 5
    low, middle, high = np.frombuffer(plain, np.uint8, 3 * n, 2 * n).reshape(3, n).astype(I64)
    return np.cumsum(np.frombuffer(plain, "<u2", n).astype(I64) + 1) - 1, low | middle << 8 | high << 16


def _spans(kinds: np.ndarray, share: np.ndarray) -> np.ndarray:
    spans = np.zeros(1 << 16, I64)
    spans[kinds] = np.cumsum(share) - share << 20 | share
    return spans


def encode(ids: np.ndarray) -> tuple[bytes, int, list[int], list[int]]:
    """(payload, ids a block, 16-bit words of each block, CRC-32 of each block's ids as little-endian 32-bit).
    Behind the blocks' words the payload holds the table of order 0."""
    total = len(ids)
    if not total:
        return b"", 0, [], []
    if int(ids.max()) >> 16 or int(ids.min()) < 0:
        raise ValueError("the format holds ids from 0 to 65535")
    block = block_size(total)
    lanes, last = _layout(total, block)
    grid = np.zeros(lanes * block, np.uint16)
    grid[:total] = ids
    kinds, share = shares(grid[:total])
    spans = _spans(kinds, share)
    grid = np.ascontiguousarray(grid.reshape(lanes, block).T)
    m = _Model(lanes)
    low, size = np.zeros(lanes, I64), np.full(lanes, (1 << 48) - 1, I64)
    # an id takes two words at most; an odd number of cache lines a row keeps the rows' ends apart in the cache
    width_of_row = 2 * block + 16
    first = np.arange(lanes, dtype=I64) * width_of_row
    out, at = np.zeros(lanes * width_of_row, np.uint32), first.copy()
    done, t = [], 0
    for n, until in ((lanes, last), (lanes - 1, block)):
        if not n:
            break
        done.append((low[n:], at[n:]))
        low, size, at = low[:n].copy(), size[:n].copy(), at[:n].copy()
        m.narrow(n)
        x, x1, a, b, c, d, r = (np.empty(n, I64) for _ in range(7))
        need, word = np.empty(n, bool), np.empty(n, np.uint32)
        for row in grid[t:until, :n]:
            x[:] = row
            np.add(x, _ONE, out=x1)
            edge2, edge1 = m.predict()
            m.check(x1)
            np.right_shift(size, _SCALE, out=r)
            np.multiply(r, edge2, out=a)
            np.multiply(r, edge1, out=b)
            # order 0: start d and width size
            spans.take(x, out=c, mode="clip")
            size -= b
            np.right_shift(size, _TOTAL, out=r)
            np.right_shift(c, _WIDE, out=d)
            d *= r
            d += b
            c &= _WIDTH
            np.multiply(r, c, out=size)
            b -= a
            np.copyto(d, a, where=m.is1)
            np.copyto(size, b, where=m.is1)
            np.copyto(d, _ZERO, where=m.is2)
            np.copyto(size, a, where=m.is2)
            low += d
            # every lane writes its word, those that need it keep it
            np.less(size, _SHORT, out=need)
            a[:] = need
            np.left_shift(a, _FOUR, out=b)
            np.right_shift(low, _WORD, out=c)
            word[:] = c
            out[at] = word
            at += a
            c *= a
            c <<= _WORD
            low -= c
            low <<= b
            size <<= b
            np.less(size, _SHORT, out=need)
            again = need.nonzero()[0]
            if len(again):
                v = low[again]
                out[at[again]] = v >> 32
                at[again] += 1
                low[again] = (v & _LOW32) << 16
                size[again] <<= 16
            m.learn(x1)
        t = until
    done.append((low, at))
    low, at = (np.concatenate([d[i] for d in done[::-1]]) for i in (0, 1))
    for _ in range(3):
        out[at] = low >> 32
        at += 1
        low = (low & _LOW32) << 16
    words = np.concatenate([out[i:j] for i, j in zip(first.tolist(), at.tolist())])
    while len(carries := (words >> 16).nonzero()[0]):
        words[carries] &= 0xFFFF
        words[carries - 1] += 1
    plain = ids.astype("<i4", copy=False)
    return (words.astype("<u2").tobytes() + _pack(kinds, share), block, (at - first).tolist(),
            [zlib.crc32(plain[i:i + block].tobytes()) for i in range(0, total, block)])


def decode(payload: bytes, block: int, words: list[int], crcs: list[int], total: int) -> np.ndarray:
    """The ids of a chunk; raises where a block's checksum differs."""
    if not total:
        return np.empty(0, np.int32)
    lanes, last = _layout(total, block)
    used = np.array(words, I64)
    at, coded = np.cumsum(used) - used, int(used.sum())
    data = np.append(np.frombuffer(payload, "<u2", coded), np.zeros(1, np.uint16))
    try:
        kinds, share = _unpack(payload[2 * coded:])
    except zlib.error as e:
        raise ValueError("damaged block: the table of order 0, of all blocks") from e
    spans, symbols = _spans(kinds, share), np.repeat(kinds.astype(np.uint16), share)
    m = _Model(lanes)
    code, size = np.zeros(lanes, I64), np.full(lanes, (1 << 48) - 1, I64)
    for _ in range(3):
        code = code << 16 | data.take(at, mode="clip")
        at += 1
    grid = np.zeros((block, lanes), np.uint16)
    t = 0
    for n, until in ((lanes, last), (lanes - 1, block)):
        if not n:
            break
        code, size, at = code[:n].copy(), size[:n].copy(), at[:n].copy()
        m.narrow(n)
        x1, a, b, c, d, e, r = (np.empty(n, I64) for _ in range(7))
        told, word, quotient, divisor = np.empty(n, bool), np.empty(n, np.uint16), np.empty(n), np.empty(n)
        # a damaged block may come to anything before its checksum is taken
        with np.errstate(all="ignore"):
            for row in grid[t:until, :n]:
                edge2, edge1 = m.predict()
                np.right_shift(size, _SCALE, out=r)
                np.multiply(r, edge2, out=a)
                np.multiply(r, edge1, out=b)
                np.less(code, a, out=m.is2)
                np.less(code, b, out=told)
                # order 0; doubles divide 48 bits by 30 exactly enough: the nearest whole number is 2**-30 away
                size -= b
                np.right_shift(size, _TOTAL, out=r)
                np.subtract(code, b, out=d)
                quotient[:] = d
                divisor[:] = r
                quotient /= divisor
                c[:] = quotient
                symbols.take(c, out=word, mode="clip")
                x1[:] = word
                spans.take(x1, out=c, mode="clip")
                x1 += _ONE
                np.copyto(x1, m.one.told, where=told)
                np.copyto(x1, m.two.told, where=m.is2)
                np.right_shift(c, _WIDE, out=e)
                e *= r
                d -= e
                c &= _WIDTH
                np.multiply(r, c, out=size)
                b -= a
                np.copyto(size, b, where=told)
                np.copyto(size, a, where=m.is2)
                np.subtract(code, a, out=b)
                np.copyto(d, b, where=told)
                np.copyto(d, code, where=m.is2)
                code, d = d, code
                np.less(size, _SHORT, out=told)
                a[:] = told
                np.left_shift(a, _FOUR, out=b)
                size <<= b
                code <<= b
                data.take(at, out=word, mode="clip")
                c[:] = word
                c *= a
                code |= c
                at += a
                np.less(size, _SHORT, out=told)
                again = told.nonzero()[0]
                if len(again):
                    code[again] = code[again] << 16 | data.take(at[again], mode="clip")
                    at[again] += 1
                    size[again] <<= 16
                np.subtract(x1, _ONE, out=b)
                row[:] = b
                m.check(x1)
                m.learn(x1)
        t = until
    ids = grid.T.reshape(-1)[:total].astype(np.int32)
    plain = ids.astype("<i4", copy=False)
    found = [zlib.crc32(plain[i:i + block].tobytes()) for i in range(0, total, block)]
    if found != list(crcs):
        raise ValueError(f"damaged block: {next(i for i, (a, b) in enumerate(zip(found, crcs)) if a != b)}")
    return ids
