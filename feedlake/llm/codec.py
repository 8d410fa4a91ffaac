"""Adaptive context-mixing range coder for blocks of token ids.

A block holds at most BLOCK ids and is independent of all others: its model starts anew, and it
carries its own dictionary and checksums. The dictionary lists the ids that the block has twice or
more, from the most frequent on, then those it has once, in their order; an id's place in it is its
number. Three orders predict the next number:

* order 2: the number that followed the last two, with a confidence;
* order 1: the number that followed the last one, with a confidence;
* order 0: how often each size class of numbers came up so far (classes double in size; the last class is
  the next number that comes once).

"Is it order 2's?" and "is it order 1's?" are binary decisions. Each probability mixes two
adaptive estimates (by the own confidence, and by both confidences together) with a weight that
moves to the estimate that did better. What neither predicts is coded by order 0: the adaptive class
of the number, then its place in the class. One 64-bit range coder takes all, writing 16-bit words;
both decisions are one step of it.

The coder's steps depend on each other inside a block, never between blocks; so many blocks run side
by side, one array element each ("lanes"), and a step is a few array operations over all lanes. The
two decisions' arrays are two rows of one. Values a lane does not need are multiplied by 0: choosing
by np.where, or taking some of the lanes out and putting them back, costs several times as much.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 2048
LANES = 4096
MAGIC = b"CMR2"
#: What an occurrence adds to the count of its class of numbers, and the count that a class begins with.
INC, BEGIN, CLASSES = 12, 2, 12
U = np.uint64
_SLOTS = 4096
#: The coder writes 16 bits at a time; an id takes 14 bits for the decisions, 14 for the class and 12 for the place at most.
_ONE, _OUT, _W, _SPLIT, _LEAST = U(1), U(16), U(48), U(1 << 48), U(1 << 44)
#: Bits of the decisions' probabilities, and of the shares of a place in a class.
_P, _S = 15, 14
#: Constants of the tables' own types, which array operations take faster than Python's numbers.
_0, _1, _2, _3, _4H = (np.int16(i) for i in range(5))
_4, _8, _SURE, _W_MIN, _W_MAX = (np.int32(i) for i in (4, 8, 65535, 16, 240))
_P_ONE, _P_MIN, _P_MAX, _TO_P, _TO_ONE = (np.int32(i) for i in (1 << _P, 1 << (_P - 7), (1 << _P) - (1 << (_P - 7)), 24 - _P, _P))
#: By number: its class, if it comes more than once. By class: its first number.
_CLASS = np.array([(i + 1).bit_length() - 1 for i in range(BLOCK)], np.int64)
_FIRST = np.array([(1 << i) - 1 for i in range(CLASSES - 1)], np.int64)
_ABOVE = np.arange(1, CLASSES + 1, dtype=np.int8)[:, None]


class _Lanes:
    """The state of n blocks side by side, the longest first; the numbers below `often` come more than once."""

    def __init__(self, lengths: np.ndarray, often: np.ndarray):
        n = len(lengths)
        self.n, self.lengths = n, lengths
        self.low, self.rng = np.zeros(n, U), np.full(n, ~U(0), U)
        #: Tables are flat, entry by entry: entry i of a lane is at i * n + lane, so lanes that look at one entry share cache lines.
        self.lane = np.arange(n, dtype=np.int64)
        self.after = np.zeros(n * (_SLOTS + BLOCK), np.int16)  # number * 4 + confidence: order 2's entries, then order 1's
        self.estimates = np.full(n * 2 * (4 + 16), 1 << 15, np.int32)  # by own confidence: order 2's, order 1's; by both: order 2's, order 1's
        self.weight = np.full((2, n), 128, np.int32)
        self.under = np.repeat(np.arange(CLASSES + 1, dtype=np.int16) * BEGIN, n).reshape(CLASSES + 1, n)  # counts of all lower classes
        places = np.ones((CLASSES, n), np.int64)
        places[:-1] = np.clip(often - _FIRST[:, None], 1, _FIRST[:, None] + 1)
        self.share = ((1 << _S) // places).astype(np.uint16).reshape(-1)
        self.often = often.astype(np.int16)
        self.first = np.repeat(np.append(_FIRST, 0).astype(np.int16), n).reshape(CLASSES, n)
        self.first[-1] = often  # the next number that comes once

    def run(self, coder, numbers: np.ndarray | None) -> np.ndarray:
        """Code `numbers` (a row for each lane), or decode them."""
        n, steps = self.n, int(self.lengths[0]) if self.n else 0
        out = np.zeros((steps, n), np.int16) if numbers is None else None
        columns = None if numbers is None else _turned(numbers)
        active = np.searchsorted(-self.lengths, -np.arange(steps), side="left")  # lanes longer than t
        prev1 = prev2 = np.zeros(n, np.int64)
        tables = np.array([[0, 4 * n], [8 * n, 0]])
        for t in range(steps):
            k = int(active[t])
            coder.settle(self, k)
            p1, p2, lane = prev1[:k], prev2[:k], self.lane[:k]
            at = np.empty((2, k), np.int64)
            at[0] = (p2 * 40503 + p1 * 30011) & (_SLOTS - 1)
            at[1] = p1 + _SLOTS
            at *= n
            at += lane
            e = self.after.take(at)
            c, g = e & _3, e >> _2
            known = c > _0
            asked = known.copy()
            asked[1] &= ~known[0] | (g[0] != g[1])
            at_estimates = np.empty((2, 2, k), np.int64)
            np.multiply(c, n, out=at_estimates[0], dtype=np.int64)
            np.add(at_estimates[0, 0] * 4, at_estimates[0, 1], out=at_estimates[1, 0])
            at_estimates += tables[:, :, None]
            at_estimates[1, 1] = at_estimates[1, 0] + 16 * n
            at_estimates += lane
            estimates, w = self.estimates.take(at_estimates), self.weight[:, :k]
            a, b = estimates
            p = (a - b) * w
            p += b << _8
            p >>= _TO_P
            np.maximum(p, _P_MIN, out=p)
            np.minimum(p, _P_MAX, out=p)
            p *= asked
            p[1] *= _P_ONE - p[0]
            p[1] >>= _TO_ONE
            x, hit = coder.number(self, k, t, p.astype(U), g, None if columns is None else columns[t, :k], asked)
            asked[1] &= ~hit[0]
            change = hit * _SURE - estimates
            change >>= _4
            change *= asked
            change += estimates
            self.estimates[at_estimates] = change
            step = ((a > b) == hit) * _4
            step -= _2
            step *= asked
            step += w
            np.maximum(step, _W_MIN, out=step)
            np.minimum(step, _W_MAX, out=self.weight[:, :k])
            fresh = x * _4H + _1
            new = e - _1
            new -= fresh
            new *= c > _1
            new += fresh
            known &= g == x
            e += c < _3
            e -= new
            e *= known
            new += e
            self.after[at] = new
            prev2, prev1 = p1, x.astype(np.int64)
            if out is not None:
                out[t, :k] = x
        return out

    def group(self, x: np.ndarray) -> np.ndarray:
        """The classes of the numbers x of the first lanes, counted."""
        k = len(x)
        once = x >= self.often[:k]
        group = np.maximum(_CLASS.take(x), once * (CLASSES - 1))
        self.first[-1, :k] += once
        self.under[1:, :k] += np.multiply(_ABOVE > group.astype(np.int8), np.int16(INC), dtype=np.int16)
        return group


class _Writer:
    def __init__(self, n: int):
        self.words, self.ends = np.empty((BLOCK // 2, n), np.uint16), np.zeros(n, np.int64)  # a lane's words are a column
        self.calls = 0

    def settle(self, m: _Lanes, k: int) -> None:
        """Write the words that are certain until each range is wide enough for a whole id."""
        s = np.flatnonzero(m.rng[:k] < _LEAST)
        while len(s):
            low, rng = m.low.take(s), m.rng.take(s)
            _cut(low, rng)
            self.out(s, low)
            m.low[s] = low << _OUT
            rng <<= _OUT
            m.rng[s] = rng
            s = s[rng < _LEAST]

    def out(self, s: np.ndarray, low: np.ndarray) -> None:
        at = self.ends.take(s)
        self.ends[s] = at + 1
        self.calls += 1  # no lane has more words
        if self.calls > len(self.words) and at.max() >= len(self.words):
            self.words = np.concatenate([self.words, np.empty_like(self.words)])
        self.words.reshape(-1)[at * len(self.ends) + s] = (low >> _W).astype(np.uint16)

    def number(self, m: _Lanes, k: int, t: int, p, g, x, asked) -> tuple[np.ndarray, np.ndarray]:
        """Code the number x of each of the first k lanes; x, and whether it is order 2's and order 1's."""
        hit = (g == x) & asked
        hit[1] &= ~hit[0]
        literal = ~(hit[0] | hit[1])
        low, rng = m.low[:k], m.rng[:k]
        cut = p * (rng >> U(_P))
        end = cut[0] + cut[1]
        total = _total(t)
        group = m.group(x)
        at = group * m.n + m.lane[:k]
        q = (rng - end) // U(total)
        f = m.under.reshape(-1).take(at + m.n) - m.under.reshape(-1).take(at) - INC  # less this one's own
        one = ((q * f.astype(U)) >> U(_S)) * m.share.take(at).astype(U)
        place = (x - m.first.reshape(-1).take(at)) * (group < CLASSES - 1)
        low += cut[0] * hit[1] + (end + q * m.under.reshape(-1).take(at).astype(U) + one * place.astype(U)) * literal
        cut *= hit
        np.add(cut[0], cut[1], out=rng)
        rng += one * literal
        return x, hit

    def finish(self, m: _Lanes) -> list[bytes]:
        every = np.arange(m.n)
        for k in range(4):
            self.out(every, m.low << U(16 * k))
        words = _turned(self.words[: self.ends.max(initial=0)]).astype("<u2")
        return [w[:e].tobytes() for w, e in zip(words, self.ends.tolist())]


class _Reader:
    def __init__(self, coded: list[bytes]):
        words = [np.frombuffer(c, "<u2") for c in coded]
        self.words = np.concatenate([*words, np.zeros(4, np.uint16)])
        start = np.cumsum([0, *(len(w) for w in words)])[:-1]
        self.next = start + 4
        self.code = np.zeros(len(words), U)
        for k in range(4):
            self.code = self.code << _OUT | self.words.take(start + k, mode="clip")

    def settle(self, m: _Lanes, k: int) -> None:
        """Read where the writer wrote."""
        s = np.flatnonzero(m.rng[:k] < _LEAST)
        while len(s):
            low, rng = m.low.take(s), m.rng.take(s)
            _cut(low, rng)
            at = self.next.take(s)
            self.code[s] = self.code.take(s) << _OUT | self.words.take(at, mode="clip")
            self.next[s] = at + 1
            m.low[s] = low << _OUT
            rng <<= _OUT
            m.rng[s] = rng
            s = s[rng < _LEAST]

    def number(self, m: _Lanes, k: int, t: int, p, g, x, asked) -> tuple[np.ndarray, np.ndarray]:
        """As the writer's, but x is read."""
        low, rng = m.low[:k], m.rng[:k]
        cut = p * (rng >> U(_P))
        end = cut[0] + cut[1]
        ahead = self.code[:k] - low
        hit = np.empty((2, k), bool)
        np.less(ahead, cut[0], out=hit[0])
        literal = ahead >= end
        hit[1] = ~(hit[0] | literal)
        total = _total(t)
        q = (rng - end) // U(total)
        ahead -= end * literal
        v = np.minimum(ahead // q, U(total - 1)).astype(np.int16)
        group = np.add.reduce((m.under[1:CLASSES, :k] <= v).view(np.int8), axis=0, dtype=np.int8).astype(np.int64)
        at = group * m.n + m.lane[:k]
        under = m.under.reshape(-1).take(at)
        first = q * under.astype(U)
        one = ((q * (m.under.reshape(-1).take(at + m.n) - under).astype(U)) >> U(_S)) * m.share.take(at).astype(U)
        ahead -= first
        place = np.minimum(ahead // one, U(BLOCK))
        x = np.minimum(m.first.reshape(-1).take(at) + place.astype(np.int16), BLOCK - 1)
        x *= literal
        x += g[0] * hit[0] + g[1] * hit[1]
        low += cut[0] * hit[1] + (end + first + one * place) * literal
        cut *= hit
        np.add(cut[0], cut[1], out=rng)
        rng += one * literal
        m.group(x)
        return x, hit


def _turned(table: np.ndarray) -> np.ndarray:
    """The transposed table, copied in squares that stay in the cache."""
    out = np.empty(table.shape[::-1], table.dtype)
    for a in range(0, table.shape[0], 64):
        for b in range(0, table.shape[1], 512):
            out[b : b + 512, a : a + 64] = table[a : a + 64, b : b + 512].T
    return out


def _total(t: int) -> int:
    """The sum of the classes' counts after t numbers."""
    return CLASSES * BEGIN + INC * t


def _cut(low: np.ndarray, rng: np.ndarray) -> None:
    """Cut ranges that reach over the edge of their first word there."""
    over = np.flatnonzero((low ^ (low + rng - _ONE)) >> _W)
    if len(over):
        rng[over] = _SPLIT - (low[over] & (_SPLIT - _ONE))


def _numbered(ids: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    """The dictionary of a block, how many of it come more than once, and the ids' numbers."""
    values = np.sort(ids)
    edge = np.empty(len(ids) + 1, bool)
    edge[:1] = edge[-1:] = True
    np.not_equal(values[1:], values[:-1], out=edge[1:-1])
    starts = np.flatnonzero(edge)
    counts, values = starts[1:] - starts[:-1], values[starts[:-1]]
    order = np.argsort(-counts.astype(np.int16), kind="stable")
    often = int(np.count_nonzero(counts > 1))
    number = np.empty(len(values), np.int16)
    number[order] = np.arange(len(values), dtype=np.int16)
    if len(values) and values[-1] < len(_PLACES):
        _PLACES[values] = number
        numbers = _PLACES.take(ids)
    else:
        numbers = number[np.searchsorted(values, ids)]
    once = np.flatnonzero(numbers >= often)
    numbers[once] = np.arange(often, len(values), dtype=np.int16)
    return np.concatenate([values[order[:often]], ids[once]]), often, numbers


#: Scratch space of _numbered: numbers by id.
_PLACES = np.zeros(1 << 16, np.int16)


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Each block of at most BLOCK ids (unsigned 32-bit) as bytes of its own."""
    out: list[bytes] = []
    for k in range(0, len(blocks), LANES):
        out += _encode(blocks[k : k + LANES])
    return out


def _encode(blocks: list[np.ndarray]) -> list[bytes]:
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    lengths = np.array([len(blocks[i]) for i in order], np.int64)
    numbers = np.zeros((len(order), int(lengths[0]) if len(order) else 0), np.int16)
    heads, often = [], []
    for row, i in enumerate(order):
        ids = np.asarray(blocks[i], "<u4")
        if len(ids) > BLOCK:
            raise ValueError(f"a block holds at most {BLOCK} ids")
        names, n, numbers[row, : len(ids)] = _numbered(ids)
        wide = len(names) and int(names.max()) > 0xFFFF
        often.append(n)
        heads.append(np.array([len(ids), len(names) | n << 12 | (0x80000000 if wide else 0), zlib.crc32(ids.tobytes())], "<u4").tobytes() + names.astype("<u4" if wide else "<u2").tobytes())
    lanes, writer = _Lanes(lengths, np.array(often, np.int64)), _Writer(len(order))
    lanes.run(writer, numbers)
    bodies: list[bytes] = [b""] * len(blocks)
    for i, head, coded in zip(order, heads, writer.finish(lanes) if len(order) else []):
        body = head + coded
        bodies[i] = MAGIC + np.array([zlib.crc32(body)], "<u4").tobytes() + body
    return bodies


def decode_blocks(bodies: list[bytes]) -> list[np.ndarray]:
    """The ids of each block. Raises ValueError where a checksum fails."""
    out: list[np.ndarray] = []
    for k in range(0, len(bodies), LANES):
        out += _decode(bodies[k : k + LANES])
    return out


def _decode(bodies: list[bytes]) -> list[np.ndarray]:
    heads = []
    for b in bodies:
        if b[:4] != MAGIC or len(b) < 20 or zlib.crc32(b[8:]) != int.from_bytes(b[4:8], "little"):
            raise ValueError("a block of token ids is damaged")
        n, names, crc = (int(x) for x in np.frombuffer(b, "<u4", 3, 8))
        wide, often, names = names >> 31, names >> 12 & 0xFFF, names & 0xFFF
        heads.append((n, np.frombuffer(b, "<u4" if wide else "<u2", names, 20).astype(np.uint32), crc, b[20 + names * (4 if wide else 2) :], often))
    order = sorted(range(len(bodies)), key=lambda i: -heads[i][0])
    lanes = _Lanes(np.array([heads[i][0] for i in order], np.int64), np.array([heads[i][4] for i in order], np.int64))
    numbers = lanes.run(_Reader([heads[i][3] for i in order]), None)
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(bodies)
    rows = _turned(numbers) if lanes.n else None
    for row, i in enumerate(order):
        n, names, crc, _, _ = heads[i]
        got = rows[row, :n]
        if n and (got.max() >= len(names) or got.min() < 0):
            raise ValueError("a block of token ids is damaged")
        ids = names[got] if n else np.zeros(0, np.uint32)
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise ValueError("a block of token ids is damaged")
        out[i] = ids
    return out
