"""Adaptive context-mixing range coder for token ids, many blocks at a time.

A block of at most ``BLOCK`` ids is coded on its own: its models start afresh and its header holds a checksum. The
ids of a block are numbered by value (the header lists them). For each number three predictions are mixed: order 0,
frequencies of what the block held so far, brought up to date at ``RENEW``; order 1, the number that last followed
the previous one; order 2, the number that last followed the previous two. The weights of orders 1 and 2 are their
own success rates so far, by how often the prediction held lately and whether both orders agree. The mixed
frequencies drive a range coder with 52 bits of state that moves 24-bit words; its numbers are exact as doubles.

Blocks are independent, so numpy codes one id of up to ``LANES`` blocks in each step; the longest blocks come
first and drop out from the end. Both orders lie in one array and are looked up and updated by the same calls. The
encoder knows all numbers, so it does for ``STRIDE`` steps at once what does not depend on the step before.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 4096
LANES = 1920
STRIDE = 16                               # divides all of RENEW
RENEW = (0, 64, 256, 1024, 2048)
_HEAD = "<IIIII"      # ids, distinct ids, bytes of the id list and of the code, crc32 of the ids
_ZERO, _WEIGHT = 13, 8                    # bits of order-0 frequencies and of mixing weights
_BITS, _STATE, _WORD = _ZERO + _WEIGHT, 52, 24
_REST = _STATE - _WORD                    # a span below 2 ** _REST moves a word; one is enough, as it is 2 ** (_REST - _BITS) at least
_NUMBER, _S12, _H1, _H2 = np.uint16(BLOCK - 1), np.uint16(12), np.uint16(2477), np.uint16(31)
_LANE = BLOCK + 32                        # a lane's place in the tables: not a power of two, so lanes do not share a few lines of the cache
_TRUST = np.array([[8], [2]], np.uint16)
_HIT, _RATE = np.int16(32767), np.int16(5)


def _flips() -> np.ndarray:
    """What changes in a prediction (number, and at bit 12 how far it is trusted, 0..3), by its exclusive or with the number that came.

    One that held is trusted more, one that failed less; one that fails untrusted is replaced.
    """
    differs = np.arange(4 * BLOCK, dtype=np.uint16)
    trust = differs >> _S12
    held = differs & _NUMBER == 0
    turned = (trust ^ np.where(held, np.minimum(trust + 1, 3), np.maximum(trust, 1) - 1)) << _S12
    return np.where(~held & (trust == 0), differs, turned).astype(np.uint16)


_FLIPS = _flips()


class _Models:
    """What all lanes of a group have learnt."""

    def __init__(self, distinct: np.ndarray, decoding: bool):
        self.lanes, self.wide = len(distinct), int(distinct.max()) + 1
        self.distinct, self.until = distinct.astype(np.int32), 0
        self.seen = (np.arange(self.wide - 1) < distinct[:, None]).astype(np.uint16)
        self.below = np.zeros((self.lanes, self.wide), np.uint16)
        self.flat = self.below.reshape(-1)
        self.table = np.zeros(2 * self.lanes * _LANE, np.uint16)                 # predictions of order 1, then of order 2
        self.luck = np.full(2 * self.lanes * 32, 1 << 11, np.int16)              # success rates of order 1, then of order 2
        self.holder = np.zeros((self.lanes, (1 << _ZERO) + 32), np.uint16) if decoding else None
        both = np.arange(2 * self.lanes).reshape(2, -1)
        self.row, self.place, self.slot, self.chance = both[0] * self.wide, both[0] * ((1 << _ZERO) + 32), both * _LANE, both * 32

    def renew(self, m: int, steps: np.ndarray, t: int) -> None:
        """Order-0 frequencies from the numbers before step t; every listed number keeps at least one part."""
        wide = self.wide - 1
        for lo in range(0, m, 64):                       # a few lanes at a time: these tables are of 64-bit numbers
            hi = min(m, lo + 64)
            k, distinct = hi - lo, self.distinct[lo:hi, None]
            if t > self.until:
                part = steps[self.until:t, lo:hi] + np.arange(k) * wide
                self.seen[lo:hi] += np.bincount(part.reshape(-1), minlength=k * wide).reshape(k, wide).astype(np.uint16)
            counts = np.cumsum(self.seen[lo:hi], axis=1, dtype=np.float64)
            whole = counts[:, -1:].copy()
            counts *= (1 << _ZERO) - distinct
            counts /= whole
            counts = counts.astype(np.int32)
            counts += np.minimum(np.arange(1, self.wide, dtype=np.int32), distinct)
            self.below[lo:hi, 1:] = counts
            if self.holder is not None:
                parts = np.diff(counts, axis=1, prepend=0).reshape(-1)
                self.holder[lo:hi, :1 << _ZERO] = np.repeat(np.tile(np.arange(wide, dtype=np.uint16), k), parts).reshape(k, -1)
        self.until = t

    def prepared(self, steps: np.ndarray, t: int, n: int, m: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and width, of 2 ** _BITS, of the numbers of steps t to t + n in the first m lanes. ``steps`` begins with two of zeros."""
        before, last, own = (steps[t + i:t + i + n, :m] for i in range(3))
        at = np.empty((n, 2, m), np.int64)
        at[:, 0], at[:, 1] = last, before * _H1 + last * _H2 & _NUMBER
        at += self.slot[:, :m]
        at, both = at.reshape(n, -1), np.concatenate([own, own], axis=1)
        found, table = np.empty((n, 2 * m), np.uint16), self.table
        for i in range(n):
            old = table.take(at[i], out=found[i], mode="clip")
            table[at[i]] = old ^ _FLIPS.take(old ^ both[i])
        found = found.reshape(n, 2, m)
        guess = found & _NUMBER
        hit, trust = guess == own[:, None], (found >> _S12) * _TRUST
        sure = trust[:, 0] + trust[:, 1] + (guess[:, 0] == guess[:, 1])
        at = (self.chance[:, :m] + sure[:, None]).reshape(n, -1)
        aim, rates, luck = (hit * _HIT).reshape(n, -1), np.empty((n, 2 * m), np.int16), self.luck
        for i in range(n):
            old = luck.take(at[i], out=rates[i], mode="clip")
            new = aim[i] - old
            new >>= _RATE
            new += old
            luck[at[i]] = new
        rates = rates.reshape(n, 2, m).astype(np.int32)
        weights = np.empty((n, 2, m), np.int32)
        np.right_shift(rates[:, 1] * 248, 15, out=weights[:, 1])
        np.right_shift(rates[:, 0] * (252 - weights[:, 1]), 15, out=weights[:, 0])
        zero = 256 - weights[:, 0] - weights[:, 1]
        weights <<= _ZERO
        place = self.row[:m] + own
        lo = self.flat.take(place).astype(np.int32)
        place += 1
        size = self.flat.take(place) - lo
        lo *= zero
        size *= zero
        for order in range(2):
            lo += weights[:, order] * (guess[:, order] < own)
            size += weights[:, order] * hit[:, order]
        return lo.astype(np.uint64), size.astype(np.uint64)


def _active(lengths: np.ndarray) -> list[int]:
    """Lanes that have a number at each step."""
    return np.searchsorted(-lengths, -np.arange(lengths[0]), side="left").tolist()


def _encode_group(numbers: list[np.ndarray], distinct: np.ndarray) -> list[bytes]:
    """Code words of blocks of numbers, longest first."""
    lanes, lengths = len(numbers), np.array([len(x) for x in numbers])
    longest, active = int(lengths[0]), _active(lengths)
    steps = np.zeros((longest + 2, lanes), np.uint16)
    for i, x in enumerate(numbers):
        steps[2:len(x) + 2, i] = x
    models = _Models(distinct, decoding=False)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, (1 << _STATE) - 1, np.uint64)
    width = longest * 9 // 10 + 8
    out, first = np.zeros(lanes * width, np.uint32), np.arange(lanes) * width       # a word may hold one bit more, which is carried at the end
    pos = first.copy()
    bits, rest, word, least, mask = (np.uint64(x) for x in (_BITS, _REST, _WORD, 1 << _REST, (1 << _REST) - 1))
    for start in range(0, longest, STRIDE):
        if start in RENEW:
            models.renew(active[start], steps[2:], start)
        los, sizes = models.prepared(steps, start, min(STRIDE, longest - start), active[start])
        for m, lo, size in zip(active[start:start + STRIDE], los, sizes, strict=True):
            unit = span[:m] >> bits
            low[:m] += unit * lo[:m]
            unit *= size[:m]
            span[:m] = unit
            short = (unit < least).nonzero()[0]
            now, at = low.take(short), pos.take(short)
            out[at] = now >> rest
            at += 1
            pos[short] = at
            now &= mask
            now <<= word
            low[short] = now
            span[short] = unit.take(short) << word
    out[pos] = (low + mask) >> rest                      # the rest of the code may be zeros
    over = np.flatnonzero(out >> _WORD)
    while len(over):
        out[over] &= (1 << _WORD) - 1
        over -= 1
        out[over] += 1
        over = over[out[over] >> _WORD > 0]
    code = out.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4)
    return [code[a:b + 1, :_WORD // 8].tobytes() for a, b in zip(first.tolist(), pos.tolist(), strict=True)]


def _decode_group(codes: list[bytes], lengths: np.ndarray, distinct: np.ndarray) -> list[np.ndarray]:
    lanes, longest, active = len(codes), int(lengths[0]), _active(lengths)
    width = max(map(len, codes)) * 8 // _WORD + 4
    loaded = np.zeros((lanes, width, 4), np.uint8)
    for i, c in enumerate(codes):
        loaded[i, :len(c) * 8 // _WORD, :_WORD // 8] = np.frombuffer(c, np.uint8).reshape(-1, _WORD // 8)
    words = loaded.view("<u4").reshape(-1).astype(np.uint32, copy=False)
    pos = np.arange(lanes) * width
    extra = _STATE - 2 * _WORD                           # the state begins with two words and so many bits of the third
    gap = words[pos] * float(1 << _REST) + words[pos + 1] * float(1 << extra) + (words[pos + 2] >> _WORD - extra)
    words[:-1] = (words[:-1] << extra | words[1:] >> _WORD - extra) & (1 << _WORD) - 1
    pos += 2
    span = np.full(lanes, (1 << _STATE) - 1, np.float64)
    models, steps = _Models(distinct, decoding=True), np.zeros((longest, lanes), np.uint16)
    table, luck, flat, holder, m = models.table, models.luck, models.flat, models.holder.reshape(-1), 0
    scale, shift, least = 1 / (1 << _BITS), float(1 << _WORD), float(1 << _REST)
    number, hashed = np.zeros(lanes, np.uint16), np.zeros(lanes, np.uint16)
    for start in range(0, longest, STRIDE):
        if start in RENEW:
            models.renew(active[start], steps, start)
        if m != active[start]:                           # lanes that end before the next stride run on unread
            m = active[start]
            gap, span, pos, number, hashed = (x[:m].copy() for x in (gap, span, pos, number, hashed))
            slot, chance, row, place = models.slot[:, :m].copy(), models.chance[:, :m].copy(), models.row[:m], models.place[:m]
            after, at, weights, less = np.stack([row, row]) + 1, np.empty((2, m), np.int64), np.empty((2, m)), np.empty((2, m), bool)
            ends = np.empty((2, m), np.int64)
        for t in range(start, min(start + STRIDE, longest)):
            context = number * _H2
            context += hashed
            context &= _NUMBER
            hashed = number * _H1
            np.add(slot[0], number, out=at[0])
            np.add(slot[1], context, out=at[1])
            old = table.take(at)
            guess = old & _NUMBER
            trust = old >> _S12
            trust *= _TRUST
            sure = trust[0]
            sure += trust[1]
            sure += guess[0] == guess[1]
            chances = chance + sure
            rates = luck.take(chances)
            one, two = rates * (1 / (1 << 15))
            two *= 248
            two = np.floor(two, out=weights[1])
            one *= 252 - two
            one = np.floor(one, out=weights[0])
            zero = 256 - one
            zero -= two
            weights *= 1 << _ZERO
            unit = span * scale
            np.floor(unit, out=unit)
            aim = gap / unit
            np.floor(aim, out=aim)
            # the two predictions' own parts are taken out, order 0 is left
            past = flat.take(after + guess) * zero
            np.subtract(aim + 1, past, out=past)
            np.less_equal(guess[0], guess[1], out=less[1])
            np.logical_not(less[1], out=less[0])
            past -= weights[::-1] * less
            np.maximum(past, 0, out=past)
            np.minimum(past, weights, out=past)
            aim -= past[0]
            aim -= past[1]
            aim /= zero
            aim += place
            number = holder.take(aim.astype(np.int64), mode="clip")
            np.add(row, number, out=ends[0])
            np.add(ends[0], 1, out=ends[1])
            lo, size = flat.take(ends) * zero
            size -= lo
            hit = guess == number
            np.less(guess, number, out=less)
            np.multiply(weights, less, out=past)
            lo += past[0]
            lo += past[1]
            weights *= hit
            size += weights[0]
            size += weights[1]
            lo *= unit
            gap -= lo
            size *= unit
            span = size
            short = (span < least).nonzero()[0]
            if len(short):
                now = pos.take(short)
                left = gap.take(short)
                left *= shift
                left += words.take(now, mode="clip")     # damaged code may run on
                gap[short] = left
                now += 1
                pos[short] = now
                span[short] = span.take(short) * shift
            steps[t, :m] = number
            table[at] = old ^ _FLIPS.take(old ^ number)
            aims = hit * _HIT
            aims -= rates
            aims >>= _RATE
            aims += rates
            luck[chances] = aims
    return [steps[:n, i] for i, n in enumerate(lengths)]


def _numbered(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct ids of a block, and the number of each of its ids among them."""
    most = int(ids.max())
    if most >= 1 << 18:
        own, numbers = np.unique(ids, return_inverse=True)
        return own, numbers.astype(np.uint16)
    at, there = ids.astype(np.int64), np.zeros(most + 1, bool)
    there[at] = True
    own, number = there.nonzero()[0], np.empty(most + 1, np.uint16)
    number[own] = np.arange(len(own), dtype=np.uint16)
    return own, number.take(at)


def _listed(own: np.ndarray) -> bytes:
    """Ascending ids as differences of seven bits a byte."""
    d = np.diff(own.astype(np.int64), prepend=0)
    used = 1 + sum((d >= 1 << bits).view(np.uint8) for bits in (7, 14, 21, 28))
    first = np.cumsum(used, dtype=np.int64) - used
    out = np.empty(int(first[-1]) + int(used[-1]), np.uint8)
    while len(d):
        more = d >= 128
        out[first] = (d & 127) | more.view(np.uint8) << 7
        d, first = d[more] >> 7, first[more] + 1
    return out.tobytes()


def _unlisted(body: bytes) -> np.ndarray:
    b = np.frombuffer(body, np.uint8).astype(np.int64)
    ends = np.flatnonzero(b < 128)
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)
    place = np.arange(len(b)) - np.repeat(starts, ends - starts + 1)
    return np.cumsum(np.add.reduceat((b & 127) << (7 * place), starts)) if len(b) else np.zeros(0, np.int64)


def encode(frames: list[np.ndarray]) -> list[bytes]:
    """A body for each array of uint32 ids: its blocks one after another."""
    blocks = [(f, ids[at:at + BLOCK]) for f, ids in enumerate(frames) for at in range(0, len(ids), BLOCK)]
    blocks.sort(key=lambda x: -len(x[1]))
    bodies: dict[int, list[bytes]] = {f: [] for f in range(len(frames))}
    for at in range(0, len(blocks), LANES):
        group = blocks[at:at + LANES]
        distinct = [_numbered(ids) for _, ids in group]
        for (f, ids), (own, _), code in zip(group, distinct, _encode_group([x for _, x in distinct], np.array([len(own) for own, _ in distinct])), strict=True):
            names = _listed(own)
            bodies[f].append(struct.pack(_HEAD, len(ids), len(own), len(names), len(code), zlib.crc32(ids.astype("<u4").tobytes())) + names + code)
    return [b"".join(bodies[f]) for f in range(len(frames))]


def decode(bodies: list[bytes]) -> list[np.ndarray]:
    """The ids of each body; a block that fails its checksum raises."""
    blocks = []
    for f, body in enumerate(bodies):
        at = 0
        while at < len(body):
            n, _, names, size, crc = struct.unpack_from(_HEAD, body, at)
            at += struct.calcsize(_HEAD)
            blocks.append((f, len(blocks), n, _unlisted(body[at:at + names]), body[at + names:at + names + size], crc))
            at += names + size
    blocks.sort(key=lambda x: -x[2])
    out: dict[int, list] = {f: [] for f in range(len(bodies))}
    for at in range(0, len(blocks), LANES):
        group = blocks[at:at + LANES]
        with np.errstate(all="ignore"):                  # damaged code may lead anywhere; its checksum tells
            found = _decode_group([b[4] for b in group], np.array([b[2] for b in group]), np.array([len(b[3]) for b in group]))
        for (f, order, _, own, _, crc), x in zip(group, found, strict=True):
            if len(x) and x.max() >= len(own):
                raise ValueError("block fails its checksum")
            ids = own[x].astype("<u4")
            if zlib.crc32(ids.tobytes()) != crc:
                raise ValueError("block fails its checksum")
            out[f].append((order, ids))
    return [np.concatenate([x for _, x in sorted(out[f], key=lambda y: y[0])]) if out[f] else np.zeros(0, "<u4") for f in range(len(bodies))]
