"""Adaptive context-mixing range coder for token ids.

Blocks are coded independently: every table starts empty and every block
carries the CRC of its ids.  Independence lets numpy run many blocks side by
side, one lane each, one id per step.

For each id three predictors speak: order 2 (the id that last followed the two
ids before), order 1 (the id that last followed the id before) and order 0 (the
ids seen in this block so far, by frequency).  Their confidence states pick an
adaptive row of mixing weights (order 2, order 1, order 0, unseen); the weights
drive one arithmetic-coding step that says which predictor is right, and ids
that neither context predicted take a second step with the order-0
frequencies, or 16 plain bits if unseen.

The coder keeps a 48-bit range and emits 16-bit digits.  Carries are added to
the digit before and propagated once at the end.
"""

from __future__ import annotations

import zlib

import numpy as np

U = np.uint64
TOP, BITS = U(1 << 32), U(16)
ORDER1, ORDER2 = 9, 11             # log2 of the slots of a lane's context tables
WEIGHT = 8                         # what one use adds to a mixing weight
U32, LOW16 = np.uint32, U(0xFFFF)
START = U(sum((j + 1) << 16 * j for j in range(4)))
GAIN = np.array([sum(WEIGHT << 16 * j for j in range(e, 4)) for e in range(4)], np.uint64)
MAX_BLOCK = (0xFFFF - 4) // WEIGHT  # the running sums stay below 2**16


def _refreshes(n: int) -> list[int]:
    """Positions at which the order-0 frequencies are counted anew."""
    out, t = [], 16
    while t < n:
        out += [t, t + t // 2]
        t *= 2
    return [t for t in out if t < n]


class _Model:
    """Predictor tables of all lanes.

    A context slot is ``id << 2 | confidence`` (0 empty, 3 highest).  A row of
    mixing weights is one 64-bit word: the running sums of the four weights, 16
    bits each.
    """

    def __init__(self, lanes: int):
        self.order1 = np.zeros(lanes << ORDER1, np.uint32)
        self.order2 = np.zeros(lanes << ORDER2, np.uint32)
        self.weights = np.full(lanes << 5, START, np.uint64)
        lane = np.arange(lanes, dtype=np.uint32)
        self.base1, self.base2 = lane << U32(ORDER1), lane << U32(ORDER2)
        self.base0 = lane << U32(5)
        self.prev1 = np.zeros(lanes, np.uint32)
        self.hash2 = np.zeros(lanes, np.uint32)

    def keep(self, lanes: int) -> None:
        """Go on with the first lanes only; the last block may be shorter."""
        for k in ("base0", "base1", "base2", "prev1", "hash2"):
            setattr(self, k, getattr(self, k)[:lanes])

    def predict(self) -> None:
        mixed = self.prev1 * U32(0x9E3779B1)
        self.at1 = self.base1 + (mixed >> U32(32 - ORDER1))
        self.at2 = self.base2 + ((mixed + self.hash2) >> U32(32 - ORDER2))
        self.hash2 = mixed * U32(0x85EBCA6B)
        self.s1, self.s2 = self.order1[self.at1], self.order2[self.at2]
        self.c1, self.c2 = self.s1 >> U32(2), self.s2 >> U32(2)
        self.f1, self.f2 = self.s1 & U32(3), self.s2 & U32(3)
        self.row = (self.base0 + (self.f2 << U32(2)) + self.f1
                    + ((self.c1 == self.c2).astype(np.uint32) << U32(4)))
        self.sums = self.weights[self.row]

    def share(self, event: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of each lane's event within the row's total."""
        shift = event.astype(np.uint64) << U(4)
        lo = ((self.sums << U(16)) >> shift) & LOW16
        return lo, ((self.sums >> shift) & LOW16) - lo

    def update(self, ids: np.ndarray, event: np.ndarray) -> None:
        self.weights[self.row] = self.sums + GAIN[event]
        fresh = (ids << U32(2)) | U32(1)
        for at, s, c, f, to in ((self.at1, self.s1, self.c1, self.f1, self.order1),
                                (self.at2, self.s2, self.c2, self.f2, self.order2)):
            other = np.where(f > 1, (s & U32(0xFFFFFFFC)) | U32(1), fresh)
            to[at] = np.where((c == ids) & (f > 0), s + (f < 3), other)
        self.prev1 = ids


def _split(n_ids: int, block: int) -> np.ndarray:
    n = max(1, -(-n_ids // block)) if n_ids else 0
    sizes = np.full(n, block, np.int64)
    if n and n_ids % block:
        sizes[-1] = n_ids % block
    return sizes


def encode_blocks(ids: np.ndarray, block: int) -> tuple[list[bytes], np.ndarray]:
    """Code ``ids`` (each below 2**16) in blocks; payloads and the CRC of each block's ids."""
    sizes = _split(len(ids), block)
    lanes = len(sizes)
    if not lanes:
        return [], np.empty(0, np.int64)
    if int(ids.max()) > 0xFFFF or not 1 <= block <= MAX_BLOCK:
        raise ValueError(f"ids must be below 65536 and blocks at most {MAX_BLOCK} ids")
    grid = np.zeros((lanes, block), np.uint16)
    grid.reshape(-1)[:len(ids)] = ids
    le = ids.astype("<u4").tobytes()
    crcs = np.array([zlib.crc32(le[4 * i * block:4 * (i * block + int(s))])
                     for i, s in enumerate(sizes)], np.int64)
    # Each lane's own vocabulary, ordered by lane and id, for the order-0 counts.
    order = np.argsort(grid, axis=1, kind="stable")
    order += np.arange(0, lanes * block, block)[:, None]
    ranked = grid.reshape(-1)[order]
    new = np.ones(grid.shape, bool)
    np.not_equal(ranked[:, 1:], ranked[:, :-1], out=new[:, 1:])
    dense = np.empty(lanes * block, np.int32)
    dense[order.reshape(-1)] = np.cumsum(new, dtype=np.int32) - 1
    dense = np.ascontiguousarray(dense.reshape(lanes, block).T)
    steps = np.ascontiguousarray(grid.T.astype(np.uint32))
    per_lane = new.sum(1)
    lane_start = np.cumsum(per_lane) - per_lane
    del order, ranked, new, grid
    count = np.zeros(int(per_lane.sum()), np.int32)
    freq = cum = count
    model = _Model(lanes)
    low = np.zeros(lanes, np.uint64)
    rng = np.full(lanes, 1 << 48, np.uint64)
    digits = np.zeros((lanes, 2 * block + 8), np.int32)
    pos = np.zeros(lanes, np.int64)

    def put(who, lo, fr, unit) -> None:
        """Narrow the range of lanes ``who`` to [lo, lo + fr) units, carry and emit."""
        added = low[who] + unit * lo
        over = added >> U(48)
        if over.any():
            c = np.flatnonzero(over)
            digits[(who if not isinstance(who, slice) else np.arange(len(added)))[c],
                   pos[who][c] - 1] += 1
            added &= U((1 << 48) - 1)
        low[who], narrowed = added, unit * fr
        rng[who] = narrowed
        small = np.flatnonzero(narrowed < TOP)
        if len(small):
            i = small if isinstance(who, slice) else who[small]
            v = low[i]
            digits[i, pos[i]] = v >> U(32)
            pos[i] += 1
            low[i] = (v & U(0xFFFFFFFF)) << BITS
            rng[i] <<= BITS

    refresh, t0, counted = set(_refreshes(block)), 0, 0
    live = lanes
    for t in range(block):
        if t == sizes[-1] and live == lanes and lanes > 1 or t >= sizes[0]:
            live = lanes - 1
            if t >= sizes[0]:
                break
            model.keep(live)
        if t in refresh:
            seen = dense[counted:t].reshape(-1)
            count += np.bincount(seen, minlength=len(count)).astype(np.int32)
            cum = np.cumsum(count, dtype=np.int32)
            cum -= count
            cum -= np.repeat(cum[lane_start], per_lane)
            freq = count
            t0, counted = t, t
        ids_t = steps[t, :live]
        model.predict()
        word = dense[t, :live]
        fr0 = freq[word]
        event = np.where(fr0 > 0, 2, 3)
        event[(model.c1 == ids_t) & (model.f1 > 0)] = 1
        event[(model.c2 == ids_t) & (model.f2 > 0)] = 0
        all_ = slice(0, live)
        lo, width = model.share(event)
        put(all_, lo, width, rng[all_] // (model.sums >> U(48)))
        who = np.flatnonzero(event == 2)
        if len(who):
            put(who, cum[word[who]].astype(np.uint64), fr0[who].astype(np.uint64),
                rng[who] // U(t0))
        who = np.flatnonzero(event == 3)
        if len(who):
            put(who, ids_t[who].astype(np.uint64), U(1), rng[who] >> BITS)
        model.update(ids_t, event)
    for shift in (32, 16, 0):
        digits[np.arange(lanes), pos] = (low >> U(shift)) & U(0xFFFF)
        pos += 1
    while (carry := digits >> 16).any():
        digits &= 0xFFFF
        digits[:, :-1] += carry[:, 1:]
    out = digits.astype("<u2")
    return [out[i, :pos[i]].tobytes() for i in range(lanes)], crcs


def decode_blocks(payloads: list[bytes], n_ids: int, block: int, crcs: np.ndarray) -> np.ndarray:
    """The ids of ``encode_blocks``; raises ValueError if a block's checksum differs."""
    sizes = _split(n_ids, block)
    lanes = len(sizes)
    if lanes != len(payloads):
        raise ValueError("wrong number of blocks")
    if not lanes:
        return np.empty(0, np.uint32)
    width = max(map(len, payloads)) // 2 + 2
    digits = np.zeros((lanes, width), np.uint64)
    for i, p in enumerate(payloads):
        d = np.frombuffer(p, "<u2")
        digits[i, :len(d)] = d
    model = _Model(lanes)
    rng = np.full(lanes, 1 << 48, np.uint64)
    code = (digits[:, 0] << U(32)) + (digits[:, 1] << U(16)) + digits[:, 2]
    pos = np.full(lanes, 3, np.int64)
    steps = np.zeros((block, lanes), np.uint32)
    table = first = run = None

    def cut(who, lo, fr, unit) -> None:
        """Follow the range into [lo, lo + fr) units and read further digits."""
        rest, narrowed = code[who] - unit * lo, unit * fr
        code[who], rng[who] = rest, narrowed
        small = np.flatnonzero(narrowed < TOP)
        if len(small):
            i = small if isinstance(who, slice) else who[small]
            code[i] = (code[i] << BITS) + digits[i, np.minimum(pos[i], width - 1)]
            pos[i] += 1
            rng[i] <<= BITS

    refresh, t0 = set(_refreshes(block)), 0
    live = lanes
    for t in range(block):
        if t >= sizes[0]:
            break
        if t == sizes[-1] and live == lanes and lanes > 1:
            live = lanes - 1
            model.keep(live)
        if t in refresh:
            table = np.sort(steps[:t].T.astype(np.uint16), axis=1).reshape(-1)
            start = np.ones(len(table), bool)
            start[1:] = table[1:] != table[:-1]
            start[::t] = True
            at = np.flatnonzero(start)
            length = np.diff(np.append(at, len(table)))
            first = np.repeat((at % t).astype(np.uint16), length)
            run = np.repeat(length.astype(np.uint16), length)
            t0 = t
        model.predict()
        all_ = slice(0, live)
        sums = model.sums
        unit = rng[all_] // (sums >> U(48))
        v = code[all_] // unit
        event = ((v >= (sums & LOW16)).astype(np.int64) + (v >= ((sums >> U(16)) & LOW16))
                 + (v >= ((sums >> U(32)) & LOW16)))
        lo, share = model.share(event)
        cut(all_, lo, share, unit)
        ids_t = np.where(event == 0, model.c2, model.c1)
        who = np.flatnonzero(event == 2)
        if len(who):
            unit = rng[who] // U(max(t0, 1))
            slot = np.minimum(code[who] // unit, U(max(t0, 1) - 1)).astype(np.int64) + who * t0
            if table is None or slot.max() >= len(table):
                raise ValueError("damaged block")
            ids_t[who] = table[slot]
            cut(who, first[slot].astype(np.uint64), run[slot].astype(np.uint64), unit)
        who = np.flatnonzero(event == 3)
        if len(who):
            unit = rng[who] >> BITS
            plain = np.minimum(code[who] // unit, U(0xFFFF))
            ids_t[who] = plain
            cut(who, plain, U(1), unit)
        steps[t, :live] = ids_t
        model.update(ids_t, event)
    ids = steps.T.reshape(-1)[:n_ids].astype("<u4")
    raw = ids.tobytes()
    for i, s in enumerate(sizes):
        if zlib.crc32(raw[4 * i * block:4 * (i * block + int(s))]) != crcs[i]:
            raise ValueError(f"checksum of block {i} differs")
    return ids
