"""Token ids to bytes and back: a range coder driven by mixed predictions of order 0, 1 and 2.

Orders 1 and 2 predict one id each from the last one or two ids; how far a prediction is trusted is
learned by its record, and the two are mixed with weights that follow which of them was right. In
every block they start from nothing. The mixture either names the id (one of the predictions) or
passes to order 0, which codes any id by the share it has among the ids that are coded together.
These shares are a small table of their own. All of that drives one arithmetic coder with a carry.

Blocks do not depend on each other, so many are coded in step: position t of every block at once, as
arrays. Only whole numbers and single IEEE operations decide, so every machine reads the same.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

_SLOTS = 10  # bits of a context's slot
_LEVELS = 16
_MIX = 14  # bits of the first step's total
_SHARES = 20  # bits of order 0's total: all 65,536 ids have room beside the frequent ones
_STATE, _WORD = 60, 16
_FLOOR = np.uint64(1 << (_STATE - _WORD))
_MASK = np.uint64((1 << (_STATE - _WORD)) - 1)
_GUESSED = np.float32(2.0**-10)  # stands for the chance that order 0 gives an id
_HIT = np.float32(0.062)
_NONE = np.uint64(0)
# the record after a miss and after a hit, by the record before; it lies above the sixteen bits of an id
_RECORD = np.array([[max(s >> 1, 1) for s in range(_LEVELS)], [min(s + 1, _LEVELS - 1) for s in range(_LEVELS)]], np.int32)
_RECORD = (_RECORD << 16).ravel()
_LENGTH = struct.Struct("<I")

BLOCK = 2048
LANES = 2048


class _Shares:
    """Order 0: the share of each id in 2**_SHARES, at least 1 where the id occurs."""

    def __init__(self, ids: np.ndarray, share: np.ndarray) -> None:
        self.ids, self._share = ids, share
        self.share, self.below = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.uint64)
        self.share[ids], self.below[ids] = share, np.cumsum(share) - share

    @classmethod
    def of(cls, stream: np.ndarray) -> _Shares:
        counts = np.bincount(stream, minlength=1 << 16)
        ids = np.flatnonzero(counts)
        share = 1 + counts[ids] * ((1 << _SHARES) - len(ids)) // max(len(stream), 1)
        if len(ids):
            share[np.argmax(share)] += (1 << _SHARES) - share.sum()
        return cls(ids, share)

    def packed(self) -> bytes:
        planes = self._share.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
        return zstandard.compress(np.diff(self.ids, prepend=0).astype("<u2").tobytes() + planes, 3)

    @classmethod
    def unpacked(cls, table: bytes) -> _Shares:
        data = np.frombuffer(zstandard.decompress(table), np.uint8)
        n = len(data) // 6
        ids = np.cumsum(data[: 2 * n].view("<u2"), dtype=np.int64)
        share = np.ascontiguousarray(data[2 * n :].reshape(4, n).T).view("<u4").ravel().astype(np.int64)
        if share.sum() != 1 << _SHARES or len(ids) and ids[-1] > 65535:
            raise ValueError("a table of shares is damaged")
        return cls(ids, share)

    def symbols(self) -> np.ndarray:
        """The id at each place of the total."""
        return np.repeat(self.ids.astype(np.int32), self._share)


class _Model:
    """The predictions of many blocks, one column each; row 0 is order 1, row 1 is order 2.

    ``predict``, then ``learn`` an id in each column.
    """

    def __init__(self, lanes: int) -> None:
        lane = np.arange(2 * lanes).reshape(2, lanes)
        self._slots, self._levels = (lane << _SLOTS).astype(np.uint32), (lane * _LEVELS).astype(np.int32)
        # what a context predicts in the low 16 bits, its record above
        self._held = np.zeros(2 * lanes << _SLOTS, np.int32)
        self._hits = np.full(2 * lanes * _LEVELS, 2.0**-5, np.float32)
        self._weight = np.full((2, lanes), 0.45, np.float32)
        self._context, self._last = np.zeros((2, lanes), np.uint32), np.zeros(lanes, np.uint32)

    def predict(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the first ``n`` columns: the predicted ids, and the shares of order 2 and 1 in 2**_MIX.

        Where both name one id its share is with order 2, and that of order 1 is 0.
        """
        self._slot = (self._slots[:, :n] + (self._context[:, :n] >> np.uint32(32 - _SLOTS))).astype(np.intp)
        held = self._held.take(self._slot, mode="wrap")
        self._guess, self._sure = held & 65535, held >> 16
        self._level = (self._levels[:, :n] + self._sure).astype(np.intp)
        self._chance = self._hits.take(self._level, mode="wrap")
        self._pull = self._weight[:, :n] * self._chance
        parts = np.maximum(self._pull * np.float32(1 << _MIX), np.float32(1)).astype(np.int32)
        same = self._guess[0] == self._guess[1]
        return self._guess, parts[1] + parts[0] * same, parts[0] * ~same

    def learn(self, n: int, ids: np.ndarray) -> None:
        weight = self._weight[:, :n]
        hit = self._guess == ids
        likely = np.where(hit, self._pull, (weight - self._pull) * _GUESSED)
        self._hits[self._level] = self._chance * np.float32(0.9375) + hit * _HIT
        # a prediction of some record stays after a miss
        kept = np.where(self._sure > 1, self._guess, ids)
        self._held[self._slot] = _RECORD.take(self._sure + hit * np.int32(_LEVELS)) | kept
        rest = (np.float32(1) - weight[0] - weight[1]) * _GUESSED
        pace = np.float32(0.03125) / (likely[0] + likely[1] + rest)
        moved = weight * np.float32(0.96875) + likely * pace
        self._weight[:, :n] = np.minimum(np.maximum(moved, np.float32(0.02)), np.float32(0.49))
        code = ids.astype(np.uint32)
        self._context[0, :n] = code * np.uint32(2654435761)
        self._context[1, :n] = self._context[0, :n] + self._last[:n]
        self._last[:n] = code * np.uint32(2654142463)


class _Writer:
    def __init__(self, lanes: int, length: int) -> None:
        self.low = np.zeros(lanes, np.uint64)
        self.span = np.full(lanes, 1 << _STATE, np.uint64)
        self._width = 4 * length + 8
        self._words = np.zeros(lanes * self._width, np.uint16)
        self._at = np.arange(lanes) * self._width

    def _carry(self, at: np.ndarray) -> None:
        while len(at):
            at = at - 1
            self._words[at] += np.uint16(1)
            at = at[self._words[at] == 0]

    def emit(self, n: int) -> None:
        """Words of the first ``n`` lanes where the span has become short."""
        short = np.flatnonzero(self.span[:n] < _FLOOR)
        while len(short):
            low, at = self.low.take(short), self._at.take(short)
            top = low >> np.uint64(_STATE - _WORD)
            over = np.flatnonzero(top >> np.uint64(_WORD))
            if len(over):
                self._carry(at[over])
            self._words[at] = top.astype(np.uint16)
            self._at[short] = at + 1
            self.low[short] = (low & _MASK) << np.uint64(_WORD)
            span = self.span.take(short) << np.uint64(_WORD)
            self.span[short] = span
            short = short[span < _FLOOR]

    def payloads(self) -> list[bytes]:
        """One more word decides: a multiple of the floor lies inside what is left of the span."""
        value = self.low + _MASK
        self._carry(self._at[np.flatnonzero(value >> np.uint64(_STATE))])
        self._words[self._at] = (value >> np.uint64(_STATE - _WORD)).astype(np.uint16)
        begins = np.arange(len(value)) * self._width
        return [self._words[a : b + 1].astype("<u2").tobytes() for a, b in zip(begins, self._at)]


class _Reader:
    def __init__(self, payloads: list[bytes]) -> None:
        sizes = [len(p) // 2 for p in payloads]
        width = max(sizes) + 8
        words = np.zeros((len(payloads), width), np.uint16)
        for row, size, payload in zip(words, sizes, payloads):
            row[:size] = np.frombuffer(payload[: 2 * size], "<u2")
        # the state begins with three words and three quarters; what follows is cut at the quarters
        begin = words[:, :4].astype(np.uint64)
        first = [begin[:, k] << np.uint64(_STATE - _WORD * (k + 1)) for k in range(3)]
        self.code = first[0] | first[1] | first[2] | (begin[:, 3] >> np.uint64(4))
        words[:, :-1] = (words[:, :-1] << np.uint16(12)) | (words[:, 1:] >> np.uint16(4))
        self._words = words.ravel()
        self._at = np.arange(len(payloads)) * width + 3
        self._last = (np.arange(len(payloads)) + 1) * width - 2
        self.span = np.full(len(payloads), 1 << _STATE, np.uint64)

    def take(self, n: int) -> None:
        """New words for the first ``n`` lanes where the span has become short."""
        short = np.flatnonzero(self.span[:n] < _FLOOR)
        while len(short):
            at = self._at.take(short)
            # beyond the last word only in a damaged block
            word = self._words.take(np.minimum(at, self._last.take(short))).astype(np.uint64)
            self.code[short] = (self.code.take(short) << np.uint64(_WORD)) | word
            self._at[short] = at + 1
            span = self.span.take(short) << np.uint64(_WORD)
            self.span[short] = span
            short = short[span < _FLOOR]


def _lanes(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks from long to short, and how many of them have more than t ids, for each t."""
    order = np.argsort(-sizes, kind="stable")
    longer = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(sizes.max(initial=0)), "right")
    return order, longer


def _coded(blocks: list[np.ndarray], shares: _Shares) -> list[bytes]:
    sizes = np.array([len(b) for b in blocks], np.int64)
    order, longer = _lanes(sizes)
    rows = np.zeros((len(blocks), len(longer)), np.uint16)
    for row, k in zip(rows, order):
        row[: sizes[k]] = blocks[k]
    ids = np.ascontiguousarray(rows.T)
    model, out = _Model(len(blocks)), _Writer(len(blocks), len(longer))
    mix_bits, share_bits, whole = np.uint64(_MIX), np.uint64(_SHARES), np.int32(1 << _MIX)
    for t, n in enumerate(longer.tolist()):
        now = ids[t, :n].astype(np.int32)
        guess, share2, share1 = model.predict(n)
        first, second = guess[1] == now, guess[0] == now
        both = share2 + share1
        below = np.where(first, 0, np.where(second, share2, both))
        share = np.where(first, share2, np.where(second, share1, whole - both))
        missed = ~(first | second)
        low, span = out.low[:n], out.span[:n]
        unit = span >> mix_bits
        low += unit * below.astype(np.uint64)
        unit *= share.astype(np.uint64)
        part, at = unit >> share_bits, now.astype(np.intp)
        low += part * shares.below.take(at, mode="wrap") * missed
        span[:] = np.where(missed, part * shares.share.take(at, mode="wrap"), unit)
        out.emit(n)
        model.learn(n, now)
    found: list[bytes] = [b""] * len(blocks)
    for k, payload in zip(order, out.payloads() if len(longer) else []):
        if sizes[k]:
            found[k] = payload
    return found


def _decoded(payloads: list[bytes], sizes: list[int], shares: _Shares) -> list[np.ndarray]:
    counts_of = np.array(sizes, np.int64)
    order, longer = _lanes(counts_of)
    if not len(longer):
        return [np.zeros(0, np.uint16) for _ in sizes]
    ids = np.zeros((len(longer), len(sizes)), np.uint16)
    model, source, symbols = _Model(len(sizes)), _Reader([payloads[k] for k in order]), shares.symbols()
    mix_bits, share_bits, whole = np.uint64(_MIX), np.uint64(_SHARES), np.int32(1 << _MIX)
    most = np.uint64(len(symbols) - 1)
    for t, n in enumerate(longer.tolist()):
        guess, share2, share1 = model.predict(n)
        both = share2 + share1
        code, span = source.code[:n], source.span[:n]
        unit = span >> mix_bits
        one, rest = unit * share2.astype(np.uint64), unit * both.astype(np.uint64)
        first, missed = code < one, code >= rest
        code -= np.where(first, _NONE, np.where(missed, rest, one))
        share = np.where(first, share2, np.where(missed, whole - both, share1))
        unit *= share.astype(np.uint64)
        part = unit >> share_bits
        # beyond the last place only in a damaged block
        place = np.minimum(code // np.maximum(part, np.uint64(1)), most)
        now = np.where(missed, symbols.take(place.astype(np.intp), mode="wrap"), np.where(first, guess[1], guess[0]))
        at = now.astype(np.intp)
        code -= part * shares.below.take(at, mode="wrap") * missed
        span[:] = np.where(missed, part * shares.share.take(at, mode="wrap"), unit)
        if not span.all():
            raise ValueError("a block of token ids is damaged")
        source.take(n)
        ids[t, :n] = now
        model.learn(n, now)
    rows = np.ascontiguousarray(ids.T)
    found = [np.zeros(0, np.uint16)] * len(sizes)
    for row, k in zip(rows, order):
        found[k] = row[: counts_of[k]]
    return found


def encode_together(blocks: list[np.ndarray]) -> tuple[bytes, list[bytes]]:
    """The table of shares of all blocks of ids below 65,536, and each block as bytes.

    A block of length 0 is no bytes. With the table each can be read without the others.
    """
    shares = _Shares.of(np.concatenate(blocks)) if blocks else _Shares.of(np.zeros(0, np.uint16))
    return shares.packed(), _coded(blocks, shares)


def decode_together(table: bytes, payloads: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The blocks back, given how many ids each has."""
    if not any(sizes):
        return [np.zeros(0, np.uint16) for _ in sizes]
    return _decoded(payloads, sizes, _Shares.unpacked(table))


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Each block as bytes with a table of its own; a block of length 0 is no bytes."""
    found = []
    for block in blocks:
        table, (payload,) = encode_together([block])
        found.append(_LENGTH.pack(len(table)) + table + payload if len(block) else b"")
    return found


def decode(payloads: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The blocks of ``encode`` back, given how many ids each has."""
    found = []
    for payload, size in zip(payloads, sizes):
        end = _LENGTH.size + (_LENGTH.unpack_from(payload)[0] if size else 0)
        found += decode_together(payload[_LENGTH.size : end], [payload[end:]], [size])
    return found
