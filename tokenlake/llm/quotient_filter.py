"""Counting quotient filters of packed n-grams: lossless, sorted, mergeable.

A key is a row of ``n`` ids of ``bits`` bits. A Feistel network over the ids permutes it invertibly, so keys spread evenly
and can be read back. Packed, its top bits name a bucket, the next bits are the quotient and the rest the remainder, which
is stored in full. A filter holds its keys in order: a bit per quotient says whether it occurs, a bit per entry whether it
ends its quotient's run, so quotients need no bytes of their own. Counters of one cost one bit; larger ones a byte, or
eight if they pass that.

All work is on numpy arrays. Filters of different shards are merged in the order of their keys.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np

WORD = np.uint64
_HEAD = struct.Struct("<IB")
# A count of 2 to 256 is one byte; larger ones are written out after this mark.
_LARGE = 255


def _odd_constants(n: int) -> np.ndarray:
    """Odd multipliers from the fractional part of the golden ratio, by index."""
    golden, mask = 0x9E3779B97F4A7C15, (1 << 64) - 1
    return np.array([((i + 1) * golden * golden + 2 * i + 1) & mask | 1 for i in range(n)], WORD)


def mix(cells: list[np.ndarray], salt: int) -> np.ndarray:
    """A 64-bit hash of rows of ids."""
    factors = _odd_constants(len(cells) + salt)[salt:]
    total = np.full(cells[0].shape, 0x632BE59BD9B4E019 + salt, WORD)
    for cell, factor in zip(cells, factors):
        total += cell * factor
    for shift, factor in ((29, 0xBF58476D1CE4E5B9), (32, 0x94D049BB133111EB)):
        total ^= total >> WORD(shift)
        total *= WORD(factor)
    return total ^ (total >> WORD(31))


@dataclass(frozen=True)
class Layout:
    """Keys of ``n`` ids below 2**bits (32 at most), of which the top ``prefix`` bits name the bucket."""

    n: int
    bits: int
    prefix: int

    @cached_property
    def per_limb(self) -> int:
        return 64 // self.bits

    @cached_property
    def limb_bits(self) -> list[int]:
        return [self.bits * len(range(self.n)[at : at + self.per_limb]) for at in range(0, self.n, self.per_limb)]

    def permute(self, cells: list[np.ndarray], back: bool = False) -> list[np.ndarray]:
        """Each step changes one id by a hash of the others, so the steps undo themselves in reverse."""
        cells = [c.copy() for c in cells]
        steps = range(2 * self.n + 2)
        for step in reversed(steps) if back else steps:
            at = step % self.n
            cells[at] ^= mix(cells[:at] + cells[at + 1 :], step) >> WORD(64 - self.bits)
        return cells

    def pack(self, cells: list[np.ndarray]) -> list[np.ndarray]:
        limbs = []
        for at in range(0, self.n, self.per_limb):
            limb = cells[at].copy()
            for cell in cells[at + 1 : at + self.per_limb]:
                limb = (limb << WORD(self.bits)) | cell
            limbs.append(limb)
        return limbs

    def unpack(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        cells, mask = [], WORD((1 << self.bits) - 1)
        for limb, width in zip(limbs, self.limb_bits):
            cells.extend((limb >> WORD(shift)) & mask for shift in range(width - self.bits, -1, -self.bits))
        return cells


def _starts(limbs: list[np.ndarray]) -> np.ndarray:
    """Where another key begins in sorted limbs."""
    new = np.ones(len(limbs[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([limb[1:] != limb[:-1] for limb in limbs])
    return np.flatnonzero(new)


@dataclass(frozen=True)
class CountingFilter:
    """Distinct permuted keys in ascending order, as limbs with the most significant first, and their counts."""

    layout: Layout
    limbs: list[np.ndarray]
    counts: np.ndarray

    @classmethod
    def of(cls, layout: Layout, limbs: list[np.ndarray], counts: np.ndarray | None = None) -> CountingFilter:
        """Sorts keys and adds up the counts of equal ones; without counts each key counts one."""
        if len(limbs) == 1 and counts is None:
            limbs = [np.sort(limbs[0])]
        else:
            order = np.argsort(limbs[0], kind="stable") if len(limbs) == 1 else np.lexsort(limbs[::-1])
            limbs = [limb[order] for limb in limbs]
            counts = None if counts is None else counts[order]
        at = _starts(limbs)
        if counts is None:
            sums = np.diff(at, append=len(limbs[0]))
        else:
            sums = np.add.reduceat(counts, at) if len(at) else counts[:0]
        return cls(layout, [limb[at] for limb in limbs], sums.astype(np.int64))

    @classmethod
    def count(cls, layout: Layout, cells: list[np.ndarray]) -> CountingFilter:
        """The filter of rows of ids."""
        return cls.of(layout, layout.pack(layout.permute(cells)))

    @classmethod
    def merge(cls, filters: list[CountingFilter]) -> CountingFilter:
        """Runs are sorted already, which a stable sort makes use of."""
        first = filters[0]
        if len(filters) == 1:
            return first
        limbs = [np.concatenate(parts) for parts in zip(*(f.limbs for f in filters))]
        return cls.of(first.layout, limbs, np.concatenate([f.counts for f in filters]))

    def at_least(self, least: int) -> tuple[list[np.ndarray], np.ndarray]:
        """(ids, counts) of the keys with such a count, read back from the permuted keys."""
        kept = self.counts >= least
        cells = self.layout.unpack([limb[kept] for limb in self.limbs])
        return self.layout.permute(cells, back=True), self.counts[kept]

    def buckets(self) -> Iterator[tuple[int, bytes]]:
        """(bucket, filter of its keys as bytes)."""
        names = self.limbs[0] >> WORD(self.layout.limb_bits[0] - self.layout.prefix) if self.layout.prefix else np.zeros(len(self.counts), WORD)
        at = _starts([names]).tolist()
        for start, end in zip(at, [*at[1:], len(names)]):
            yield int(names[start]), self._pack(start, end)

    def _pack(self, start: int, end: int) -> bytes:
        n, top = end - start, self.layout.limb_bits[0] - self.layout.prefix
        q = min(n.bit_length() - 1, top)
        rest = top - q
        first = self.limbs[0][start:end]
        quotients = (first & WORD((1 << top) - 1)) >> WORD(rest) if q else np.zeros(n, WORD)
        occupied = np.zeros(1 << q, bool)
        occupied[quotients] = True
        ends = np.append(quotients[1:] != quotients[:-1], True)
        parts = [_HEAD.pack(n, q), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes()]
        for limb, width in zip([first, *(x[start:end] for x in self.limbs[1:])], [rest, *self.layout.limb_bits[1:]]):
            size = -(-width // 8)
            parts.append((limb & WORD((1 << width) - 1)).astype(">u8").view(np.uint8).reshape(n, 8)[:, 8 - size :].tobytes())
        counts = self.counts[start:end]
        more = counts[counts > 1] - 2
        parts += [np.packbits(counts > 1).tobytes(), np.minimum(more, _LARGE).astype(np.uint8).tobytes()]
        parts.append(more[more >= _LARGE].astype("<i8").tobytes())
        return b"".join(parts)

    @classmethod
    def read(cls, layout: Layout, bucket: int, data: bytes) -> CountingFilter:
        n, q = _HEAD.unpack_from(data)
        at, top = _HEAD.size, layout.limb_bits[0] - layout.prefix
        rest = top - q

        def take(size: int) -> np.ndarray:
            nonlocal at
            at += size
            return np.frombuffer(data, np.uint8, size, at - size)

        occupied = np.flatnonzero(np.unpackbits(take(-(-(1 << q) // 8)), count=1 << q))
        ends = np.flatnonzero(np.unpackbits(take(-(-n // 8)), count=n))
        quotients = np.repeat(occupied, np.diff(ends, prepend=-1)).astype(WORD)
        limbs = []
        for width in [rest, *layout.limb_bits[1:]]:
            size = -(-width // 8)
            wide = np.zeros((n, 8), np.uint8)
            wide[:, 8 - size :] = take(n * size).reshape(n, size)
            limbs.append(wide.view(">u8").reshape(n).astype(WORD))
        limbs[0] |= quotients << WORD(rest)
        if layout.prefix:
            limbs[0] |= WORD(bucket) << WORD(top)
        counts = np.ones(n, np.int64)
        several = np.flatnonzero(np.unpackbits(take(-(-n // 8)), count=n))
        more = take(len(several)).astype(np.int64)
        large = more == _LARGE
        more[large] = np.frombuffer(data, "<i8", int(large.sum()), at)
        counts[several] = more + 2
        return cls(layout, limbs, counts)
