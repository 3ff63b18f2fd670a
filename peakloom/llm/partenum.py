"""PartEnum signatures of sets of 64-bit shingle hashes.

Sizes are cut into bands so narrow that linked sets lie in one band or neighbouring ones; a set takes part in its own band and
in the next.  Two linked sets of a band differ in at most k shingles.  The domain of shingles (their hashes) is partitioned on
two levels: into `groups` groups, and each group into `parts` parts.  A signature is a group's number, a choice of parts - near
of its parts, and the shingles of the set that fall into them; every choice of every group signs.  As k differences spoil (more
than `near` differences in) at most k // (near + 1) groups, k // (near + 1) + 1 + spare groups leave at least spare + 1 of them
with at most `near` differences, hence with a choice of parts that has none: linked sets share a signature.

Empty choices would be shared by sets that have nothing in common.  If at most `spare` groups of a set have one, then at least
one of the groups that agree has none, so the set may leave its empty signatures out: its linked sets hold the same shingles
there.  Only a set with more such groups (rare, `spare` is chosen so) signs them too, and so does any partner that needs it.

near, parts, groups and spare of a band come from a bounded search: the choice that puts most shingles into a signature, with at
most LOAD signatures for a shingle of the smallest set that signs in the band.
"""

from __future__ import annotations

import itertools
import math
from typing import NamedTuple

import numpy as np

from .common import U64, mix

GOLD = U64(0x9E3779B97F4A7C15)
#: Most signatures a shingle (and some for the smallest sets), most differences left to a group, parts beyond those.
LOAD, SOME, NEAR, MORE = 1.5, 10, 4, 3


class Band(NamedTuple):
    low: int
    k: int
    near: int
    parts: int
    groups: int
    spare: int

    def signatures(self) -> int:
        return self.groups * math.comb(self.parts, self.near) if self.k else 0


def spared(least: int, base: int, parts: int, near: int) -> tuple[int, int, float]:
    """(groups, spare groups, groups with an empty choice to be expected beyond the spare ones)."""

    def thin(groups: int) -> float:
        empty = math.exp(-least / (groups * parts))
        return groups * sum(math.comb(parts, j) * empty**j * (1 - empty) ** (parts - j) for j in range(parts - near, parts + 1))

    groups = base
    while groups <= 2 * base + 2:
        expected = thin(groups)
        need = base + math.ceil(expected + 3 * math.sqrt(expected))
        if need <= groups:
            return groups, groups - base, 0.0
        groups = need
    return base, 0, thin(base)


def choose(least: int, k: int) -> tuple[int, int, int, int]:
    """(near, parts, groups, spare) for sets of at least `least` shingles and k differences."""
    best, chosen = None, (0, 1, k + 1, 0)
    for near in range(min(k, NEAR) + 1):
        for parts in range(near + 1, near + 1 + (MORE if near else 1)):
            groups, spare, thin = spared(least, k // (near + 1) + 1, parts, near)
            if groups * math.comb(parts, near) > LOAD * least + SOME:
                continue
            worth = (-round(thin, 2), least * (parts - near) / (groups * parts))
            if best is None or worth > best:
                best, chosen = worth, (near, parts, groups, spare)
    return chosen


class Bands:
    """The bands for a threshold in percent; grows as larger sizes are met."""

    def __init__(self, percent: int):
        if not 0 < percent <= 100:
            raise ValueError("percent must lie in 1..100")
        self.percent, self.all, self.low = percent, [], [1]
        self._add()

    def _add(self) -> None:
        low = self.low[-1]
        high = low * 100 // self.percent
        k = 2 * high * (100 - self.percent) // (100 + self.percent)
        least = self.low[-2] if len(self.low) > 1 else 1
        self.all.append(Band(low, k, *choose(least, k)))
        self.low.append(high + 1)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        while len(sizes) and self.low[-2] <= sizes.max():  # the next band is needed as well
            self._add()
        return np.searchsorted(np.array(self.low), sizes, side="right") - 1


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each start on, so many each."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def of_band(number: int, band: Band, s: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, signature) in one band, for hashes s of documents numbered from 0."""
    shape = (docs, band.groups, band.parts)
    x = mix(s ^ mix(np.array([number], np.uint64) + GOLD))
    slot = doc * (band.groups * band.parts) + (x % U64(band.groups * band.parts)).astype(np.int64)
    content = np.zeros(shape, np.uint64)
    np.add.at(content.reshape(-1), slot, mix(x + GOLD))
    filled = (np.bincount(slot, minlength=content.size) > 0).reshape(shape)
    every = (filled.sum(2) <= band.near).sum(1) > band.spare  # these sign empty choices as well
    tag = mix(np.arange(band.groups, dtype=np.uint64) + (U64(number) << U64(40)))
    out_d, out_s = [], []
    for choice in itertools.combinations(range(band.parts), band.parts - band.near):
        g = np.tile(tag, (docs, 1))
        for j in choice:
            g = mix(g * GOLD + content[:, :, j] + U64(j))
        d, at = np.nonzero(filled[:, :, choice].any(2) | every[:, None])
        out_d.append(d)
        out_s.append(g[d, at])
    return np.concatenate(out_d), np.concatenate(out_s)


def signatures(s: np.ndarray, sizes: np.ndarray, bands: Bands, most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(document number, signature) for sets laid end to end; works through so many slots and shingles at a time."""
    own, start = bands.of(sizes), np.cumsum(sizes) - sizes
    out_d, out_s = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for step in (0, 1):
        for number in np.unique(own[sizes > 0]) + step:
            band = bands.all[number]
            if not band.k:  # equal sets only, and those are one set here
                continue
            who = np.flatnonzero((sizes > 0) & (own + step == number))
            load = np.cumsum(sizes[who] + band.groups * band.parts) // most
            for some in np.split(who, np.flatnonzero(np.diff(load)) + 1):
                d, g = of_band(int(number), band, s[ranges(start[some], sizes[some])], np.repeat(np.arange(len(some)), sizes[some]), len(some))
                out_d.append(some[d])
                out_s.append(g)
    return np.concatenate(out_d), np.concatenate(out_s)
