"""Cutting texts for byte-level BPE and remembering what a cut piece encodes to.

The tokenizers' word pattern never joins what lies on both sides of a single blank between two characters that are not white
space (a match holds white space only at its start, or is all white space).  So a text is cut there, and each part, with its
blank put back, is encoded on its own and remembered.  Texts with other white space at such a cut, or with the spelling of
an added token, are encoded whole.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def plain(part: str) -> bool:
    return part != "" and not part[0].isspace() and not part[-1].isspace()


def regroup(ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where groups of the given sizes begin and end among items that end at `ends` (both in the same unit)."""
    return np.concatenate([[0], np.searchsorted(ends, np.cumsum(sizes), side="left") + 1])


class PieceCache:
    """Text -> its ids as little-endian uint32 bytes.

    encode_parts takes plain parts, each to be encoded with a blank before it; encode_texts takes whole texts.  Two
    generations of parts bound the memory: when the younger is full it becomes the older, and that one goes.  Texts that
    hold a string of `added` are encoded whole.
    """

    def __init__(self, encode_parts: Callable[[list[str]], list[bytes]], encode_texts: Callable[[list[str]], list[bytes]], most: int = 400_000, added: tuple[str, ...] = ()):
        self.encode_parts, self.encode_texts, self.most, self.added = encode_parts, encode_texts, most, added
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        get, old, young = self.young.get, self.old, self.young
        open_, whole = [], []
        out: list = [None] * len(texts)
        new: set[str] = set()
        for k, text in enumerate(texts):
            parts = text.split(" ")
            found = list(map(get, parts))
            found[0] = None
            gaps, odd = [], not plain(parts[0]) or any(a in text for a in self.added)
            at = 0
            while not odd:
                try:
                    at = found.index(None, at + 1)
                except ValueError:
                    break
                p = parts[at]
                if (y := old.get(p)) is not None:
                    young[p] = found[at] = y
                elif plain(p):
                    gaps.append((at, p))
                    new.add(p)
                else:
                    odd = True
            if odd:
                whole.append(k)
            else:
                open_.append((k, parts[0], found, gaps))
        asked = list(new)
        learnt = dict(zip(asked, self.encode_parts(asked), strict=True)) if asked else {}
        firsts = list({first for _, first, _, _ in open_} | {texts[k] for k in whole})
        begun = dict(zip(firsts, self.encode_texts(firsts), strict=True))
        for k, first, found, gaps in open_:
            for at, p in gaps:
                found[at] = learnt[p]
            found[0] = begun[first]
            out[k] = b"".join(found)
        for k in whole:
            out[k] = begun[texts[k]]
        young.update(learnt)
        if len(young) >= self.most:
            self.old, self.young = young, {}
        return out


def by_bytes(batch, column: str, most: int = 4 << 20):
    """Cuts an Arrow batch so that the texts of a part take about `most` bytes."""
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        limit = (ends[at - 1] if at else 0) + most
        to = max(at + 1, int(np.searchsorted(ends, limit, side="right")))
        yield batch.slice(at, to - at)
        at = to
