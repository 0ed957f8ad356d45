"""Words of many texts at once: numpy over the UTF-8 bytes of an Arrow column.

A word is a run of bytes other than the ASCII white space 0x20 and 0x09-0x0D.
Its hash is a polynomial over its bytes modulo 2 ** 64, from one running sum of
the whole slice; hashes of runs of words are built by doubling.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE, STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
SECOND = 0xA24BAED4963EE407
MASK = (1 << 64) - 1
PIECE = 1 << 17  # bytes whose running sum is held at a time

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(BASE)
    return h ^ (h >> np.uint64(32))


class _Powers:
    """Powers of BASE and of its inverse modulo 2 ** 64, as many as have been asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def take(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            n = max(n, PIECE + 1)
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.cumprod(p, dtype=np.uint64))
        return self.up, self.down


_powers = _Powers()


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of raw[starts[i]:ends[i]]; the spans stand in order and do not overlap.

    ``raw`` may hold bytes or code points.
    """
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, low + PIECE, "right")))
        high = int(ends[to - 1])
        up, down = _powers.take(high - low + 1)
        run = np.zeros(high - low + 1, np.uint64)
        np.cumsum((raw[low:high].astype(np.uint64) + np.uint64(1)) * up[:high - low], dtype=np.uint64, out=run[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (run[e] - run[s]) * down[s]
        at = to
    return mixed(out)


def spans(member: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True; a run also ends where a text starts (``firsts``)."""
    if not len(member):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(member) + 1, bool)
    cut[firsts] = True
    cut[-1] = True
    before = np.empty(len(member), bool)
    before[0] = False
    before[1:] = member[:-1]
    starts = np.flatnonzero(member & (~before | cut[:-1]))
    after = np.empty(len(member), bool)
    after[-1] = False
    after[:-1] = member[1:]
    return starts, np.flatnonzero(member & (~after | cut[1:])) + 1


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, and the offsets of its rows in them (one more than rows)."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches, column: str, size: int = 1 << 18):
    """Arrow batches cut into slices of about ``size`` bytes of ``column``, one row at least."""
    for b in batches:
        if not b.num_rows:
            continue
        _, offsets = column_bytes(b.column(column))
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
            yield b.slice(at, to - at)
            at = to


class Words:
    """The words of a slice of texts: ``hashes``, ``text`` (number of the text), ``starts`` and ``ends`` in ``raw``."""

    def __init__(self, column: pa.Array):
        self.raw, self.offsets = column_bytes(column)
        firsts = self.offsets[:-1]
        self.starts, self.ends = spans(~SPACE[self.raw], firsts)
        self.hashes = hash_spans(self.raw, self.starts, self.ends)
        #: words before the first of each text, and of all
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.count = np.diff(self.bounds)
        self.text = np.repeat(np.arange(len(firsts)), self.count)

    def __len__(self):
        return len(self.hashes)


def run_hashes(words: np.ndarray, length: int, step: int = STEP) -> np.ndarray:
    """Hash of every run of ``length`` words: runs of 1, 2, 4, ... words are joined two by two."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    n = len(words) - length + 1
    out, have, block, size = None, 0, words, 1
    while True:
        factor = np.uint64(pow(step, size, 1 << 64))
        if length & size:
            out = block[:n] if out is None else out * factor + block[have:have + n]
            have += size
        if have == length:
            return mixed(out + np.uint64(length))
        block = block[:-size] * factor + block[size:]
        size *= 2


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(a) - width + 1
    if n <= 0:
        return a[:0]
    if width == 1:
        return a
    full = np.full(-(-len(a) // width) * width, np.iinfo(a.dtype).max, a.dtype)
    full[:len(a)] = a
    full = full.reshape(-1, width)
    ahead = np.minimum.accumulate(full, 1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])
