"""Word n-grams of a batch of texts, interned in an open-addressed NumPy table.

Texts are laid out as bytes: lower-cased words, each followed by one space, so that every n-gram is one
stretch of bytes.  Keys of the table are the stretches' xxhash64; two stretches share a slot only if
their bytes are equal too.
"""

from __future__ import annotations

import zlib

import numpy as np
import xxhash

_P = [np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]  # fixed values: primes of xxhash64
SHORT = 32  # stretches of fewer bytes are hashed as vectors

#: What a byte becomes: 0 for separators, A-Z lower-cased (bytes beyond ASCII are parts of letters).
BYTES = np.array([c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 0 for c in range(256)], dtype=np.uint8)
MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def _rotl(x, r):
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


class Grams:
    """The n-grams of 1 to ``n`` consecutive words of several texts: ``start`` and ``size`` in ``buf``,
    and the number of their text in ``doc``.  ``offsets`` are the texts' bounds in ``data``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, n: int = 1):
        low = BYTES[data]
        keep = low > 0
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        begin, end = keep.copy(), keep.copy()
        begin[1:] &= ~keep[:-1] | edge[1:-1]
        end[:-1] &= ~keep[1:] | edge[1:-1]
        first = np.flatnonzero(begin)
        size = np.flatnonzero(end) + 1 - first
        doc = np.searchsorted(offsets, first, "right") - 1
        start = np.cumsum(size + 1) - (size + 1)
        self.buf = np.full(int(size.sum()) + len(size) + 8, 32, dtype=np.uint8)  # 8 bytes more, for whole lanes
        self.buf[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = low[keep]
        self.n_texts = len(offsets) - 1
        self.n_words = np.bincount(doc, minlength=self.n_texts)
        parts = [(start, size, doc)]
        for k in range(1, n):
            here = np.flatnonzero(doc[k:] == doc[:-k]) if len(doc) > k else np.array([], dtype=np.int64)
            parts.append((start[here], start[here + k] + size[here + k] - start[here], doc[here]))
        self.start, self.size, self.doc = (np.concatenate(x) for x in zip(*parts))
        self._u8 = np.ndarray(len(self.buf) - 7, "<u8", self.buf, strides=(1,))
        self._u4 = np.ndarray(len(self.buf) - 3, "<u4", self.buf, strides=(1,))

    def bytes_of(self, k: int) -> bytes:
        return self.buf[self.start[k]: self.start[k] + self.size[k]].tobytes()

    def hashes(self) -> np.ndarray:
        """xxhash64 (seed 0) of every n-gram."""
        p1, p2, p3, p4, p5 = _P
        h = p5 + self.size.astype(np.uint64)
        at, left = self.start.copy(), self.size.copy()
        long = np.flatnonzero(left >= SHORT)
        left[long] = 0
        for _ in range(SHORT // 8 - 1):
            k = np.flatnonzero(left >= 8)
            if not len(k):
                break
            h[k] = _rotl(h[k] ^ _rotl(self._u8[at[k]] * p2, 31) * p1, 27) * p1 + p4
            at[k] += 8
            left[k] -= 8
        k = np.flatnonzero(left >= 4)
        h[k] = _rotl(h[k] ^ self._u4[at[k]].astype(np.uint64) * p1, 23) * p2 + p3
        at[k] += 4
        left[k] -= 4
        for _ in range(3):
            k = np.flatnonzero(left >= 1)
            h[k] = _rotl(h[k] ^ self.buf[at[k]].astype(np.uint64) * p5, 11) * p1
            at[k] += 1
            left[k] -= 1
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        h ^= h >> np.uint64(32)
        h[long] = [xxhash.xxh64_intdigest(self.bytes_of(k)) for k in long]
        return h

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether n-grams ``a`` and ``b`` have the same bytes."""
        out = self.size[a] == self.size[b]
        k = np.flatnonzero(out & (self.start[a] != self.start[b]))
        for i in k[self.size[a[k]] > 8 * SHORT]:
            out[i] = self.bytes_of(a[i]) == self.bytes_of(b[i])
        k = k[self.size[a[k]] <= 8 * SHORT]
        at = 0
        while len(k):
            left = self.size[a[k]] - at
            differ = (self._u8[self.start[a[k]] + at] ^ self._u8[self.start[b[k]] + at]) & MASKS[np.minimum(left, 8)]
            out[k[differ != 0]] = False
            k = k[(differ == 0) & (left > 8)]
            at += 8
        return out


class Table:
    """Slots of the distinct n-grams of ``grams``: ``slot`` of each occurrence, and by slot ``bucket``
    (crc32 of the bytes modulo ``buckets``) and ``count``; ``used`` are the slots in use."""

    def __init__(self, grams: Grams, buckets: int, room: int = 1 << 14):
        self.grams, self.hash = grams, grams.hashes()
        self.slot = np.empty(len(self.hash), dtype=np.int64)
        self._clear(room)
        done = 0
        while done < len(self.hash):
            step = min(len(self.owner) // 4, len(self.hash) - done)  # at most three quarters full after it
            self._put(np.arange(done, done + step))
            done += step
            if 2 * self.filled > len(self.owner):
                kept = self.owner[self.owner >= 0]
                self._clear(2 * len(self.owner))
                self._put(kept)  # the owners have new slots; what was put before follows its owner
                self.slot[:done] = self.slot[self.first[:done]]
        self.used = np.flatnonzero(self.owner >= 0)
        self.bucket = np.zeros(len(self.owner), dtype=np.int64)
        self.bucket[self.used] = [zlib.crc32(grams.bytes_of(k)) % buckets for k in self.owner[self.used]]
        self.count = np.bincount(self.slot, minlength=len(self.owner))

    def _clear(self, room: int) -> None:
        self.owner = np.full(room, -1, dtype=np.int64)
        self.mask = np.uint64(room - 1)
        self.filled = 0
        if not hasattr(self, "first"):
            self.first = np.empty(len(self.hash), dtype=np.int64)  # the occurrence that owns the slot

    def _put(self, todo: np.ndarray) -> None:
        slot = (self.hash[todo] & self.mask).astype(np.int64)
        while len(todo):
            free = self.owner[slot] < 0
            self.owner[slot[free]] = todo[free]  # one of those that meet here wins
            own = self.owner[slot]
            self.filled += int((free & (own == todo)).sum())
            same = self.hash[own] == self.hash[todo]
            same[same] = self.grams.same(own[same], todo[same])
            self.slot[todo[same]] = slot[same]
            self.first[todo[same]] = own[same]
            todo, slot = todo[~same], (slot[~same] + 1) & int(self.mask)
