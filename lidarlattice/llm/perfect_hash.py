"""A minimal perfect hash over 80-bit keys, built shard by shard and looked up in numpy arrays.

A key is two numbers: `a` (64 bits) and `b` (16 bits). The leading bits of `a` name its shard.
A shard keeps one bit array for each level: a key's bit is set on the first level on which
no other key of the shard that is left has the same place. A key's slot is the number of set
bits before its own, so slots run from 0 without gaps. The keys themselves are stored by slot
and compared, so that a key that was not put in is told apart. Each has a tag of 16 bits.
"""

from __future__ import annotations

import struct

import numpy as np

#: Bits of a level for each key that is left.
ROOM = 2
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers, one to one (the finaliser of the public splitmix64 generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fold(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A number for each ordered pair."""
    return mix(first * _STEP + mix(second + _STEP))


def shard_of(a: np.ndarray, bits: int) -> np.ndarray:
    return (a >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(a), np.int64)


def _place(a: np.ndarray, b: np.ndarray, level: int, size) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = mix((a ^ (b.astype(np.uint64) << np.uint64(17))) + np.uint64(level + 1) * _STEP)
    return ((h >> np.uint64(32)) * size >> np.uint64(32)).astype(np.int64)


def build(a: np.ndarray, b: np.ndarray, tags: np.ndarray | None = None) -> bytes:
    """One shard of different keys, as bytes: the sizes of its levels, their bits, and the keys and tags (0, if None) by slot."""
    tags = np.zeros(len(a), np.uint16) if tags is None else tags
    sizes, levels, order = [], [], []
    left = np.arange(len(a))
    while len(left):
        size = ROOM * len(left) + 1
        at = _place(a[left], b[left], len(sizes), np.uint64(size))
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, bool)
        bits[at[alone]] = True
        order.append(left[alone][np.argsort(at[alone])])
        sizes.append(size)
        levels.append(np.packbits(bits, bitorder="little").tobytes())
        left = left[~alone]
    slots = np.concatenate(order) if order else np.zeros(0, np.int64)
    head = struct.pack(f"<II{len(sizes)}I", len(a), len(sizes), *sizes)
    return head + b"".join(levels) + a[slots].astype("<u8").tobytes() + b[slots].astype("<u2").tobytes() + tags[slots].astype("<u2").tobytes()


class PerfectHash:
    """Some shards together: keys to slots, which run from 0 through all of them."""

    def __init__(self, bits: int, shards: dict[int, bytes]):
        self.bits, names = bits, sorted(shards)
        self.row = np.full(1 << bits, -1, np.int64)
        self.row[names] = np.arange(len(names))
        counts, sizes, arrays, a, b, tags = [], [], [], [], [], []
        for name in names:
            blob = shards[name]
            n, depth = struct.unpack_from("<II", blob)
            of = struct.unpack_from(f"<{depth}I", blob, 8)
            at = 8 + 4 * depth
            levels = []
            for size in of:
                wide = (size + 7) // 8
                levels.append(np.unpackbits(np.frombuffer(blob, np.uint8, wide, at), bitorder="little")[:size])
                at += wide
            a.append(np.frombuffer(blob, "<u8", n, at))
            b.append(np.frombuffer(blob, "<u2", n, at + 8 * n))
            tags.append(np.frombuffer(blob, "<u2", n, at + 10 * n))
            counts.append(n)
            sizes.append(of)
            arrays.append(levels)
        self.a = np.concatenate(a) if a else np.zeros(0, np.uint64)
        self.b = np.concatenate(b) if b else np.zeros(0, np.uint16)
        self.tags = np.concatenate(tags) if tags else np.zeros(0, np.uint16)
        # one bit for each key by its trailing bits: most keys that are not stored go no further
        self.seen = np.zeros(1 << max(10, 3 + int(len(self.a)).bit_length()), bool)
        self.seen[(self.a & np.uint64(len(self.seen) - 1)).astype(np.int64)] = True
        starts = np.cumsum([0, *counts])[:-1] if counts else np.zeros(0, np.int64)
        # for each level: size and offset of each shard, the bits of all, and the slots before each 64th bit
        self.levels = []
        done = starts.astype(np.int64)
        for level in range(max(map(len, sizes), default=0)):
            size = np.array([of[level] if level < len(of) else 0 for of in sizes], np.int64)
            wide = -(-size // 64) * 64
            offset = np.cumsum(np.r_[0, wide])[:-1]
            flags = np.zeros(int(wide.sum()), np.uint8)
            for k, levels in enumerate(arrays):
                if level < len(levels):
                    flags[offset[k] : offset[k] + size[k]] = levels[level]
            words = np.packbits(flags, bitorder="little").view("<u8")
            ones = np.bitwise_count(words).astype(np.int64)
            before = np.cumsum(np.r_[0, ones])[:-1]
            first = before[np.minimum(offset // 64, max(len(before) - 1, 0))] if len(before) else np.zeros(len(names), np.int64)
            per_word = np.repeat(np.arange(len(names)), wide // 64)
            rank = before - first[per_word] + done[per_word]
            self.levels.append((size.astype(np.uint64), offset, words, rank))
            done = done + np.bincount(per_word, weights=ones, minlength=len(names)).astype(np.int64)

    def __len__(self) -> int:
        return len(self.a)

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for a key that is not stored."""
        out = np.full(len(a), -1, np.int64)
        left = np.flatnonzero(self.seen[(a & np.uint64(len(self.seen) - 1)).astype(np.int64)])
        row = self.row[shard_of(a[left], self.bits)]
        left, row = left[row >= 0], row[row >= 0]
        for level, (size, offset, words, rank) in enumerate(self.levels):
            if not len(left):
                break
            here = size[row] > 0
            left, row = left[here], row[here]
            at = offset[row] + _place(a[left], b[left], level, size[row])
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            slot, who = rank[at[hit] >> 6] + below, left[hit]
            same = (self.a[slot] == a[who]) & (self.b[slot] == b[who])
            out[who[same]] = slot[same]
            left, row = left[~hit], row[~hit]
        return out
