"""Canonical length-limited Huffman codes over token ids, encoded and decoded in whole arrays."""

from __future__ import annotations

import numpy as np


def code_lengths(counts: np.ndarray, limit: int = 16) -> np.ndarray:
    """Bits of each id (0: it does not occur), optimal among codes of at most `limit` bits (package-merge).

    The limit is raised where that many ids cannot be told apart by so few bits. One single id gets one bit.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(len(used) - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    # Level by level, pairs of the cheapest items become packages and are merged with the leaves.
    levels, items = [], leaves
    is_leaf = np.ones(len(leaves), bool)
    for _ in range(limit):
        levels.append(is_leaf)
        pairs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((leaves, pairs))
        by_cost = np.argsort(both, kind="stable")
        items, is_leaf = both[by_cost], by_cost < len(leaves)
    taken = 2 * len(leaves) - 2
    bits = np.zeros(len(leaves), np.int64)
    for is_leaf in reversed(levels):
        own = int(is_leaf[:taken].sum())
        bits[:own] += 1
        taken = 2 * (taken - own)
    lengths[order] = bits
    return lengths


class Code:
    """The canonical code of given lengths: ids in order of (length, id) get ascending code words."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        self.limit = max(int(lengths.max(initial=1)), 1)
        order = np.flatnonzero(lengths)
        order = order[np.argsort(lengths[order], kind="stable")]
        spans = np.left_shift(1, self.limit - lengths[order].astype(np.int64))
        starts = np.cumsum(spans) - spans
        self.words = np.zeros(len(lengths), np.uint64)
        self.words[order] = starts >> (self.limit - lengths[order])
        # One entry per window of `limit` bits: the id above, its length in the low byte.
        entry = (order.astype(np.int64) << 8) | lengths[order]
        self.table = np.zeros(1 << self.limit, np.int64)
        self.table[: int(spans.sum())] = np.repeat(entry, spans)

    def encode(self, ids: np.ndarray, counts: np.ndarray, every: int) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Documents laid one after another, each from a whole byte on.

        Returns the bits, the bytes of each document, and for each run of `every` ids its first bit in its document.
        """
        lengths = self.lengths[ids].astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(lengths)))
        edges = np.concatenate(([0], np.cumsum(counts)))
        sizes = (ends[edges[1:]] - ends[edges[:-1]] + 7) // 8
        first = (np.cumsum(sizes) - sizes) * 8
        position = ends[:-1] + np.repeat(first - ends[edges[:-1]], counts)
        runs = -(-counts // every)
        nth = np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs)
        checkpoints = position[np.repeat(edges[:-1], runs) + nth * every] - np.repeat(first, runs)
        cells = np.zeros(int(sizes.sum()) // 4 + 2, np.uint64)
        if len(ids):
            cell = position >> 5
            value = self.words[ids] << (64 - lengths - (position & 31)).astype(np.uint64)
            starts = np.concatenate(([0], np.flatnonzero(np.diff(cell)) + 1))
            cells[cell[starts]] += np.add.reduceat(value >> np.uint64(32), starts)
            cells[cell[starts] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), starts)
        return cells.astype(">u4").tobytes()[: int(sizes.sum())], sizes, checkpoints

    def decode(self, bits: bytes, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The ids of runs that begin at bit `starts` and have `counts` ids each, all runs in step, one after another."""
        padded = np.frombuffer(bits + bytes(8), np.uint8).astype(np.uint32)
        windows = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
        out = np.empty(int(counts.sum()), np.uint32)
        order = np.argsort(-counts, kind="stable")
        position = starts[order].astype(np.int64)
        target = (np.cumsum(counts) - counts)[order]
        left = counts[order]
        mask, high = (1 << self.limit) - 1, 32 - self.limit
        active = len(order)
        for step in range(int(left[0]) if len(left) else 0):
            while active and left[active - 1] <= step:
                active -= 1
            at = position[:active]
            entry = self.table[(windows[at >> 3] >> (high - (at & 7)).astype(np.uint32)) & mask]
            out[target[:active] + step] = entry >> 8
            at += entry & 255
        return out
