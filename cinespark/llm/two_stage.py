"""Two-stage suffix sorting of fixed-length prefixes, as numpy code for one task.

Only suffixes smaller than their successors are sorted directly (and the last wanted start of a
segment, whose successor is not there). The others follow by one scan over the byte buckets in
ascending order: a suffix p that is larger than its successor p + 1 has its place right after the
place of p + 1 is known, in the order in which the scan meets the successors.
"""

from __future__ import annotations

import numpy as np


def prefixes(buf: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """buf[start:start + width] as fixed byte strings; order and equality are those of the bytes."""
    view = np.lib.stride_tricks.sliding_window_view(buf, width)
    return np.ascontiguousarray(view[starts]).view(f"S{width}").ravel()


def _merge(keys: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two lists of suffixes, each in order, as one."""
    if not len(b):
        return a
    if not len(a):
        return b
    return np.insert(a, np.searchsorted(keys[a], keys[b]), b)


def suffix_order(buf: np.ndarray, starts: np.ndarray, linked: np.ndarray, width: int):
    """Order of the suffixes at ``starts`` by their first ``width`` bytes, which lie inside ``buf``.

    linked[i]: starts[i + 1] == starts[i] + 1 in the same segment. Returns (order, keys).
    """
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, f"S{width}")
    keys = prefixes(buf, starts, width)
    first = buf[starts]
    # length of the run of equal bytes at a start (at most width), and whether a smaller byte ends it
    change = np.flatnonzero(buf[1:] != buf[:-1])
    slot = np.searchsorted(change, starts)
    at_end = slot == len(change)
    stop = np.where(at_end, len(buf) - 1, change[np.minimum(slot, max(len(change) - 1, 0))] if len(change) else len(buf) - 1)
    run = np.minimum(stop - starts + 1, width)
    after = buf[np.minimum(stop + 1, len(buf) - 1)]
    larger = ~at_end & (after < first) & (run < width)             # larger than the successor
    induced = larger & linked
    seeds = np.flatnonzero(~induced)
    seeds = seeds[np.argsort(keys[seeds], kind="stable")]          # the direct sort
    # seeds that are larger than their (absent) successor stand before the others of their bucket
    early, late = seeds[larger[seeds]], seeds[~larger[seeds]]
    early_at = np.searchsorted(first[early], np.arange(257))
    late_at = np.searchsorted(first[late], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    none = np.zeros(0, np.int64)
    out = []
    for c in range(256):
        own = early[early_at[c]:early_at[c + 1]]
        level = np.concatenate([*waiting[c], none])
        waiting[c] = []
        bucket = []
        depth = 1
        while len(level) or len(own):
            now = own[run[own] == depth]
            own = own[run[own] != depth]
            level = _merge(keys, level, now)
            bucket.append(level)
            before = level[level > 0] - 1
            level = before[induced[before] & (first[before] == c)]  # one more equal byte in front
            depth += 1
        bucket.append(late[late_at[c]:late_at[c + 1]])
        done = np.concatenate(bucket)
        out.append(done)
        before = done[done > 0] - 1
        before = before[induced[before] & (first[before] > c)]
        if len(before):
            chars = first[before]
            by = np.argsort(chars, kind="stable")
            before, chars = before[by], chars[by]
            cuts = np.flatnonzero(np.diff(chars)) + 1
            for part in np.split(before, cuts):
                waiting[first[part[0]]].append(part)
    return np.concatenate(out), keys


def common_prefixes(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix in order with the one before it (0 for the first)."""
    width = keys.dtype.itemsize
    rows = keys[order].view(np.uint8).reshape(-1, width)
    differ = rows[1:] != rows[:-1]
    lcp = np.zeros(len(order), np.int64)
    lcp[1:] = np.where(differ.any(1), differ.argmax(1), width)
    return lcp
