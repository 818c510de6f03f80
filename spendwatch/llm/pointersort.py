"""Sorting word-start pointers of a text buffer by multikey quicksort.

A pointer is the place of a word in a buffer of many texts; no word is copied.
A key is the next eight bytes of a word as one big-endian number, zero after
its end. A slice of pointers is parted in three around a pivot key: smaller,
equal and larger. The equal part goes on with the following eight bytes. Small
slices are finished together, level by level.
"""

from __future__ import annotations

import numpy as np

#: Bytes of one key.
STEP = 8
#: Masks that keep all but the last 0 to 8 bytes of a key.
KEPT = np.array([(1 << 64) - (1 << 8 * k) for k in range(STEP + 1)], np.uint64)
#: Slices up to this size are finished together.
SMALL = 32_768
#: Keys looked at for a pivot.
PROBES = 31


def keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Eight bytes from each start as a number; bytes from the end on are zero.

    ``data`` must have eight bytes after the last end.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    everywhere = np.ndarray((len(data) - STEP + 1,), ">u8", data, strides=(1,))
    beyond = STEP - np.minimum(ends - starts, STEP)
    value = everywhere[starts].astype(np.uint64)
    value &= KEPT[beyond]
    return value


Slice = tuple[int, int, int, np.ndarray | None]


def _key_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: np.ndarray, one: Slice) -> np.ndarray:
    """The keys of a slice, as they were parted or read anew."""
    low, high, depth, key = one
    part = order[low:high]
    return keys(data, np.minimum(starts[part] + depth, ends[part]), ends[part]) if key is None else key


def _finish(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: np.ndarray, slices: list[Slice]) -> None:
    """Sort small slices of ``order`` in place: each by its key, then all runs of equal keys at once, eight bytes further in each round."""
    sorted_keys = []
    for one in slices:
        key = _key_of(data, starts, ends, order, one)
        by = np.argsort(key)
        order[one[0] : one[1]] = order[one[0] : one[1]][by]
        sorted_keys.append(key[by])
    lengths = [high - low for low, high, _, _ in slices]
    at = np.concatenate([np.arange(low, high) for low, high, _, _ in slices])
    run, depth = np.repeat(np.arange(len(slices)), lengths), np.repeat([d + STEP for _, _, d, _ in slices], lengths)
    pointer, key = order[at], np.concatenate(sorted_keys)
    while True:
        fresh = np.ones(len(at), bool)
        fresh[1:] = (run[1:] != run[:-1]) | (key[1:] != key[:-1])
        group = np.cumsum(fresh) - 1
        # a run goes on where it has several pointers and a longest word beyond this key
        longest = np.maximum.reduceat(ends[pointer] - starts[pointer], np.flatnonzero(fresh))
        further = (np.bincount(group)[group] > 1) & (longest[group] > depth)
        at, run, depth = at[further], group[further], depth[further]
        if not len(at):
            return
        pointer = order[at]
        key = keys(data, np.minimum(starts[pointer] + depth, ends[pointer]), ends[pointer])
        by = np.lexsort((key, run))
        pointer, key, depth = pointer[by], key[by], depth[by] + STEP
        order[at] = pointer


def sorted_pointers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Order of the words by their bytes; equal words stand together."""
    order = np.arange(len(starts))
    if not len(starts):
        return order
    data = np.concatenate((data, np.zeros(STEP, np.uint8)))
    todo: list[Slice] = [(0, len(order), 0, None)]
    small: list[Slice] = []
    while todo:
        one = todo.pop()
        low, high, depth, _ = one
        if high - low <= SMALL:
            if high - low > 1:
                small.append(one)
            continue
        part, key = order[low:high], _key_of(data, starts, ends, order, one)
        probes = np.sort(key[:: max(1, len(key) // PROBES)])
        pivot = probes[len(probes) // 2]
        less, more = key < pivot, key > pivot
        same = part[~(less | more)]
        first = low + int(less.sum())
        second = first + len(same)
        order[low:high] = np.concatenate((part[less], same, part[more]))
        todo += [(low, first, depth, key[less]), (second, high, depth, key[more])]
        if (ends[same] - starts[same] > depth + STEP).any():
            todo.append((first, second, depth + STEP, None))
    if small:
        _finish(data, starts, ends, order, small)
    return order


def equal_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Number of the run of equal words that each sorted pointer lies in."""
    if not len(order):
        return np.zeros(0, np.int64)
    data = np.concatenate((data, np.zeros(STEP, np.uint8)))
    start, end = starts[order], ends[order]
    size = end - start
    fresh = np.ones(len(order), bool)
    fresh[1:] = size[1:] != size[:-1]
    alive = np.flatnonzero(~fresh)  # pointers that may equal the one before
    depth = 0
    while len(alive):
        one = keys(data, np.minimum(start[alive] + depth, end[alive]), end[alive])
        two = keys(data, np.minimum(start[alive - 1] + depth, end[alive - 1]), end[alive - 1])
        fresh[alive[one != two]] = True
        depth += STEP
        alive = alive[(one == two) & (size[alive] > depth)]
    return np.cumsum(fresh) - 1
