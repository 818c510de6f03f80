"""Cutting stock by column generation, over a histogram of lengths.

The problem size is the number of different lengths, never the number of
documents: at most ``sizes`` rows in the linear program and one pattern per row
in its basis.
"""

from __future__ import annotations

import numpy as np

#: Up to this length each length is a class of its own. Above, class sizes are multiples of ``UNIT`` that grow by ``STEP``.
SHORT = 256
UNIT = 8
STEP = 1.02
#: Pricing rounds at most, and columns of one round, for short and for long classes; the solution is feasible whenever it stops.
SHORT_ROUNDS, SHORT_TOGETHER = 60, 32
LONG_ROUNDS, LONG_TOGETHER = 2_500, 0
#: Stop once no column is worth more than this, which bounds the distance from the optimum.
CLOSE = 1.004


def class_sizes(capacity: int) -> np.ndarray:
    """Class sizes in growing order; a length belongs to the smallest class that holds it."""
    sizes = list(range(1, min(SHORT, capacity) + 1))
    while sizes[-1] < capacity:
        sizes.append(min(capacity, max(sizes[-1] + UNIT, int(sizes[-1] * STEP) // UNIT * UNIT)))
    return np.array(sizes, np.int64)


def priced(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[np.ndarray, list[tuple[int, int, int, np.ndarray]]]:
    """Unbounded knapsack by dynamic programming: the greatest worth within each capacity, and the choices made.

    Copies of a class are added in powers of two, each one vector operation
    over all capacities.
    """
    best, took = np.zeros(capacity + 1), []
    for k in np.flatnonzero(worth > 1e-12).tolist():
        copies = 1
        while copies * sizes[k] <= capacity:
            shift = copies * int(sizes[k])
            gain = best[:-shift] + copies * worth[k]
            better = gain > best[shift:] + 1e-12
            best[shift:][better] = gain[better]
            took.append((k, copies, shift, better))
            copies *= 2
    return best, took


def traced(took: list[tuple[int, int, int, np.ndarray]], classes: int, room: int) -> np.ndarray:
    """The pattern behind the greatest worth within ``room``."""
    pattern = np.zeros(classes, np.int64)
    for k, copies, shift, better in reversed(took):
        if room >= shift and better[room - shift]:
            pattern[k] += copies
            room -= shift
    return pattern


def best_pattern(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The worthiest pattern within the capacity."""
    best, took = priced(sizes, worth, capacity)
    return float(best[capacity]), traced(took, len(sizes), capacity)


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = LONG_ROUNDS, together: int = LONG_TOGETHER) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often each is used in the linear program.

    Revised simplex on equality demands. It starts from one single-class
    pattern per class. A round prices columns by one knapsack on the duals: the
    best pattern of all, and the best ones that hold a given class. Each that
    is still worth it after the ones before replaces the column that blocks first.
    """
    m = len(sizes)
    columns = np.diag(capacity // sizes).astype(np.int64)
    inverse = np.diag(1.0 / np.diag(columns))
    amount = inverse @ demand
    for _ in range(rounds):
        duals = inverse.sum(axis=0)
        best, took = priced(sizes, duals, capacity)
        if best[capacity] <= CLOSE:
            break
        holding = duals + best[capacity - sizes]
        patterns = [traced(took, m, capacity)]
        for k in np.argsort(-holding, kind="stable")[:together].tolist():
            if holding[k] > CLOSE:
                patterns.append(traced(took, m, capacity - int(sizes[k])))
                patterns[-1][k] += 1
        for pattern in patterns:
            direction = inverse @ pattern
            up = direction > 1e-9
            if not up.any() or inverse.sum(axis=0) @ pattern <= CLOSE:
                continue
            ratio = np.where(up, amount / np.where(up, direction, 1), np.inf)
            out = int(ratio.argmin())
            step = max(ratio[out], 0.0)
            amount = np.maximum(amount - step * direction, 0)
            amount[out] = step
            columns[:, out] = pattern
            pivot = inverse[out] / direction[out]
            inverse -= np.outer(direction, pivot)
            inverse[out] = pivot
    return columns.T[:m], amount


def whole_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns with whole-number uses that meet the demand exactly.

    Short classes fill sequences of their own almost fully, so they are solved
    apart, to the token; long classes in units. The program's uses are rounded
    down; what is left of both, less than one use of each basis pattern, goes
    by first fit, longest first.
    """
    left = demand.astype(np.int64).copy()
    chosen: list[tuple[np.ndarray, int]] = []
    for short in (True, False):
        have = np.flatnonzero((demand > 0) & ((sizes <= SHORT) == short))
        if not len(have):
            continue
        size, rest = sizes[have], left[have]
        if short:
            patterns, uses = solve(size, rest.astype(float), capacity, SHORT_ROUNDS, SHORT_TOGETHER)
        else:
            patterns, uses = solve(-(-size // UNIT), rest.astype(float), -(-capacity // UNIT))
        for pattern, use in zip(patterns, uses):
            while (pattern * size).sum() > capacity:  # only where the capacity is no multiple of the unit
                pattern[np.flatnonzero(pattern)[0]] -= 1
            held = pattern > 0
            times = min(int(use + 1e-6), int((rest[held] // pattern[held]).min())) if held.any() else 0
            if times:
                rest -= pattern * times
                full = np.zeros(len(sizes), np.int64)
                full[have] = pattern
                chosen.append((full, times))
        left[have] = rest
    while left.any():
        pattern, room = np.zeros(len(sizes), np.int64), capacity
        for k in np.flatnonzero(left)[::-1].tolist():
            pattern[k] = min(left[k], room // sizes[k])
            room -= pattern[k] * sizes[k]
        held = pattern > 0
        times = int((left[held] // pattern[held]).min())
        left -= pattern * times
        chosen.append((pattern, times))
    return chosen
