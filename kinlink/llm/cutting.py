"""Cutting stock by column generation, for one stock length and a histogram of item lengths.

The linear program has one row for each item length that occurs and one column
for each pattern (how many items of each length a sequence holds).  Columns are
priced by a knapsack dynamic program over the stock length, several in a round;
the program ends when it is proved to be within ``gap`` of its optimum, or half
a sequence.  Fractions are rounded down and
what is left is packed best-fit.  All sizes depend on the stock length alone,
never on how many items there are.
"""

from __future__ import annotations

import numpy as np

#: Products by NumPy's own loops: the matrices are small, and threads of a BLAS library wait for cores that Spark has taken.
times = np.einsum



def price(worth: np.ndarray, lengths: np.ndarray, stock: int) -> tuple[float, np.ndarray]:
    """The most that a pattern is worth, and for each first item the best pattern with it: unbounded knapsack."""
    best, took = np.zeros(stock + 1), np.full(stock + 1, -1)
    fits = np.searchsorted(lengths, np.arange(stock + 1), "right")
    for room in range(1, stock + 1):
        best[room], fit = best[room - 1], fits[room]
        if fit:
            value = worth[:fit] + best[room - lengths[:fit]]
            k = int(value.argmax())
            if value[k] > best[room] + 1e-12:
                best[room], took[room] = value[k], k
    # Patterns are traced for all first items side by side.
    patterns, room = np.eye(len(lengths), dtype=np.int64), stock - lengths
    while (room > 0).any():
        k = took[room]
        some = np.flatnonzero((k >= 0) & (room > 0))
        patterns[some, k[some]] += 1
        room = np.where(k >= 0, room - lengths[np.maximum(k, 0)], room - 1)
        room = np.maximum(room, 0)
    return float(best[stock]), patterns[np.argsort(-times("ij,j->i", patterns, worth), kind="stable")]


def relax(lengths: np.ndarray, demand: np.ndarray, stock: int, gap: float, max_rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one a column) and how often each is used, in fractions: the linear program by revised simplex.

    Dual prices divided by the best pattern's worth bound the optimum from below;
    the program ends when what is used is within ``gap`` of the best bound so far.
    Columns are priced halfway between the prices of now and those of the best
    bound, which settles in fewer rounds, and at the prices of now where that finds none.
    Demands are raised by a little of their own each, so that pivots do not go round.
    """
    demand = demand + 1e-3 * np.random.default_rng(len(lengths)).random(len(lengths))
    basis = np.diag(stock // lengths).astype(float)
    inverse, bound, pivots = np.diag(1 / np.diag(basis)), 0.0, 0
    used, center = times("ij,j->i", inverse, demand), None
    for _ in range(max_rounds):
        dual, entered = inverse.sum(axis=0), 0
        now = np.maximum(dual, 0)
        for prices in ([] if center is None else [(now + center) / 2]) + [now]:
            worth, patterns = price(prices, lengths, stock)
            low = float((prices * demand).sum()) / max(worth, 1e-12)
            if low > bound:
                bound, center = low, prices / max(worth, 1e-12)
            left = patterns.astype(float)
            while entered < 24:  # the pattern that pays most now is entered, again and again
                gain = times("ij,j->i", left, dual)
                k = int(gain.argmax())
                if gain[k] <= 1 + 1e-7:
                    break
                step = times("ij,j->i", inverse, left[k])
                ratio = np.where(step > 1e-9, np.maximum(used, 0) / np.maximum(step, 1e-9), np.inf)
                out = int(ratio.argmin())
                used = used - ratio[out] * step
                used[out] = ratio[out]
                basis[:, out] = left[k]
                row = inverse[out] / step[out]
                dual = dual + (1 - gain[k]) * row
                inverse -= np.outer(step, row)
                inverse[out] = row
                entered, pivots = entered + 1, pivots + 1
                if pivots % 500 == 0:  # against rounding errors: a step of Newton's method for the inverse
                    inverse = 2 * inverse - times("ij,jk->ik", inverse, times("ij,jk->ik", basis, inverse))
                    used, dual = times("ij,j->i", inverse, demand), inverse.sum(axis=0)
            if entered:
                break
        if not entered or used.sum() <= bound * (1 + gap) + 0.5:
            break
    return basis.astype(np.int64), np.maximum(used, 0)


def best_fit(lengths: np.ndarray, left: np.ndarray, stock: int) -> list[np.ndarray]:
    """One pattern for each sequence that the leftover items need: longest first, each sequence filled greedily."""
    left, out = left.copy(), []
    while left.any():
        room, pattern = stock, np.zeros(len(lengths), dtype=np.int64)
        for k in range(len(lengths) - 1, -1, -1):
            n = min(int(left[k]), room // int(lengths[k]))
            pattern[k] += n
            left[k] -= n
            room -= n * int(lengths[k])
        out.append(pattern)
    return out


def solve(histogram: dict[int, int], stock: int, gap: float = 5e-4, max_rounds: int = 500) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: items in each}) for every pattern; items are at most ``stock`` long, and all find a place."""
    sizes = {k: v for k, v in histogram.items() if v > 0}
    if not sizes:
        return []
    if min(sizes) < 1 or max(sizes) > stock:
        raise ValueError("lengths run from 1 to the stock length")
    lengths = np.array(sorted(sizes), dtype=np.int64)
    demand = np.array([sizes[int(k)] for k in lengths], dtype=np.int64)
    columns, used = relax(lengths, demand.astype(float), stock, gap, max_rounds)
    plan, left = [], demand.copy()
    for pattern, times in zip(columns.T, np.floor(used + 1e-9).astype(np.int64), strict=True):
        some = pattern > 0
        times = min(int(times), int((left[some] // pattern[some]).min())) if some.any() else 0
        if times:
            plan.append((times, pattern))
            left -= times * pattern
    plan += [(1, p) for p in best_fit(lengths, left, stock)]
    return [(n, {int(k): int(c) for k, c in zip(lengths, p, strict=True) if c}) for n, p in plan]
