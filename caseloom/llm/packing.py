"""Filling sequences of a fixed capacity, as numbers only.

``Spaces`` is a segment tree over the amounts of free space, 0 to the capacity. Each
leaf holds the sequences with exactly so much space; inner nodes say whether there are
any below. The tightest sequence that takes a piece is found in one walk down.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Sequence
from functools import lru_cache

import numpy as np


class Spaces:
    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.size)
        self.leaves: dict[int, deque] = {}

    def add(self, space: int, item) -> None:
        self.leaves.setdefault(space, deque()).append(item)
        node = space + self.size
        while node:
            self.counts[node] += 1
            node >>= 1

    def take(self, space: int):
        """One item filed under exactly ``space``."""
        node = space + self.size
        while node:
            self.counts[node] -= 1
            node >>= 1
        return self.leaves[space].popleft()

    def tightest(self, least: int) -> int | None:
        """The smallest filed space of at least ``least``."""
        counts, node = self.counts, least + self.size
        if counts[node]:
            return least
        while node > 1:
            if not node & 1 and counts[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if counts[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None

    def widest(self, most: int) -> int | None:
        """The largest filed space of at most ``most``."""
        counts, node = self.counts, most + self.size
        if counts[node]:
            return most
        while node > 1:
            if node & 1 and counts[node - 1]:
                node -= 1
                while node < self.size:
                    node = 2 * node + 1 if counts[2 * node + 1] else 2 * node
                return node - self.size
            node >>= 1
        return None


def best_fit(
    lengths: Sequence[int], order: Iterable[int], capacity: int, sequences: list[list[int]], free: list[int]
) -> None:
    """Put the pieces named by ``order`` into ``sequences``, opening new ones where none fits.

    With ``order`` by falling length this is best-fit decreasing.
    """
    spaces = Spaces(capacity)
    for at, space in enumerate(free):
        spaces.add(space, at)
    for piece in order:
        length = int(lengths[piece])
        space = spaces.tightest(length)
        if space is None:
            at, space = len(sequences), capacity
            sequences.append([])
            free.append(capacity)
        else:
            at = spaces.take(space)
        sequences[at].append(piece)
        free[at] = space - length
        spaces.add(space - length, at)


def falling(lengths: Sequence[int]) -> list[int]:
    """Piece numbers by falling length, equal lengths in their given order."""
    return np.argsort(-np.asarray(lengths, np.int64), kind="stable").tolist()


def pack_best_fit(lengths: Sequence[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing over all pieces; ``sequences[s]`` lists piece numbers."""
    sequences: list[list[int]] = []
    best_fit(lengths, falling(lengths), capacity, sequences, [])
    return sequences


# -- patterns --------------------------------------------------------------------------

#: Lengths are rounded up to so many steps of the capacity; a pattern joins so many pieces at most.
STEPS, MOST = 64, 4
#: Misfit of the shortest steps counts less, since short pieces fill gaps anyway.
SHORT_STEPS, SHORT_WEIGHT = 6, 0.1


@lru_cache(maxsize=8)
def patterns(steps: int, most: int) -> tuple[tuple[int, ...], ...]:
    """All falling ways to fill ``steps`` steps with one to ``most`` pieces."""
    found: list[tuple[int, ...]] = []

    def grow(head: tuple[int, ...], left: int, limit: int) -> None:
        if not left:
            found.append(head)
        elif len(head) < most:
            room = most - len(head)
            for part in range(min(limit, left), -(-left // room) - 1, -1):
                grow((*head, part), left - part, part)

    grow((), steps, steps)
    return tuple(found)


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 0) -> np.ndarray:
    """``x >= 0`` that makes ``|a x - b|`` least, by the active-set method."""
    n = a.shape[1]
    x, used = np.zeros(n), np.zeros(n, bool)
    pull = a.T @ b
    small = 1e-9 * max(1.0, float(np.abs(pull).max(initial=0)))
    for _ in range(rounds or 3 * a.shape[0]):
        pull = a.T @ (b - a @ x)
        pull[used] = -np.inf
        best = int(np.argmax(pull))
        if pull[best] <= small:
            break
        used[best] = True
        while True:
            names = np.flatnonzero(used)
            goal = np.linalg.lstsq(a[:, names], b, rcond=None)[0]
            if (goal > 0).all():
                x[:] = 0
                x[names] = goal
                break
            now = x[names]
            bad = goal <= 0
            share = np.min(now[bad] / np.maximum(now[bad] - goal[bad], 1e-300))
            x[names] = now + share * (goal - now)
            used[names[x[names] <= 1e-12]] = False
            x[~used] = 0
            if not used.any():
                break
    return x


def pack_patterns(lengths: Sequence[int], capacity: int, steps: int = STEPS, most: int = MOST) -> list[list[int]]:
    """Pattern packing: fit repeat counts to the histogram, round, pack the rest.

    Lengths are rounded up to steps, so that pieces of a pattern always fit. Its last
    and shortest place takes the longest piece that still fits, which uses up what
    rounding left. Pieces without a place go to the tightest gap, or to new sequences.
    """
    lengths = np.asarray(lengths, np.int64)
    if not len(lengths):
        return []
    grain = -(-capacity // steps)
    steps = capacity // grain
    step = np.minimum(-(-lengths // grain), steps)
    histogram = np.bincount(step, minlength=steps + 1)[: steps + 1]
    present = [p for p in patterns(steps, most) if all(histogram[s] for s in p)]

    held = Spaces(capacity)  # the pieces not placed yet, by length
    for piece in falling(lengths):
        held.add(int(lengths[piece]), piece)
    sequences: list[list[int]] = []
    free: list[int] = []
    if present:
        a = np.zeros((steps, len(present)))
        for column, pattern in enumerate(present):
            for part in pattern:
                a[part - 1, column] += 1
        weight = np.where(np.arange(1, steps + 1) <= SHORT_STEPS, SHORT_WEIGHT, 1.0)
        repeats = nonnegative_least_squares(a * weight[:, None], histogram[1:] * weight)
        for column in np.argsort(-repeats, kind="stable").tolist():
            for _ in range(int(round(repeats[column]))):
                chosen, space = [], capacity
                for k, part in enumerate(present[column]):
                    last = k == len(present[column]) - 1
                    least = (part - 1) * grain + 1
                    length = held.widest(min(space, capacity) if last else min(part * grain, capacity))
                    if length is None or length < least:
                        break
                    chosen.append((length, held.take(length)))
                    space -= length
                else:
                    sequences.append([piece for _, piece in chosen])
                    free.append(space)
                    continue
                for length, piece in chosen:
                    held.add(length, piece)
                break
    rest = []
    length = held.widest(capacity)
    while length is not None:
        rest.append(held.take(length))
        length = held.widest(capacity)
    best_fit(lengths, rest, capacity, sequences, free)
    return sequences
