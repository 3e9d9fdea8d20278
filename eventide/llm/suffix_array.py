"""Enhanced suffix array of many short strings, and its common-prefix interval tree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def suffix_rows(padded: np.ndarray, row: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The suffixes of the zero-padded strings ``padded`` (one per row) that start at ``at`` in
    ``row``, as a matrix of ``width`` bytes; ``padded`` is at least max(at) + width wide."""
    flat = np.lib.stride_tricks.sliding_window_view(padded.reshape(-1), width)
    return flat[row * padded.shape[1] + at]


def sorted_suffixes(rows: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array (order of the rows) and LCP array: lcp[i] is the common prefix of the
    suffixes i - 1 and i of the order, lcp[0] = 0. ``length``: bytes of each suffix."""
    width = rows.shape[1]
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{width}").ravel(), kind="stable")
    lcp = np.zeros(len(order), np.int64)
    step = 65536
    for a in range(1, len(order), step):
        b = min(a + step, len(order))
        differ = rows[order[a:b]] != rows[order[a - 1:b - 1]]
        first = differ.argmax(axis=1)
        first[~differ.any(axis=1)] = width
        lcp[a:b] = np.minimum(first, np.minimum(length[order[a:b]], length[order[a - 1:b - 1]]))
    return order, lcp


def intervals(lcp: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Nodes (length, first, last) of the common-prefix interval tree with length >= least,
    children before parents, by a stack scan over the LCP array."""
    stack: list[tuple[int, int]] = []  # (length, first)
    lcps = lcp.tolist()
    n = len(lcps)
    for i in range(1, n + 1):
        value = lcps[i] if i < n else 0
        if value < least:
            value = 0
        first = i - 1
        while stack and stack[-1][0] > value:
            length, first = stack.pop()
            yield length, first, i - 1
        if value and (not stack or stack[-1][0] < value):
            stack.append((value, first))


def maximal_repeats(lcp: np.ndarray, left: np.ndarray, least: int
                    ) -> Iterator[tuple[int, int, int]]:
    """The nodes whose occurrences cannot all be extended to the left: their left characters
    (``left``, in suffix order; a negative one differs from all) are diverse."""
    differs = np.zeros(len(left), np.int64)
    if len(left) > 1:
        differs[1:] = (left[1:] != left[:-1]) | (left[1:] < 0)
    seen = np.cumsum(differs).tolist()
    for length, first, last in intervals(lcp, least):
        if seen[last] > seen[first] or left[first] < 0:
            yield length, first, last


def covered_lengths(groups: Iterator[tuple[int, int, int]], place: np.ndarray) -> np.ndarray:
    """For every suffix (in suffix order): the length of the longest group in which it is not
    the earliest occurrence, 0 if none. ``place``: sort key of the occurrences.

    Groups come children first. An occurrence that has its length is skipped from then on, so
    all groups together cost one visit for each occurrence and one for each group's earliest.
    """
    n = len(place)
    cover = [0] * n
    after = list(range(1, n + 2))  # next occurrence that is still open
    places = place.tolist()

    def open_from(i: int) -> int:
        path = []
        while i < n and cover[i]:
            path.append(i)
            i = after[i]
        for p in path:
            after[p] = i
        return i

    for length, first, last in groups:
        i = best = open_from(first)
        members = []
        while i <= last:
            members.append(i)
            if places[i] < places[best]:
                best = i
            i = open_from(i + 1)
        for m in members:
            if places[m] > places[best]:
                cover[m] = length
    return np.array(cover, np.int64)
