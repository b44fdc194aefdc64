"""Sorted runs of byte strings: front coding, and a loser tree that never compares a known prefix again."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def prefixes(keys: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row of a sorted byte matrix with the row before; 0 for the first."""
    common = np.zeros(len(keys), np.int64)
    if len(keys) > 1:
        differ = keys[1:] != keys[:-1]
        common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), keys.shape[1])
    return common


def front_coded(keys: np.ndarray, common: np.ndarray) -> bytes:
    """What each row adds to the prefix it shares with the row before, row after row."""
    return keys[np.arange(keys.shape[1])[None, :] >= common[:, None]].tobytes()


def restored(common: list[int], rest: bytes, width: int) -> list[bytes]:
    """The rows of a front-coded run."""
    rows, at, last = [], 0, b""
    for shared in common:
        to = at + width - shared
        last = last[:shared] + rest[at:to]
        rows.append(last)
        at = to
    return rows


def _common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of two strings of one length that agree up to *at*."""
    n, step = len(a), 8
    while at < n and a[at : at + step] == b[at : at + step]:
        at += step
        step *= 2
    if at >= n:
        return n
    step = min(step, n - at)
    while step > 1:
        half = step // 2
        if a[at : at + half] == b[at : at + half]:
            at += half
            step -= half
        else:
            step = half
    return at if a[at : at + 1] != b[at : at + 1] else at + 1


def merged(runs: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """Merge sorted runs (keys, common prefixes): run, place in it, prefix shared with the key before.

    Every head knows how much it shares with the last key that left.  Of two heads
    the one that shares more is smaller; only on a tie are bytes compared, from
    there on, and the loser keeps what it shares with the winner.  Equal keys
    leave in the order of their runs.
    """
    if not runs:
        return
    size = 1 << (len(runs) - 1).bit_length()
    over = -1  # what an ended run shares: less than any other
    heads: list[bytes] = [keys[0] if keys else b"" for keys, _ in runs] + [b""] * (size - len(runs))
    shared = [0 if keys else over for keys, _ in runs] + [over] * (size - len(runs))
    place = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's shared prefix is brought up to date."""
        x, y = shared[a], shared[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x == over:
            return a, b
        common = _common(heads[a], heads[b], x)
        if heads[a][common:] == heads[b][common:]:
            if a > b:
                a, b = b, a
        elif heads[a][common:] > heads[b][common:]:
            a, b = b, a
        shared[b] = common
        return a, b

    losers = [0] * size
    winners = list(range(size))
    level = size
    while level > 1:
        level //= 2
        nxt = []
        for i in range(level):
            winner, losers[level + i] = play(winners[2 * i], winners[2 * i + 1])
            nxt.append(winner)
        winners = nxt
    best = winners[0]
    while shared[best] != over:
        yield best, place[best], shared[best]
        keys, common = runs[best]
        place[best] += 1
        if place[best] < len(keys):
            heads[best], shared[best] = keys[place[best]], common[place[best]]
        else:
            shared[best] = over
        node = (size + best) // 2
        while node >= 1:
            best, losers[node] = play(best, losers[node])
            node //= 2
