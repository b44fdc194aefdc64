"""Texts cut where a byte-level pattern always cuts, so that each distinct piece is encoded once.

A piece starts at a space that a visible character follows: the pattern of the
vocabularies served lets a word take one space before it and never looks back over
that place, so the pieces of a text can be encoded apart and joined again.  ``<`` is
not taken as such a character, since added tokens (``<|...|>``) are cut out before
the pattern runs and change what the white space before them is.

The keys of pieces are 64-bit; the memory for encoded pieces is bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

from tickbars.llm import words

BLOCK_BYTES = 4 << 20
HELD_PIECES = 1 << 20

# Bytes that may follow the space: visible ASCII but "<", and the lead byte of U+00C0 to U+00FF.
VISIBLE = np.zeros(256, bool)
VISIBLE[0x21:0x7F] = True
VISIBLE[ord("<")] = False
VISIBLE[0xC3] = True


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the pieces of the texts (empty texts have none), and len(texts) + 1 offsets into them."""
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        cut[: len(data) - 1] = (data[:-1] == 0x20) & VISIBLE[data[1:]]
    # a space at the end of a text may stand before a visible character of the next one
    ends = offsets[1:][offsets[1:] > 0] - 1
    cut[ends] = False
    cut[offsets[:-1]] = True
    starts = np.flatnonzero(cut[:-1])
    return starts, np.searchsorted(starts, offsets)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes of the ranges, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    shift = starts - (np.cumsum(lengths) - lengths)
    return np.repeat(shift, lengths) + np.arange(total)


class Encoder:
    """Ids of texts by way of their distinct pieces."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        """*encode* gives the ids of some pieces, one after the other, and how many each has."""
        self.encode = encode
        self.forget()

    def forget(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.starts = np.empty(0, np.uint32)
        self.lengths = np.empty(0, np.uint32)
        self.ids = np.empty(0, np.uint32)

    def _learn(self, keys: np.ndarray, found: list[bytes]) -> None:
        ids, lengths = self.encode(found)
        starts = np.cumsum(lengths) - lengths + len(self.ids)
        order = np.argsort(np.concatenate([self.keys, keys]), kind="stable")
        self.keys = np.concatenate([self.keys, keys])[order]
        self.starts = np.concatenate([self.starts, starts.astype(np.uint32)])[order]
        self.lengths = np.concatenate([self.lengths, lengths.astype(np.uint32)])[order]
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, one text after the other, and len(texts) + 1 offsets into them."""
        starts, first = pieces(data, offsets)
        ends = np.append(starts[1:], len(data))
        keys, at, which = np.unique(words.range_keys(data, starts, ends - starts), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > HELD_PIECES:
            self.forget()
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == keys[inside]
        if not known.all():
            new = at[~known]
            flat = data.tobytes()
            self._learn(keys[~known], [flat[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
            place = np.searchsorted(self.keys, keys)
        place = place[which]
        lengths = self.lengths[place].astype(np.int64)
        ids = self.ids[spread(self.starts[place].astype(np.int64), lengths)]
        return ids, np.concatenate([[0], np.cumsum(lengths)])[first]

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Blocks of texts (from, to) with their ids and offsets into them."""
        for at, to in words.blocks(offsets, BLOCK_BYTES):
            yield at, to, *self(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
