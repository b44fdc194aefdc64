"""Texts of an Arrow batch as byte arrays: words, 64-bit keys of byte ranges, small compressed copies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 4 << 20
IS_WHITE = np.zeros(256, bool)
IS_WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string or binary array, one text after the other, and len + 1 offsets; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def blocks(offsets: np.ndarray, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about *block_bytes* together, one text at least."""
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + block_bytes, side="right")) - 1)
        yield at, to
        at = to


def word_ranges(
    data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = IS_WHITE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in the texts, and len(texts) + 1 offsets into them; *apart* marks bytes of no word."""
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(apart[data], out=inside[1:-1])
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True  # a word ends with its text
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def range_keys(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit key of each range of bytes: eight bytes at a time are mixed in."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,)) if len(data) else np.zeros(1, np.uint64)
    keys = lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    left, at, which = lengths, starts, None
    while len(at):
        part = eights[at] & _MASKS[np.minimum(left, 8)]
        now = keys if which is None else keys[which]
        now = (now ^ part) * np.uint64(0xFF51AFD7ED558CCD)
        now ^= now >> np.uint64(32)
        now *= np.uint64(0xC4CEB9FE1A85EC53)
        now ^= now >> np.uint64(29)
        if which is None:
            keys = now
        else:
            keys[which] = now
        more = np.flatnonzero(left > 8)
        which = more if which is None else which[more]
        left, at = left[more] - 8, at[more] + 8
    return keys


def mixed(keys: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit keys."""
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


def pack(data: bytes) -> bytes:
    """Length and zstd form of *data*."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpack(packed: bytes) -> bytes:
    size = int.from_bytes(packed[:8], "little")
    return pa.decompress(packed[8:], size, codec="zstd", asbytes=True) if size else b""


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted numbers in little room: their steps, byte by byte of equal weight together."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return pack(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_sorted(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(unpack(packed), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)
