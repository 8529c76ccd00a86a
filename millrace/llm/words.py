"""Words of whole Arrow text columns as 64-bit hashes, without a Python loop over words.

A word is a run of bytes outside ``\\x20 \\x09-\\x0D``. Those bytes and ``A-Z``
are ASCII, so working on UTF-8 bytes is the same as working on characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes hashed at a time; a longer word is taken whole.
PIECE = 1 << 19
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


def _bytes_table(lower: bool) -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    if lower:
        codes[65:91] += np.uint64(32)
    return mixed(codes * _BASE + _MIX)


_TABLES = {flag: _bytes_table(flag) for flag in (True, False)}
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and those of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        for name, step in (("up", int(_BASE)), ("down", pow(int(_BASE), -1, 1 << 64))):
            row = np.full(n, step, np.uint64)
            row[0] = 1
            _POWERS[name] = np.multiply.accumulate(row)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _hash_piece(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    up, down = _powers(max(len(data), 1))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLES[lower][data] * up, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def word_hashes(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all rows, and where each row's words begin (rows + 1 numbers).

    Null is the empty text. Memory is a few times the column's bytes: pieces
    of at most ``PIECE`` bytes (or one longer word) are hashed one by one.
    """
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    hashes, firsts = [], []
    low = 0
    while low < len(data):
        high = min(low + PIECE, len(data))
        if high < len(data):  # end the piece behind a space or a row, never inside a word
            row = offsets[np.searchsorted(offsets, high, "right") - 1]
            blank = np.flatnonzero(_SPACE[data[low:high]])
            cut = max(row, low + blank[-1] + 1 if len(blank) else low)
            if cut <= low:
                blank = np.flatnonzero(_SPACE[data[high:]])[:1]
                after = offsets[np.searchsorted(offsets, high, "left")]
                cut = min(after, high + blank[0] if len(blank) else len(data))
            high = cut
        piece = data[low:high]
        inside = ~_SPACE[piece]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        edges = offsets[(offsets > low) & (offsets < high)] - low
        first[edges] = inside[edges]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        last[edges - 1] = inside[edges - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        hashes.append(_hash_piece(piece, starts, ends, lower))
        firsts.append(starts + low)
        low = high
    every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    at = np.concatenate(firsts) if firsts else np.zeros(0, np.int64)
    return every, np.searchsorted(at, offsets)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; fewer words are one run, none give none."""
    if len(words) == 0:
        return words
    width = min(width, len(words))
    total = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        total = total * _BASE + words[k : len(words) - width + 1 + k]
    return mixed(total)


def texts(batch: pa.RecordBatch, name: str = "text", most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most so many bytes of text, or one row."""
    sizes = np.asarray(pc.binary_length(batch.column(name)).fill_null(0)).astype(np.int64)
    ends = np.cumsum(sizes)
    low = 0
    while low < batch.num_rows:
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(low, high - low)
        low = high
