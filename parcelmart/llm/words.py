"""Words of texts as 64-bit hashes, for a whole Arrow column at a time.

A word is a run of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased. Its hash is a
polynomial over random byte values modulo 2**64, so one cumulative sum over the bytes of a
column gives the hashes of all its words. Two different words share a hash with a probability
of about 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20  # texts are hashed in runs of about so many bytes; a longer text is a run of its own

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_RANDOM = np.random.default_rng(20240607)
_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
for _upper in range(ord("A"), ord("Z") + 1):
    _VALUES[_upper] = _VALUES[_upper + 32]
_STEP = 0x9E3779B97F4A7C15 | 1
_UNSTEP = pow(_STEP, -1, 1 << 64)
_MIX = [np.uint64(int(x) | 1) for x in _RANDOM.integers(1, 2**63, 16, dtype=np.uint64)]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWERS = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def _powers_up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse; kept up to the usual run length."""
    if len(_POWERS[0]) >= n:
        return _POWERS[0][:n], _POWERS[1][:n]
    size = max(n, SLICE_BYTES + (SLICE_BYTES >> 2))
    made = _powers(_STEP, size), _powers(_UNSTEP, size)
    if size <= 4 * SLICE_BYTES:
        _POWERS[:] = made
    return made[0][:n], made[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null rows are empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data, offsets


def runs(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets from 0) of runs of rows with about ``size`` bytes."""
    data, offsets = text_bytes(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        end = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        end = min(max(end, first + 1), rows)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def word_spans(
    data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the number of the first word of each row (with the
    end). ``between`` marks the byte values that stand between words."""
    inside = ~between[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    row_starts = offsets[:-1][offsets[:-1] < len(data)]
    begins[row_starts] = inside[row_starts]
    starts = np.flatnonzero(begins)
    ends_here = inside.copy()
    ends_here[:-1] &= ~inside[1:]
    row_lasts = offsets[1:][offsets[1:] > 0] - 1
    ends_here[row_lasts] = inside[row_lasts]
    ends = np.flatnonzero(ends_here) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _powers_up_to(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_VALUES[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def shingles(words: np.ndarray, first_word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word shingles, row by row, and the number of the first of each row (with
    the end). A row with fewer words gives its whole word sequence as one, a row without any none."""
    counts = np.diff(first_word)
    made = np.where(counts >= n, counts - n + 1, (counts > 0).astype(counts.dtype))
    bounds = np.concatenate([[0], np.cumsum(made)])
    row = np.repeat(np.arange(len(counts)), made)
    at = first_word[:-1][row] + (np.arange(bounds[-1]) - bounds[row])
    width = np.minimum(counts, n)[row]
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        inside = width > k
        if inside.all():
            out += words[at + k] * _MIX[k]
        else:
            out[inside] += words[at[inside] + k] * _MIX[k]
    out += width.astype(np.uint64)
    return mix(out), bounds


def shingle_sets(column: pa.Array, n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, hashes, bounds): for each run of rows the distinct shingles of each
    row, sorted by hash within the row."""
    for first, end, data, offsets in runs(column):
        starts, ends, first_word = word_spans(data, offsets)
        made, bounds = shingles(word_hashes(data, starts, ends), first_word, n)
        row = np.repeat(np.arange(end - first), np.diff(bounds))
        order = _by_row_and_hash(row, made, end - first)
        made, row = made[order], row[order]
        fresh = np.ones(len(made), bool)
        fresh[1:] = (made[1:] != made[:-1]) | (row[1:] != row[:-1])
        made, row = made[fresh], row[fresh]
        yield first, end, made, np.searchsorted(row, np.arange(end - first + 1))


def _by_row_and_hash(row: np.ndarray, hashes: np.ndarray, rows: int) -> np.ndarray:
    """The order by row and hash. One key of the row and the upper bits of the hash sorts fastest; it
    decides unless two hashes of a row share those bits."""
    bits = np.uint64(max(1, int(rows).bit_length()))
    key = (row.astype(np.uint64) << (np.uint64(64) - bits)) | (hashes >> bits)
    order = np.argsort(key)
    key, sorted_hashes = key[order], hashes[order]
    if ((key[1:] == key[:-1]) & (sorted_hashes[1:] != sorted_hashes[:-1])).any():
        return np.lexsort((hashes, row))
    return order
