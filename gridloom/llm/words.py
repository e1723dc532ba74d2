"""Words of whole Arrow batches as positions in one byte array, and their fingerprints; all in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: A-Z → a-z, all else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes outside white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Digits, lower-case letters, and all bytes of characters beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

#: Bytes that are worked on at once, so that helper arrays stay small whatever the batch.
SLICE = 2_000_000


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each row starts (one more entry than rows); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0]:bounds[-1]], bounds - bounds[0]


def row_slices(bounds: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes; a larger row is a range of its own."""
    first = 0
    while first < len(bounds) - 1:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1)
        yield first, last
        first = last


def find_words(data: np.ndarray, bounds: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of ``letters`` that do not cross rows, and where each row's words start among them."""
    inside = letters[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    full = bounds[1:] > bounds[:-1]
    head, tail = bounds[:-1][full], bounds[1:][full] - 1
    starts[head] = inside[head]
    ends[tail] = inside[tail]
    at = np.flatnonzero(starts)
    return at, np.flatnonzero(ends) + 1, np.searchsorted(at, bounds)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits over 64 bits (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))  # a new array; the steps below change it where it is
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def multipliers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(steps + np.uint64(seed)) | np.uint64(1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of each word: a sum of its bytes, each times a number of its position, then mixed."""
    lengths = ends - starts
    if len(lengths) and not lengths.min():  # sums below need at least a byte each
        out, full = np.zeros(len(starts), np.uint64), lengths > 0
        out[full] = word_hashes(data, starts[full], ends[full])
        return out
    out = np.empty(len(starts), np.uint64)
    factors = multipliers(int(lengths.max()) if len(lengths) else 0, 1)
    reach = np.concatenate([[0], np.cumsum(lengths)])
    for first, last in row_slices(reach, SLICE // 8):  # several arrays of eight bytes each
        n = lengths[first:last]
        heads = reach[first:last] - reach[first]
        place = np.arange(reach[last] - reach[first]) - np.repeat(heads, n)
        values = data[place + np.repeat(starts[first:last], n)].astype(np.uint64) + np.uint64(1)
        out[first:last] = np.add.reduceat(values * factors[place], heads)
    return mixed(out)


def sequence_hashes(hashes: np.ndarray, n: int, seed: int = 2) -> np.ndarray:
    """A fingerprint of each run of ``n`` consecutive words; fewer words give none."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k, factor in enumerate(multipliers(n, seed)):
        total += hashes[k:k + count] * factor
    return mixed(total)


def rolling_hashes(hashes: np.ndarray, n: int, base: int = 0x5851F42D4C957F2D) -> np.ndarray:
    """As ``sequence_hashes``, for long runs: a polynomial over prefix sums, whatever ``n`` at one cost.

    The base is odd, hence has an inverse modulo 2**64, by which each run's sum is brought to one scale.
    """
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.full(len(hashes), base, np.uint64))
        inverse = np.multiply.accumulate(np.full(count, pow(base, -1, 1 << 64), np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(hashes * powers)])
        return mixed((sums[n:] - sums[:-n]) * inverse)
