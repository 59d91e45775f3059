"""Words, hashes and per-document counts of Arrow text columns, as numpy arrays.

A word is a maximal run of bytes other than the six ASCII white-space characters. All functions
work on a block: a slice of a record batch whose texts hold about BLOCK_BYTES together, so that
the arrays of a task stay small however many rows a batch brings. Null texts are empty.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 3 << 20
#: For steps whose arrays are many times a block and whose results do not depend on how long a block is.
SMALL_BLOCK = 1 << 20
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def blocks(batches: Iterable[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `limit` bytes of text; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            used = int(total[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(total, used + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


class Texts:
    """The bytes of a text column: `raw`, and `bounds` with one more entry than there are rows."""

    def __init__(self, column: pa.Array):
        column = pc.fill_null(column.cast(pa.large_string()), "")
        column = pa.concat_arrays([column])
        if column.offset:
            column = pa.concat_arrays([column, column.slice(0, 0)])
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.raw = raw[offsets[0] : offsets[-1]] if len(offsets) else raw[:0]
        self.bounds = (offsets - offsets[0]).astype(np.int64)
        self.rows = len(column)

    def owners(self) -> np.ndarray:
        """The row of every byte."""
        return np.repeat(np.arange(self.rows), np.diff(self.bounds))


def spans(texts: Texts, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of the runs of marked bytes; runs `first[i]:first[i + 1]` are those of row i."""
    lengths = np.diff(texts.bounds)
    before = np.zeros(len(inside), dtype=bool)
    before[1:] = inside[:-1]
    before[texts.bounds[:-1][lengths > 0]] = False
    after = np.zeros(len(inside), dtype=bool)
    after[:-1] = inside[1:]
    after[texts.bounds[1:][lengths > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, texts.bounds)


def words(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return spans(texts, ~SPACE[texts.raw])


def owners_of(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        for name, base in (("up", _MULTIPLIER), ("down", pow(_MULTIPLIER, -1, 2**64))):
            factors = np.full(n, base, dtype=np.uint64)
            factors[0] = 1
            _powers[name] = np.cumprod(factors, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of raw[starts[i]:ends[i]]; equal bytes have equal hashes in every task.

    Starts and ends must not decrease. Sums of byte values times powers are taken over stretches
    of about `step` bytes, so the tables of powers are as long as the longest span at most.
    """
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(starts, low + step)))
        high = int(ends[at:stop].max())
        up, down = _power_tables(max(step + 4096, high - low + 1))
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[raw[low:high]] * up[: high - low], out=sums[1:])
        s, e = starts[at:stop] - low, ends[at:stop] - low
        out[at:stop] = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        at = stop
    return out


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of every `size` consecutive values (fewer at the end of the array are left out)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _power_tables(1 << 20)
    step = len(up) - size - 1
    out = np.zeros(n, np.uint64)
    for low in range(0, n, step):
        high = min(n, low + step)
        part = hashes[low : high + size - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=sums[1:])
        out[low:high] = mixed((sums[size:] - sums[:-size]) * down[: high - low])
    return out


def windows_inside(first: np.ndarray, size: int, total: int) -> np.ndarray:
    """Marks the windows of `size` words that lie in one document; one flag per window start."""
    n = max(0, total - size + 1)
    inside = np.ones(n, dtype=bool)
    for back in range(1, size):
        cut = first[1:-1] - back
        cut = cut[(cut >= 0) & (cut < n)]
        inside[cut] = False
    return inside


def keyed(owner: np.ndarray, hashes: np.ndarray, rows: int) -> tuple[np.ndarray, np.uint64]:
    """Row number in the leading bits, hash in the others: sorting groups by row. Also the shift."""
    shift = np.uint64(64 - max(1, int(rows).bit_length()))
    return (owner.astype(np.uint64) << shift) | (hashes >> (np.uint64(64) - shift)), shift


def runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, length) of the runs of equal values."""
    if not len(ordered):
        return ordered, np.zeros(0, np.int64)
    heads = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    return ordered[heads], np.diff(np.append(heads, len(ordered)))


def covered(marked: np.ndarray, size: int, total: int) -> np.ndarray:
    """Marks the words that lie in a marked window of `size` words."""
    edge = np.zeros(total + 1, np.int32)
    at = np.flatnonzero(marked)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return np.cumsum(edge[:-1]) > 0


def per_row(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The sum of the values of each row."""
    sums = np.concatenate(([0], np.cumsum(values)))
    return sums[first[1:]] - sums[first[:-1]]
