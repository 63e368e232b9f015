"""Words of an Arrow string column as numpy arrays, without a Python object per text or word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; an array of 64-bit numbers per byte is made of it.
PIECE = 4 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse, modulo 2**64, for all i below n."""
    if not _powers or len(_powers[0]) < n:
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        _powers[:] = [np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n - 1, b, np.uint64)])) for b in (BASE, inverse)]
    return _powers[0], _powers[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which every bit depends on every bit (the SplitMix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of consecutive texts: ``starts`` and ``ends`` in ``data``; text i has words ``first[i]:first[i + 1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        solid = ~SPACE[data]
        begins, closes = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1]
        closes[:-1] &= ~solid[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        begins[edges] = solid[edges]
        closes[edges - 1] = solid[edges - 1]
        self.data = data
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word, which depends on its bytes alone."""
        out = np.empty(len(self), np.uint64)
        i = 0
        while i < len(self):
            j = max(i + 1, int(np.searchsorted(self.ends, self.starts[i] + PIECE, "right")))
            low, high = self.starts[i], self.ends[j - 1]
            up, down = powers(max(PIECE, int(high - low)) + 1)
            n = int(high - low)
            upto = np.zeros(n + 1, np.uint64)
            np.cumsum((self.data[low:high].astype(np.uint64) + np.uint64(1)) * up[:n], out=upto[1:])
            a, b = self.starts[i:j] - low, self.ends[i:j] - low
            out[i:j] = mixed((upto[b] - upto[a]) * down[a] ^ (b - a).astype(np.uint64))
            i = j
        return out

    def hashes_of_runs(self, words: np.ndarray, k: int) -> np.ndarray:
        """Hashes of all runs of ``k`` consecutive words given the words' hashes; runs may span texts."""
        n = len(words)
        if n < k:
            return np.empty(0, np.uint64)
        out = np.empty(n - k + 1, np.uint64)
        step = PIECE // 4
        for i in range(0, n - k + 1, step):
            part = words[i : i + step + k - 1]
            up, down = powers(PIECE + 1)
            upto = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * up[: len(part)], out=upto[1:])
            out[i : i + step] = mixed((upto[k:] - upto[:-k]) * down[: len(part) - k + 1])
        return out


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null is the empty text."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset :][: len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def in_pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Consecutive rows of a batch with at most ``limit`` bytes of text (or one longer text), their bytes and offsets."""
    if not batch.num_rows:
        return
    data, offsets = buffers(batch.column(text))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield batch.slice(i, j - i), data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def single_spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with every word followed by one space and no other white space."""
    words = Words(data, offsets)
    keep = ~SPACE[data]
    lengths = words.ends - words.starts
    at = np.concatenate([[0], np.cumsum(lengths + 1)])
    out = np.full(at[-1], 32, np.uint8)
    solid = np.ones(at[-1], bool)
    solid[at[1:] - 1] = False
    out[solid] = data[keep]
    return out, at[words.first]
