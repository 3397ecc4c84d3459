"""Words and n-grams of Arrow text columns as numpy arrays, a bounded block of texts at a time.

Words are runs of bytes other than space and 0x09 to 0x0D. UTF-8 never uses
those bytes inside a longer character, so texts need not be decoded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20  # a single longer text makes a block of its own
SEPARATORS = b" \t\n\x0b\x0c\r"
PRIME = np.uint64(0x9E3779B97F4A7C15)

IS_WORD = np.ones(256, bool)
IS_WORD[list(SEPARATORS)] = False
#: What a byte adds to the hash of its word: separators nothing.
BYTE_VALUE = np.where(IS_WORD, np.arange(1, 257), 0).astype(np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each 64-bit value over all 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), PRIME, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@dataclass
class Block:
    """Some neighbouring texts of a column: rows first to last, their bytes, and where each begins."""

    first: int
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than texts

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of each word, and for each text the number of its first word (one more than texts)."""
        inside = IS_WORD[self.data]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        begins = self.offsets[:-1][self.offsets[:-1] < len(self.data)]
        before[begins] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        ends_at = begins[begins > 0] - 1
        after[ends_at] = False
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def word_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, np.uint64)
        at = self._places(starts)
        longest = int((ends - starts).max())
        value = BYTE_VALUE[self.data] * powers(longest + 1)[np.minimum(at, longest)]
        return mix(np.add.reduceat(value, starts))

    def _places(self, starts: np.ndarray) -> np.ndarray:
        """Bytes since the word before began; 0 ahead of the first word."""
        at = np.zeros(len(self.data), np.int64)
        lengths = np.diff(np.append(starts, len(self.data)))
        at[starts[0] :] = np.arange(starts[0], len(self.data)) - np.repeat(starts, lengths)
        return at


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """A string column in blocks of about `limit` bytes; null reads as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        last = min(last, n)
        yield Block(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last
