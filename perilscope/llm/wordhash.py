"""64-bit hashes of words and word runs, vectorised over the bytes of an Arrow column.

A word is a run of bytes other than space and \\x09-\\x0D. Its hash is a polynomial over the bytes, taken from prefix
sums and mixed; the hash of a run of words is a polynomial over the word hashes. Both depend on the content alone,
so tasks on different machines agree. Work goes through slices of ``SLICE_BYTES``, which bounds memory; a slice holds
one text at least.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000
BLANKS = b" \t\n\x0b\x0c\r"
BYTE_BASE = 0x9E3779B97F4A7C15 | 1
WORD_BASE = 0xC2B2AE3D27D4EB4F | 1
MASK = (1 << 64) - 1


def mixed(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers; a bijection for each salt."""
    x = values + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mixed(np.arange(256, dtype=np.uint64))
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[65:91] = BYTE_VALUES[97:123]
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[list(BLANKS)] = False


class Powers:
    """Powers of an odd base and of its inverse, modulo 2^64, as many as were asked for so far."""

    def __init__(self, base: int):
        self.bases = (base, pow(base, -1, 1 << 64))
        self.tables = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]

    def up_to(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.tables[0]) < count:
            size = 1 << (count - 1).bit_length()
            for k, base in enumerate(self.bases):
                table = np.full(size, base, dtype=np.uint64)
                table[0] = 1
                self.tables[k] = np.cumprod(table, dtype=np.uint64)
        return self.tables[0], self.tables[1]


BYTE_POWERS, WORD_POWERS = Powers(BYTE_BASE), Powers(WORD_BASE)


@dataclass
class Slice:
    """Words of some texts: row of the batch of the first text, borders by text, byte bounds and hash by word."""

    first_row: int
    data: np.ndarray
    borders: np.ndarray  # by text: its first byte; one more at the end
    bounds: np.ndarray  # by text: number of its first word; one more at the end
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray

    def runs(self, length: int) -> np.ndarray:
        """Hash of the run of ``length`` words from each word on; runs may reach into the next text."""
        return self.spans(np.arange(max(len(self.hashes) - length + 1, 0)), length)

    def spans(self, first: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        """Hashes of the word runs that begin at ``first``."""
        if not len(first):
            return np.zeros(0, dtype=np.uint64)
        up, down = WORD_POWERS.up_to(len(self.hashes) + 1)
        if not hasattr(self, "_sums"):
            self._sums = np.zeros(len(self.hashes) + 1, dtype=np.uint64)
            np.cumsum(self.hashes * up[: len(self.hashes)], out=self._sums[1:])
        return mixed((self._sums[first + length] - self._sums[first]) * down[first], 1)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and text borders of a string column; NULL is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]] if len(column) else data[:0], offsets - offsets[0] if len(column) else offsets[:1]


def slices(column: pa.Array, fold: bool = False) -> Iterator[Slice]:
    """The words of a batch, slice by slice; ``fold`` takes A-Z for a-z."""
    data, borders = texts_of(column)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(borders, borders[row] + SLICE_BYTES, side="right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield words_of(data[borders[row] : borders[stop]], borders[row : stop + 1] - borders[row], row, fold)
        row = stop


def words_of(data: np.ndarray, borders: np.ndarray, first_row: int, fold: bool) -> Slice:
    solid = IS_WORD[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = solid[:-1]
    inner = borders[(borders > 0) & (borders < len(data))]
    before[inner] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = solid[1:]
    after[inner - 1] = False
    ends = np.flatnonzero(solid & ~after) + 1
    up, down = BYTE_POWERS.up_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((FOLDED_VALUES if fold else BYTE_VALUES)[data] * up[: len(data)], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts])
    return Slice(first_row, data, borders, np.searchsorted(starts, borders), starts, ends, hashes)
