"""Words of whole Arrow text columns as numpy arrays.

All texts of a slice are handled as one byte buffer, so the cost is a few array passes and not
a loop over words. Words are runs of the bytes a table marks; as no table splits the bytes of
one UTF-8 character, byte tables give the same words as the character classes they stand for.
A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType

#: Bytes of text that are turned into arrays at once (a single longer text is one slice).
SLICE_BYTES = 1 << 20

_BYTES = np.arange(256)
#: ``[^\x20\x09-\x0D]+``
NOT_SPACE = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: digits, a to z, and everything outside ASCII.
ALNUM = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
#: Lines: everything but the line feed.
NOT_NEWLINE = _BYTES != 0x0A
_LOWER = _BYTES.astype(np.uint8).copy()
_LOWER[0x41:0x5B] += 0x20

_random = np.random.default_rng(20260101)
_BYTE_VALUES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_STEP_INVERSE = pow(_STEP, -1, 1 << 64)
_WINDOW_STEPS = (0xD6E8FEB86659FD93, 0xA3B195354A39B70D)
_powers = {_STEP: np.ones(1, np.uint64), _STEP_INVERSE: np.ones(1, np.uint64)}


def _power_table(base: int, size: int) -> np.ndarray:
    table = _powers[base]
    if len(table) < size:
        size = max(size, SLICE_BYTES)
        table = np.full(size, base, np.uint64)
        table[0] = 1
        table = np.multiply.accumulate(table)
        if size <= 2 * SLICE_BYTES:
            _powers[base] = table
    return table


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; distinct values stay distinct."""
    x = values.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words:
    """Words of some texts: ``starts`` and ``ends`` are byte positions in ``data``; the words of
    text ``i`` are ``bounds[i]`` to ``bounds[i + 1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray = NOT_SPACE, lower: bool = False):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        inside = table[self.data]
        start, end = inside.copy(), inside.copy()
        if len(inside):
            start[1:] &= ~inside[:-1]
            end[:-1] &= ~inside[1:]
            filled = offsets[:-1] < offsets[1:]
            first, last = offsets[:-1][filled], offsets[1:][filled] - 1
            start[first], end[last] = inside[first], inside[last]
        self.inside = inside
        self.starts, self.ends = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.bounds = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def owners(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of the bytes of each word, the same in any text and task."""
        if not len(self):
            return np.zeros(0, np.uint64)
        values = np.where(self.inside, _BYTE_VALUES[self.data], np.uint64(0))
        values *= _power_table(_STEP, len(values))[: len(values)]
        sums = np.add.reduceat(values, self.starts)
        return mix(sums * _power_table(_STEP_INVERSE, len(values))[self.starts])

    def places(self, length: int) -> np.ndarray:
        """Positions at which ``length`` words of one text begin."""
        room = np.repeat(self.bounds[1:], self.counts) - np.arange(len(self))
        return np.flatnonzero(room >= length)

    def text(self, word: int) -> bytes:
        return self.data[self.starts[word] : self.ends[word]].tobytes()


def windows(hashes: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """Hash of the ``length`` words from each position on (those that fit into the array);
    ``which`` picks one of two independent hashes."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = _WINDOW_STEPS[which]
    powered, size, total, done = hashes if which == 0 else mix(hashes ^ np.uint64(base)), 1, None, 0
    while True:
        if length & size:
            part = powered[done : done + n]
            scaled = part * np.uint64(pow(base, done, 1 << 64))
            total = scaled if total is None else total + scaled
            done += size
        if size * 2 > length:
            return mix(total)
        powered = powered[:-size] + powered[size:] * np.uint64(pow(base, size, 1 << 64))
        size *= 2


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive texts of at most ``limit`` bytes together (or one longer text): first row, row
    after the last, bytes, and the offsets of the texts in them."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        low, high = offsets[first], offsets[last]
        yield first, last, data[low:high], offsets[first : last + 1] - low
        first = last


def packed_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """As ``slices``, of texts that ``compressed`` packed; a slice at a time is unpacked."""
    unpack = zstandard.ZstdDecompressor().decompress
    first, parts, size = 0, [], 0
    for low in range(0, len(column), 256):
        for packed in column.slice(low, 256).to_pylist():
            text = b"" if packed is None else unpack(packed)
            if parts and size + len(text) > limit:
                yield first, first + len(parts), *_joined(parts)
                first, parts, size = first + len(parts), [], 0
            parts.append(text)
            size += len(text)
    if parts:
        yield first, first + len(parts), *_joined(parts)


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def code_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of characters of each text."""
    return sums_between((data & 0xC0) != 0x80, offsets)


def sums_between(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` from each offset to the next."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return np.diff(total[offsets])


@arrow_udf(BinaryType())
def compressed(text: pa.Array) -> pa.Array:
    """Texts as zstandard frames: a third of the bytes to shuffle. Null stays null."""
    pack = zstandard.ZstdCompressor(level=1).compress
    return pa.array([None if t is None else pack(t) for t in text.cast(pa.binary()).to_pylist()], pa.binary())


def decompressed(column: pa.Array) -> pa.Array:
    """The UTF-8 bytes that ``compressed`` packed; null is empty."""
    unpack = zstandard.ZstdDecompressor().decompress
    return pa.array([b"" if z is None else unpack(z) for z in column.to_pylist()], pa.large_binary())
