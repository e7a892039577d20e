"""Words of many texts at once: their place and a hash of each, by array operations on the bytes.

A word is a maximal run of letters and digits of ASCII and of all characters beyond ASCII; A-Z are lower case.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes scanned at once, unless one text has more.
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _lowered() -> np.ndarray:
    """Each byte as it counts in a word; 0 for what is between words."""
    table = np.arange(256, dtype=np.uint8)
    for byte in range(128):
        char = chr(byte)
        table[byte] = ord(char.lower()) if char.isalnum() else 0
    return table


LOWERED = _lowered()
_CODES = np.random.default_rng(20_240_229).integers(1, 1 << 63, 256, dtype=np.uint64)


class Powers:
    """Powers of an odd base modulo 2**64 and their inverses, as many as were asked for."""

    def __init__(self, base: int = _BASE) -> None:
        self._bases = (np.uint64(base), np.uint64(pow(base, -1, 1 << 64)))
        self._tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def upto(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._tables[0]) < count:
            count = max(count, 1 << 16)
            self._tables = [
                np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(count - 1, base))]) for base in self._bases
            ]
        return self._tables[0][:count], self._tables[1][:count]


_POWERS = Powers()


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def prefix_hashes(codes: np.ndarray, powers: Powers) -> np.ndarray:
    """Sums of code times power up to each place; see :func:`span_hashes`."""
    forward, _ = powers.upto(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * forward[: len(codes)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """The hash of each span of codes, wherever it stands."""
    _, back = powers.upto(len(sums))
    return (sums[ends] - sums[starts]) * back[starts]


@dataclass
class Words:
    """The words of texts ``first`` to ``last`` (not included) of a batch."""

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    # The text of each word, counted from ``first``.
    texts: np.ndarray


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins; the last number is the end. There must be no NULL."""
    wide = texts.type in (pa.large_string(), pa.large_binary())
    width = np.int64 if wide else np.int32
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole, ends


def slices(ends: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of ``most`` bytes together, or of one text."""
    first, count = 0, len(ends) - 1
    while first < count:
        last = int(np.searchsorted(ends, ends[first] + most, side="right")) - 1
        last = min(count, max(last, first + 1))
        yield first, last
        first = last


def scan(texts: pa.Array) -> Iterator[Words]:
    whole, ends = raw_bytes(texts)
    for first, last in slices(ends):
        base = ends[first]
        data = LOWERED[whole[base : ends[last]]]
        cuts = ends[first : last + 1] - base
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = data != 0
        begin, end = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
        # A text's end ends a word, and the next text's begins one.
        joints = cuts[1:-1]
        joints = joints[(joints > 0) & (joints < len(data))]
        both = joints[inside[joints] & inside[joints + 1]]
        begin[both] = True
        end[both] = True
        starts, stops = np.flatnonzero(begin[:-1]), np.flatnonzero(end)
        sums = prefix_hashes(_CODES[data], _POWERS)
        hashes = mix(span_hashes(sums, starts, stops, _POWERS))
        owner = np.searchsorted(cuts, starts, side="right") - 1
        yield Words(first, last, data, starts, stops, hashes, owner)
