"""Vectorised words, word hashes and shingle sets over Arrow string columns.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A word's hash is a
polynomial over its bytes modulo 2**64, read off one prefix sum for a whole chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20


def _splitmix(seed: int, n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """Random value of each byte with A-Z folded, and which bytes are white space."""
    value = _splitmix(7, 256)
    value[65:91] = value[97:123]
    space = np.zeros(256, bool)
    space[[32, *range(9, 14)]] = True
    return value, space


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i modulo 2**64, by doubling."""
    base = 0x5851F42D4C957F2D
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.ones(n, np.uint64)
        done = 1
        while done < n:
            step = min(done, n - done)
            p[done : done + step] = p[:step] * np.uint64(pow(b, done, 1 << 64))
            done += step
        out.append(p)
    return out[0], out[1]


class Words:
    """Word hashes of chunks of documents: ``chunks(strings)`` yields (first row, rows + 1 word bounds, hashes)."""

    def __init__(self) -> None:
        self.value, self.space = byte_tables()
        self.p, self.q = powers(CHUNK_BYTES)

    def chunks(self, strings: pa.Array, with_bytes: bool = False) -> Iterator[tuple]:
        strings = strings.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
        data = np.frombuffer(strings.buffers()[2] or b"", np.uint8)
        row = 0
        while row < len(strings):
            last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
            last = min(last, len(strings))
            b = data[offsets[row] : offsets[last]]
            starts, ends, bounds = self.split(b, offsets[row : last + 1] - offsets[row])
            out = (row, bounds, self.hashes(b, starts, ends))
            yield (*out, b, starts, ends) if with_bytes else out
            row = last

    def split(self, b: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of words in b, and for each document the index of its first word."""
        inside = np.zeros(len(b) + 2, np.int8)
        inside[1:-1] = ~self.space[b]
        edge = np.diff(inside)
        starts, ends = np.flatnonzero(edge[: len(b) + 1] == 1), np.flatnonzero(edge == -1)
        cuts = doc[1:-1]
        cuts = np.unique(cuts[(cuts > 0) & (cuts < len(b))])
        cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]  # two documents meet inside a run
        if len(cuts):
            starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
        return starts, ends, np.searchsorted(starts, doc)

    def hashes(self, b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(b) > len(self.p):
            self.p, self.q = powers(len(b))
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(self.value[b] * self.p[: len(b)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.q[starts]) if len(starts) else np.zeros(0, np.uint64)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words; of all words as one if there are fewer; none without words."""
    if not len(words):
        return words
    width = min(k, len(words))
    out = np.zeros(len(words) - width + 1, np.uint64)
    for j in range(width):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[j : j + len(out)]
    return mix(out + np.uint64(width))
