"""64-bit hashes of the words of many texts at once, in numpy.

Words are runs without ASCII white space; A-Z count as a-z. A word's hash is a polynomial in its bytes (a random code per
byte value), taken from running sums over the whole slice of texts, then mixed. Slices bound the memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from txnspark.llm.common import worker_code

worker_code(__name__)

SLICE_BYTES = 2_000_000
BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit words."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _codes() -> np.ndarray:
    lowered = np.arange(256)
    lowered[65:91] += 32
    return mix((lowered.astype(np.uint64) + _U(1)) * _U(BASE))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for factor in (BASE, pow(BASE, -1, 2**64)):
        p = np.full(n, factor, np.uint64)
        p[:1] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, hashes of all words of a run of texts, number of words per text); NULL has none."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    codes = _codes()
    powers = inverse = np.zeros(0, np.uint64)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + SLICE_BYTES, "right")) - 1)
        raw = data[ends[first] : ends[last]]
        cuts = ends[first : last + 1] - ends[first]
        if len(raw) + 1 > len(powers):
            powers, inverse = _powers(max(len(raw) + 1, SLICE_BYTES))
        inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
        edge = np.zeros(len(raw) + 1, bool)
        edge[cuts] = True  # texts do not join their words
        before = np.concatenate(([False], inside))
        after = np.concatenate((inside, [False]))
        starts = np.flatnonzero(after & (~before | edge))
        stops = np.flatnonzero(before & (~after | edge))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes[raw] * powers[: len(raw)], dtype=np.uint64)))
        hashes = mix((sums[stops] - sums[starts]) * inverse[starts])
        counts = np.diff(np.searchsorted(starts, cuts))
        yield first, hashes, counts
        first = last
