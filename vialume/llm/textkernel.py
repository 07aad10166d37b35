"""Hashes and counts over the UTF-8 bytes of an Arrow column of texts, without a Python loop per word.

Words are runs of bytes other than space and 0x09 to 0x0D, which never occur inside a longer
UTF-8 character. A hash of a run of bytes is a polynomial over random values of the bytes, modulo
2**64, mixed at the end; equal runs have equal hashes in every process.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SEGMENT = 1 << 20
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_STEP = (_rng.integers(1, 2**63, 8, dtype=np.uint64) * U(2) + U(1))
_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 2**64)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SEGMENT + 1)
        have = np.empty(size, dtype=np.uint64)
        have[0] = 1
        filled = 1
        while filled < size:  # doubling: p^(i+k) = p^i * p^k
            take = min(filled, size - filled)
            have[filled:filled + take] = have[:take] * U(pow(base, filled, 2**64))
            filled += take
        _powers[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    everything = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return everything[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``size`` bytes, one text at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes; runs are in order and do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, side="right")))
        base, stop = int(starts[i]), int(ends[j - 1])
        if stop - base > SEGMENT:  # one very long run
            out[i] = int.from_bytes(hashlib.blake2b(data[base:stop].tobytes(), digest_size=8).digest(), "little")
        else:
            values = np.zeros(stop - base + 1, dtype=np.uint64)
            np.cumsum(_BYTE[data[base:stop]] * _power(_P, stop - base)[:stop - base], out=values[1:])
            s, e = starts[i:j] - base, ends[i:j] - base
            out[i:j] = mix((values[e] - values[s]) * _power(_PINV, stop - base + 1)[s] + (e - s).astype(np.uint64))
        i = j
    return out


class Words:
    """Words of some texts: where they start and end, and the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        n = len(data)
        space = _IS_SPACE[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        self.starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])) | ~space & edge[:-1]) if n else np.zeros(0, np.int64)
        self.ends = np.flatnonzero(~space & (np.concatenate((space[1:], [True])) | edge[1:])) + 1 if n else np.zeros(0, np.int64)
        self.space = space
        self.first = np.searchsorted(self.starts, offsets)  # of text i: words first[i] to first[i + 1]

    def hashes(self) -> np.ndarray:
        return run_hashes(self.data, self.starts, self.ends)


def windows(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Hash of the ``k`` words from each position; the last ``k - 1`` positions are left out."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out += words[j:j + n] * _STEP[j]
    return mix(out)


def shingle_set(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of ``k`` words in a row; of fewer words the whole sequence is one."""
    if 0 < len(words) < k:
        total = U(len(words))
        with np.errstate(over="ignore"):
            for j, w in enumerate(words):
                total = total + w * _STEP[j]
        return mix(np.array([total], dtype=np.uint64))
    return np.unique(windows(words, k))


def text_windows(texts: pa.Array, lower: bool = True) -> Iterator[tuple[int, np.ndarray]]:
    """Number and shingle set of each text of a column."""
    data, offsets = buffers(texts)
    for i, j in chunks(offsets):
        words = Words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], lower)
        hashes = words.hashes()
        for k in range(j - i):
            yield i + k, shingle_set(hashes[words.first[k]:words.first[k + 1]])
