"""Words and word shingles of Arrow text batches as NumPy arrays of 64-bit hashes.

Both word rules used here put every byte from 0x80 up inside a word and every
separator is one ASCII byte, so that splitting UTF-8 bytes equals splitting
characters. Hashes are 64 bits: among a billion different words a pair collides
with a chance of about 3 in 100.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SEATS = _RNG.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Letters and digits of ASCII and all other characters beyond it, upper case among them.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
#: All but the six ASCII white-space characters.
NONSPACE = np.ones(256, bool)
NONSPACE[[32, 9, 10, 11, 12, 13]] = False


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * _MIX
    return h ^ (h >> np.uint64(29))


class Words:
    """The words of a batch of texts: ``doc`` (row in the batch), ``start``/``end`` (bytes in ``data``), ``hash``."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray, inside: np.ndarray):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
        buffer = texts.buffers()[2]
        data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None and n else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0] if n else np.zeros(1, np.int64)
        self.n_docs, self.data = n, data
        mask = inside[data]
        before = np.empty_like(mask)
        before[1:], before[:1] = mask[:-1], False
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
        self.start = np.flatnonzero(mask & ~before)
        after = np.empty_like(mask)
        after[:-1], after[-1:] = mask[1:], False
        last = offsets[1:] - 1
        after[last[last >= 0]] = False
        self.end = np.flatnonzero(mask & ~after) + 1
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        self.bounds = np.searchsorted(self.start, offsets)
        self.hash = self._hashes(LOWER[data[mask]])

    def _hashes(self, letters: np.ndarray) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        lengths = self.end - self.start
        first = np.cumsum(lengths) - lengths
        place = np.arange(len(letters)) - np.repeat(first, lengths)
        power = np.multiply.accumulate(np.full(int(lengths.max()), _STEP))
        return mix(np.add.reduceat(_BYTE[letters] * power[place], first))

    def text(self, i: int) -> str:
        return LOWER[self.data[self.start[i] : self.end[i]]].tobytes().decode("utf-8", "replace")

    def shingle_sets(self, width: int) -> list[np.ndarray]:
        """For each text its sorted distinct hashes of ``width`` consecutive words; of a shorter text all its words are one shingle."""
        h = self.hash
        runs = np.zeros(0, np.uint64)
        if len(h) >= width:
            runs = np.zeros(len(h) - width + 1, np.uint64)
            for j in range(width):
                runs += h[j : len(h) - width + 1 + j] * _SEATS[j]
            runs = mix(runs)
        out = []
        for a, b in zip(self.bounds[:-1], self.bounds[1:]):
            if b - a >= width:
                out.append(np.unique(runs[a : b - width + 1]))
            elif b > a:
                out.append(mix((h[a:b] * _SEATS[: b - a]).sum(keepdims=True) + np.uint64(b - a)))
            else:
                out.append(np.zeros(0, np.uint64))
        return out
