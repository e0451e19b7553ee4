"""Words of UTF-8 texts as 64-bit hashes, by array operations over whole pieces of text.

A text is cut at separator bytes into pieces of about PIECE bytes, so memory beyond the hashes themselves doesn't
grow with the text. Letters A-Z count as a-z. All separators are ASCII, so bytes of longer characters are in words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_U = np.uint64


def splitmix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x + _U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


class WordHasher:
    """separators: 256 booleans; folds A-Z."""

    def __init__(self, separators: np.ndarray):
        lower = np.arange(256)
        lower[65:91] += 32
        self.is_word = ~separators
        self.value = splitmix(lower.astype(np.uint64))
        self.powers = self._powers(64)

    @staticmethod
    def _powers(n: int) -> np.ndarray:
        steps = np.full(n, 0x5851F42D4C957F2D, np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            return np.multiply.accumulate(steps)

    def _piece(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and start offsets of the words of a piece that begins and ends between words."""
        at = np.flatnonzero(self.is_word[data])
        if not len(at):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
        lengths = np.diff(first, append=len(at))
        if lengths.max() >= len(self.powers):
            self.powers = self._powers(int(lengths.max()) * 2)
        inside = np.arange(len(at)) - np.repeat(first, lengths)
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(self.value[data[at]] * self.powers[inside], first)
            return splitmix(sums ^ (lengths.astype(np.uint64) << _U(40))), at[first]

    def text(self, data: np.ndarray) -> np.ndarray:
        """Word hashes of one text, given as its bytes."""
        out, at = [], 0
        while at < len(data):
            end = at + PIECE
            if end < len(data):
                while end < len(data) and self.is_word[data[end]]:
                    step = np.flatnonzero(~self.is_word[data[end : end + PIECE]])
                    end = end + int(step[0]) if len(step) else min(len(data), end + PIECE)
            out.append(self._piece(data[at:end])[0])
            at = end
        return out[0] if len(out) == 1 else np.concatenate([np.zeros(0, np.uint64), *out])

    def column(self, texts: pa.Array):
        """The word hashes of each text of a column in turn; null texts have no words."""
        texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
        n = len(texts)
        if not n:
            return
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8)
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        null = texts.is_null().to_numpy(zero_copy_only=False)
        row = 0
        while row < n:
            end = int(np.searchsorted(offsets, offsets[row] + PIECE, "right")) - 1
            if end <= row:
                yield np.zeros(0, np.uint64) if null[row] else self.text(data[offsets[row] : offsets[row + 1]])
                row += 1
                continue
            # several short texts at once: a text's border is a separator
            end = min(end, n)
            size = offsets[row : end + 1] - offsets[row]
            gap = np.insert(data[offsets[row] : offsets[end]], size[1:-1], 32)
            hashes, starts = self._piece(gap)
            cuts = np.searchsorted(starts, size[1:-1] + np.arange(len(size) - 2))
            for i, part in enumerate(np.split(hashes, cuts)):
                yield np.zeros(0, np.uint64) if null[row + i] else part
            row = end


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = words[:n].copy()
        for j in range(1, k):
            out = out * _U(0xD1342543DE82EF95) + words[j : j + n]
        return splitmix(out)
