"""Words and word shingles of whole texts as 64-bit hashes, in numpy.

A word is a longest run of bytes other than space and tab to carriage return, of the UTF-8 text.
Hashes of different words agree with a chance of about 2^-64 per pair.
"""

from __future__ import annotations

import numpy as np

#: Bytes looked at in one step: bounds memory, not the text. Steps end between words.
STEP_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


class WordHasher:
    """Splits texts and hashes their words; keeps the powers it needs."""

    def __init__(self, lower: bool = False):
        self.lower = lower
        self.up = self.down = np.empty(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            self.up = _powers(BASE, n)
            self.down = _powers(np.uint64(pow(int(BASE), -1, 1 << 64)), n)

    def _step(self, data: np.ndarray, starts_row: np.ndarray):
        """Word starts, and word hashes; ``starts_row`` marks the first byte of each text."""
        if self.lower:
            data = np.where((data >= 65) & (data <= 90), data + 32, data)
        space = (data == 32) | ((data >= 9) & (data <= 13))
        inside = ~space
        before = np.concatenate([[True], space[:-1]]) | starts_row
        after = np.concatenate([space[1:] | starts_row[1:], [True]])
        first = np.flatnonzero(inside & before)
        last = np.flatnonzero(inside & after)
        self._grow(len(data))
        sums = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:len(data)],
                         dtype=np.uint64)
        below = np.where(first > 0, sums[first - 1], np.uint64(0))
        return first, mix((sums[last] - below) * self.down[first])

    def words(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words of an Arrow string array in order, and how many each text has."""
        import pyarrow as pa
        import pyarrow.compute as pc
        texts = texts.cast(pa.large_string())
        n = len(texts)
        if not n:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        lengths = np.nan_to_num(np.array(pc.binary_length(texts).to_numpy(
            zero_copy_only=False), np.float64)).astype(np.int64)
        buffers = texts.buffers()
        offsets = np.frombuffer(buffers[1], np.int64)[texts.offset:texts.offset + n + 1]
        data = (np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]]
                if buffers[2] is not None else np.empty(0, np.uint8))
        # A null may have bytes behind it: then take the texts alone.
        if lengths.sum() != len(data):
            return self.words(pa.array([t or "" for t in texts.to_pylist()], pa.large_string()))
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        heads = bounds[:-1][lengths > 0]
        firsts, hashes, at = [], [], 0
        while at < len(data):
            end = self._end(data, bounds, at)
            marks = np.zeros(end - at, bool)
            marks[heads[np.searchsorted(heads, at):np.searchsorted(heads, end)] - at] = True
            first, hashed = self._step(data[at:end], marks)
            firsts.append(first + at)
            hashes.append(hashed)
            at = end
        if not firsts:
            return np.empty(0, np.uint64), np.zeros(n, np.int64)
        edges = np.searchsorted(np.concatenate(firsts), bounds)
        return np.concatenate(hashes), np.diff(edges)

    @staticmethod
    def _end(data: np.ndarray, bounds: np.ndarray, at: int) -> int:
        """Where a step from ``at`` may end: at the end of a text or before a space."""
        want = at + STEP_BYTES
        if want >= len(data):
            return len(data)
        while want < len(data):
            row = bounds[np.searchsorted(bounds, want)]
            stretch = data[want:min(row, want + STEP_BYTES)]
            space = np.flatnonzero((stretch == 32) | ((stretch >= 9) & (stretch <= 13)))
            if len(space):
                return int(want + space[0])
            want += len(stretch)
            if want == row:
                return int(want)
        return len(data)


def word_hash(word: bytes) -> int:
    """The hash of one word, as the hasher gives it."""
    import pyarrow as pa
    return int(WordHasher().words(pa.array([word.decode()]))[0][0])


def shingles(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every k consecutive words of each text, and how many each text has.

    A text with fewer than k words has its whole sequence as its only shingle, one without none.
    """
    n = len(words)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    weights = [mix(np.array([j + 1], np.uint64))[0] | np.uint64(1) for j in range(k)]
    full = np.zeros(n, np.uint64)
    for j in range(min(k, n)):
        full[:n - j] += words[j:] * weights[j]
    # The window of a short text is cut at its end; its length is part of the hash.
    short = np.flatnonzero((counts > 0) & (counts < k))
    sizes = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    keep = np.repeat(bounds[:-1], sizes) + np.arange(sizes.sum()) - np.repeat(
        np.cumsum(sizes) - sizes, sizes)
    out = full[keep]
    at = np.concatenate([[0], np.cumsum(sizes)])
    for i in short:
        own = words[bounds[i]:bounds[i + 1]]
        total = np.uint64(len(own))
        with np.errstate(over="ignore"):
            for j, w in enumerate(own):
                total = total + w * weights[j]
        out[at[i]] = total
    return mix(out), sizes


def distinct(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values of each text, ascending, and how many each text has."""
    rows = np.repeat(np.arange(len(counts)), counts)
    order = np.argsort(values, kind="stable")
    order = order[np.argsort(rows[order], kind="stable")]
    values, rows = values[order], rows[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return values[fresh], np.bincount(rows[fresh], minlength=len(counts)).astype(np.int64)
