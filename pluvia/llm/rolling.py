"""Word hashes and rolling window hashes of whole texts, in numpy."""

from __future__ import annotations

import numpy as np

SLICE = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\v\f\r")] = True


def _mixed(seed: int, n: int) -> np.ndarray:
    """n well spread 64-bit numbers (splitmix64)."""
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    return finish(x)


def finish(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each number over all of it."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as many as were asked for."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, self.base)])
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, self.inverse)])
        return self.up[:n], self.down[:n]


_BYTES = _mixed(1, 256)
_IN_WORD = Powers(0x5851F42D4C957F2D)
_WINDOWS = (Powers(0xD1342543DE82EF95), Powers(0xA0761D6478BD642F))


def _slices(text: bytes) -> list[bytes]:
    """Parts of about SLICE bytes that end at white space."""
    parts, at = [], 0
    while len(text) - at > SLICE:
        raw = np.frombuffer(text, np.uint8, offset=at + SLICE)
        ends = np.flatnonzero(_SPACE[raw])
        if not len(ends):
            break
        parts.append(text[at : at + SLICE + int(ends[0])])
        at += len(parts[-1])
    return [*parts, text[at:]]


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word, words being runs of bytes other than ASCII white space."""
    if len(text) > SLICE:
        parts = _slices(text)
        if len(parts) > 1:
            return np.concatenate([word_hashes(p) for p in parts])
    raw = np.frombuffer(text, np.uint8)
    edges = np.flatnonzero(np.diff(_SPACE[raw].view(np.int8), prepend=1, append=1))
    up, down = _IN_WORD.to(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * up[:-1], out=total[1:])
    starts, ends = edges[::2], edges[1::2]
    return finish((total[ends] - total[starts]) * down[starts])


def window_hashes(words: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """A hash of each run of ``width`` words; ``which`` chooses one of two that are independent."""
    if len(words) < width:
        return np.zeros(0, np.uint64)
    up, down = _WINDOWS[which].to(len(words) + 1)
    values = words if which == 0 else finish(words ^ np.uint64(0x2545F4914F6CDD1D))
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return finish((total[width:] - total[:-width]) * down[: len(words) - width + 1])
