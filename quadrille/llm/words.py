"""Words of many texts at once, as 64-bit hashes, computed on the bytes with numpy.

A word's hash is a polynomial over random 64-bit values of its bytes, taken from prefix sums, and then
mixed; two different words have one hash with a chance of about 2^-60.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_U = np.uint64
#: Bytes handled at once; memory is about 60 times that. A text longer than that is cut at separators.
PIECE = 1 << 20
_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 1 << 64)
_VALUES = np.random.default_rng(20).integers(1, 1 << 64, 256, dtype=np.uint64) | _U(1)

#: ASCII upper case to lower case, byte by byte; other bytes stay.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: [\x20\x09-\x0D]
WHITE = separators((0x20, 0x20), (0x09, 0x0D))
#: [\x00-\x2F\x3A-\x60\x7B-\x7F]
NOT_ALNUM = separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    up = np.ones(1, _U)
    down = np.ones(1, _U)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_Powers.up) < n:
        size = max(n, PIECE + 4096)
        for name, base in (("up", _R), ("down", _R_INV)):
            out = np.full(size, base, _U)
            out[0] = 1
            setattr(_Powers, name, np.multiply.accumulate(out))
    return _Powers.up, _Powers.down


class Words:
    """Of a piece: starts and ends in bytes, and hashes. prefix(n) hashes the first n bytes of each word."""

    def __init__(self, data: bytes, sep: np.ndarray):
        raw = np.frombuffer(data, np.uint8)
        self.low = FOLD[raw]
        inside = np.empty(len(raw) + 2, bool)
        inside[0] = inside[-1] = False
        np.logical_not(sep[self.low], out=inside[1:-1])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        up, self._down = _powers(len(raw) + 1)
        self._sums = np.zeros(len(raw) + 1, _U)
        np.cumsum(_VALUES[self.low] * up[: len(raw)], out=self._sums[1:])
        self.hashes = self._hash(self.ends)

    def _hash(self, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[self.starts]) * self._down[self.starts] + (ends - self.starts).astype(_U))

    def prefix(self, n: int) -> np.ndarray:
        return self._hash(np.minimum(self.starts + n, self.ends))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of ranges of bytes, as they are."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_VALUES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


def pieces(text: bytes, sep: np.ndarray) -> Iterator[bytes]:
    """Pieces of one long text, cut before a separator."""
    at = 0
    while len(text) - at > PIECE:
        end, step = at + PIECE, 1 << 14
        cut = -1
        while cut < 0 and end < len(text):
            found = np.flatnonzero(sep[np.frombuffer(text, np.uint8, min(step, len(text) - end), end)])
            cut = end + int(found[0]) if len(found) else -1
            end += step
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def groups(texts: Sequence[bytes | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that make up about a piece."""
    a, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or b"")
        if i > a and size + n > PIECE:
            yield a, i
            a, size = i, 0
        size += n + 1
    if a < len(texts):
        yield a, len(texts)


def words_of(texts: Sequence[bytes | None], sep: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(a, b, bounds, hashes): the words of texts[a:b]; those of text a + i are hashes[bounds[i]:bounds[i + 1]]."""
    gap = bytes([int(np.flatnonzero(sep)[0])])
    for a, b in groups(texts):
        part = [t or b"" for t in texts[a:b]]
        if b - a == 1 and len(part[0]) > PIECE:
            hashes = np.concatenate([Words(x, sep).hashes for x in pieces(part[0], sep)])
            yield a, b, np.array([0, len(hashes)]), hashes
            continue
        w = Words(gap.join(part), sep)
        offsets = np.cumsum([0] + [len(t) + 1 for t in part])
        yield a, b, np.searchsorted(w.starts, offsets), w.hashes


def shingles(h: np.ndarray, bounds: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """Of each text its distinct hashed n-word shingles, sorted; of fewer words, one of the whole sequence; of none, none."""
    if len(h) >= n:
        s = np.zeros(len(h) - n + 1, _U)
        for k in range(n):
            s += h[k : k + len(s)] * _U((_R * (2 * k + 3)) % (1 << 64) | 1)
        s = mix(s)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= n:
            out = np.sort(s[a : b - n + 1])
            yield out[np.concatenate(([True], out[1:] != out[:-1]))]
        elif b > a:
            with np.errstate(over="ignore"):
                x = _U(b - a)
                for v in h[a:b]:
                    x = mix((x * _U(_R) + v).reshape(1))[0]
            yield np.array([x], _U)
        else:
            yield np.empty(0, _U)


def utf8(column) -> list[bytes | None]:
    """An Arrow string column's values as bytes."""
    import pyarrow as pa

    return column.cast(pa.large_binary()).to_pylist()
