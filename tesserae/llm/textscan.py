"""Vectorised scanning of UTF-8 text: words, 64-bit hashes of words, word windows and byte windows."""

from __future__ import annotations

import functools

import numpy as np

U = np.uint64
_A, _B = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F)
_POW_BITS = 16
SEGMENT = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@functools.cache
def _byte_values(lower: bool) -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    if lower:
        codes[65:91] += U(32)
    return mix((codes + U(1)) * _A)


@functools.cache
def _powers(count: int, inverse: bool = False) -> np.ndarray:
    base = int(_B) | 1
    if inverse:
        base = pow(base, -1, 1 << 64)
    out = np.full(count, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@functools.cache
def _is_word_byte(kind: str) -> np.ndarray:
    flags = np.ones(256, dtype=bool)
    if kind == "space":  # [^\x20\x09-\x0D]+
        flags[[0x20, *range(0x09, 0x0E)]] = False
    else:  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
        flags[:0x80] = False
        flags[0x30:0x3A] = flags[0x41:0x5B] = flags[0x61:0x7B] = True
    return flags


def words(data: bytes, kind: str = "space", lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte offsets, and 64-bit hashes, of the words of one text."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = _is_word_byte(kind)[raw]
    if not inside.any():
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(0, dtype=np.uint64)
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    edge = np.concatenate([[0] if inside[0] else [], edge, [len(raw)] if inside[-1] else []]).astype(np.int64)
    starts, ends = edge[0::2], edge[1::2]
    size = ends - starts
    first = np.cumsum(size) - size
    pos = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(first, size)
    weight = _powers(1 << _POW_BITS)[pos & ((1 << _POW_BITS) - 1)]
    if size.max() >> _POW_BITS:
        weight = weight + (pos >> _POW_BITS).astype(np.uint64) * _A
    total = np.add.reduceat(_byte_values(lower)[raw[inside]] * weight, first)
    return starts, ends, mix(total + size.astype(np.uint64) * _B)


def join_windows(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a window from the hashes of its two adjoining parts."""
    return mix(left * _A + (right ^ _B) * _B)


def windows(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of ``length`` items, put together from windows of doubled lengths."""
    if len(h) < length:
        return np.zeros(0, dtype=np.uint64)
    out, have, power, size, left = None, 0, h, 1, length
    while left:
        if left & 1:
            if out is None:
                out, have = power, size
            else:
                n = len(h) - have - size + 1
                out = join_windows(out[:n], power[have : have + n])
                have += size
        left >>= 1
        if left:
            power = join_windows(power[:-size], power[size:])
            size *= 2
    return out[: len(h) - length + 1]


def byte_windows(data: np.ndarray, length: int) -> np.ndarray:
    """Rolling hashes of all windows of ``length`` bytes; at most ``SEGMENT`` + ``length`` bytes at once."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    size = SEGMENT + 4096
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_byte_values(False)[data] * _powers(size)[: len(data)], out=total[1:])
    return mix((total[length:] - total[:-length]) * _powers(size, True)[:n])


def second_hash(parts: np.ndarray, part: int, length: int) -> np.ndarray:
    """Hashes of windows of ``length`` items by those of their first and last ``part`` items, joined the other way round."""
    if not part < length <= 2 * part:
        raise ValueError("the parts must cover the window")
    n = len(parts) - (length - part)
    return join_windows(parts[length - part :], parts[:n]) if n > 0 else np.zeros(0, dtype=np.uint64)


def sliding_anchor(h: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` hashes, the leftmost place of the least (on the upper 44 bits)."""
    low = U((1 << 20) - 1)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    have = 1
    while have * 2 <= width:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    if have < width:
        key = np.minimum(key[: len(key) - (width - have)], key[width - have :])
    return (key & low).astype(np.int64)
