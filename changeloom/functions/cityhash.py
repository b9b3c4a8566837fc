"""CityHash64 (version 1.0.2) over Arrow arrays of bytes.

The published algorithm, computed for all values of a batch at once with numpy: values are
split by length class, words are gathered from Arrow's own buffer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# fixed values of the published algorithm
K0 = np.uint64(0xC3A5C85C97CB3127)
K1 = np.uint64(0xB492B66FBE98F273)
K2 = np.uint64(0x9AE16A3B2F90404F)
K3 = np.uint64(0xC949D7C7509E6557)
KMUL = np.uint64(0x9DDFEA08EB382D69)


def _u(n: int) -> np.uint64:
    return np.uint64(n)


def _rotate(v: np.ndarray, by) -> np.ndarray:
    by = np.asarray(by, np.uint64)
    return (v >> by) | (v << ((_u(64) - by) & _u(63)))


def _mix(v: np.ndarray) -> np.ndarray:
    return v ^ (v >> _u(47))


def _pair(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """128 bits to 64."""
    a = (low ^ high) * KMUL
    a ^= a >> _u(47)
    b = (high ^ a) * KMUL
    b ^= b >> _u(47)
    return b * KMUL


class _Bytes:
    """Little-endian words of the values of one length class."""

    def __init__(self, data: np.ndarray, start: np.ndarray):
        self.data, self.start = data, start

    def word(self, at, size: int = 8) -> np.ndarray:
        place = (self.start + at)[:, None] + np.arange(size)
        return np.ascontiguousarray(self.data[place]).view(f"<u{size}").ravel().astype(np.uint64)


def _weak(b: _Bytes, at, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first, second, third, fourth = (b.word(at + k) for k in (0, 8, 16, 24))
    x = x + first
    y = _rotate(y + x + fourth, 21)
    keep = x
    x = x + second + third
    return x + fourth, y + _rotate(x, 44) + keep


def _to_16(b: _Bytes, n: np.ndarray) -> np.ndarray:
    out = np.full(len(n), K2)
    size = n.astype(np.uint64)
    for low, high in ((1, 3), (4, 8), (9, 16)):
        own = np.flatnonzero((n >= low) & (n <= high))
        if not len(own):
            continue
        part, m, u = _Bytes(b.data, b.start[own]), n[own], size[own]
        if low == 9:
            first, last = part.word(0), part.word(m - 8)
            out[own] = _pair(first, _rotate(last + u, u)) ^ last
        elif low == 4:
            out[own] = _pair(u + (part.word(0, 4) << _u(3)), part.word(m - 4, 4))
        else:
            y = part.word(0, 1) + (part.word(m >> 1, 1) << _u(8))
            z = u + (part.word(m - 1, 1) << _u(2))
            out[own] = _mix(y * K2 ^ z * K3) * K2
    return out


def _to_32(b: _Bytes, n: np.ndarray) -> np.ndarray:
    p, q, r, s = b.word(0) * K1, b.word(8), b.word(n - 8) * K2, b.word(n - 16) * K0
    return _pair(_rotate(p - q, 43) + _rotate(r, 30) + s, p + _rotate(q ^ K3, 20) - r + n.astype(np.uint64))


def _to_64(b: _Bytes, n: np.ndarray) -> np.ndarray:
    def half(p: np.ndarray, z: np.ndarray, more: np.ndarray, last: np.ndarray):
        q, r = _rotate(p + z, 52), _rotate(p, 37)
        p = p + more
        r = r + _rotate(p, 7)
        p = p + last
        return p + z, q + _rotate(p, 31) + r

    head = b.word(0) + (n.astype(np.uint64) + b.word(n - 16)) * K0
    v1, v2 = half(head, b.word(24), b.word(8), b.word(16))
    w1, w2 = half(b.word(16) + b.word(n - 32), b.word(n - 8), b.word(n - 24), b.word(n - 16))
    return _mix(_mix((v1 + w2) * K2 + (w1 + v2) * K0) * K0 + v2) * K2


def _longer(b: _Bytes, n: np.ndarray) -> np.ndarray:
    size = n.astype(np.uint64)
    x, y, z = b.word(0), b.word(n - 16) ^ K1, b.word(n - 56) ^ K0
    v1, v2 = _weak(b, n - 64, size, y)
    w1, w2 = _weak(b, n - 32, size * K1, np.full(len(n), K0))
    z = z + _mix(v2) * K1
    x, y = _rotate(z + x, 39) * K1, _rotate(y, 33) * K1
    blocks = (n - 1) // 64
    order = np.argsort(-blocks, kind="stable")
    state = [a[order] for a in (x, y, z, v1, v2, w1, w2)]
    blocks, start = blocks[order], b.start[order]
    for k in range(int(blocks.max())):
        live = int(np.searchsorted(-blocks, -k))  # rows with more than k blocks stand first
        x, y, z, v1, v2, w1, w2 = (a[:live] for a in state)
        own, at = _Bytes(b.data, start[:live]), 64 * k
        x = _rotate(x + y + v1 + own.word(at + 16), 37) * K1
        y = _rotate(y + v2 + own.word(at + 48), 42) * K1
        x = x ^ w2
        y = y ^ v1
        z = _rotate(z ^ w1, 33)
        v1, v2 = _weak(own, at, v2 * K1, x + w1)
        w1, w2 = _weak(own, at + 32, z + w2, y)
        for a, new in zip(state, (z, y, x, v1, v2, w1, w2), strict=True):
            a[:live] = new
    x, y, z, v1, v2, w1, w2 = state
    out = np.empty(len(n), np.uint64)
    out[order] = _pair(_pair(v1, w1) + _mix(y) * K1 + z, _pair(v2, w2) + x)
    return out


def city_hash64(values: pa.Array) -> np.ndarray:
    """uint64 hash of each value of a string or binary array; a null counts as no bytes."""
    values = values.cast(pa.large_binary()).fill_null(b"")
    if not len(values):
        return np.empty(0, np.uint64)
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    raw = values.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(1, np.uint8)
    start, n = offsets[:-1], np.diff(offsets)
    out = np.empty(len(n), np.uint64)
    with np.errstate(over="ignore"):
        for low, high, work in ((0, 16, _to_16), (17, 32, _to_32), (33, 64, _to_64), (65, None, _longer)):
            own = np.flatnonzero((n >= low) & (n <= high if high else True))
            if len(own):
                out[own] = work(_Bytes(data, start[own]), n[own])
    return out
