"""Lists of whole numbers as bytes: seven bits a byte, low ones first; the top bit says that more follow."""

from __future__ import annotations

import numpy as np


def pack(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all numbers (0 or more, below 2**63), and where each number's bytes end."""
    values = numbers.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    bits, top = 7, int(values.max(initial=0))
    while top >> bits:
        sizes += values >= np.uint64(1 << bits)
        bits += 7
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    first = ends - sizes
    for k in range(int(sizes.max(initial=0))):
        has = np.flatnonzero(sizes > k) if k else slice(None)
        more = (sizes[has] > k + 1).astype(np.uint8) << 7
        out[first[has] + k] = ((values[has] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | more
    return out, ends


def unpack(content: bytes) -> np.ndarray:
    raw = np.frombuffer(content, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    last = np.flatnonzero(raw < 128)
    first = np.concatenate([[0], last[:-1] + 1])
    sizes = last - first + 1
    values = (raw[first] & 127).astype(np.int64)
    for k in range(1, int(sizes.max())):
        has = np.flatnonzero(sizes > k)
        values[has] |= (raw[first[has] + k] & 127).astype(np.int64) << (7 * k)
    return values


def gaps(numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Differences within sorted lists that stand one after the other; ``starts`` are their first places."""
    out = numbers.astype(np.int64)
    out[1:] -= numbers[:-1].astype(np.int64)
    out[starts] = numbers[starts]
    return out


def pack_sorted(numbers: np.ndarray) -> bytes:
    return pack(gaps(numbers, np.zeros(min(1, len(numbers)), np.int64)))[0].tobytes()


def unpack_sorted(content: bytes) -> np.ndarray:
    return np.cumsum(unpack(content))
