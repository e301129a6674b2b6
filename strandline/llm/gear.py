"""Content-defined cuts: a gear rolling hash over UTF-8 bytes, computed for a whole batch with array arithmetic."""

from __future__ import annotations

import hashlib

import numpy as np

#: The gear table is derived, not listed: 256 words from a keyed digest.
GEAR = np.frombuffer(b"".join(hashlib.blake2b(bytes([i]), digest_size=4, key=b"gear").digest() for i in range(256)), dtype="<u4").astype(np.uint32)
REACH = 32


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of GEAR[data[i-k]] << k over the last 32 bytes, by doubling the reach five times."""
    h = GEAR[data]
    reach = 1
    while reach < REACH:
        if len(h) > reach:
            h[reach:] = h[reach:] + (h[:-reach] << np.uint32(reach))
        reach *= 2
    return h


def cuts(data: bytes, *, least: int, average: int, most: int) -> list[int]:
    """Ends of the chunks of data, the last being len(data).

    A cut falls after a byte whose hash is below 2^32 / (average - least), at least `least` bytes
    after the last one; without any, after `most` bytes. Cuts never part the bytes of one
    character. Texts up to `least` bytes are one chunk; an empty text has none.
    """
    n = len(data)
    if n <= least:
        return [n] if n else []
    raw = np.frombuffer(data, dtype=np.uint8)
    found = np.flatnonzero(gear_hashes(raw) < np.uint32((1 << 32) // max(1, average - least))) + 1
    out, last, k, found = [], 0, 0, found.tolist()
    while n - last > least:
        while k < len(found) and found[k] < last + least:
            k += 1
        at = min(found[k] if k < len(found) else n, last + most, n)
        while at < n and raw[at] & 0xC0 == 0x80:
            at += 1
        out.append(at)
        last = at
    if last < n:
        out.append(n)
    return out


def chunks(data: bytes, *, least: int, average: int, most: int) -> list[tuple[int, int, bytes]]:
    """(start, size, 128-bit digest) of each chunk."""
    out, at = [], 0
    for end in cuts(data, least=least, average=average, most=most):
        out.append((at, end - at, hashlib.blake2b(data[at:end], digest_size=16).digest()))
        at = end
    return out
