"""Local alignment of pairs of sequences, many pairs at a time."""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Scores: a gap of n costs OPEN + (n - 1) * EXTEND.
MATCH, MISMATCH, OPEN, EXTEND = 1.0, -1.0, 2.0, 0.5
LOW = np.float32(-1e9)


def align_batch(queries: list[str], targets: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(score, span in the query) of the best local alignment of each pair, by anti-diagonals over all pairs at once.

    Among alignments of the best score the one that ends first in the query, then the one of the
    shortest span there, counts. Each state carries the query offset its alignment began at, so
    nothing is traced back. Pairs without a match get (0, 0).
    """
    k = len(queries)
    n, m = max(map(len, queries), default=0), max(map(len, targets), default=0)
    if not k or not n or not m:
        return np.zeros(k, np.float32), np.zeros(k, np.int64)
    q = np.zeros((k, n), np.int32)
    t = np.full((k, m), -1, np.int32)
    for i, (a, b) in enumerate(zip(queries, targets, strict=True)):
        q[i, : len(a)] = np.frombuffer(a.encode("utf-32-le"), np.int32) + 1
        t[i, : len(b)] = np.frombuffer(b.encode("utf-32-le"), np.int32) + 1
    # Column i of a diagonal d is the cell (i, d - i), 1-based; 0 is the border.
    shape = (k, n + 1)
    h1, h2 = np.zeros(shape, np.float32), np.zeros(shape, np.float32)
    e1, f1 = np.full(shape, LOW), np.full(shape, LOW)
    s1, s2 = np.zeros(shape, np.int32), np.zeros(shape, np.int32)
    es1, fs1 = np.zeros(shape, np.int32), np.zeros(shape, np.int32)
    best, end, span = np.zeros(k, np.float32), np.zeros(k, np.int64), np.zeros(k, np.int64)
    rows = np.arange(n + 1, dtype=np.int32)
    s1[:], s2[:] = rows, rows
    for d in range(2, n + m + 1):
        lo, hi = max(1, d - m), min(n, d - 1)
        i = np.arange(lo, hi + 1)
        sub = np.where(q[:, i - 1] == t[:, d - i - 1], np.float32(MATCH), np.float32(MISMATCH))
        sub[q[:, i - 1] == 0] = MISMATCH
        diag, ds = h2[:, i - 1] + sub, s2[:, i - 1]

        def better(a, sa, b, sb):
            take = (b > a) | ((b == a) & (sb > sa))
            return np.where(take, b, a), np.where(take, sb, sa)

        e, es = better(h1[:, i] - np.float32(OPEN), s1[:, i], e1[:, i] - np.float32(EXTEND), es1[:, i])
        f, fs = better(h1[:, i - 1] - np.float32(OPEN), s1[:, i - 1], f1[:, i - 1] - np.float32(EXTEND), fs1[:, i - 1])
        h, s = better(diag, ds, e, es)
        h, s = better(h, s, f, fs)
        none = h <= 0
        h, s = np.where(none, np.float32(0), h), np.where(none, i.astype(np.int32), s)
        top = h.max(axis=1)
        length = i[None, :] - s
        order = np.where(h == top[:, None], i[None, :].astype(np.int64) * (n + 1) + length, np.iinfo(np.int64).max)
        at = order.argmin(axis=1)
        where = np.arange(k)
        e_at, l_at = i[at], length[where, at]
        win = (top > best) | ((top == best) & (top > 0) & ((e_at < end) | ((e_at == end) & (l_at < span))))
        best, end, span = np.where(win, top, best), np.where(win, e_at, end), np.where(win, l_at, span)
        nh, ns, ne, nf, nes, nfs = np.zeros(shape, np.float32), np.tile(rows, (k, 1)), np.full(shape, LOW), np.full(shape, LOW), np.zeros(shape, np.int32), np.zeros(shape, np.int32)
        nh[:, i], ns[:, i], ne[:, i], nf[:, i], nes[:, i], nfs[:, i] = h, s, e, f, es, fs
        h2, s2, h1, s1, e1, f1, es1, fs1 = h1, s1, nh, ns, ne, nf, nes, nfs
    return best, span


@dataclass(frozen=True)
class Floors:
    """What an alignment must reach, and what that implies for exact matches.

    An alignment over L query bases of at least the identity f (score / L) has a score of f * L or more. A mismatch
    takes 2 from the L that a perfect one scores, a gap 2 or more, so there are (1 - f) * L / 2 errors
    at most, and each spoils q q-grams at most: L - (q - 1) - q * (1 - f) * L / 2 of the query's
    q-grams match, in the same order in both sequences. A longer alignment has a part of less than
    about two shortest lengths that reaches the identity as well (cut it at matching bases: the
    parts' scores add up). Gaps of n bases cost n / 2 or more, which bounds how far the matches of a
    part stray from one diagonal.
    """

    identity: float
    overlap: int

    @property
    def lost(self) -> float:
        return (1 - self.identity / 100) / 2

    def needed(self, length: int, q: int) -> int:
        return int(np.ceil(length - (q - 1) - q * np.floor(self.lost * length + 1e-9) - 1e-9))

    def gram(self) -> int:
        """The longest q of which an alignment has a match at the least; 0 if none is certain."""
        return max((q for q in range(1, self.overlap + 1) if self.needed(self.overlap, q) >= 1), default=0)

    def windows(self, q: int, longest: int) -> list[tuple[int, int, int]]:
        """(query bases, distance from the diagonal, matches) of parts by their length: a possible pair has one of them."""
        top = min(longest, 2 * self.overlap + int(2 * self.lost * longest / 1.5) + 1)
        out, low = [], self.overlap
        while low <= top:
            high = max(low + 1, low * 5 // 4)
            # The count falls where one more error fits in.
            out.append((high, int(4 * self.lost * high) + 1, max(1, min(self.needed(x, q) for x in range(low, high)))))
            low = high
        return out


def _chain(js: list[int]) -> int:
    """The longest strictly increasing subsequence."""
    ends: list[int] = []
    for j in js:
        k = bisect_left(ends, j)
        ends[k : k + 1] = [j]
    return len(ends)


def possible(query: str, index: dict[str, list[int]], q: int, windows: list[tuple[int, int, int]]) -> bool:
    """Whether an alignment that reaches the floors can be there, by the matches of the query's q-grams with an index of the target's."""
    hits = [(i, j) for i in range(len(query) - q + 1) for j in index.get(query[i : i + q], ())]
    if len(hits) > 1000:
        return True
    for width, band, need in windows:
        for k in range(len(hits) - need + 1):
            i0, j0 = hits[k]
            if hits[k + need - 1][0] - i0 >= width:
                continue
            js = []
            for i, j in hits[k:]:
                if i - i0 >= width:
                    break
                if abs(i - j - i0 + j0) <= band:
                    js.append((i, -j))
            if len(js) >= need and _chain([-j for _, j in sorted(js)]) >= need:
                return True
    return False


def gram_index(target: str, q: int) -> dict[str, list[int]]:
    """Places of a sequence's q-grams, last first."""
    out: dict[str, list[int]] = defaultdict(list)
    for j in range(len(target) - q, -1, -1):
        out[target[j : j + q]].append(j)
    return dict(out)


def align(pairs: DataFrame, query: str = "query", target: str = "target", batch: int = 128, floors: Floors | None = None) -> DataFrame:
    """pairs with align_score, overlap (span in the query) and identity, 100 * score / span, or 0 without an alignment.

    With floors, pairs that can't reach them are left out unaligned; of those that stay some may not reach them.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema.fields) + ", align_score double, overlap long, identity double"
    q = floors.gram() if floors else 0

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, dict[str, list[int]]] = {}
        spans: dict[int, list[tuple[int, int, int]]] = {}

        def kept(a: str, b: str) -> bool:
            if b not in known:
                if len(known) > 2000:
                    known.clear()
                known[b] = gram_index(b, q)
            n = len(a)
            if n not in spans:
                spans[n] = floors.windows(q, n)
            return n >= floors.overlap and possible(a, known[b], q, spans[n])

        held: list[pd.DataFrame] = []

        def aligned(part: pd.DataFrame) -> pd.DataFrame:
            score, span = align_batch(part[query].fillna("").tolist(), part[target].fillna("").tolist())
            part["align_score"] = score.astype(float)
            part["overlap"] = span.astype("int64")
            part["identity"] = np.where(span > 0, np.maximum(0.0, 100.0 * score.astype(float) / np.maximum(span, 1)), 0.0)
            return part

        for frame in frames:
            if q:
                frame = frame[[kept(a or "", b or "") for a, b in zip(frame[query], frame[target], strict=True)]]
            # Few pairs may be left of a frame: they wait for those of the next.
            held.append(frame)
            if sum(map(len, held)) < batch:
                continue
            whole = pd.concat(held)
            for at in range(0, len(whole) // batch * batch, batch):
                yield aligned(whole.iloc[at : at + batch].copy())
            held = [whole.iloc[len(whole) // batch * batch :]]
        if held and sum(map(len, held)):
            yield aligned(pd.concat(held).copy())

    return pairs.mapInPandas(run, schema)
