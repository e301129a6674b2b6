"""Language-model scores from a probabilistic suffix tree over words, learned and applied in rounds over chunks of documents."""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, shared_dir, table
from .ids import _file, _publish
from .near import _LOWER, _mix

#: Words of context at most; training occurrences that a context has at least, also as a share of all tokens (the P_min of such trees); nats of leave-one-out gain from which it is retained; its parent's distribution counts for WEIGHT * count^GROWTH observations.
DEPTH, LEAST, SHARE, CUT, WEIGHT, GROWTH = 2, 16, 1e-6, 4.0, 4.0, 0.8
#: UTF-8 bytes of text in one chunk, and bytes of text for which there is one bucket of keys.
CHUNK_BYTES, BUCKET_BYTES = 8 << 20, 4 << 20
#: Gains are summed as whole numbers of this part of a nat, so that their order doesn't matter.
NAT = 1 << 16
_U = np.uint64
#: Names of words have all 64 bits, those of sequences and contexts so many less: they are most of what is shuffled.
SHORT = _U(8)


def _pack(x: np.ndarray) -> bytes:
    """64-bit numbers by byte planes: those of small numbers are mostly zeros, which the shuffle's compression takes."""
    return np.ascontiguousarray(x.astype("<i8", copy=False)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack(raw: bytes, kind: str = "<i8") -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(kind).ravel()


def _save(root: str, chunk: str, **arrays: np.ndarray) -> None:
    for name, x in arrays.items():
        raw = x.tobytes() if x.dtype.itemsize == 1 else _pack(x)
        _publish(root, f"{chunk}-{name}", [np.int64(len(raw)).tobytes(), pa.compress(raw, codec="zstd", asbytes=True)])


def _load(root: str, chunk: str, name: str, kind: str = "<i8") -> np.ndarray:
    with _file(root, f"{chunk}-{name}") as f:
        raw = f.read()
    raw = pa.decompress(raw[8:], int(np.frombuffer(raw, "<i8", 1)[0]), codec="zstd", asbytes=True)
    return np.frombuffer(raw, np.uint8) if kind == "u1" else _unpack(raw, kind)


def smoothed(n: np.ndarray, context: np.ndarray, parent: np.ndarray, weight: float) -> np.ndarray:
    """A state's probability of a token: its counts with weight * context^GROWTH observations of the parent's distribution. The more often a context occurs the more words follow it that it was never seen with, in about that proportion."""
    more = weight * np.maximum(context, 0) ** GROWTH
    return (n + more * parent) / (context + more)


class Chunk:
    """The documents of one chunk as arrays over their tokens: word, place in the document, and by level k what is known of the k words before: n, the training count of those words and the token (-1 where the context is too rare), and flag, whether the context is a state."""

    def __init__(self, root: str, name: str, levels: int = 0, flags: int = 0):
        self.root, self.name = root, name
        self.words, self.word = _load(root, name, "words", "<u8"), _load(root, name, "word")
        self.sizes, self.held = _load(root, name, "sizes"), _load(root, name, "held", "u1").astype(bool)
        starts = np.cumsum(self.sizes) - self.sizes
        self.place = np.arange(len(self.word)) - np.repeat(starts, self.sizes)
        self.train = ~np.repeat(self.held, self.sizes)
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.grams = [self.words[self.word]]
        self.n = [_load(root, name, "n0")[self.word] if k == 0 else _load(root, name, f"n{k}") for k in range(levels)]
        self.flag = [None, *[_load(root, name, f"flag{k}", "u1").astype(bool) for k in range(1, flags + 1)]]

    def gram(self, k: int) -> np.ndarray:
        """64-bit names of the k words before each token and the token; names across documents mean nothing."""
        while len(self.grams) <= k:
            with np.errstate(over="ignore"):
                before = np.append(np.zeros(1, np.uint64), self.grams[-1][:-1])
                self.grams.append(_mix(before * _U(0x9E3779B97F4A7C15) + self.grams[0] + _U(len(self.grams))))
        return self.grams[k]

    def context(self, k: int) -> np.ndarray:
        """The training count of the k words before each token, -1 where there are fewer or their last k - 1 are too rare."""
        before = np.append(np.full(1, -1), self.n[k - 1][:-1])
        return np.where(self.place >= k, before, -1)

    def asked(self, r: int, depth: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What round r asks for: tokens whose context of r words is frequent, tokens whose context of r - 1 words is to be tested, the sorted distinct names, and the name of each such token."""
        if r == 0:
            return np.arange(len(self.word)), np.zeros(0, np.int64), self.words, self.word
        events = np.flatnonzero(self.context(r) >= least) if r <= depth else np.zeros(0, np.int64)
        tests = np.flatnonzero(self.n[r - 1] >= 0) if r > 1 else np.zeros(0, np.int64)
        names = [self.gram(r)[events] >> SHORT] if len(events) else []
        if len(tests):
            names.append(_mix(self.gram(r - 2)[tests - 1] ^ _U(0xD6E8FEB86659FD93)) >> SHORT)
        return events, tests, *np.unique(np.concatenate(names or [np.zeros(0, np.uint64)]), return_inverse=True)

    def chance(self, levels: int, tokens: float, words: float, weight: float, without: np.ndarray | float = 0.0) -> np.ndarray:
        """Each token's probability in the longest state of up to `levels` words; `without` occurrences of its own are left out of all counts."""
        p = (self.n[0] - without + 0.1) / (tokens - without + 0.1 * (words + 1))
        for k in range(1, levels + 1):
            with np.errstate(divide="ignore", invalid="ignore"):
                p = np.where(self.flag[k], smoothed(self.n[k] - without, self.context(k) - without, p, weight), p)
        return p


def _rows(chunk: str, names: np.ndarray, values: np.ndarray, bits: int, size: int = 64) -> list[tuple]:
    """A chunk's sorted names of `size` bits, as differences, and their values, by bucket: the names' first bits. A chunk has a row at least."""
    cut = np.searchsorted(names, np.arange(1 << bits, dtype=np.uint64) << _U(size - bits)) if bits else np.zeros(1, np.int64)
    ends = np.append(cut[1:], len(names))
    return [(chunk, b, _pack(np.diff(names[x:y], prepend=_U(0)).view("<i8")), _pack(values[x:y])) for b, (x, y) in enumerate(zip(cut.tolist(), ends.tolist(), strict=True)) if y > x or not b]


_ASKED = "chunk string, bucket int, names binary, amounts binary"
_TOLD = "chunk string, bucket int, sums binary, distinct long, total long"


def _asked_table(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["chunk", "bucket", "names", "amounts"])


def _sum_bucket(rows: pa.Table) -> pa.Table:
    """Sums of one bucket's names over all chunks, given back to each chunk in its own order; and one row of the bucket's distinct names that have something, and their total."""
    parts = [np.cumsum(_unpack(x, "<u8"), dtype=np.uint64) for x in rows.column("names").to_pylist()]
    ends = np.cumsum([len(x) for x in parts])
    names, at = np.unique(np.concatenate(parts), return_inverse=True)
    # Whole numbers below 2^53: exact, whatever the order.
    sums = np.bincount(at, np.concatenate([_unpack(x) for x in rows.column("amounts").to_pylist()]), len(names)).astype(np.int64)
    told = [_pack(sums[at[e - len(x) : e]]) for x, e in zip(parts, ends.tolist(), strict=True)]
    bucket, chunk = rows.column("bucket").to_pylist(), rows.column("chunk").to_pylist()
    n = len(told)
    return pa.table([pa.array([*chunk, None], pa.string()), pa.array([*bucket, bucket[0]], pa.int32()), pa.array([*told, None], pa.binary()), pa.array([None] * n + [int((sums > 0).sum())], pa.int64()), pa.array([None] * n + [int(sums.sum())], pa.int64())], names=["chunk", "bucket", "sums", "distinct", "total"])


def score_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH, least: int = LEAST, share: float = SHARE, cut: float = CUT, weight: float = WEIGHT, folds: int = 10, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, state_words: one row a row of docs.

    Tokens are words, A-Z lower-cased, and one end a document. Documents whose crc32 of the id's
    text leaves a remainder by `folds` are learned from, the others held out. base_score is the
    log10 of add-0.1 unigram probabilities.

    The tree: its root is that unigram distribution. A context of up to `depth` words with `least`
    training occurrences or more, and `share` of all training tokens or more, is tested: over its occurrences, each left out of all counts in
    turn, the log-likelihood it gains over the longest state that is its suffix is summed, which is
    its count times an estimate of their divergence; from `cut` nats on it is a state. A state's
    distribution is its counts smoothed by `weight` * count^0.8 observations of its parent's. A token is scored
    in the longest state that ends before it; state_words is the sum of those lengths.

    Work goes in rounds. A chunk of documents is kept in the shared folder as arrays; in each round a
    chunk sends the distinct names it has (words, then longer and longer word sequences whose
    context is frequent, and contexts under test) with its own sums to buckets by the names' first
    bits, which give back the sums over all chunks. So a frequent word or context is one entry a
    chunk, wherever it occurs, no task holds more than a chunk or a bucket, and a table ends each
    round. Words' names are 64-bit hashes, longer sequences' have 56 bits, so
    one pair of sequences in 2^56 counts as the same. The rows of a round are chunks x buckets: raise both sizes with the
    corpus.

    Null and empty texts have the end only; null ids count as empty ones (held out), and stay null;
    repeated rows count each time and have a row each; an empty table gives an empty one. doc_id is
    read as a long; other columns are ignored.
    """
    spark = docs.sparkSession
    root = f"{shared_dir(spark)}/suffix-tree-{uuid.uuid4().hex}"
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    whole = int(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    bits = min(24, (whole // bucket_bytes).bit_length())

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        known: dict[bytes, int] = {}
        ids, held, sizes, hashes, size = [], [], [], [], 0

        def close() -> pa.Table:
            chunk, (words, word) = uuid.uuid4().hex, np.unique(np.concatenate(hashes), return_inverse=True)
            train = ~np.repeat(np.array(held, bool), sizes)
            none = np.array([x is None for x in ids])
            _save(root, chunk, words=words, word=word, sizes=np.array(sizes), held=np.array(held, np.uint8), ids=np.array([x or 0 for x in ids]), none=none.astype(np.uint8))
            return _asked_table(_rows(chunk, words, np.bincount(word, train, len(words)).astype(np.int64), bits))

        for whole in batches:
            for at in range(0, whole.num_rows, 100):
                part = whole.slice(at, 100)
                split = [t.encode().translate(_LOWER).split() + [b""] for t in part.column(1).to_pylist()]
                if len(known) > 500_000:
                    known.clear()
                new = list(set().union(*split).difference(known))
                known.update(zip(new, map(xxhash.xxh3_64_intdigest, new), strict=True))
                for key, words in zip(part.column(0).to_pylist(), split, strict=True):
                    ids.append(key)
                    held.append(zlib.crc32(b"" if key is None else str(key).encode()) % folds == 0)
                    sizes.append(len(words))
                    hashes.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
                size += sum(map(len, part.column(1).to_pylist())) + 100 * part.num_rows
                if size >= chunk_bytes:
                    yield from close().to_batches()
                    ids, held, sizes, hashes, size = [], [], [], [], 0
        if ids:
            yield from close().to_batches()

    def told(asked: DataFrame) -> DataFrame:
        out = keep(asked.groupBy("bucket").applyInArrow(_sum_bucket, _TOLD), "suffix-tree-sums")
        # What a finished round shuffled is of no more use; Spark deletes it once the driver's JVM has collected its garbage.
        spark._jvm.System.gc()
        return out

    sums = told(rows.mapInArrow(begin, _ASKED))
    found = sums.where("chunk IS NULL").agg(F.sum("distinct"), F.sum("total")).first()
    words, tokens = found[0] or 0, found[1] or 0
    least = max(least, math.ceil(share * tokens))

    def received(rows: pa.Table, r: int) -> Chunk:
        """A chunk with what round r - 1 asked for, and has now been told, in its place."""
        chunk = rows.column("chunk")[0].as_py()
        order = sorted(zip(rows.column("bucket").to_pylist(), rows.column("sums").to_pylist(), strict=True))
        got = np.concatenate([_unpack(x) for _, x in order])
        if r == 1:
            _save(root, chunk, n0=got)
            return Chunk(root, chunk, 1)
        c = Chunk(root, chunk, min(r - 1, depth + 1), max(0, r - 3))
        events, tests, _, at = c.asked(r - 1, depth, least)
        if r - 1 <= depth:
            n = np.full(len(c.word), -1)
            n[events] = got[at[: len(events)]]
            _save(root, chunk, **{f"n{r - 1}": n})
            c.n.append(n)
        if r > 2:
            flag = np.zeros(len(c.word), bool)
            flag[tests] = got[at[len(events) :]] >= cut * NAT
            _save(root, chunk, **{f"flag{r - 2}": flag.astype(np.uint8)})
            c.flag.append(flag)
        return c

    def round_(r: int):
        def run(rows: pa.Table) -> pa.Table:
            c = received(rows, r)
            events, tests, names, at = c.asked(r, depth, least)
            amounts = np.bincount(at[: len(events)], c.train[events], len(names))
            if len(tests):
                k, own = r - 1, c.train.astype(float)
                parent = c.chance(k - 1, tokens, words, weight, own)[tests]
                p = smoothed(c.n[k][tests] - own[tests], c.context(k)[tests] - own[tests], parent, weight)
                gain = np.where(c.train[tests], np.rint(np.log(p / parent) * NAT), 0)
                amounts = amounts + np.bincount(at[len(events) :], gain, len(names))
            return _asked_table(_rows(c.name, names, amounts.astype(np.int64), bits, 64 - int(SHORT)))

        return run

    for r in range(1, depth + 2):
        sums = told(sums.where("chunk IS NOT NULL").groupBy("chunk").applyInArrow(round_(r), _ASKED))

    def finish(rows: pa.Table) -> pa.Table:
        c = received(rows, depth + 2)
        n = len(c.sizes)
        by_doc = lambda x: np.bincount(c.doc, x, n)
        length = np.zeros(len(c.word))
        for k in range(1, depth + 1):
            length[c.flag[k]] = k
        none = _load(root, c.name, "none", "u1").astype(bool)
        cols = [
            pa.array(_load(root, c.name, "ids"), pa.int64(), mask=none),
            pa.array(c.held),
            pa.array(c.sizes),
            pa.array(by_doc(c.n[0] > 0).astype(np.int64)),
            pa.array(np.full(n, tokens, np.int64)),
            pa.array(by_doc(np.log10(c.chance(0, tokens, words, weight)))),
            pa.array(by_doc(np.log10(c.chance(depth, tokens, words, weight)))),
            pa.array(by_doc(length).astype(np.int64)),
        ]
        return pa.table(cols, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "state_words"])

    return sums.where("chunk IS NOT NULL").groupBy("chunk").applyInArrow(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, state_words long")


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base and model scores."""
    return score_documents(table(spark, sf_dir, "documents"))
