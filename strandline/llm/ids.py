"""Token-id files: raw id payloads by shard, found by document key through a minimal perfect hash with stored fingerprints."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import default_tokenizer, encoder
from .common import shared_dir, table

MAGIC = b"TIDX0001"
#: Bits a key has on each level of the hash.
GAMMA = 2.0
_U = np.uint64


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser over keys and a seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + _U((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


#: Bits between two stored ranks of a level.
BLOCK = 512


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: levels of bit arrays, each taking the keys that meet no other there; a key's slot is the rank of its bit."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, levels = keys.astype(np.uint64), []
        while len(left):
            m = max(64, int(GAMMA * len(left)))
            at = (_mix(left, len(levels)) % _U(m)).astype(np.int64)
            hits = np.bincount(at, minlength=m)
            levels.append(hits == 1)
            left = left[hits[at] > 1]
            if len(levels) > 200:
                raise ValueError("keys of a shard are not distinct")
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key that the hash was built from."""
        out, left, base = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys)), 0
        for level, bits in enumerate(self.levels):
            at = (_mix(keys[left].astype(np.uint64), level) % _U(len(bits))).astype(np.int64)
            hit = bits[at]
            out[left[hit]] = base + np.cumsum(bits)[at[hit]] - 1
            left, base = left[~hit], base + int(bits.sum())
        return out

    def pack(self) -> tuple[list[int], bytes, bytes]:
        """(bits of each level, the levels' bits in whole blocks, the rank before each block)."""
        sizes, rows, ranks, total = [], [], [], 0
        for bits in self.levels:
            padded = np.zeros(-(-len(bits) // BLOCK) * BLOCK, bool)
            padded[: len(bits)] = bits
            inside = padded.reshape(-1, BLOCK).sum(axis=1)
            ranks.append(total + np.cumsum(inside) - inside)
            total += int(bits.sum())
            sizes.append(len(bits))
            rows.append(np.packbits(padded))
        join = lambda parts, kind: np.concatenate(parts).astype(kind).tobytes() if parts else b""
        return sizes, join(rows, np.uint8), join(ranks, "<u8")


def row_keys(doc_ids: np.ndarray, nulls: np.ndarray, copy: np.ndarray) -> np.ndarray:
    """Distinct 64-bit keys of (doc_id, copy): copy counts rows of one doc_id from 0; null ids have keys of their own. Copy 0 of an id is a bijection of it, so keys of ids without copies never meet."""
    plain = _mix(doc_ids.view(np.uint64), 1000)
    with np.errstate(over="ignore"):
        odd = _mix(plain + copy.astype(np.uint64) * _U(0xD6E8FEB86659FD93) + nulls.astype(np.uint64) * _U(0xA0761D6478BD642F), 1001)
    return np.where((copy > 0) | nulls, odd, plain)


def write_index(keys: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> bytes:
    """Header, the hash's bits and block ranks, then by slot a 32-bit fingerprint, a 64-bit start and a 32-bit count."""
    hashed = PerfectHash.build(keys)
    slot = hashed.slots(keys)
    prints, at, n = np.zeros(len(keys), "<u4"), np.zeros(len(keys), "<u8"), np.zeros(len(keys), "<u4")
    prints[slot] = (_mix(keys, 77) >> _U(32)).astype("<u4")
    at[slot], n[slot] = starts, counts
    sizes, bits, ranks = hashed.pack()
    return b"".join([MAGIC, np.array([len(keys), len(sizes), *sizes], "<u8").tobytes(), bits, ranks, prints.tobytes(), at.tobytes(), n.tobytes()])


class Index:
    """Keyed access to a shard: each key costs a few probes of one block of bits, one stored rank, one fingerprint and one slice of the payload.

    Only the header is read when it is opened. Few keys read just the blocks and slots they meet;
    many keys read the sections whole, once.
    """

    def __init__(self, file):
        self.file = file
        if self._bytes(0, 8) != MAGIC:
            raise ValueError("not an index of token ids")
        n, levels = (int(x) for x in np.frombuffer(self._bytes(8, 16), "<u8"))
        self.n, self.sizes = n, np.frombuffer(self._bytes(24, 8 * levels), "<u8").astype(np.int64)
        blocks = -(-self.sizes // BLOCK)
        self.first_block = np.cumsum(blocks) - blocks
        at, self.sections = 24 + 8 * levels, {}
        for name, kind, rows in (("bits", np.dtype((np.uint8, BLOCK // 8)), int(blocks.sum())), ("ranks", np.dtype("<u8"), int(blocks.sum())), ("prints", np.dtype("<u4"), n), ("starts", np.dtype("<u8"), n), ("counts", np.dtype("<u4"), n)):
            self.sections[name] = (at, kind, rows)
            at += kind.itemsize * rows
        self.whole: dict[str, np.ndarray] = {}

    def _bytes(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def _take(self, name: str, rows: np.ndarray) -> np.ndarray:
        start, kind, total = self.sections[name]
        if name not in self.whole and len(rows) * 64 < total:
            base, shape = kind.subdtype or (kind, ())
            each, back = np.unique(rows, return_inverse=True)
            raw = b"".join(self._bytes(start + int(r) * kind.itemsize, kind.itemsize) for r in each)
            return np.frombuffer(raw, base).reshape(len(each), *shape)[back]
        if name not in self.whole:
            base, shape = kind.subdtype or (kind, ())
            self.whole[name] = np.frombuffer(self._bytes(start, kind.itemsize * total), base).reshape(total, *shape)
        return self.whole[name][rows]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, start, count) of each key; a key that isn't held is taken for one with probability 2^-32."""
        keys = keys.astype(np.uint64)
        slot, left = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = (_mix(keys[left], level) % _U(size)).astype(np.int64)
            block, inside = self.first_block[level] + at // BLOCK, at % BLOCK
            bits = np.unpackbits(self._take("bits", block), axis=1)
            hit = bits[np.arange(len(at)), inside] == 1
            before = (bits[hit] * (np.arange(BLOCK) < inside[hit][:, None])).sum(axis=1)
            slot[left[hit]] = self._take("ranks", block[hit]).astype(np.int64) + before
            left = left[~hit]
        ok = slot >= 0
        ok[ok] = self._take("prints", slot[ok]) == (_mix(keys[ok], 77) >> _U(32)).astype(np.uint32)
        starts, counts = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.uint32)
        starts[ok], counts[ok] = self._take("starts", slot[ok]), self._take("counts", slot[ok])
        return ok, starts, counts


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def _publish(uri: str, name: str, data_parts) -> None:
    """Write a file under a name of this attempt, then move it into place: a task that is lost or run twice leaves a whole file or none."""
    system, root = _open(uri)
    system.create_dir(root, recursive=True)
    part = f"{root}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        for x in data_parts:
            out.write(x)
    system.move(part, f"{root}/{name}")


#: first_doc and last_doc bound the doc_ids that aren't null; borders are the shard's first and last key with their numbers of rows.
_MANIFEST = "shard int, n_docs long, n_ids long, first_doc long, last_doc long, id_bytes int, borders array<struct<none:boolean,doc:long,n:long>>"
#: Bytes of text that a shard is planned for.
SHARD_BYTES = 64 << 20


def write_ids(docs: DataFrame, root: str, *, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int = 0, shards: int | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode docs and write their ids, end_id after each document, in ascending doc_id order; returns the manifest, one row a shard.

    docs are dealt out by ranges of doc_id (and of a digest of the text, so that very many copies of
    one id part), into as many shards as the texts fill at shard_bytes each (for little text a shard a core), or as given. Each
    range becomes one shard of three files under root: .ids, the raw ids as 16- or 32-bit
    little-endian integers; .keys, the doc_ids in order; .idx, the index. Ids of null and empty
    texts are the end id alone; null doc_ids come first; rows that repeat a doc_id keep an order by
    the text's digest and are told apart by their copy number, which runs on where an id goes on in
    the next shard. doc_id is read as a long. An empty table writes no shard. Other columns are
    ignored. A task holds one shard's index and a batch of texts, never its payload.
    """
    spark = docs.sparkSession
    path = tokenizer or default_tokenizer()
    size = int(docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0) if not shards else 0
    # Less text than shards of that size for all cores still goes to all of them, a megabyte each at least.
    n = shards or max(1, -(-size // shard_bytes), min(spark.sparkContext.defaultParallelism, size >> 20))
    dealt = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).withColumn("__d", F.xxhash64("text"))
    dealt = dealt.repartitionByRange(n, "doc_id", "__d").sortWithinPartitions("doc_id", "__d").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        enc = encoder(path)
        kind = np.dtype("<u2") if max(len(enc.bytes_of), end_id + 1) <= 1 << 16 else np.dtype("<u4")
        ids, nulls, counts = [], [], []

        def payload():
            for whole in batches:
                for at in range(0, whole.num_rows, 500):
                    b = whole.slice(at, 500)
                    coded = [np.append(np.frombuffer(x, "<u4"), np.uint32(end_id)).astype(kind) for x in enc.encode(b.column(1).to_pylist())]
                    ids.append(b.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
                    nulls.append(b.column(0).is_null().to_numpy(zero_copy_only=False))
                    counts.append(np.array([len(x) for x in coded], np.int64))
                    yield b"".join(x.tobytes() for x in coded)

        _publish(root, f"{shard:06d}.ids", payload())
        if not ids:
            return
        doc, null, n_of = np.concatenate(ids), np.concatenate(nulls), np.concatenate(counts)
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (null[1:] != null[:-1])
        copy = np.arange(len(doc)) - np.flatnonzero(new)[np.cumsum(new) - 1]
        starts = np.cumsum(n_of) - n_of
        _publish(root, f"{shard:06d}.idx", [write_index(row_keys(doc, null, copy), starts, n_of)])
        _publish(root, f"{shard:06d}.keys", [np.uint64(len(doc)).tobytes(), doc.astype("<i8").tobytes(), null.astype(np.uint8).tobytes(), copy.astype("<u4").tobytes()])
        ends = np.flatnonzero(np.append(new[1:], True))
        borders = [{"none": bool(null[k]), "doc": None if null[k] else int(doc[k]), "n": int(copy[k]) + 1} for k in sorted({int(ends[0]), int(ends[-1])})]
        held = doc[~null]
        row = (shard, len(doc), int(n_of.sum()), int(held[0]) if len(held) else None, int(held[-1]) if len(held) else None, kind.itemsize, borders)
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.struct([("none", pa.bool_()), ("doc", pa.int64()), ("n", pa.int64())])))
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=["shard", "n_docs", "n_ids", "first_doc", "last_doc", "id_bytes", "borders"])

    dealt.mapInArrow(run, _MANIFEST).write.mode("overwrite").parquet(f"{root}/manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{root}/manifest")


def _file(root: str, name: str):
    system, top = _open(root)
    return system.open_input_file(f"{top}/{name}")


def read_ids(spark: SparkSession, root: str) -> DataFrame:
    """All documents of a written set, from its files: doc_id, copy, start (ids of all documents before it), ids binary (little-endian unsigned 32-bit).

    A shard is one task; its keys are looked up through its index and its payload is read in slices.
    """
    shards = spark.read.schema(_MANIFEST).parquet(f"{root}/manifest")
    # One row a shard: the running totals are over shards, not documents. What a shard's first key has in shards before:
    earlier = Window.partitionBy("b.none", "b.doc").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    went = shards.select("shard", F.posexplode("borders").alias("k", "b")).withColumn("went_before", F.coalesce(F.sum("b.n").over(earlier), F.lit(0))).where("k = 0").select("shard", "went_before")
    based = shards.withColumn("base", F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    based = based.join(went, "shard").select("shard", "base", "id_bytes", "went_before").repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, base, width, went_before in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with _file(root, f"{shard:06d}.keys") as f:
                    raw = f.read()
                n = int(np.frombuffer(raw, "<u8", 1)[0])
                doc, null, copy = np.frombuffer(raw, "<i8", n, 8), np.frombuffer(raw, np.uint8, n, 8 + 8 * n).astype(bool), np.frombuffer(raw, "<u4", n, 8 + 9 * n)
                with _file(root, f"{shard:06d}.idx") as f:
                    found, starts, counts = Index(f).find(row_keys(doc, null, copy))
                goes_on = (null == null[0]) & (doc == doc[0])
                if not found.all():
                    raise ValueError(f"shard {shard} of {root}: its index lacks keys")
                with _file(root, f"{shard:06d}.ids") as f:
                    for at in range(0, n, 500):
                        part, out = slice(at, min(n, at + 500)), []
                        for s, c in zip(starts[part].tolist(), counts[part].tolist(), strict=True):
                            f.seek(s * width)
                            out.append(np.frombuffer(f.read(c * width), f"<u{width}").astype("<u4").tobytes())
                        yield pa.RecordBatch.from_arrays([pa.array(doc[part], pa.int64(), mask=null[part]), pa.array(copy[part].astype(np.int64) + np.where(goes_on[part], went_before, 0), pa.int64()), pa.array(starts[part].astype(np.int64) + base, pa.int64()), pa.array(out, pa.binary())], names=["doc_id", "copy", "start", "ids"])

    return based.mapInArrow(run, "doc_id long, copy long, start long, ids binary")


def lookup_ids(keys: DataFrame, root: str) -> DataFrame:
    """The ids of keys(doc_id): doc_id, found, ids; the first copy of each id. A key's shard is searched in the sorted bounds of the manifest, which has one row a shard; keys then go to their shard."""
    spark = keys.sparkSession
    shards = spark.read.schema(_MANIFEST).parquet(f"{root}/manifest").where("first_doc IS NOT NULL").select("shard", "first_doc", "last_doc", "id_bytes").orderBy("shard").toPandas()
    numbers, firsts, lasts, widths = (shards[c].to_numpy(np.int64) for c in ("shard", "first_doc", "last_doc", "id_bytes"))
    wanted = keys.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc = b.column(0).to_numpy()
            # The first shard that doesn't end before the key holds the key's first copy, if any does.
            k = np.searchsorted(lasts, doc)
            ok = k < len(lasts)
            ok[ok] = firsts[k[ok]] <= doc[ok]
            yield pa.RecordBatch.from_arrays([pa.array(numbers[k[ok]].astype(np.int32)), pa.array(widths[k[ok]].astype(np.int32)), pa.array(doc[ok])], names=["shard", "id_bytes", "doc_id"])

    at = wanted.mapInArrow(searched, "shard int, id_bytes int, doc_id long").repartition("shard").sortWithinPartitions("shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard, width, doc = (c.to_numpy() for c in b.columns)
            for s in np.unique(shard):
                mine = shard == s
                ids = doc[mine].astype(np.int64)
                with _file(root, f"{s:06d}.idx") as f:
                    found, starts, counts = Index(f).find(row_keys(ids, np.zeros(len(ids), bool), np.zeros(len(ids), np.uint32)))
                w, out = int(width[mine][0]), []
                with _file(root, f"{s:06d}.ids") as f:
                    for ok, a, c in zip(found.tolist(), starts.tolist(), counts.tolist(), strict=True):
                        if ok:
                            f.seek(a * w)
                        out.append(np.frombuffer(f.read(c * w), f"<u{w}").astype("<u4").tobytes() if ok else None)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.full(len(ids), s, np.int32)), pa.array(out, pa.binary())], names=["doc_id", "shard", "ids"])

    got = at.mapInArrow(run, "doc_id long, shard int, ids binary").where("ids IS NOT NULL").groupBy("doc_id").agg(F.min_by("ids", "shard").alias("ids"))
    return wanted.join(got, "doc_id", "left").select("doc_id", F.col("ids").isNotNull().alias("found"), "ids")


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents' ids and returns, from the files: doc_id, start, n_tokens and ids_crc32."""
    root = f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}"
    write_ids(table(spark, sf_dir, "documents"), root)

    # Built-ins take the digests: a second Python stage would hold a second worker a task beside the reader's.
    return read_ids(spark, root).select("doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
