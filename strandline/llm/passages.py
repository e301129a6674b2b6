"""Substring dedup by content: chunks cut by a gear rolling hash, compared by digest, later copies removed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .gear import cuts

#: Chunk sizes in bytes, and the least run of repeated chunks that counts as a passage.
LEAST, AVERAGE, MOST, MIN_RUN = 24, 56, 256, 96


def text_key(text: Column) -> Column:
    """Tells rows of one doc_id apart; not relied on beyond that."""
    return F.xxhash64(text)


def chunk_rows(docs: DataFrame) -> DataFrame:
    """docs(doc_id, tkey, text) to a row a chunk: digest, doc_id, tkey, start, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                digests, starts, sizes, counts = [], [], [], []
                for text in b.column(2).to_pylist():
                    data = text.encode()
                    ends = cuts(data, least=LEAST, average=AVERAGE, most=MOST)
                    a = 0
                    for e in ends:
                        digests.append(xxhash.xxh3_128_digest(data[a:e]))
                        a = e
                    ends = np.array(ends, np.int32)
                    begins = np.concatenate([np.zeros(1, np.int32), ends[:-1]]) if len(ends) else ends
                    starts.append(begins)
                    sizes.append(ends - begins)
                    counts.append(len(ends))
                row = pa.array(np.repeat(np.arange(b.num_rows), counts))
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), b.column(0).take(row), b.column(1).take(row), pa.array(np.concatenate(starts), pa.int32()), pa.array(np.concatenate(sizes), pa.int32())], names=["digest", "doc_id", "tkey", "start", "n"])

    return docs.mapInArrow(run, "digest binary, doc_id long, tkey long, start int, n int")


def _runs(parts: list[dict] | None, later_only: bool, size: int, least: int) -> list[tuple[int, int]]:
    """Maximal runs of touching chunks of `least` bytes or more, or over the whole text of `size` bytes."""
    out: list[list[int]] = []
    for p in sorted(parts or (), key=lambda p: p["start"]):
        if later_only and not p["later"]:
            continue
        if out and out[-1][1] == p["start"]:
            out[-1][1] += p["n"]
        else:
            out.append([p["start"], p["start"] + p["n"]])
    return [(a, z) for a, z in out if z - a >= least or (a, z) == (0, size)]


def chunk_dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = MIN_RUN) -> DataFrame:
    """Remove passages that an earlier document, or an earlier part of the same one, already holds.

    Returns doc_id, n_bytes, n_repeated (bytes in passages that occur twice or more, the first
    copy included), n_removed, n_spans and kept, the text that is left; one row for each row of
    docs. Earlier means a smaller (doc_id, digest of the text, offset); null ids come first. A
    passage is a run of `least` bytes or more of adjacent chunks whose digests occur elsewhere, or a
    whole text of such chunks, however short;
    chunk borders follow the content, so insertions shift nothing. Cuts fall between characters.
    Null texts count as empty and lose nothing; rows equal in doc_id and text are one document;
    doc_id is read as a long; an empty table gives an empty result; other columns are ignored,
    whatever their names.

    Digests are counted with a combining aggregate, so a digest that a third of the documents
    share is one row a task; they meet their chunks again in a join that adaptive execution
    splits where a digest is hot. Only a document's own repeated chunks are gathered.
    """
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).withColumn("tkey", text_key(F.col("text"))).select("doc_id", "tkey", "text")
    rows = chunk_rows(source)
    where = F.struct("doc_id", "tkey", "start")
    repeated = rows.groupBy("digest").agg(F.min(where).alias("first"), F.max(where).alias("last")).where("first != last").select("digest", "first")
    marked = rows.join(repeated, "digest").select("doc_id", "tkey", "start", "n", (where != F.col("first")).alias("later"))
    by_doc = marked.groupBy(F.col("doc_id").alias("d"), F.col("tkey").alias("k")).agg(F.collect_set(F.struct("start", "n", "later")).alias("parts"))
    joined = source.join(by_doc, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tkey") == F.col("k")), "left").select("doc_id", "text", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 500):
                b = whole.slice(begin, 500)
                out = []
                for t, parts in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                    data = t.encode()
                    cut = _runs(parts, True, len(data), least)
                    left, at = [], 0
                    for a, z in cut:
                        left.append(data[at:a])
                        at = z
                    left.append(data[at:])
                    out.append((len(data), sum(z - a for a, z in _runs(parts, False, len(data), least)), sum(z - a for a, z in cut), len(cut), b"".join(left).decode()))
                cols = list(zip(*out, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string())], names=["doc_id", "n_bytes", "n_repeated", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_repeated long, n_removed long, n_spans long, kept string")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document, the text that is left as a digest."""
    done = chunk_dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_repeated", "n_removed", "n_spans", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def brute_force(docs: list[tuple], least: int = LEAST, average: int = AVERAGE, most: int = MOST) -> dict:
    """The same by dictionaries, for small tests: {doc_id: (n_bytes, n_removed, n_spans, sha256)} of documents with distinct ids."""
    first: dict[bytes, tuple] = {}
    cut = {}
    for i, t in sorted(docs):
        data, at, parts = (t or "").encode(), 0, []
        for e in cuts(data, least=least, average=average, most=most):
            parts.append({"start": at, "n": e - at, "later": data[at:e] in first})
            first.setdefault(data[at:e], (i, at))
            at = e
        gone = _runs(parts, True, len(data), MIN_RUN)
        left = bytearray()
        at = 0
        for a, z in gone:
            left += data[at:a]
            at = z
        left += data[at:]
        cut[i] = (len(data), sum(z - a for a, z in gone), len(gone), hashlib.sha256(left).hexdigest())
    return cut
