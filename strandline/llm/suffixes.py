"""Exact substring dedup: bytes under any string of WIDTH bytes that starts anywhere else are removed.

Sorting every suffix by the difference-cover recursion costs more than the job may (see the README
for figures). What is kept of it is its core: a sample of positions such that equal
strings hold it at equal offsets, names for what surrounds a sampled position, and a comparison of
adjacent sorted strings for the rest. The sample here follows the content instead of position
modulo 3, so one round of naming settles every string and nothing is left to recurse on.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, table
from .gear import REACH, gear_hashes

WIDTH = 200
#: Distinct surroundings of one sampled gram that a task compares at once; more are compared through a shuffle of all their strings.
GROUP = 4000
_U = np.uint64


def sample(data: bytes, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions sampled from data, and the first and last start of the strings of width bytes that each stands for.

    A string stands under the leftmost of its 32-byte grams with the smallest hash, so equal
    strings stand under equal grams at equal offsets, and each string under one position.
    """
    n = len(data)
    if n < width:
        none = np.zeros(0, np.int64)
        return none, none, none
    h = gear_hashes(np.frombuffer(data, np.uint8))[REACH - 1 :].astype(np.uint64)
    h = (h * _U(0x9E3779B1)) & _U(0xFFFFFFFF)
    key = ((h ^ (h >> _U(15))) << _U(32)) | np.arange(len(h), dtype=np.uint64)
    span, reach = width - REACH + 1, 1
    while reach * 2 <= span:
        key = np.minimum(key[:-reach], key[reach:])
        reach *= 2
    if reach < span:
        key = np.minimum(key[: len(key) - (span - reach)], key[span - reach :])
    at = (key & _U(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(at) - 1]])
    return at[first], first, last


_ANCHORS = "gram long, name binary, doc_id long, tkey long, first int, last int"


def anchor_rows(docs: DataFrame) -> DataFrame:
    """docs(doc_id, tkey, text) to a row a sampled position: its gram, the name of all bytes of its strings, their starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 500):
                b = whole.slice(begin, 500)
                grams, names, firsts, lasts, counts = [], [], [], [], []
                for text in b.column(2).to_pylist():
                    data = text.encode()
                    at, first, last = sample(data)
                    grams += [xxhash.xxh3_64_intdigest(data[p : p + REACH]) for p in at.tolist()]
                    names += [xxhash.xxh3_128_digest(data[a : z + WIDTH]) for a, z in zip(first.tolist(), last.tolist(), strict=True)]
                    firsts.append(first)
                    lasts.append(last)
                    counts.append(len(at))
                row = pa.array(np.repeat(np.arange(b.num_rows), counts))
                yield pa.RecordBatch.from_arrays([pa.array(np.array(grams, np.uint64).view(np.int64)), pa.array(names, pa.binary()), b.column(0).take(row), b.column(1).take(row), pa.array(np.concatenate(firsts).astype(np.int32)), pa.array(np.concatenate(lasts).astype(np.int32))], names=["gram", "name", "doc_id", "tkey", "first", "last"])

    return docs.mapInArrow(run, _ANCHORS)


def _same_doc() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tkey") == F.col("k"))


def _surroundings(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of all strings of wanted(gram, doc_id, tkey, first, last, single)."""
    by_doc = wanted.groupBy(F.col("doc_id").alias("d"), F.col("tkey").alias("k")).agg(F.collect_list(F.struct("gram", "first", "last", "single", "large")).alias("parts"))
    joined = docs.join(by_doc, _same_doc()).select("doc_id", "tkey", "text", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 200):
                b = whole.slice(begin, 200)
                out, row = [], []
                for k, (text, parts) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
                    data = text.encode()
                    out += [(p["gram"], p["first"], p["single"], p["large"], data[p["first"] : p["last"] + WIDTH]) for p in parts]
                    row += [k] * len(parts)
                cols = list(zip(*out, strict=True)) or [[]] * 5
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), b.column(0).take(take), b.column(1).take(take), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.bool_()), pa.array(cols[3], pa.bool_()), pa.array(cols[4], pa.binary())], names=["gram", "doc_id", "tkey", "first", "single", "large", "data"])

    return joined.mapInArrow(run, "gram long, doc_id long, tkey long, first int, single boolean, large boolean, data binary")


def _adjacent(rows: DataFrame) -> DataFrame:
    """Within each gram, sort all strings and compare neighbours: runs (doc_id, tkey, a, z) of the bytes under strings that occur twice, of rows marked single."""

    def repeated(group: list[dict]) -> list[tuple]:
        data = [np.frombuffer(g["data"], np.uint8) for g in group]
        strings = np.concatenate([np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(d, WIDTH)) for d in data]).view(f"V{WIDTH}").ravel()
        order = np.argsort(strings, kind="stable")
        same = strings[order[1:]] == strings[order[:-1]]
        twice = np.zeros(len(strings), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        out, at = [], 0
        for g, d in zip(group, data, strict=True):
            n = len(d) - WIDTH + 1
            if g["single"]:
                hit = np.flatnonzero(twice[at : at + n])
                if len(hit):
                    cut = np.flatnonzero(np.diff(hit) > WIDTH) + 1
                    out += [(g["doc_id"], g["tkey"], g["first"] + int(x[0]), g["first"] + int(x[-1]) + WIDTH) for x in np.split(hit, cut)]
            at += n
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pack(out: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["doc_id", "tkey", "a", "z"])

        group: list[dict] = []
        for b in batches:
            out: list[tuple] = []
            for row in b.to_pylist():
                if group and group[0]["gram"] != row["gram"]:
                    out += repeated(group)
                    group = []
                group.append(row)
            yield pack(out)
        if group:
            yield pack(repeated(group))

    return rows.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, "doc_id long, tkey long, a int, z int")


def _exploded(rows: DataFrame) -> DataFrame:
    """The same for grams with very many surroundings: every string by its digest, in an aggregate that combines on the map side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                n = len(r["data"]) - WIDTH + 1
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(r["data"][i : i + WIDTH]) for i in range(n)], pa.binary()), pa.array([r["doc_id"]] * n, pa.int64()), pa.array([r["tkey"]] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32) + r["first"]), pa.array([r["single"]] * n)], names=["name", "doc_id", "tkey", "a", "single"])

    strings = rows.mapInArrow(run, "name binary, doc_id long, tkey long, a int, single boolean")
    often = strings.groupBy("name").agg(F.count("*").alias("c")).where("c > 1").select("name")
    return strings.where("single").join(often, "name").select("doc_id", "tkey", "a", (F.col("a") + WIDTH).alias("z"))


def repeated_runs(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """Runs (doc_id, tkey, a, z) that cover the bytes of docs(doc_id, tkey, text) under repeated strings; runs may overlap."""
    rows = anchor_rows(docs)
    half = F.conv(F.substring(F.hex("name"), 1, 15), 16, 10).cast("long")
    # Aggregates are written before they meet the rows: a join of two plain exchanges is split where a key is hot.
    grams = keep(rows.groupBy("gram").agg(F.count("*").alias("c"), F.min(half).alias("lo"), F.max(half).alias("hi")).where("c > 1").select("gram", (F.col("lo") != F.col("hi")).alias("several")), "grams")
    met = keep(rows.join(grams, "gram"), "anchors")
    span = [F.col("first").alias("a"), (F.col("last") + WIDTH).alias("z")]
    alike = met.where("NOT several").select("doc_id", "tkey", *span)
    several = met.where("several")
    named = keep(several.groupBy("gram", "name").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "tkey", "first", "last")).alias("one")), "named")
    whole = several.join(named.where("c > 1").select("gram", "name"), ["gram", "name"]).select("doc_id", "tkey", *span)
    sizes = keep(named.groupBy("gram").agg(F.count("*").alias("names")), "name-counts")
    wanted = named.join(sizes, "gram").select("gram", "one.doc_id", "one.tkey", "one.first", "one.last", (F.col("c") == 1).alias("single"), (F.col("names") > group).alias("large"))
    around = keep(_surroundings(docs, wanted), "around")
    edges = _adjacent(around.where("NOT large")).union(_exploded(around.where("large")))
    return alike.union(whole).union(edges)


def exact_dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """Remove from every text, as UTF-8 bytes, each byte under a string of WIDTH bytes that also starts anywhere else.

    Returns doc_id, n_bytes, n_removed, n_spans and kept (binary: a cut may part a character), one
    row for each row of docs. Every copy goes, the first included; strings are judged on the input;
    matches stay within a document and may overlap, in the same document too. Texts shorter than
    WIDTH and null texts lose nothing. Every row is a document of its own, so rows that are equal
    lose their long texts; null ids are kept; other columns are ignored, whatever their names; an empty
    table gives an empty result.
    """
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).withColumn("tkey", F.xxhash64("text")).select("doc_id", "tkey", "text")
    runs = repeated_runs(source, group)
    by_doc = runs.groupBy(F.col("doc_id").alias("d"), F.col("tkey").alias("k")).agg(F.collect_set(F.struct("a", "z")).alias("runs"))
    joined = source.join(by_doc, _same_doc(), "left").select("doc_id", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 500):
                b = whole.slice(begin, 500)
                out = [_cut(t.encode(), [(r["a"], r["z"]) for r in runs or ()]) for t, runs in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
                cols = list(zip(*out, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def _cut(data: bytes, runs: list[tuple[int, int]]) -> tuple:
    """(n_bytes, n_removed, n_spans, what is left) of data without its runs."""
    left, at, removed, spans = [], 0, 0, 0
    end = -1
    for a, z in sorted(runs):
        if a > end:
            spans += 1
            left.append(data[at:a])
            removed += z - a
            at = end = z
        elif z > end:
            removed += z - end
            at = end = z
    left.append(data[at:])
    return len(data), removed, spans, b"".join(left)


def op9_exact_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document, what is left as a digest."""
    return exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(docs: list[tuple], width: int = WIDTH) -> list[tuple]:
    """The same by a dictionary of all strings, for small tests: (doc_id, n_bytes, n_removed, n_spans, sha256)."""
    texts = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(d[s : s + width] for _, d in texts for s in range(len(d) - width + 1))
    out = []
    for i, d in texts:
        n, removed, spans, left = _cut(d, [(s, s + width) for s in range(len(d) - width + 1) if seen[d[s : s + width]] > 1])
        out.append((i, n, removed, spans, hashlib.sha256(left).hexdigest()))
    return out
