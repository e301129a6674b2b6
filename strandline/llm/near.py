"""Near-duplicate documents: fast similarity sketches, banding, verification on full shingle sets, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, components, keep, table

#: Coordinates of a sketch = BANDS x ROWS. A pair at the threshold 0.8 shares no band with probability (1 - 0.8^6)^42 < 3e-6.
BANDS, ROWS = 42, 6
SHINGLE, PERCENT = 5, 80
_U = np.uint64
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def shingle_sets(texts: list[str | None], width: int, known: dict[bytes, int]) -> list[np.ndarray]:
    """Of each text, the sorted distinct 64-bit fingerprints of its width-word shingles, A-Z lower-cased; with fewer words, of the whole sequence; without words, none.

    known keeps 64-bit fingerprints of words. A shingle's fingerprint mixes those of its words in
    order, so unequal shingles share one with probability 2^-64.
    """
    import xxhash

    split = [(t or "").encode().translate(_LOWER).split() for t in texts]
    counts = np.array([len(w) for w in split], np.int64)
    words = [w for ws in split for w in ws]
    if len(known) > 500_000:
        known.clear()
    new = [w for w in set(words) if w not in known]
    known.update(zip(new, map(xxhash.xxh3_64_intdigest, new), strict=True))
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def mixed(parts: list[np.ndarray], size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            out = np.full(len(parts[0]), _U(size))
            for part in parts:
                out = _mix(out * _U(0x9E3779B97F4A7C15) + part)
        return out

    n = max(0, len(h) - width + 1)
    flat = mixed([h[k : k + n] for k in range(width)], width)
    out, at = [], 0
    for c in counts.tolist():
        if c >= width:
            out.append(np.unique(flat[at : at + c - width + 1]))
        else:
            out.append(mixed([h[at + k : at + k + 1] for k in range(c)], c) if c else np.zeros(0, np.uint64))
        at += c
    return out


def sketch(items: np.ndarray, t: int) -> np.ndarray:
    """Fast similarity sketch (Dahlgaard, Knudsen, Thorup, 2017) of a nonempty set: t coordinates.

    In round i < t every item falls into one bin by a hash of (item, i); a bin keeps the smallest
    (round, value) that meets it. Rounds t..2t-1 put every item into bin i - t, so that each
    coordinate fills for certain. Rounds stop when all bins are full: a set of n items needs about
    t ln t / n of them. Coordinates agree between two sets with their Jaccard similarity as mean
    and the concentration of independent samples.
    """
    none = np.iinfo(np.uint64).max
    full = np.full(t, none, np.uint64)
    # Values carry their round in the upper bits, so rounds can be taken several at once: as many as fill the bins, most likely.
    many = max(1, int(1.3 * t * np.log(t) / len(items)))
    many = max(1, min(many, t, 2_000_000 // len(items) + 1))
    with np.errstate(over="ignore"):
        for a in range(0, t, many):
            turn = np.arange(a, min(t, a + many), dtype=np.uint64)[:, None]
            v = _mix(items[None, :] + (turn + _U(1)) * _U(0x9E3779B97F4A7C15))
            np.minimum.at(full, (((v & _U(0xFFFF)) * _U(t)) >> _U(16)).astype(np.int64).ravel(), ((turn << _U(48)) | (v >> _U(16))).ravel())
            if (full != none).all():
                return full
        for b in np.flatnonzero(full == none).tolist():
            i = _U(t + b)
            full[b] = ((i << _U(48)) | (_mix(items + (i + _U(1)) * _U(0x9E3779B97F4A7C15)) >> _U(16))).min()
    return full


def band_keys(coords: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Of each row of coordinates, one 64-bit key a band, the band's number mixed in."""
    parts = coords.reshape(len(coords), bands, rows)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _U(0xD6E8FEB86659FD93), (len(coords), bands))
        for k in range(rows):
            key = _mix(key * _U(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key


_SETS = "doc_id long, n_shingles long, digest binary, keys array<long>"


def sketched(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """docs(doc_id, text) to (doc_id, n_shingles, digest of the set, band keys)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        known: dict[bytes, int] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                sets = shingle_sets(b.column(1).to_pylist(), width, known)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                once = {d: s for d, s in zip(digests, sets, strict=True) if len(s)}
                coords = np.array([sketch(s, bands * rows) for s in once.values()], np.uint64).reshape(-1, bands * rows)
                row_of = dict(zip(once, range(len(once)), strict=True))
                keys = band_keys(coords, bands, rows).view(np.int64)
                picked = [row_of[d] for d in digests if d in row_of]
                sizes = np.array([len(s) for s in sets], np.int64)
                offsets = pa.array(np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands, 0))]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(keys[picked].ravel(), pa.int64()))], names=["doc_id", "n_shingles", "digest", "keys"])

    return docs.mapInArrow(run, _SETS)


def _sets_of(rows: DataFrame, width: int) -> DataFrame:
    """rows(node, digest, text) to (node, items): the full sets, as sorted arrays, of those rows whose text has the set of that digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        known: dict[bytes, int] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                sets = shingle_sets(b.column(2).to_pylist(), width, known)
                same = [k for k, (d, x) in enumerate(zip(b.column(1).to_pylist(), sets, strict=True)) if hashlib.blake2b(x.tobytes(), digest_size=16).digest() == d]
                sets = [sets[k].view(np.int64) for k in same]
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(same, pa.int64())), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64), pa.int64()))], names=["node", "items"])

    return rows.mapInArrow(run, "node long, items array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs(a, b), those whose full sets overlap enough."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    both = pairs.join(left, "a").where(F.size("x") > 0).join(right, "b")
    sized = both.where((F.size("x") * 100 >= F.size("y") * percent) & (F.size("y") * 100 >= F.size("x") * percent))
    met = sized.withColumn("i", F.size(F.array_intersect("x", "y")))
    return met.where(F.col("i") * 100 >= (F.size("x") + F.size("y") - F.col("i")) * percent).select("a", "b")


def _least_share(n: Column, part: int, whole: int) -> Column:
    """ceil(n * part / whole)."""
    return F.floor((n * part + whole - 1) / whole).cast("int")


def open_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members(node, root) of different roots that can still be similar enough: all of them, and few others.

    A prefix join: items are ordered by the number of members that hold them, rarest first. Two
    sets that overlap enough share one of the first items of both, so many that what is left of
    each is too small for the overlap they need. Items of one member alone take up places of its
    prefix but meet nothing. Of each pair the set with fewer items, then the smaller number, is
    looked up; a shared item that comes too late for its pair is left out inside the join.
    """
    items = sets.join(members, "node").select("node", "root", F.size("items").alias("n"), F.explode("items").alias("item"))
    common = items.groupBy("item").agg(F.count("*").alias("c")).where("c > 1")
    ranked = items.join(common, "item").groupBy("node", "root", "n").agg(F.sort_array(F.collect_list(F.struct("c", "item"))).alias("shared"))
    # Places from 1 on; those of the node's own items come first.
    own = F.col("n") - F.size("shared")
    asks = F.col("n") - _least_share(F.col("n"), percent, 100) + 1 - own
    holds = F.col("n") - _least_share(F.col("n"), 2 * percent, 100 + percent) + 1 - own
    first = ranked.withColumn("own", own).withColumn("holds", holds).withColumn("prefix", F.slice("shared", F.lit(1), F.greatest(F.lit(0), asks)))
    placed = first.select("node", "root", "n", "own", "holds", F.posexplode("prefix").alias("k", "x")).select(F.col("x.item").alias("item"), "node", "root", "n", "holds", "k", (F.col("n") - F.col("own") - F.col("k")).alias("left"))
    held = placed.where("k < holds").select("item", F.col("node").alias("a"), F.col("root").alias("r"), F.col("n").alias("n_a"), F.col("left").alias("left_a"))
    asked = placed.select("item", F.col("node").alias("b"), F.col("root").alias("s"), F.col("n").alias("n_b"), F.col("left").alias("left_b"))
    ordered = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    enough = F.least("left_a", "left_b") * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent
    return asked.join(held, "item").where(ordered & (F.col("r") != F.col("s")) & enough).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, centres: int = 1) -> DataFrame:
    """Components of documents linked by a Jaccard similarity of word shingles of percent / 100 or more.

    Returns doc_id, n_shingles, component_id (the smallest doc_id reachable) and kept (doc_id is
    component_id), one row for each row of docs with a doc_id; an empty table gives none.

    Equal sets collapse to one node before anything is paired, so exact copies cost no pairs.
    Within the bucket of a band key, nodes are tested against one centre, first the bucket's
    smallest node, then `centres` others drawn by a hash of band and node. Nodes of buckets that
    still span several components are then paired by a prefix join on their rarest shingles, which
    finds every pair of them that is similar enough. So a group of n copies costs about n tests,
    not n^2, and yet every similar pair that shares a band is tested or already connected. Tests
    compare full sets. Null, empty or wordless texts have no shingles and are linked with nothing;
    rows with a null doc_id are left out; rows that repeat a doc_id, with the same text or another,
    are one document, linked with whatever one of its texts is linked with (kept is true on each
    row whose doc_id is the component's). doc_id is read as a long. Ties of sets or ids change
    nothing; other columns are ignored, whatever their names.
    """
    # What the result reads is kept; all else is scratch and goes before it is returned.
    work = Scratch(docs.sparkSession, "near")
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).where("doc_id IS NOT NULL")
    base = work.keep(sketched(source, width, bands, rows))
    filled = base.where("n_shingles > 0")
    # Written once, so that a set keeps its number.
    nodes = work.keep(filled.groupBy("digest").agg(F.min_by("keys", "doc_id").alias("keys"), F.min("doc_id").alias("rep")).select(F.monotonically_increasing_id().alias("node"), "digest", "rep", "keys"))
    member = keep(filled.select("doc_id", "digest").join(nodes.select("node", "digest", "rep"), "digest").select("doc_id", "node", "rep"), "members")
    several = member.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a != z").select("doc_id", "a")
    same_id = member.join(several, "doc_id").where("a != node").select("a", F.col("node").alias("b"))

    posted = nodes.select("node", F.posexplode("keys").alias("band", "key"))
    full = posted.groupBy("key").agg(F.count("*").alias("c"), F.min("node").alias("first")).where("c > 1").select("key", "first")
    buckets = work.keep(posted.join(full, "key").select("key", "band", "node", "first"))
    wanted = buckets.select("node").distinct().join(nodes.select("node", "digest", F.col("rep").alias("doc_id")), "node")
    texts = source.join(wanted, "doc_id").dropDuplicates(["doc_id", "node", "text"])
    sets = work.keep(_sets_of(texts.select("node", "digest", "text"), width))

    links = work.keep(_verified(buckets.where("node != first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct(), sets, percent).union(same_id))
    for turn in (*range(centres), None):
        roots = components(links)
        placed = buckets.select("key", "band", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        drawn = F.xxhash64("node", "band", F.lit(turn or 0))
        split = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min_by("node", drawn).alias("centre"), F.min_by("root", drawn).alias("at")).where("lo != hi")
        if turn is not None:
            pairs = placed.join(split, "key").where("root != at").select(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")).distinct()
        else:
            pairs = open_pairs(placed.join(split.select("key"), "key", "left_semi").select("node", "root").distinct(), sets, percent)
        links = links.unionByName(work.keep(_verified(pairs, sets, percent)))
    roots = components(links)
    by_root = work.keep(nodes.select("node", "rep").join(roots, "node").groupBy("root").agg(F.min("rep").alias("component_id")))
    of_node = keep(roots.join(by_root, "root").select("node", "component_id"), "component-nodes")
    sizes = keep(base.select("doc_id", "n_shingles"), "sizes")
    work.discard()
    placed = member.join(of_node, "node", "left").groupBy("doc_id").agg(F.min(F.coalesce("component_id", "rep")).alias("component_id"))
    done = sizes.join(placed, "doc_id", "left")
    return done.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by 2-word shingles at 0.8."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)


ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]] ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS items FROM w),
n AS (SELECT doc_id, len(items) AS n FROM s),
u AS (SELECT doc_id, unnest(items) AS item FROM s),
f AS (SELECT item, count(*) AS df FROM u GROUP BY item),
-- A pair at 0.8 shares one of the rarest n - ceil(0.8 n) + 1 items of either set.
p AS (SELECT doc_id, item FROM (SELECT u.doc_id, u.item, n.n, row_number() OVER (PARTITION BY u.doc_id ORDER BY df, u.item) AS r FROM u JOIN f USING (item) JOIN n USING (doc_id)) WHERE r <= n - ((80 * n + 99) // 100) + 1),
c AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM p a JOIN p b USING (item) WHERE a.doc_id < b.doc_id),
i AS (SELECT c.a, c.b, count(*) AS k FROM c JOIN u x ON x.doc_id = c.a JOIN u y ON y.doc_id = c.b AND y.item = x.item GROUP BY c.a, c.b),
e AS (SELECT i.a, i.b FROM i JOIN n x ON x.doc_id = i.a JOIN n y ON y.doc_id = i.b WHERE 100 * k >= 80 * (x.n + y.n - k)),
g AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT doc_id AS node, doc_id AS seen FROM n UNION SELECT r.node, g.b FROM r JOIN g ON g.a = r.seen)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r.seen) AS component_id, n.doc_id = min(r.seen) AS kept FROM n JOIN r ON r.node = n.doc_id GROUP BY n.doc_id, n.n
"""
