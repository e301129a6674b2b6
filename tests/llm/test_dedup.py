import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import lines, near, passages, suffixes
from strandline.llm.common import components
from strandline.llm.gear import cuts


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 7))) for _ in range(n))


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    for n in (1, 2, 30, 1000):
        s = near.sketch(rng.integers(0, 2**63, n).astype(np.uint64), 252)
        assert (s != np.iinfo(np.uint64).max).all()
    a = rng.integers(0, 2**63, 900).astype(np.uint64)
    seen = [(near.sketch(rng.permutation(a)[:800], 252) == near.sketch(a, 252)).mean() for _ in range(20)]
    assert abs(np.mean(seen) - 800 / 900) < 0.03


def shingles(t, width):
    w = (t or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def near_brute(rows, width):
    """{(doc_id, text): (n_shingles, component_id)}; rows of one id are one document."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {(i, t): (len(shingles(t, width)), find(i)) for i, t in rows}


def near_rows():
    rng = random.Random(2)
    base = [words(rng, rng.randrange(20, 120)) for _ in range(8)]
    rows = []
    for b in base:
        for _ in range(12):
            w = b.split()
            for _ in range(rng.randrange(0, 7)):
                w[rng.randrange(len(w))] = "zz" + str(rng.randrange(1000))
            rows.append((len(rows), " ".join(w)))
    w, x = words(rng, 60), words(rng, 60)
    twice = [(-9, w), (-9, x), (920, w + " more"), (930, x + " more"), (-9, None), (940, "a long one " + words(rng, 30_000))]
    return rows + twice + [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two"), (906, base[0]), (907, base[0]), (907, base[0])]


def test_near_duplicates(spark):
    rows = near_rows()
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows] + [(None, "no id", 1, 2)], "doc_id long, text string, kept int, node int")
    for width in (2, 5):
        out = near.near_duplicates(docs, width=width).collect()
        want = near_brute(rows, width)
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == sorted((i, *want[i, t]) for i, t in rows)
        assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    assert want[920, rows[98][1]][1] == want[930, rows[99][1]][1] == -9
    assert near.near_duplicates(docs.limit(0)).count() == 0


def test_open_pairs_lose_nothing(spark):
    rng = random.Random(12)
    base = [rng.sample(range(10_000), rng.randrange(10, 200)) for _ in range(5)]
    sets = []
    for b in base:
        for _ in range(25):
            mine = set(rng.sample(b, int(len(b) * rng.uniform(0.8, 1)))) | {rng.randrange(10_000) for _ in range(rng.randrange(len(b) // 5))}
            sets.append(sorted(mine))
    frame = spark.createDataFrame([(k, x) for k, x in enumerate(sets)], "node long, items array<long>")
    members = frame.select("node", (F.col("node") % 7).alias("root"))
    got = {(min(r), max(r)) for r in near.open_pairs(members, frame, 80).collect()}
    want = {(i, j) for j in range(len(sets)) for i in range(j) if i % 7 != j % 7 and 100 * len({*sets[i]} & {*sets[j]}) >= 80 * len({*sets[i]} | {*sets[j]})}
    assert want <= got and len(want) > 30


def test_chunks_resist_shifts():
    rng = random.Random(3)
    data = words(rng, 2000).encode()
    whole = {data[a:b] for a, b in zip([0, *cuts(data, least=24, average=56, most=256)], cuts(data, least=24, average=56, most=256), strict=False)}
    moved = b"inserted here " + data
    ends = cuts(moved, least=24, average=56, most=256)
    again = {moved[a:b] for a, b in zip([0, *ends], ends, strict=False)}
    assert len(whole & again) > 0.95 * len(whole)
    assert cuts(b"", least=24, average=56, most=256) == [] and cuts(b"x", least=24, average=56, most=256) == [1]
    text = "é" * 4000
    for e in cuts(text.encode(), least=24, average=56, most=255):
        text.encode()[:e].decode()


def test_passages_against_brute_force(spark):
    rng = random.Random(4)
    shared = [words(rng, 80) for _ in range(4)]
    rows = [(i, words(rng, 30) + " " + rng.choice(shared) + " " + words(rng, 20)) for i in range(40)] + [(50, None), (51, ""), (52, shared[0] * 3)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_bytes string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept.encode()).hexdigest()) for r in passages.chunk_dedup(docs).collect()}
    assert got == passages.brute_force(rows)
    assert sum(v[1] > 0 for v in got.values()) >= 35
    twice = spark.createDataFrame([(1, words(rng, 90))] * 2, "doc_id long, text string")
    assert [r.n_removed for r in passages.chunk_dedup(twice).collect()] == [0, 0]


def test_exact_substrings_against_brute_force(spark):
    rng = random.Random(5)
    shared = [words(rng, 60) for _ in range(5)]
    rows = [(i, words(rng, 20) + rng.choice(shared)[rng.randrange(40) :] + words(rng, 10) + rng.choice(shared)) for i in range(30)]
    rows += [(100, "a" * 900), (101, "ab" * 300), (102, None), (103, ""), (104, shared[0]), (104, shared[0]), (None, shared[1]), (105, "a" * 199)]
    docs = spark.createDataFrame([(i, t, b"") for i, t in rows], "doc_id long, text string, kept binary")
    for group in (4000, 2):
        got = suffixes.exact_dedup(docs, group=group).collect()
        ours = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got), key=repr)
        assert ours == sorted(suffixes.brute_force(rows), key=repr)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def line_variants(rng, n_bases, copies, low, high):
    texts = []
    for _ in range(n_bases):
        base = "".join(rng.choice("abcé ") for _ in range(rng.randrange(low, high)))
        texts.append(base)
        for _ in range(copies):
            s = list(base)
            for _ in range(rng.randrange(0, 5)):
                k = rng.randrange(len(s))
                if rng.random() < 0.4:
                    s[k] = rng.choice("abé")
                elif rng.random() < 0.5:
                    s.insert(k, rng.choice("abé"))
                else:
                    del s[k]
            texts.append("".join(s))
    return [t for t in dict.fromkeys(texts) if t.strip()]


@pytest.mark.parametrize("low,high,least", [(17, 40, 16), (4, 12, 4), (60, 140, 16)])
def test_line_links(spark, low, high, least):
    texts = line_variants(random.Random(low), 25, 6, low, high)
    texts += ["a" * k for k in (low, low + 1, low + 2, low + 3)] + [("ab" * 80)[: low + k] for k in range(4)]
    texts = list(dict.fromkeys(texts))
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").withColumn("tkey", F.xxhash64("text"))
    rows = lines.line_rows(docs)
    name = {bytes(r.lkey): r.line for r in rows.collect()}
    want = {(*sorted((a, b)), d) for i, a in enumerate(texts) for b in texts[:i] if min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= 2 and (d := edits(a, b)) <= 2}
    for most in (lines.BROADCAST_IDS, 0):
        links, _ = lines.near_lines(rows, lines.hashed_lines(rows, least), most)
        got = [(*sorted((name[bytes(r.a)], name[bytes(r.b)])), r.edits) for r in links.collect()]
        assert set(got) == want and len(got) == len(want) and len(want) > 20


def lines_brute(rows, least=16):
    """{(doc_id, text): (n_lines, n_removed, n_near, n_links, removed_lines)} of rows with distinct ids."""
    places = [(i, k, line) for i, t in sorted(rows) for k, line in enumerate((t or "").split("\n")) if t is not None and line.strip(" \t\n\x0b\x0c\r")]
    first = {}
    for p in places:
        first.setdefault(p[2], p[:2])
    names = list(first)
    root = {n: n for n in names}
    links = dict.fromkeys(names, 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(names):
        for b in names[:k]:
            if min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= 2 and edits(a, b) <= 2:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    start = {}
    for n in names:
        start[find(n)] = min(start.get(find(n), first[n]), first[n])
    out = {}
    for i, t in rows:
        mine = [(k, line) for d, k, line in places if d == i]
        gone = [k for k, line in mine if start[find(line)] != (i, k)]
        near = [k for k in gone if first[(t or "").split("\n")[k]] == (i, k)]
        out[i, t] = (len(mine), len(gone), len(near), sum(links[line] for _, line in mine), gone)
    return out


def test_line_dedup(spark):
    rng = random.Random(7)
    pool = line_variants(rng, 30, 4, 10, 60) + ["short", "Same", "  ", "\t", "x", "Sane"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 8)))) for i in range(60)] + [(90, None), (91, ""), (92, "Same\nSame\nSame"), (93, "Same"), (94, "l" * 200_000 + "\nSame")]
    docs = spark.createDataFrame([(i, t, 5, b"") for i, t in rows] + [(None, "of no one", 5, b"")], "doc_id long, text string, n_lines int, lkey binary")
    got = {(r.doc_id, r.text): r for r in lines.line_dedup(docs, out="left_text").collect()}
    want = lines_brute(rows)
    assert {k: (r.n_lines, r.n_removed, r.n_near, r.n_links, list(r.removed_lines)) for k, r in got.items() if k[0] is not None} == want
    assert {k: r.left_text for k, r in got.items() if k[0] is not None} == {(i, t): None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want[i, t][4]) for i, t in rows}
    assert got[None, "of no one"].n_removed == 0 and sum(v[2] for v in want.values()) > 20
    twice = spark.createDataFrame([(1, "one line of some length\none line of some length")] * 2, "doc_id long, text string")
    assert [r.n_removed for r in lines.line_dedup(twice).collect()] == [1, 1]
    assert lines.line_dedup(docs.limit(0)).count() == 0
