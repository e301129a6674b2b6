"""Cases small enough to check by hand."""

import random

import pytest
from pyspark.sql import functions as F

from strandline.functions import seq as S
from strandline.functions.align import align_batch
from strandline.operators import coverage as C
from strandline.operators import downsample as D
from strandline.operators import graph as G
from strandline.operators import pools as P
from strandline.operators import stats as T
from strandline.plans.options import ScrubOptions

ALN = "qname string, tname string, n_match long, aln_len long"
IV = "name string, length long, mean_q double, ref string, st long, en long"


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_pool_bounds(spark):
    rows = [("a", "c1", 4500, 5000), ("b", "c1", 2940, 3000), ("c", "c1", 4500, 4999), ("d", "c1", 0, 0), ("e", "zz", 5000, 5000), ("a", "c2", 5000, 5000), ("a", "c2", 5000, 5000)]
    aln = spark.createDataFrame(rows, ALN)
    known = spark.createDataFrame([("c1", 10), ("c2", 10), ("c3", 10)], "name string, length long")
    pools = {tuple(r) for r in P.pools(P.known_targets(P.dual_threshold(aln), known)).collect()}
    assert pools == {("c1", "a"), ("c1", "b"), ("c2", "a")}
    stats = {r.chrom: (r.n_seen, r.n_passed, r.n_reads) for r in P.pool_stats(aln, known).collect()}
    assert stats == {"c1": (4, 2, 2), "c2": (2, 2, 1), "c3": (0, 0, 0)}


def test_reads_last_duplicate(spark):
    pools = spark.createDataFrame([("c1", "a")], "chrom string, read string")
    reads = spark.createDataFrame([(0, "a", "AC", "!!"), (1, "a", "GT", None)], "ord long, name string, seq string, qual string")
    assert tuple(P.pool_reads(pools, reads).first()) == ("c1", "a", 1, "GT", "")


def test_sequence_expressions(spark):
    assert one(spark, S.revcomp(F.lit("ACGTacgtNnR"))) == "RnNacgtACGT"
    assert one(spark, S.softclip_length(F.lit("10S20M3I2D5S"))) == 15
    assert one(spark, S.aligned_query_length(F.lit("10S20M3I2D5S"))) == 23
    assert one(spark, S.read_length(F.lit("*"), F.lit("ACG"))) == 3
    assert one(spark, S.read_length(F.lit("*"), F.lit(""))) == 1
    assert one(spark, S.mean_phred(F.lit("!I"))) == 20.0
    assert one(spark, S.mean_phred(F.lit(""))) is None
    assert one(spark, S.wrap(F.lit("A" * 165))).split("\n") == ["A" * 80, "A" * 80, "A" * 5]
    assert one(spark, S.tail(F.lit("ACG"), 10)) == "ACG"


def test_cycle_key(spark):
    df = spark.createDataFrame([([("A", "+"), ("B", "+"), ("C", "+")],), ([("C", "+"), ("B", "+"), ("A", "+")],), ([("B", "+"), ("C", "+"), ("A", "+")],)], "n array<struct<seg:string,orient:string>>")
    assert df.select(S.cycle_key(F.col("n"))).distinct().count() == 1


def test_bins_and_greedy(spark):
    contigs = spark.createDataFrame([("c", 1000)], "name string, length long")
    reads = spark.createDataFrame([("r", 1000, 1.0, "c", 0, 1000), ("s", 601, 1.0, "c", 400, 1001)], IV)
    rows = {(r.name, r.bin, r.credit) for r in D.binned(reads, contigs, 500).collect()}
    assert rows == {("r", 0, 500), ("r", 1, 500), ("s", 0, 300), ("s", 1, 300)}
    assert {r.name for r in D.greedy(reads, contigs, 2, 500).collect()} == {"r", "s"}
    assert {r.name for r in D.greedy(reads.where("name = 'r'"), contigs, 2, 500).collect()} == {"r"}
    assert {r.name for r in D.spanning(spark.createDataFrame([("x", 800, 1.0, "c", 0, 800), ("y", 799, 1.0, "c", 0, 799)], IV), contigs).collect()} == {"x"}


def test_greedy_recredits_by_default(spark):
    contigs = spark.createDataFrame([("c", 1000)], "name string, length long")
    reads = spark.createDataFrame([("long", 1000, 9.0, "c", 0, 1000), ("m", 400, 5.0, "c", 550, 950)], IV)
    assert {r.name for r in D.greedy(reads, contigs, 2, 500).collect()} == {"long"}
    assert {r.name for r in D.greedy(reads, contigs, 2, 500, credit_once=True).collect()} == {"long", "m"}


def test_depth_windows_and_local_coverage(spark):
    random.seed(1)
    rows = [(f"r{i}", 0, 0.0, "c", s, s + random.randrange(1, 40_000)) for i, s in enumerate(random.randrange(0, 60_000) for _ in range(40))]
    rows = [(n, e - s, q, r, s, e) for n, _, q, r, s, e in rows]
    iv = spark.createDataFrame(rows, IV)
    depth = [0] * 100_000
    for *_, s, e in rows:
        for p in range(s, e):
            depth[p] += 1
    runs = C.depth_runs(iv).collect()
    assert sum(r.depth * (r.end - r.start) for r in runs) == sum(e - s for *_, s, e in rows)
    assert all(depth[r.start] == depth[r.end - 1] == r.depth for r in runs)
    local = {r.name: r.local_cov for r in C.local_coverage(iv).collect()}
    assert all(abs(local[n] - sum(depth[s:e]) / (e - s)) < 1e-6 for n, _, _, _, s, e in rows)
    contigs = spark.createDataFrame([("c", 700), ("d", 300)], "name string, length long")
    means = {(r.ref, r.win_start): r.mean_cov for r in C.window_means(iv, contigs).collect()}
    assert set(means) == {("c", 0), ("c", 100), ("c", 200), ("d", 0)}
    assert all(abs(means["c", w] - sum(depth[w : w + 500]) / 500) < 1e-9 for w in (0, 100, 200))


def test_baseline_is_the_exact_median(spark):
    means = spark.createDataFrame([("c", i, float(v)) for i, v in enumerate((1, 2, 3, 10))], "ref string, win_start long, mean_cov double")
    assert C.baselines(means).first().baseline == 2.5


def test_first_failing_rule(spark):
    rows = spark.createDataFrame([(5, 0.5, 0.9), (20, 0.79, 0.9), (20, 0.80, 0.21), (20, 0.8, 0.2)], "mapq int, mapped_fraction double, softclip_fraction double")
    assert [r.outcome for r in C.outcomes(rows).collect()] == ["failed_mapq", "failed_mapped_fraction", "failed_softclip", "clean"]


def test_statistics(spark):
    lens = spark.createDataFrame([(5,), (4,), (3,), (2,)], "len0 long")
    assert T.n50(lens, "len0").first().n50 == 4
    q = spark.createDataFrame([(0.0,), (4.99,), (5.0,), (44.0,), (60.0,)], "q double")
    assert [r.n for r in sorted(T.quality_histogram(q, "q").collect())] == [2, 1, 0, 0, 0, 0, 0, 0, 2]
    assert T.read_stats(spark.createDataFrame([], "length long, mean_q double")).first()["count"] == 0
    assert [one(spark, T.coverage_badge(F.lit(c))) for c in (80, 79.9, 30, 29.9)] == ["green", "yellow", "yellow", "red"]
    assert [one(spark, T.contig_status(F.lit(n))) for n in (50001, 50000, 10001, 10000)] == ["chromosome-scale", "large", "large", "fragment"]


def smith_waterman(a, b):
    """Score by the plain affine recurrences."""
    low = -1e9
    h = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    e = [[low] * (len(b) + 1) for _ in range(len(a) + 1)]
    f = [[low] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0.0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            e[i][j] = max(h[i][j - 1] - 2, e[i][j - 1] - 0.5)
            f[i][j] = max(h[i - 1][j] - 2, f[i - 1][j] - 0.5)
            h[i][j] = max(0.0, h[i - 1][j - 1] + (1 if a[i - 1] == b[j - 1] else -1), e[i][j], f[i][j])
            best = max(best, h[i][j])
    return best


def test_alignment_scores():
    random.seed(4)
    pairs = [("".join(random.choice("ACGT") for _ in range(random.randrange(0, 40))), "".join(random.choice("ACGT") for _ in range(random.randrange(0, 40)))) for _ in range(60)]
    score, span = align_batch([a for a, _ in pairs], [b for _, b in pairs])
    assert [float(s) for s in score] == [smith_waterman(a, b) for a, b in pairs]
    assert all(s <= len(a) for s, (a, _) in zip(span, pairs, strict=True))
    score, span = align_batch(["GGGACGTCC", "ACGTTACGT", "AAAA"], ["ACGT", "ACGTACGT", "CCCC"])
    assert list(score) == [4, 6, 0] and list(span) == [4, 9, 0]


def edge(a, b, identity, overlap, la=1000, lb=1000):
    return (a, "+", b, "+", float(identity), overlap, la, lb, float(identity) * overlap)


EDGE = "src_seg string, src_orient string, dst_seg string, dst_orient string, identity double, overlap long, src_len long, dst_len long, score double"


def brute_walks(edges, depth):
    out = {}
    for e in edges:
        out.setdefault(e[0], []).append(e)
    walks, closed, stack = [], [], [([s], 0) for s in out]
    lens = {e[0]: e[6] for e in edges} | {e[2]: e[7] for e in edges}
    stack = [([s], lens[s]) for s in out]
    while stack:
        nodes, total = stack.pop()
        if len(nodes) > 1:
            walks.append((tuple(nodes), total))
        if len(nodes) - 1 >= depth:
            continue
        for e in out.get(nodes[-1], []):
            if len(nodes) > 1 and e[2] == nodes[0]:
                closed.append((tuple(nodes) + (e[2],), total - e[5]))
            elif e[2] not in nodes:
                stack.append((nodes + [e[2]], total + lens[e[2]] - e[5]))
    return sorted(walks), sorted(closed)


def test_walks_against_brute_force(spark):
    random.seed(6)
    names = "ABCDEFG"
    edges = [edge(a, b, random.randrange(75, 100), random.randrange(100, 200)) for a in names for b in random.sample(names, 3) if a != b]
    open_, closed = G.walks(spark.createDataFrame(edges, EDGE), 4)
    want = brute_walks(edges, 4)
    seg = lambda df: sorted((tuple(n.seg for n in r.nodes), r.total_len) for r in df.collect())
    assert seg(open_) == want[0] and seg(closed) == want[1]


def test_stitch(spark):
    segs = spark.createDataFrame([("A", "AAAACC"), ("B", "CCGGTT"), ("C", "TTAA")], "name string, seq string")
    edges = spark.createDataFrame([edge("A", "B", 90, 2), edge("B", "C", 90, 2), edge("C", "A", 90, 2)], EDGE)
    node = lambda x: (x, "+")
    paths = spark.createDataFrame([("linear", [node(x) for x in "ABC"]), ("cycle", [node(x) for x in "ABCA"]), ("broken", [node(x) for x in "CB"])], "kind string, nodes array<struct<seg:string,orient:string>>")
    got = {r.kind: r.seq for r in G.stitch(paths, segs, edges).collect()}
    assert got == {"linear": "AAAACCGGTTAA", "cycle": "AAAACCGGTT"}


def test_joins_and_rings(spark):
    segs = spark.createDataFrame([(i, n, s) for i, (n, s) in enumerate({"A": "ACGTTGCA", "B": "TGCATCCC", "C": "TCCCACGT"}.items())], "ord long, name string, seq string")
    assert G.join_candidates(segs, 4).count() == 24 and G.join_candidates(segs, 4, compat=True).count() == 12
    joins = G.candidate_joins(segs, 4, 75.0, 4)
    rings = {tuple(r.path) for r in G.circular_joins(joins, segs, 12, 0.4).collect()}
    assert rings == {("A", "B", "C"), ("B", "C", "A"), ("C", "A", "B")}
    assert G.circular_joins(G.candidate_joins(segs, 4, 75.0, 4, compat=True), segs, 12, 0.4).count() == 0


def test_short_self_hit(spark):
    segs = spark.createDataFrame([("A", "ACGGT" * 40)], "name string, seq string")
    hit = G.circular(G.self_terminals(segs, 500)).first()
    assert (hit.identity, hit.overlap, hit.circular_possible) == (100.0, 200, True)
    assert not G.circular(G.self_terminals(segs, 500), window=500).first().circular_possible


def test_rings_lose_their_overlaps(spark):
    segs = spark.createDataFrame([("A", "A" * 100), ("B", "C" * 100)], "name string, seq string")
    joins = spark.createDataFrame([("A", "B", "+/+", 40), ("B", "A", "+/+", 40)], "seg_a string, seg_b string, orientation string, overlap_bp long")
    assert sorted((r.total, r.size) for r in G.circular_joins(joins, segs, 120, 0.4).collect()) == [(200, 120)] * 2
    # An open path of 160 is beyond 132, so the ring that it would close into is not looked for.
    assert G.circular_joins(joins, segs, 200, 0.1).count() == 0 and G.circular_joins(joins, segs, 120, 0.1).count() == 0
    # No limit on the number of segments.
    many = [f"s{k:02d}" for k in range(14)]
    ring = spark.createDataFrame([(a, b, "+/+", 10) for a, b in zip(many, many[1:] + many[:1], strict=True)], "seg_a string, seg_b string, orientation string, overlap_bp long")
    found = G.circular_joins(ring, spark.createDataFrame([(n, "G" * 30) for n in many], "name string, seq string"), 280, 0.1).collect()
    assert len(found) == 14 and {r.size for r in found} == {280}


def test_written_paths_keep_their_ranks(spark):
    kind = "kind string, nodes array<struct<seg:string,orient:string>>, total_len long, mean_identity double, min_identity double, total_overlap long, score double"
    row = lambda name, total, identity: ("cycle", [(name, "+")], total, identity, identity, 100, identity)
    none = spark.createDataFrame([row("any", 77, 80.0)], kind)
    cycles = spark.createDataFrame([row("near", 1000, 80.0), row("far", 1190, 99.0)], kind)
    linear = spark.createDataFrame([row("line", 1000, 99.0)], kind)
    pick = lambda top: [r.nodes[0].seg for r in G.fasta_choice(none, cycles, linear, top, 1000).collect()]
    assert pick(2) == ["any", "near"] and pick(9) == ["any", "near", "far", "line"]


def test_depth_holds_supplementary_alignments(spark):
    from strandline.operators import coverage as C
    from strandline.plans.options import ScrubOptions

    row = lambda name, flag, st, en: (name, flag, "c", st, en, 60, f"{en - st}M", "")
    rows = [row("a", 0, 0, 1000), row("a", 2048, 0, 1000), row("b", 0, 0, 1000), row("x", 1024, 200, 300), row("u", 4, 0, 1000), row("s", 256, 0, 1000)]
    aln = spark.createDataFrame(rows, "qname string, flag int, tname string, ref_start long, ref_end long, mapq int, cigar string, seq string")
    got = C.classify(aln, spark.createDataFrame([("c", 1000)], "name string, length long"), ScrubOptions(coverage_ratio=1.0)).collect()
    assert sorted((r.qname, r.local_cov, r.threshold, r.outcome) for r in got) == [("a", 3.0, 3.0, "clean"), ("b", 3.0, 3.0, "clean"), ("x", 3.0, 3.0, "clean")]


def test_scratch_tables_go(spark):
    from pathlib import Path

    from strandline.storage import Scratch

    work = Scratch(spark, "some")
    first = work.keep(spark.range(5))
    second = work.keep(first.where("id > 2"))
    root = Path(work.root.removeprefix("file:").replace("//", "/", 1))
    assert second.count() == 2 and sorted(p.name for p in root.iterdir()) == ["1", "2"]
    work.discard()
    assert not root.exists()


@pytest.mark.parametrize("once", [False, True])
def test_greedy_against_the_rule_spelled_out(spark, once):
    """Two contigs, one of them deep and with gaps that no read crosses."""
    rng, target, size, length = random.Random(7), 3, 100, {"c": 6000, "d": 900}
    rows = []
    for k in range(400):
        ref = "c" if k % 4 else "d"
        base = rng.choice([0, 2000, 2050, 4500]) if ref == "c" else 0
        st = base + rng.randrange(0, 500)
        rows.append((f"r{k:03}", rng.randrange(50, 60), float(rng.randrange(8, 12)), ref, st, min(st + rng.randrange(20, 400), length[ref])))
    want = set()
    for ref in length:
        mine = sorted((r for r in rows if r[3] == ref), key=lambda r: (-r[1], -r[2], r[4], r[0]))
        span = {r[0]: range(r[4] // size, min(r[5] - 1, length[ref] - 1) // size + 1) for r in mine}
        have, took = {}, set()
        for b in range(length[ref] // size + 1):
            for r in (r for r in mine if b in span[r[0]]):
                if have.get(b, 0) >= target * size:
                    break
                if once and r[0] in took:
                    continue
                took.add(r[0])
                for x in span[r[0]]:
                    have[x] = have.get(x, 0) + (r[5] - r[4]) // len(span[r[0]])
        want |= took
    reads = spark.createDataFrame(rows, "name string, length int, mean_q double, ref string, st int, en int")
    contigs = spark.createDataFrame(list(length.items()), "name string, length long")
    assert {r.name for r in D.greedy(reads, contigs, target, size, credit_once=once).collect()} == want and len(want) < 400


def test_blocks_of_alignments(spark):
    assert C.covered(10, "2S3M1I2M2D4M5N1=3H", "TTACGTACGTACG") == [(10, 15), (17, 21), (26, 27)]
    assert C.covered(0, "5M", "ACNGT") == [(0, 2), (3, 5)] and C.covered(0, "*", "AC") == [] and C.covered(3, "4M", "") == [(3, 7)] and C.covered(0, "3M", "acg") == [(0, 3)]
    rows = spark.createDataFrame([("c", 5, "2M3D2M", None), ("c", 5, "10M", ""), (None, None, "3M", ""), ("c", 1, None, "A")], "tname string, ref_start long, cigar string, seq string")
    assert sorted((r.ref, r.st, r.en) for r in C.aligned_blocks(rows).collect()) == [("c", 5, 7), ("c", 5, 15), ("c", 10, 12)]


def test_depth_leaves_deletions_out(spark):
    aln = spark.createDataFrame([("a", 0, "c", 0, 1000, 60, "400M200D400M", ""), ("b", 0, "c", 0, 1000, 60, "1000M", ""), ("d", 0, "c", 420, 580, 60, "160M", "")], "qname string, flag int, tname string, ref_start long, ref_end long, mapq int, cigar string, seq string")
    judged, base = C.classified(aln, spark.createDataFrame([("c", 1000), ("e", 700)], "name string, length long"), ScrubOptions(window=100, step=100))
    assert {r.qname: round(r.local_cov, 6) for r in judged.collect()} == {"a": 1.96, "b": 1.96, "d": 2.0}
    assert {r.ref: r.baseline for r in base.collect()} == {"c": 2.0, "e": 0.0}


def test_medians_equal_the_built_in(spark):
    import random

    rng = random.Random(9)
    rows = [(rng.choice("abc"), rng.choice([0.0, 1.25, 7.5, rng.random() * 40, -3.5])) for _ in range(999)] + [("d", 4.0), ("e", None), ("f", 1.0), ("f", 2.0), (None, 3.0)]
    means = spark.createDataFrame(rows, "ref string, mean_cov double")
    want = {r[0]: r[1] for r in means.where("mean_cov IS NOT NULL").groupBy("ref").agg(F.median("mean_cov")).collect()}
    assert {r.ref: r.baseline for r in C.baselines(means).collect()} == want
    assert C.global_baseline(means).first()[0] == means.agg(F.median("mean_cov")).first()[0]
    assert C.global_baseline(means.limit(0)).first()[0] == 0.0


def _random_segments(spark, n, seed, size=700, joined=0):
    """Segments of random bases; some begin with the last bases of another, with errors."""
    rng = random.Random(seed)
    seqs = ["".join(rng.choices("ACGT", k=size)) for _ in range(n)]
    for k in range(joined):
        a, b, m = rng.randrange(n), rng.randrange(n), rng.choice([110, 160, 300])
        tail = list(seqs[a][-m:])
        for i in rng.sample(range(m), m // 25):
            tail[i] = rng.choice(["", "A", "CG"])
        seqs[b] = ("".join(tail) + seqs[b][m:])[:size] if rng.random() < 0.7 else seqs[b]
    return spark.createDataFrame([(k, f"s{k:02d}", s) for k, s in enumerate(seqs)], "ord long, name string, seq string")


@pytest.mark.parametrize("identity", [75.0, 90.0])
def test_only_possible_pairs_are_aligned(spark, identity):
    from strandline.functions.align import Floors, gram_index, possible
    from strandline.plans.options import GraphOptions

    segs = _random_segments(spark, 9, 3, 300, 7)
    options = GraphOptions(window=200, min_identity=identity, min_overlap=100)
    rows = lambda df: sorted(map(tuple, df.collect()))
    edges = rows(G.build_edges(segs, options, exact=True))
    assert rows(G.build_edges(segs, options)) == edges and edges
    joins = rows(G.candidate_joins(segs, 200, identity, 100, exact=True))
    assert rows(G.candidate_joins(segs, 200, identity, 100)) == joins and joins
    floors = Floors(identity, 100)
    q = floors.gram()
    rng = random.Random(1)
    seqs = ["".join(rng.choices("ACGT", k=500)) for _ in range(40)]
    tried = [possible(a, gram_index(b, q), q, floors.windows(q, 500)) for a in seqs for b in seqs if a != b]
    assert q == (7 if identity == 75.0 else 16) and sum(tried) < 0.05 * len(tried)


def test_no_alignment_that_reaches_the_floors_is_left_out():
    from strandline.functions.align import Floors, gram_index, possible

    rng = random.Random(11)
    tried = []
    for _ in range(400):
        floors = Floors(rng.choice([60.0, 75.0, 90.0]), rng.choice([12, 30, 60]))
        a = rng.choices("ACGT", k=rng.randrange(60, 160))
        b = list(a[rng.randrange(20) :])
        for _ in range(rng.randrange(0, len(b) // 6)):
            k = rng.randrange(len(b))
            b[k] = rng.choice(["", b[k] + rng.choice("ACGT") * rng.randrange(1, 5), rng.choice("ACGT")])
        tried.append((floors, "".join(a), "".join(b) + "".join(rng.choices("ACGT", k=40))))
    checked = 0
    for (floors, a, b), score, span in zip(tried, *align_batch([a for _, a, _ in tried], [b for _, _, b in tried]), strict=True):
        if span >= floors.overlap and 100 * score / span >= floors.identity:
            q = floors.gram()
            assert q and possible(a, gram_index(b, q), q, floors.windows(q, len(a)))
            checked += 1
    assert checked > 150


def test_cycles_by_halves_equal_whole_walks(spark):
    for seed, n, depths in ((1, 6, (2, 5)), (2, 8, (4,))):
        rng = random.Random(seed)
        pairs = {(rng.randrange(n), rng.choice("+-"), rng.randrange(n), rng.choice("+-")) for _ in range(4 * n)}
        rows = [(f"n{a}", x, f"n{b}", y, float(70 + (a * 7 + b) % 30), 10 + (a + 3 * b) % 20, 100 + a, 100 + b, float((70 + (a * 7 + b) % 30) * (10 + (a + 3 * b) % 20))) for a, x, b, y in pairs if a != b]
        e = spark.createDataFrame(rows, "src_seg string, src_orient string, dst_seg string, dst_orient string, identity double, overlap int, src_len int, dst_len int, score double")
        for depth in depths:
            cols = ["nodes", "total_len", "depth", "sum_identity", "min_identity", "total_overlap", "score"]
            want = sorted(map(repr, G.distinct_cycles(G.walks(e, depth)[1]).select(*cols).collect()))
            got = G.closed_walks(e, depth)
            assert sorted(map(repr, G.distinct_cycles(got).select(*cols).collect())) == want
            assert got.count() == got.select("nodes").distinct().count() and all(r.nodes[0].seg == min(x.seg for x in r.nodes) for r in got.collect())


def test_rings_are_found_once_and_turned(spark):
    import itertools

    rng = random.Random(8)
    lens = {f"s{k}": rng.randrange(50, 200) for k in range(6)}
    joins = {(a, b): rng.randrange(1, 60) for a in lens for b in lens if a != b and rng.random() < 0.55}
    lo, hi = 400 * 0.75, 400 * 1.25
    want = []
    for n in range(1, 7):
        for path in itertools.permutations(lens, n):
            size, ok = lens[path[0]], True
            for a, b in itertools.pairwise(path):
                ok = ok and (a, b) in joins and (size := size - joins[a, b] + lens[b]) <= hi
                if not ok:
                    break
            if ok and (path[-1], path[0]) in joins and lo <= size - joins[path[-1], path[0]] <= hi:
                want.append((list(path), sum(lens[x] for x in path), size - joins[path[-1], path[0]]))
    j = spark.createDataFrame([(a, b, "+/+", o) for (a, b), o in joins.items()], "seg_a string, seg_b string, orientation string, overlap_bp long")
    s = spark.createDataFrame([(k, "A" * n) for k, n in lens.items()], "name string, seq string")
    assert sorted(map(tuple, G.circular_joins(j, s, 400, 0.25).collect())) == sorted(map(tuple, want)) and want


def test_fill_holds_open_bins_only(spark):
    """The rule along a contig ten times as long holds no more."""
    most = []
    for n in (200, 2000):
        fill = D._Fill(3, 10, False)
        for k in range(n):
            for p in range(4):
                fill.take(("c", 0), f"r{k}-{p}", k, k, k + 3, 10)
                if k:
                    fill.take(("c", 0), f"r{k - 1}-{p}", k, k - 1, k + 2, 10)
        most.append(fill.most)
    assert most[0] == most[1] < 40
