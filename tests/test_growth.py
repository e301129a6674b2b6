"""What a step shuffles or sorts where one bin is deep, reads are many or presets are a dozen."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandline.operators import coverage as C
from strandline.operators import downsample as D
from strandline.operators import pools as P
from strandline.plans.options import DownsampleOptions
from strandline.plans.run import downsample_stats

READS = "name string, length long, mean_q double, ref string, st long, en long"


def shuffled(spark, work) -> int:
    """Rows that the stages run by work() write to shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()
    none = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)

    def total():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        stages = store.stageList(None, False, False, none, spark._jvm.java.util.ArrayList())
        return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))

    began = total()
    work()
    return total() - began


def deep(spark, n: int = 40_000):
    """Reads of one contig, most of them in a few bins."""
    k = F.col("id")
    return spark.range(n, numPartitions=4).select(F.concat(F.lit("r"), k).alias("name"), (200 + k * 7919 % 800).alias("length"), (k % 13).cast("double").alias("mean_q"), F.lit("c").alias("ref"), (k * 31 % 900).alias("st"), (k * 31 % 900 + 200 + k * 7919 % 800).alias("en"))


CONTIGS = "name string, length long"


def test_fill_sorts_what_bins_can_take(spark):
    contigs = spark.createDataFrame([("c", 2000)], CONTIGS)
    assert shuffled(spark, lambda: D.fill_bins(deep(spark), contigs, 20, 500).collect()) < 20_000


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_fill_against_the_rule_spelled_out(spark, few, monkeypatch):
    """Ties, qualities that are null, no number or negative, and spans below 0, which reopen a full bin."""
    monkeypatch.setattr(D, "SORTED", few)
    rng, rows = random.Random(5), []
    for k in range(600):
        st = rng.randrange(0, 1900)
        span = rng.choice([-20, 0, 5]) if rng.random() < 0.2 else rng.randrange(1, 300)
        rows.append((f"r{k % 500}", rng.choice([0, 1, 90, 91, 92, 500]), rng.choice([None, float("nan"), float("inf"), -1.0, 0.0, 7.0, 7.1, 30.0]), rng.choice(["c", "d"]), st, st + span))
    lengths, size, target = {"c": 2000, "d": 1500}, 250, 3
    bins = {}
    for name, length, q, ref, st, en in rows:
        first, last = st // size, min((en - 1) // size, -(-lengths[ref] // size) - 1)
        for b in range(first, last + 1):
            # Descending: NaN first, null last.
            down = (2, 0.0) if q is None else (0, 0.0) if q != q else (1, -q)
            bins.setdefault((ref, b), []).append((-length, *down, st, name, (en - st) // (last - first + 1)))
    want = set()
    for held in bins.values():
        have = 0
        for *_, name, credit in sorted(held):
            if have < target * size:
                want.add(name)
            have += credit
    reads = spark.createDataFrame(rows, READS)
    got = {r.name for r in D.fill_bins(reads, spark.createDataFrame(list(lengths.items()), CONTIGS), target, size).collect()}
    assert got == want and len(want) < 450


@pytest.mark.parametrize("step", ["achieved", "stats", "greedy"])
def test_reads_stay_where_they_are(spark, step):
    """Of 40,000 reads only those that span or fill are dealt out."""
    contigs, reads = spark.createDataFrame([("c", 2000)], CONTIGS), deep(spark)
    names = spark.createDataFrame([("r1",), ("r2",)], "name string")
    work = {
        "achieved": lambda: D.achieved(reads, names, contigs).collect(),
        "stats": lambda: downsample_stats(reads, contigs, DownsampleOptions(20, 500), names).collect(),
        "greedy": lambda: D.greedy(reads, contigs, 20, 500).collect(),
    }
    assert shuffled(spark, work[step]) < 20_000


def test_grid_meets_no_read_twice(spark):
    """Presets with missing bounds, and one name twice."""
    held = [(1, 100, 0.9, 50, 0.95), (2, 100, 0.5, 20, 0.9), (2, 30, 0.6, None, 0.1), (3, None, 0.2, 60, None), (4, 80, 0.7, 80, 0.7)]
    presets = spark.createDataFrame(held, "preset int, len_a long, id_a double, len_b long, id_b double")
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(3000)]), rng.choice("cde"), rng.randrange(0, 130), rng.choice([None, *range(0, 130)])) for _ in range(4000)]
    aln = spark.createDataFrame(rows, "qname long, tname string, aln_len long, n_match long")
    passed, reads = Counter(), {}
    for q, t, n, m in rows:
        for p, la, ia, lb, ib in held:
            if n > 0 and m is not None and any(a is not None and i is not None and n >= a and m / n >= i for a, i in ((la, ia), (lb, ib))):
                passed[p, t] += 1
                reads.setdefault((p, t), set()).add(q)
    want = {(p, t, n, len(reads[p, t] - {None})) for (p, t), n in passed.items()}
    assert {tuple(r) for r in P.preset_grid(aln, presets).collect()} == want and len(want) == 9
    every = spark.range(4000, numPartitions=4).selectExpr("id AS qname", "'c' AS tname", "120 AS aln_len", "119 AS n_match")
    assert shuffled(spark, lambda: P.preset_grid(every, presets).collect()) < 6_000


def test_many_cigars_at_once():
    rng = random.Random(3)
    cigars = ["".join(f"{rng.choice([0, 1, 2, 3, 12, 100])}{rng.choice('MMMIDNSHP=X')}" for _ in range(rng.randrange(0, 8))) for _ in range(300)]
    cigars += [None, "*", "", "M3", "3M*", "5M7", "1234567890123456M", "\u0663M", "4M\u00e92D3M"]
    seqs = [rng.choice([None, "", "".join(rng.choice("ACGTacgt") for _ in range(700)), "".join(rng.choice("ACGTN") for _ in range(rng.randrange(1, 60)))]) for _ in cigars]
    starts = [rng.randrange(-5, 1000) for _ in cigars]
    want = [(k, *b) for k, (s, c, q) in enumerate(zip(starts, cigars, seqs, strict=True)) for b in C.covered(s, c, q or "")]
    got = C._covered_many(np.array(starts), pa.array(cigars), pa.array(seqs))
    assert list(zip(*(x.tolist() for x in got), strict=True)) == want


def test_many_names_are_dealt(spark, monkeypatch):
    """Reads whose names repeat or are null, joined with names beyond those that are broadcast."""
    rows = [(f"r{k % 40}" if k % 7 else None, 10, 1.0, "cd"[k % 2], k, k + 10 + k % 3) for k in range(200)]
    reads, contigs = spark.createDataFrame(rows, READS), spark.createDataFrame([("c", 100), ("d", 50), ("e", 5)], CONTIGS)
    names = spark.createDataFrame([(f"r{k}",) for k in range(0, 60, 3)], "name string")
    work = lambda: [sorted(map(repr, df.collect())) for df in (P.keep_reads(reads, names), D.achieved(reads, names, contigs), downsample_stats(reads, contigs, DownsampleOptions(20, 50, 0.11), names))]
    few = work()
    monkeypatch.setattr(P, "NAMES", 10)
    assert work() == few and len(few[0]) == sum(r[0] is not None and int(r[0][1:]) % 3 == 0 for r in rows)
