import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strandline.operators.coverage import depth_runs
from strandline.operators.pools import best_hit, dual_threshold
from strandline.plans.options import PoolOptions
from strandline.streaming.incremental import best_hits_of, depth_of, stream_best_hits, stream_depth

HITS = "qname string, tname string, n_match long, aln_len long, ts timestamp"
SPANS = "ref string, st long, en long, ts timestamp"


def drain(spark, where, schema, make, checkpoint, out):
    """All files that lie in `where` and were not read yet, a file a batch, as updates appended to `out`."""
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(where)
    q = make(src).writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda df, n: df.write.mode("append").parquet(out)).start()
    assert q.awaitTermination(120)
    return spark.read.parquet(out)


@pytest.fixture(scope="module")
def hits():
    rng = random.Random(5)
    t0 = dt.datetime(2024, 1, 1)
    names = ["c1", "c2", "ç3"]
    return [(f"r{rng.randrange(40)}", rng.choice(names), n := rng.choice([4600, 4700, 4950]), n + rng.choice([0, 0, 50, 900]), t0 + dt.timedelta(minutes=rng.randrange(600))) for _ in range(300)]


def split(rows, parts, rng):
    dealt = [[] for _ in range(parts)]
    for r in rows:
        dealt[rng.randrange(parts)].append(r)
    return [d for d in dealt if d]


def arrive(spark, dealt, schema, where):
    for d in dealt:
        spark.createDataFrame(d, schema).coalesce(1).write.mode("append").parquet(where)


@pytest.mark.parametrize("parts", [1, 5])
def test_best_hits_equal_batch_over_restarts(spark, tmp_path, hits, parts):
    where, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    dealt = split(hits, parts, random.Random(parts))
    half = (len(dealt) + 1) // 2
    arrive(spark, dealt[:half], HITS, where)
    got = drain(spark, where, HITS, stream_best_hits, cp, out)
    if dealt[half:]:
        arrive(spark, dealt[half:], HITS, where)
        got = drain(spark, where, HITS, stream_best_hits, cp, out)
    whole = spark.createDataFrame(hits, HITS)
    want = best_hit(dual_threshold(whole, PoolOptions())).select("qname", "tname", "n_match", "aln_len")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(best_hits_of(got)) == rows(want)
    # What was delivered twice changes nothing.
    assert rows(best_hits_of(got.unionAll(got))) == rows(want)


def spans(n, seed, far=60_000):
    rng = random.Random(seed)
    out = [(rng.choice(["a", "b"]), s := rng.randrange(far), s + rng.choice([0, 1, 300, 40_000]), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=k)) for k in range(n)]
    # Borders of blocks, and a null.
    return [*out, ("a", 16384, 32768, out[0][3]), ("a", 16384, 32768, out[0][3]), ("b", 0, 16384, out[0][3]), ("b", None, 5, out[0][3])]


@pytest.mark.parametrize("parts", [1, 4])
def test_depth_equals_batch_over_restarts(spark, tmp_path, parts):
    where, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    rows = spans(120, 3)
    dealt = split(rows, parts, random.Random(1))
    half = (len(dealt) + 1) // 2
    arrive(spark, dealt[:half], SPANS, where)
    got = drain(spark, where, SPANS, stream_depth, cp, out)
    if dealt[half:]:
        arrive(spark, dealt[half:], SPANS, where)
        got = drain(spark, where, SPANS, stream_depth, cp, out)
    want = depth_runs(spark.createDataFrame(rows, SPANS).where("en > st").select("ref", "st", "en"))
    flat = lambda df: sorted(tuple(r) for r in df.select("ref", "start", "end", "depth").collect())
    assert flat(depth_of(got)) == flat(want) == flat(depth_of(got.unionAll(got)))


def test_state_ends_and_begins_anew(spark, tmp_path):
    """Files in the order of their event times, far apart: blocks end and are born again, and the sums still hold."""
    where, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    rows = sorted(spans(90, 8, 20_000)[:-4], key=lambda r: r[3])
    timed = lambda src: stream_depth(src, event_time="ts", delay="5 minutes", idle="10 minutes")
    for k in range(0, 90, 30):
        arrive(spark, [rows[k : k + 30]], SPANS, where)
        got = drain(spark, where, SPANS, timed, cp, out)
    want = depth_runs(spark.createDataFrame(rows, SPANS).where("en > st").select("ref", "st", "en"))
    flat = lambda df: sorted(tuple(r) for r in df.select("ref", "start", "end", "depth").collect())
    assert flat(depth_of(got)) == flat(want)
    assert got.groupBy("ref", "block").agg(F.count_distinct("born").alias("n")).where("n > 1").count() > 0


def test_empty_stream(spark, tmp_path):
    where, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([], HITS).write.parquet(where)
    assert best_hits_of(drain(spark, where, HITS, stream_best_hits, str(tmp_path / "cp"), out)).count() == 0
