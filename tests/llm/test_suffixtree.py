import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from strandline.llm import suffixtree as S

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, depth, least, cut, weight):
    toks = [(k, [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), None]) for k, t in rows]
    held = [zlib.crc32(b"" if k is None else str(k).encode()) % 10 == 0 for k, _ in toks]
    train = [w for (_, w), h in zip(toks, held, strict=True) if not h]
    n = Counter(tuple(w[i - k : i + 1]) for w in train for i in range(len(w)) for k in range(min(i, depth) + 1))
    total, distinct = sum(map(len, train)), sum(len(g) == 1 for g in n)
    states = set()

    def chance(w, i, top, out):
        p = (n[(w[i],)] - out + 0.1) / (total - out + 0.1 * (distinct + 1))
        for k in range(1, min(i, top) + 1):
            if tuple(w[i - k : i]) in states:
                p = smooth(w, i, k, p, out)
        return p

    def smooth(w, i, k, p, out):
        c = n[tuple(w[i - k : i])] - out
        more = weight * c**S.GROWTH
        return (n[tuple(w[i - k : i + 1])] - out + more * p) / (c + more)

    for k in range(1, depth + 1):
        gain = defaultdict(int)
        for w in train:
            for i in range(k, len(w)):
                if n[tuple(w[i - k : i])] >= least:
                    p = chance(w, i, k - 1, 1)
                    gain[tuple(w[i - k : i])] += round(math.log(smooth(w, i, k, p, 1) / p) * S.NAT)
        states |= {s for s, g in gain.items() if g >= cut * S.NAT}
    out = []
    for (k, w), h in zip(toks, held, strict=True):
        base = sum(math.log10(chance(w, i, 0, 0)) for i in range(len(w)))
        score = sum(math.log10(chance(w, i, depth, 0)) for i in range(len(w)))
        length = sum(max((k for k in range(1, min(i, depth) + 1) if tuple(w[i - k : i]) in states), default=0) for i in range(len(w)))
        out.append((k, h, len(w), sum(n[(x,)] > 0 for x in w), total, round(base, 6), round(score, 6), length))
    return out, states


def rows():
    rng = random.Random(2)
    words = ["the", "cat", "Sat", "on", "a", "mat", "été", "日本", "x y", "12"]
    data = [(i, None if i % 41 == 0 else " ".join(words[(j * j + i % 3) % 10] if rng.random() < 0.7 else rng.choice(words) for j in range(rng.randrange(0, 60)))) for i in range(150)]
    return data + [(None, "the cat sat"), (5, "repeated the cat\n\tsat "), (5, "repeated the cat\n\tsat "), (900, ""), (901, " \n "), (902, "same words " * 3000)]


@pytest.mark.parametrize("depth,least,cut", [(1, 3, 0.5), (2, 8, 4.0), (3, 4, 1.0)])
def test_against_brute_force(spark, depth, least, cut):
    data = rows()
    docs = spark.createDataFrame([(k, t, 1.5, "x") for k, t in data], "doc_id long, text string, score double, chunk string").repartition(3)
    made = S.score_documents(docs, depth=depth, least=least, cut=cut, chunk_bytes=5000, bucket_bytes=20_000).collect()
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6), r.state_words) for r in made), key=repr)
    want, states = brute(data, depth, least, cut, S.WEIGHT)
    assert got == sorted(want, key=repr)
    assert {len(s) for s in states} == set(range(1, depth + 1))


def test_distributions_sum_to_one():
    import numpy as np

    parent = np.array([0.5, 0.3, 0.2])
    assert abs(S.smoothed(np.array([3.0, 0.0, 1.0]), np.array([4.0] * 3), parent, 4.0).sum() - 1) < 1e-12


def test_held_out_documents_score_better(spark):
    got = S.op11_lm_scoring(spark, SF).toPandas()
    held = got[got.held_out]
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count() and len(held)
    assert held.score.sum() > held.base_score.sum() and (got.score.sum() > got.base_score.sum())


def test_base_columns_by_sql(spark):
    """The columns that the model doesn't enter, over a whole table."""
    sql = f"""WITH d AS (SELECT doc_id, list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), '') AS w FROM '{SF}/documents.parquet'),
    t AS (SELECT doc_id, unnest(w) AS w FROM d) SELECT doc_id, count(*) AS n, w FROM t GROUP BY doc_id, w"""
    n, c, per = Counter(), Counter(), defaultdict(list)
    for k, m, w in duckdb.sql(sql).fetchall():
        n[k] += m
        per[k].append((w, m))
        if zlib.crc32(str(k).encode()) % 10:
            c[w] += m
    total, distinct = sum(c.values()), len(c)
    want = {k: (n[k], sum(m for w, m in ws if c[w]), total, round(sum(m * math.log10((c[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w, m in ws), 5)) for k, ws in per.items()}
    assert {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in S.op11_lm_scoring(spark, SF).collect()} == want


def test_empty_table(spark):
    assert S.score_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
