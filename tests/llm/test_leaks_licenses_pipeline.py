import hashlib
import random

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from strandline.llm import bpe, leaks, licenses, quality

from .test_dedup import lines_brute, near_brute

ITEM = "Anna buys 12 apples and 7 pears at the market, then walks 3 km home with her friend Maria and eats 5 apples on the way."


def test_leaks(spark):
    changed = ITEM.replace("Anna", "Peter").replace("12", "40").replace("7", "9").replace("3 km", "8 miles").replace("Maria", "Eva").replace("5", "6")
    mixed = changed.replace("40 apples", "Forty apples")
    other = "Something else entirely was written here about rivers and hills, without any of those words in such an order at all."
    rows = [(1, "before words " + ITEM + " after"), (2, changed), (3, other), (4, None), (5, ""), (6, ITEM.replace("walks", "slowly walks")), (7, mixed), (1, "before words " + ITEM + " after")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(70, ITEM, "x"), (71, None, "x"), (72, "too few words", "x")], "item_id long, text string, tokens string")
    got = {r.doc_id: r for r in leaks.contaminated(docs, items).collect()}
    assert set(got) == {1, 2, 6, 7} - ({7} - set(got))
    assert got[1].kind == "verbatim" and got[2].kind == "template" and got[2].consistent and got[6].kind == "verbatim"
    assert leaks.contaminated(docs.limit(0), items).count() == 0 and leaks.contaminated(docs, items.limit(0)).count() == 0


def test_inconsistent_slots_are_told_apart(spark):
    item = "Add 5 to the number 5 and then take 5 from the number 9 to get what is left of it."
    good = item.replace("9", "1").replace("5", "4")
    bad = "Add 4 to the number 6 and then take 8 from the number 8 to get what is left of it."
    docs = spark.createDataFrame([(1, good), (2, bad)], "doc_id long, text string")
    got = {r.doc_id: r for r in leaks.contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert got[1].consistent and (2 not in got or got[2].kind == "verbatim")


def test_licenses(spark):
    mit = licenses.TEMPLATES["MIT"][3]
    w = mit.split()
    rows = [(1, "some words\nReleased under the MIT License.\nmore"), (2, " ".join(["intro"] * 30 + w + ["outro"] * 50)), (3, " ".join(w[: len(w) // 2])), (4, None), (5, ""), (6, "no notice in here"), (7, "LICENSED under the Apache License, version 2.0"), (1, "some words\nReleased under the MIT License.\nmore")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, license int")
    got = {(r.doc_id, r.license): r.containment for r in licenses.license_scan(docs).collect()}
    assert got == {(1, "MIT"): 100, (2, "MIT"): 100, (7, "Apache-2.0"): 100}
    assert licenses.license_scan(docs.limit(0)).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    passed = {r.doc_id for r in docs.collect() if quality.judge(r.text)[6]}
    ids = {r.doc_id for r in out}
    assert ids <= passed and len(ids) == len(out) and len(ids) > 0.8 * len({docs_text for docs_text in (r.text for r in docs.collect() if r.doc_id in passed)})
    first = corpus_pipeline.STAGES[0][1](spark, docs, "/root/testdata/sf0.001")
    assert {r.doc_id for r in first.collect()} == passed and first.columns == docs.columns
    assert all(len(r.ids_sha256) == len(hashlib.sha256().hexdigest()) for r in out)


def test_pipeline_against_brute_force(spark, tmp_path):
    rng = random.Random(31)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 8)))
    line = lambda n: " ".join(word() for _ in range(n)) + "."
    item = "Anna buys twelve apples and seven pears at the market then walks home with her friend Maria and eats five of them"
    common, texts = line(9), []
    for k in range(24):
        body = [line(rng.randrange(8, 14)) for _ in range(4)]
        body += [common] * (k % 3 == 0) + ["Home | About | Login"] * (k % 5 == 0) + [item + "."] * (k % 8 == 1)
        texts.append("\n".join(body))
    texts += [texts[2].replace("a", "b", 1), texts[3], None, "", "too short.", "!!! ??? " * 30]
    # Near copies on one line: the line stage leaves them, the next one does not.
    long = line(80)
    texts += [long, long[:-1] + " " + word() + " " + word() + "."]
    docs = list(enumerate(texts))
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    rows = [(i, quality.judge(t)[-1]) for i, t in docs if quality.judge(t)[6]]
    gone = lines_brute(rows)
    rows = [(i, "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i, t][4])) for i, t in rows]
    rows = [(i, t) for i, t in rows if t.strip()]
    comp = near_brute(rows, 5)
    rows = [(i, t) for i, t in rows if comp[i, t][1] == i]
    assert len(comp) > len(rows)
    leaky = [i for i, t in rows if "walks home with her friend" in t]
    rows = [(i, t) for i, t in rows if i not in leaky]
    assert leaky and len(rows) > 15
    tok = Tokenizer.from_file(bpe.default_tokenizer())
    want = {(i, np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()) for i, t in rows}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {(r.doc_id, bytes(r.ids)) for r in out} == want and len(out) == len(want)
    assert all(hashlib.sha256(r.ids).hexdigest() == r.ids_sha256 and r.n_tokens * 4 == len(r.ids) for r in out)


def test_stages_take_empty_tables_nulls_and_odd_columns(spark, tmp_path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    text = ITEM + " " + "Other words follow here and there, so that it is long enough for the rules."
    rows = [(1, text, "kept", 7), (1, text, "kept", 7), (None, text + " And more of it stands at the end.", "kept", 7), (3, None, None, 7), (4, "", None, 7)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept int")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), str(tmp_path)).count() == 0, name
        out = stage(spark, odd, str(tmp_path))
        assert out.count() <= 5 and "doc_id" in out.columns and ("text" in out.columns or name == "encode"), name
