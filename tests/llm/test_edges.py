"""Empty tables, null ids, clashing columns, repeated rows and a very long text, for every operator on documents."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandline.llm import bpe, chat, leaks, licenses, passages, quality, suffixes

ITEM = "Anna buys twelve apples and seven pears at the market then walks home with her friend Maria and eats five of them"
CLASH = "doc_id long, text string, kept string, n_bytes string, tkey string, digest string, words string, n string, id string, ids string, license string, item_id string, n_words string"


def items(spark):
    return spark.createDataFrame([(1, ITEM)], "item_id long, text string")


OPERATORS = {
    "quality": lambda s, d: quality.quality_rules(d),
    "passages": lambda s, d: passages.chunk_dedup(d),
    "leaks": lambda s, d: leaks.contaminated(d, items(s)),
    "bpe": lambda s, d: bpe.encoded_digests(d),
    "suffixes": lambda s, d: suffixes.exact_dedup(d),
    "licenses": lambda s, d: licenses.license_scan(d),
}


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, *"abcdefghijk") for i, t in rows], CLASH)


def words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, clashing(spark, []).limit(0)).count() == 0


def test_no_items(spark):
    assert leaks.contaminated(clashing(spark, [(1, ITEM)]), items(spark).limit(0)).count() == 0


def test_no_turns(spark):
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string, ts string")).count() == 0


def test_null_ids_repeated_rows_and_clashing_columns(spark):
    shared = words(60, 1)
    # A null id comes first, so its copy stays; rows 2 and 2 are one document.
    docs = clashing(spark, [(None, shared), (2, words(30, 2) + " " + shared), (2, words(30, 2) + " " + shared), (3, None), (4, "")])
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed > 0) for r in passages.chunk_dedup(docs).collect()), key=str)
    assert got == sorted([(None, len(shared), False), (2, len(words(30, 2) + " " + shared), True), (2, len(words(30, 2) + " " + shared), True), (3, 0, False), (4, 0, False)], key=str)
    notice = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    held = licenses.license_scan(clashing(spark, [(None, notice), (None, notice), (5, None)])).collect()
    assert [r.doc_id for r in held] == [None] * len({r.license for r in held}) and held
    judged = quality.quality_rules(clashing(spark, [(None, "Too short."), (3, None)])).collect()
    assert {(r.doc_id, r.kept, r.n_words) for r in judged} == {(None, False, 2), (3, False, 0)}
    tok = bpe.encoded_digests(clashing(spark, [(None, "a b"), (None, "a b"), (1, None)])).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in tok), key=str) == [(1, 0), (None, 2), (None, 2)]
    cut = suffixes.exact_dedup(clashing(spark, [(None, shared), (1, shared), (2, None)])).collect()
    assert {(r.doc_id, r.n_removed) for r in cut} == {(None, len(shared)), (1, len(shared)), (2, 0)}


@pytest.fixture(scope="module")
def long_text():
    return words(150_000, 7)


def test_very_long_texts(spark, long_text):
    """About a megabyte: counts of the whole text, and what stands at its very end is found."""
    tail = f"{long_text} {ITEM}"
    docs = clashing(spark, [(1, long_text), (2, tail), (3, words(40, 8))])
    judged = {r.doc_id: r.n_words for r in quality.quality_rules(docs).collect()}
    assert judged[1] == "150000" or judged[1] == 150_000
    assert {(r.doc_id, r.item_id) for r in leaks.contaminated(docs, items(spark)).collect()} == {(2, 1)}
    left = {r.doc_id: r for r in passages.chunk_dedup(docs).collect()}
    assert left[1].n_removed == 0 and left[2].n_removed > 0.999 * len(long_text) and left[3].n_removed == 0
    exact = {r.doc_id: r.n_removed for r in suffixes.exact_dedup(docs).collect()}
    assert exact == {1: len(long_text), 2: len(long_text), 3: 0}
    tok = Tokenizer.from_file(bpe.default_tokenizer())
    got = {r.doc_id: r.n_tokens for r in bpe.encoded_digests(docs).collect()}
    assert got[2] == len(tok.encode(tail, add_special_tokens=False).ids)


def test_very_long_turn(spark, long_text):
    turns = spark.createDataFrame([(1, 0, "user", long_text), (1, 1, "assistant", long_text + " [INST]")], "conv_id long, turn long, role string, text string")
    row = chat.format_chats(turns).select(chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("x")).first()
    assert hashlib.sha256(row.x[0].encode()).digest() == hashlib.sha256((long_text + " [INST]").encode()).digest()


def test_copies_of_a_row_leave_the_pipeline(spark, tmp_path):
    import corpus_pipeline

    text = words(50, 9)
    docs = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text), (None, text), (3, "x y"), (3, None)], "doc_id long, text string")
    out = dict(corpus_pipeline.STAGES)["near"](spark, docs, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted([(1, text), (None, text), (3, "x y"), (3, None)], key=str)
