import hashlib
import io
import os
import random
import uuid
import zlib

import numpy as np
from tokenizers import Tokenizer

from strandline.llm import bpe, ids

ODD = [(1, None), (2, ""), (3, " a"), (4, "a  b c"), (5, "x <|endoftext|> y<|endoftext|>z"), (6, "日本語 テキスト　です "), (7, "a b c\n\nd e "), (8, "Hello's we'll  \n x"), (9, "é f​ g"), (9, "again"), (None, "no id"), (10, "word " * 4000)]


def rows():
    rng = random.Random(3)
    base = "".join(rng.choice(["the ", "of ", "ouen ", "\n", "x. ", "é ", "12 ", "  "]) for _ in range(4000))
    return ODD + [(100 + i, base[: 1500 * i] + f"edit{i}" + base[1500 * i :]) for i in range(6)]


def le(x):
    return np.array(x, dtype="<u4").tobytes()


def test_encoding_equals_the_library(spark):
    tok = Tokenizer.from_file(bpe.default_tokenizer())
    data = rows()
    want = set()
    for i, t in data:
        e = tok.encode(t or "", add_special_tokens=False).ids
        want.add((i, len(e), hashlib.sha256(le(e)).hexdigest(), hashlib.sha256(tok.decode(e, skip_special_tokens=False).encode()).hexdigest()))
    docs = spark.createDataFrame([(i, t, 1) for i, t in data], "doc_id long, text string, key int")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encoded_digests(docs).collect()}
    assert got == want


def test_joins_use_given_pieces():
    enc = bpe.encoder(bpe.default_tokenizer())
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 20
    data = text.encode()
    piece = {"start": 33, "n": 500, "ids": enc.encode([data[33:533].decode()])[0]}
    assert bpe.assemble(enc, text, [piece]) == enc._ids([text])[0]
    assert bpe.assemble(enc, "x" * 700, [{"start": 10, "n": 300, "ids": enc.encode(["x" * 300])[0]}]) is None
    wrong = {**piece, "ids": piece["ids"][4:]}
    assert bpe.assemble(enc, text, [wrong]) in (None, enc._ids([text])[0])


def test_repeated_pre_tokens_are_not_encoded_again():
    enc = bpe.Encoder(bpe.default_tokenizer())
    tok, given = enc.tok, []

    class Counted:
        def encode_batch_fast(self, texts, **more):
            given.extend(texts)
            return tok.encode_batch_fast(texts, **more)

        def __getattr__(self, name):
            return getattr(tok, name)

    enc.tok = Counted()
    stems = [a + b + c for a in ("ther", "onen", "shin") for b in ("ati", "ouent", "le") for c in ("", "ly", "ed")]
    signs = [", ", ".\n", "!!  ", "; "]
    for _ in range(2):
        enc.encode([" ".join(stems), "\n".join(stems), "".join("a" + x for x in signs)])
    given.clear()
    texts = ["".join(x + y for x in stems for y in signs) + f"{a}{b}" for a in stems for b in signs]
    assert enc.encode(texts) == [le(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert sum(map(len, given)) < 0.001 * sum(map(len, texts))


def test_pre_tokens_are_cut_as_by_the_library(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PARTS", 300)
    monkeypatch.setattr(bpe, "MARKS", 64)
    enc, rng = bpe.Encoder(bpe.default_tokenizer()), random.Random(11)
    assert enc.cuts_parts
    odd = [chr(c) for c in (*range(0x250), 0x300, 0x378, 0x660, 0x966, 0x1680, 0x2003, 0x200B, 0x2028, 0x2160, 0x2460, 0x3000, 0x3007, 0x4E00, 0xA7DA, 0xFEFF, 0xFFFD, 0x10330, 0x1D7D8, 0x1F600, 0x20000, 0x323AF, 0xE0100)]
    usual = [" ", "  ", "\n", "\t", "a", "b", "Re", "'s", "'ll", "'", "12", ",", "<|endoftext|>", "_", "é", "²", "½"]
    texts = ["", *odd, *(x + y for x in odd for y in (x, "a", " a", "1", ".")), *("a" + x for x in odd), *(" " + x for x in odd)]
    texts += ["".join(rng.choice(usual if rng.random() < 0.9 else odd) for _ in range(rng.randrange(40))) for _ in range(3000)]
    rng.shuffle(texts)
    want = [le(e.ids) for e in enc.tok.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        for k in range(0, len(texts), 250):
            assert enc.encode(texts[k : k + 250]) == want[k : k + 250]
    assert len(enc.parts) <= 300


def test_files_round_trip(spark, tmp_path):
    root = "file://" + str(tmp_path / uuid.uuid4().hex)
    tok = Tokenizer.from_file(bpe.default_tokenizer())
    data = rows()
    docs = spark.createDataFrame([(i, t, 1) for i, t in data], "doc_id long, text string, start int")
    ids.write_ids(docs, root, shards=3)
    got = ids.read_ids(spark, root).orderBy("start").collect()
    at = 0
    for r in got:
        assert r.start == at
        at += len(r.ids) // 4
    want = sorted(((i, zlib.crc32(le([*tok.encode(t or "", add_special_tokens=False).ids, 0]))) for i, t in data), key=repr)
    assert sorted(((r.doc_id, zlib.crc32(r.ids)) for r in got), key=repr) == want
    order = [r.doc_id for r in got]
    assert order[0] is None and order[1:] == sorted(order[1:])
    found = {r.doc_id: r for r in ids.lookup_ids(spark.createDataFrame([(10,), (-7,), (55,), (None,)], "doc_id long"), root).collect()}
    assert found[10].found and bytes(found[10].ids) == le([*tok.encode("word " * 4000, add_special_tokens=False).ids, 0])
    assert not found[-7].found and not found[55].found and None not in found
    assert not [n for _, _, names in os.walk(root[7:]) for n in names if n.startswith(".0")]
    empty = root + "-empty"
    ids.write_ids(docs.limit(0), empty)
    assert ids.read_ids(spark, empty).count() == 0


def test_digests_of_the_files_need_no_second_python_stage(spark, tmp_path):
    tok = Tokenizer.from_file(bpe.default_tokenizer())
    data = [(i, t) for i, t in enumerate(["a b", None, "", "c ² d\n"])]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = ids.op7_token_ids(spark, str(tmp_path))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    all_ids = [[*tok.encode(t or "", add_special_tokens=False).ids, 0] for _, t in data]
    want = [(i, sum(map(len, all_ids[:i])), len(x), zlib.crc32(le(x))) for i, x in enumerate(all_ids)]
    assert sorted(map(tuple, got.collect())) == want


def test_null_and_negative_ids_and_copies_over_shards(spark, tmp_path):
    root = "file://" + str(tmp_path / uuid.uuid4().hex)
    tok = Tokenizer.from_file(bpe.default_tokenizer())
    data = [(None, "none"), (None, "none too"), (-5, "minus five"), (-3, "minus three"), (8, "eight")] + [(2, f"copy {k}") for k in range(400)]
    ids.write_ids(spark.createDataFrame(data, "doc_id long, text string"), root, shards=4)
    got = ids.read_ids(spark, root).collect()
    assert len({(r.doc_id, r.copy) for r in got}) == len(data) and sorted(r.copy for r in got if r.doc_id == 2) == list(range(400))
    order = sorted(got, key=lambda r: r.start)
    assert [r.copy for r in order if r.doc_id == 2] == list(range(400))
    found = {r.doc_id: r for r in ids.lookup_ids(spark.createDataFrame([(-5,), (-3,), (0,), (2,), (8,)], "doc_id long"), root).collect()}
    assert {k: r.found for k, r in found.items()} == {-5: True, -3: True, 0: False, 2: True, 8: True}
    assert bytes(found[-5].ids) == le([*tok.encode("minus five", add_special_tokens=False).ids, 0])
    assert bytes(found[2].ids) == next(bytes(r.ids) for r in order if r.doc_id == 2)
    assert ids.write_ids(spark.createDataFrame(data, "doc_id long, text string"), root + "-b", shard_bytes=500).count() > 3


def test_perfect_hash():
    keys = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    assert sorted(ids.PerfectHash.build(keys).slots(keys).tolist()) == list(range(len(keys)))

    class Counted(io.BytesIO):
        read_bytes = 0

        def read(self, n=-1):
            out = super().read(n)
            self.read_bytes += len(out)
            return out

    raw = ids.write_index(keys, np.arange(5000), np.full(5000, 3))
    ok, starts, counts = ids.Index(io.BytesIO(raw)).find(keys)
    assert ok.all() and (starts == np.arange(5000)).all() and (counts == 3).all()
    many = np.random.default_rng(2).integers(0, 2**63, 200_000).astype(np.uint64)
    raw = ids.write_index(many, np.arange(200_000), np.full(200_000, 3))
    one = Counted(raw)
    ok, starts, _ = ids.Index(one).find(many[77:78])
    assert ok.all() and starts[0] == 77 and one.read_bytes < 2000 < len(raw)
    assert not ids.Index(io.BytesIO(raw)).find(np.arange(100, dtype=np.uint64))[0].any()
    assert ids.Index(io.BytesIO(ids.write_index(keys[:0], keys[:0], keys[:0]))).find(keys[:3])[0].sum() == 0
