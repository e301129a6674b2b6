import hashlib
import random
from collections import Counter

import numpy as np
import sentencepiece
from tokenizers import Tokenizer

from strandline.llm import bpe, crosstok

ODD = [None, "", " ", "  ", "a ", "a  b   c", "x <|endoftext|> <s></s><unk> y", "日本語 テキスト　です ", "naïve café ﬁ ①", "▁ under ▁x", "tab\tand\r\nlines\n\n  indented", "\x00 nul", "emoji 👩‍👩‍👧 end", "don't we'll  2024-11-05", "aaaa" * 400, "word " * 3000 + "end", " lead"]


def texts():
    rng = random.Random(5)
    words = "the of ouen café naïve 12 3.5 end, (x) 日本 antidisestablishmentarianism zzzq".split()
    return ODD + [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 80))) for _ in range(60)] + ["the same text"] * 5


def brute(texts):
    a_tok = Tokenizer.from_file(bpe.default_tokenizer())
    a_tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=crosstok.piece_tokenizer())
    byte_of = bpe._byte_of()
    docs, counts = [], Counter()
    for t in texts:
        a = a_tok.encode(" " + t, add_special_tokens=False).ids if t else []
        b = sp.encode(t) if t else []
        ab = [bytes(byte_of[c] for c in a_tok.id_to_token(i)) for i in a]
        bb = [bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode() for p in map(sp.id_to_piece, b)]
        if not t or b"".join(ab) != (" " + t).encode() or b"".join(bb) != (" " + t).encode():
            docs.append(([], [], [], []))
            continue
        ea, eb = np.cumsum([len(x) for x in ab]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        cuts, groups, i, j = sorted(set(ea) & set(eb)), [], 0, 0
        for c in cuts:
            x, y = ea.index(c) + 1, eb.index(c) + 1
            groups.append((a[i:x], b[j:y]))
            i, j = x, y
        sa, sb = [0, *ea], [0, *eb]
        links, j0 = [], 0
        for i in range(len(a)):
            while sb[j0 + 1] <= sa[i]:
                j0 += 1
            j = j0
            while j < len(b) and sb[j] < sa[i + 1]:
                links.append((a[i], b[j]))
                j += 1
        counts.update(links)
        docs.append((a, b, groups, links))
    most = {}
    for (_, b), c in counts.items():
        most[b] = max(most.get(b, 0), c)
    rows = []
    for a, b, groups, links in docs:
        sha = hashlib.sha256(";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups).encode()).hexdigest() if groups else ""
        rows.append((len(a), len(b), len(groups), len(links), sum(counts[k] == most[k[1]] for k in links), sum(counts[k] for k in links), sha))
    return rows, {(a, b, c, c == most[b]) for (a, b), c in counts.items()}


def test_against_brute_force(spark, monkeypatch):
    data = texts()
    docs = spark.createDataFrame([(k if k else None, t, 1, "x") for k, t in enumerate(data)], "doc_id long, text string, n_a int, Chunk string").repartition(3)
    done, pairs = crosstok.align_tokens(docs, chunk_bytes=2000)
    want, counts = brute(data)
    got = {r.doc_id or 0: tuple(r)[1:] for r in done.collect()}
    assert got == dict(enumerate(want)) and len(got) == len(data)
    assert {tuple(r) for r in pairs.collect()} == counts


def test_forgetting_changes_nothing():
    whole = crosstok.Aligner(bpe.default_tokenizer(), crosstok.piece_tokenizer())
    new = crosstok.Aligner(bpe.default_tokenizer(), crosstok.piece_tokenizer())
    data = [t or "" for t in texts()]
    for t, x in zip(data, whole.groups(data), strict=True):
        new.forget()
        (y,) = new.groups([t])
        name = lambda al, g: g and [al.machine.names[k] for k in np.frombuffer(g, "<i4")]
        assert name(whole, x) == name(new, y)
        (z,) = new._run([t]) if t else (None,)
        assert name(new, y) == name(new, z)


def test_both_sides_equal_their_libraries(monkeypatch):
    monkeypatch.setattr(crosstok, "CACHE_WORDS", 50)
    both = crosstok.Aligner(bpe.default_tokenizer(), crosstok.piece_tokenizer())
    assert both.b.by_word and both.fast
    data = [t or "" for t in texts()]
    tok = Tokenizer.from_file(bpe.default_tokenizer())
    tok.encode_special_tokens = True
    assert both._ids(data) == [tok.encode(" " + t, add_special_tokens=False).ids for t in data]
    assert [both._ids([t])[0] for t in data] == both._ids(data)
    once, again = both.groups(data), [both.groups([t])[0] for t in data]
    assert once == again


def test_empty_table(spark):
    done, pairs = crosstok.align_tokens(spark.createDataFrame([], "doc_id long, text string"))
    assert done.count() == 0 and pairs.count() == 0
