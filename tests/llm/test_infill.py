import hashlib
import re

import pytest

from strandline.llm import infill

TEXTS = [(1, None), (2, ""), (3, "one line"), (4, "a\nb\nc\n"), (5, "\n\n\n"), (6, "x <P> y\nz"), (7, " \n< P>\r\n odd\x0bends"), (8, "日本\n語\n" * 30), (9, "<\n<S\nP>\n"), (9, "<\n<S\nP>\n"), (None, "no\nid\n"), (11, "long line " * 30_000 + "\nend\n" * 5_000)]
UNITS = {"line": r"[^\n]*\n|[^\n]+", "word": r"^[ \t\n\x0b\x0c\r]+|[^ \t\n\x0b\x0c\r]+[ \t\n\x0b\x0c\r]*", "char": r"(?s:.)"}


def brute(key, text, unit, rate=100, spm=50, seed=7):
    t = text or ""
    parts = re.findall(UNITS[unit], t)
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(parts)
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(parts[:i]), "".join(parts[i:j]), "".join(parts[j:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return (key, n, "plain", None, None, t)
    if h4 % 100 < spm:
        return (key, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (key, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("unit", sorted(UNITS))
@pytest.mark.parametrize("rate,spm", [(100, 50), (60, 0)])
def test_against_brute_force(spark, unit, rate, spm):
    docs = spark.createDataFrame([(k, t, "was", [k]) for k, t in TEXTS] + [(100 + k, "w1 w2\n w3  w4\n\nw5", "", None) for k in range(40)], "doc_id long, text string, Output string, more array<long>")
    made = infill.fill_in_middle(docs, unit=unit, rate=rate, spm_rate=spm)
    assert made.columns == ["doc_id", "text", "more", "n", "form", "prefix_chars", "middle_chars", "output"]
    rows = made.withColumn("back", infill.restored(made.output, made.form)).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows), key=repr)
    assert got == sorted((brute(r.doc_id, r.text, unit, rate, spm) for r in rows), key=repr) and len(got) == len(TEXTS) + 40
    assert all(r.back == (r.text or "") for r in rows)
    assert {r.form for r in rows} >= ({"psm", "spm", "plain"} if spm else {"psm", "plain"})


def test_empty_table_and_refusals(spark):
    assert infill.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for bad in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("ab", "bc", "x"), ("aa", "b", "c"), ("<P>", "x<P>y", "<M>")):
        with pytest.raises(ValueError):
            infill.fill_in_middle(docs, sentinels=bad)
    with pytest.raises(ValueError):
        infill.fill_in_middle(docs, unit="page")


def test_sentinels_that_change_the_class(spark):
    docs = spark.createDataFrame([(1, "a\nb"), (2, "a b c d")], "doc_id long, text string")
    rows = {r.doc_id: r for r in infill.fill_in_middle(docs, sentinels=("\n", "|", "#")).collect()}
    assert (rows[1].form, rows[1].n) == ("plain", 2) and rows[2].form != "plain"
