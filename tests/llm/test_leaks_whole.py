"""Leaks against a brute-force alignment of every document with every item."""

from strandline.llm import leaks

ITEM = "Anna buys twelve apples and seven pears at the market, then walks home with her friend Maria and eats five of them."


def _plain(text):
    return text.translate({ord(c): None for c in leaks.MARKS}).lower().split()


def _held(doc, item):
    """Whether some offset has PERCENT percent of the item's words, case aside."""
    d, i = _plain(doc), _plain(item)
    return any(sum(0 <= s + k < len(d) and d[s + k] == w for k, w in enumerate(i)) * 100 >= len(i) * leaks.PERCENT for s in range(-len(i), len(d)))


def _spoiled(text, step, word="other"):
    return " ".join(word if k % step == step - 1 else w for k, w in enumerate(text.split()))


def test_copies_by_case_length_and_share(spark):
    items = [(1, ITEM), (2, "one two three four five"), (3, "red green blue black white grey"), (4, "up down left right front back near"), (5, "alpha beta gamma delta eps zeta eta theta"), (6, "only three words")]
    texts = ["nothing of all this is held here, not a single item " * 3]
    for _, t in items:
        for made in (t, t.upper(), t.lower(), t.title(), _spoiled(t, 5), _spoiled(t.upper(), 5), _spoiled(t, 4), _spoiled(t, 3)):
            for before in range(5):
                texts.append(" ".join(["before"] * before + [made, "after it"]))
    docs = list(enumerate(texts))
    got = {(r.doc_id, r.item_id) for r in leaks.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).where("kind = 'verbatim'").collect()}
    want = {(d, i) for d, t in docs for i, item in items if _held(t, item)}
    assert got == want and len(want) > 150


def test_alignments_are_judged_one_by_one(spark):
    item = "Add 5 to the number 7 and then take 5 from the number 9 to get what is left of it."
    one, two = item.replace("9", "1").replace("5", "4"), item.replace("9", "2").replace("5", "8").replace("7", "6")
    filler = "here some words stand that belong to nobody " * 30
    broken = "Add 4 to the number 6 and then take 8 from the number 8 to get what is left of it."
    rows = [(1, one + " " + filler + two), (2, filler + "then take 33 from the number 44 " + filler + one), (3, one.replace("and then", "and quickly then")), (4, broken)]
    # Four parts of the item far apart, none of them PERCENT percent of it.
    w = item.split()
    rows.append((5, f" {filler} ".join(" ".join(w[k : k + 5]) for k in range(0, len(w), 5))))
    got = {r.doc_id: r for r in leaks.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert got[1].consistent and got[2].consistent and got[3].n_matched == got[3].n_tokens
    assert 5 not in got and (4 not in got or got[4].kind == "verbatim")
