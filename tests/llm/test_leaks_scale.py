"""Number tables: every window of placeholders meets every other one."""

import random
import time

from strandline.llm import leaks


def test_number_tables_take_seconds(spark):
    rng = random.Random(1)
    number = lambda: str(rng.randrange(10, 99_999))
    items = [(k, " ".join(number() for _ in range(40))) for k in range(40)]
    held = items[7][1].split()
    table = [number() for _ in range(2000)]
    table[500:540] = held
    spoiled = [number() for _ in range(300)] + [w if k % 6 else number() for k, w in enumerate(items[3][1].split())] + [number() for _ in range(300)]
    docs = spark.createDataFrame([(1, " ".join(table)), (2, " ".join(spoiled)), (3, " ".join(number() for _ in range(2000)))], "doc_id long, text string")
    began = time.time()
    got = {(r.doc_id, r.item_id, r.kind) for r in leaks.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(1, 7, "verbatim"), (2, 3, "verbatim")} and time.time() - began < 120


def test_templates_in_number_tables(spark):
    """Items with a few words among numbers: their windows of numbers alone meet a table everywhere."""
    rng = random.Random(2)
    number = lambda: str(rng.randrange(10, 999))
    row = lambda: "sum of " + " ".join(map(str, rng.sample(range(10, 999), 9))) + " is about 1" + number() + "0"
    items = [(k, row()) for k in range(5)]
    filled = "sum of " + " ".join(str(k) for k in range(201, 210)) + " is about 300"
    docs = [(1, " ".join(number() for _ in range(700)) + " " + items[2][1] + " " + " ".join(number() for _ in range(700))), (2, " ".join(number() for _ in range(900))), (3, "we see that " + filled)]
    began = time.time()
    got = {(r.doc_id, r.item_id, r.kind) for r in leaks.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert (1, 2, "verbatim") in got and not any(d == 2 for d, _, _ in got) and {i for d, i, _ in got if d == 3} == set(range(5)) and time.time() - began < 120


def _changed(rng, text):
    """The text with other numbers, each standing for the same one throughout."""
    to: dict[str, str] = {}
    free = rng.sample([str(n) for n in range(100, 999)], 60)
    return " ".join(to.setdefault(w, free.pop()) if w.isdigit() else w for w in text.split())


def test_recall_of_templates(spark):
    """Items with other numbers and a tenth of their words changed."""
    rng = random.Random(6)
    words = "add the to number and then take from get what is left of it with each one more".split()
    items = [(k, " ".join(str(rng.randrange(2, 90)) if rng.random() < 0.2 else rng.choice(words) for _ in range(rng.randrange(15, 50)))) for k in range(40)]
    filler = lambda: " ".join(rng.choice("here some other words stand that belong to nobody at all".split()) for _ in range(60))
    rows = []
    for k, t in items:
        w = _changed(rng, t).split()
        for i in rng.sample(range(len(w)), len(w) // 10):
            w[i] = "changed" if not w[i].isdigit() else w[i]
        rows.append((k, f"{filler()} {' '.join(w)} {filler()}"))
    got = {(r.doc_id, r.item_id) for r in leaks.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert sum((k, k) in got for k, _ in items) >= 0.9 * len(items) and all(d == i for d, i in got)
    assert leaks.contaminated(spark.createDataFrame(rows[:0], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert leaks.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")).count() == 0
