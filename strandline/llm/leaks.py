"""Benchmark decontamination by templates: placeholders for numbers, names and units, a hash join of template windows, a check of the slots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, table

#: Tokens of a window in ORACLE_SQL, and how many words besides slots a template match needs.
WINDOW, LITERALS = 5, 3
#: Percent of an item's tokens that must be found in their places.
PERCENT = 80
#: Benchmark windows up to this many are sent to every executor (about 24 bytes each); more are joined by a shuffle.
BROADCAST_WINDOWS = 1_000_000
#: Marks that are dropped from words, and words that count as units.
MARKS = ".,;:!?\"'()[]{}…«»“”‘’¿¡$€£"
UNITS = ("km", "m", "cm", "mm", "mile", "miles", "feet", "inches", "kg", "g", "mg", "lb", "lbs", "pounds", "grams", "l", "ml", "liters", "litres", "gallons", "s", "sec", "seconds", "min", "minutes", "h", "hours", "days", "weeks", "months", "years", "dollars", "euros", "cents", "%", "percent", "degrees", "mph", "km/h")


def _words(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), MARKS, ""), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _template(w: Column) -> Column:
    first = F.substring(w, 1, 1)
    return F.when(first.between("0", "9"), F.lit("\x01number")).when(w.isin(*UNITS), F.lit("\x01unit")).when(first != F.lower(first), F.lit("\x01name")).otherwise(w)


def _folded(w: Column) -> Column:
    """A number or unit as its placeholder, any other word in lower case."""
    low = F.lower(w)
    return F.when(F.substring(w, 1, 1).between("0", "9"), F.lit("\x01number")).when(low.isin(*UNITS), F.lit("\x01unit")).otherwise(low)


def _tokens(words: Column) -> Column:
    """(a, up) a word: the hash of its folded form, and whether it may stand for a name as well."""
    pairs = F.transform(words, lambda w: F.struct(_folded(w).alias("f"), F.substring(w, 1, 1).alias("c")))
    return F.transform(pairs, lambda p: F.struct(F.xxhash64(p["f"]).alias("a"), (~p["f"].startswith("\x01") & (p["c"] != F.lower(p["c"]))).alias("up")))


def _slot(w: Column) -> Column:
    return _folded(w).startswith("\x01") | _template(w).startswith("\x01")


def _plain(words: Column) -> Column:
    """Tokens as _tokens gives them, of words that stand for themselves only."""
    return F.transform(words, lambda w: F.struct(F.xxhash64(F.lower(w)).alias("a"), F.lit(False).alias("up")))


def _keyed(rows: DataFrame, widths: Column, most: int) -> DataFrame:
    """rows(..., tokens) to a row a window of a width in widths and form of it: ..., at, width, key. Each capitalised word counts as itself and as a name.

    The generators are outer ones, for which no filter is inferred: pushed down, it would spell the words out again.
    """
    kept = [F.col(c) for c in rows.columns if c not in ("tokens", "widths")]
    at = rows.withColumn("widths", widths).select("*", F.posexplode_outer("tokens").alias("at", "t0")).where("at IS NOT NULL")
    at = at.select(*kept, "tokens", "at", F.explode_outer("widths").alias("width")).where(F.col("at") + F.col("width") <= F.size("tokens"))
    tokens = [F.get("tokens", F.col("at") + k) for k in range(most)]
    ups = reduce(lambda x, y: x + y, [F.when((F.col("width") > k) & t["up"], 1 << k).otherwise(0) for k, t in enumerate(tokens)])
    forms = F.array(*[F.array(*[F.lit(c) for c in range(1 << most) if c & m == c]) for m in range(1 << most)])
    each = at.select(*kept, "tokens", "at", "width", F.explode_outer(F.get(forms, ups)).alias("form"))
    words = [F.when(F.col("width") > k, F.when(F.col("form").bitwiseAND(1 << k) != 0, F.lit(-1).cast("long")).otherwise(t["a"])) for k, t in enumerate(tokens)]
    return each.select(*kept, "at", "width", F.xxhash64("width", *words).alias("key"))


def contaminated(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Pairs of a document and a benchmark item that it holds, word for word or with other numbers, names or units.

    Returns doc_id, item_id, n_tokens (of the item), n_matched (tokens found in their places),
    n_equal (of those, equal but for case), n_slots, consistent, kind ('verbatim' or 'template').

    Words lose MARKS; a word that begins with a digit, a unit, or a word that begins with a capital
    is a slot. Tokens match if they are equal but for case, or slots of one kind. Of an item with
    n tokens, n * (100 - PERCENT) / 100 may differ; so one of as many stretches and one more
    matches whole, and the item's windows are as long as the shortest of those (4 words, less in
    short items). All of them meet all windows of the documents; a pair with fewer windows in
    common than PERCENT percent of matching tokens leave whole is dropped before its text is read.
    A pair is aligned at each offset of its windows, alone and as a chain that moves to offsets less
    than n away where words were put in or left out, and compared token by token; a task holds the offsets of a
    stretch of some n, however long a document is. Each alignment is
    judged by itself and the best counts (verbatim before template, then by n_matched, n_equal).
    It is verbatim if PERCENT percent of the item's tokens are equal; it is a template match if that share matches,
    LITERALS equal words that are no slots among it, and the slots are consistent, that is, each
    value of the item stands for one value in the document and the other way round. Items with fewer
    such words can only be held verbatim, and their windows are of words, not templates: numbers of a table don't meet those of another. Null texts and
    items without tokens match nothing; rows with a null id are compared too and keep their null;
    rows equal in id and text give one row; other columns are ignored.
    Empty tables give an empty result.
    """
    d = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).where("text IS NOT NULL").withColumn("tkey", F.xxhash64("text"))
    b = items.select(F.col(f"`{item_id}`").alias("item_id"), _words(F.col(f"`{text}`")).alias("item_words")).withColumn("ikey", F.xxhash64("item_words")).withColumn("n", F.size("item_words"))
    b = b.where("n > 0").dropDuplicates(["item_id", "ikey"]).withColumn("differ", F.floor(F.col("n") * (100 - PERCENT) / 100).cast("int"))
    b = b.withColumn("width", F.floor(F.col("n") / (F.col("differ") + 1)).cast("int"))
    # Without LITERALS words of its own an item has no template match; its windows are of words as they are.
    b = b.withColumn("plain", F.size(F.filter("item_words", lambda w: ~_slot(w))) < LITERALS)
    sizes = b.groupBy("plain", "width").agg(F.sum("n").alias("total")).collect()
    small = sum(r["total"] for r in sizes) <= BROADCAST_WINDOWS

    def windows(plain: bool) -> DataFrame:
        """Windows that documents and items of one kind have in common: doc_id, tkey, item_id, ikey, n, differ, width, shift, i_at."""
        widths = sorted(r["width"] for r in sizes if r["plain"] == plain) or [1]
        made, most = _plain if plain else _tokens, max(widths)
        mine = b.where("plain" if plain else "NOT plain").select("item_id", "ikey", "n", "differ", F.col("width").alias("own"), made(F.col("item_words")).alias("tokens"))
        of_items = _keyed(mine, F.array("own"), most).select("item_id", "ikey", "n", "differ", F.col("at").alias("i_at"), "key")
        of_docs = _keyed(d.select("doc_id", "tkey", made(_words(F.col("text"))).alias("tokens")), F.array(*[F.lit(w) for w in widths]), most)
        return of_docs.join(F.broadcast(of_items) if small else of_items, "key").select("doc_id", "tkey", "item_id", "ikey", "n", "differ", "width", (F.col("at") - F.col("i_at")).alias("shift"), "i_at")

    met = reduce(DataFrame.unionByName, [windows(plain) for plain in sorted({r["plain"] for r in sizes} or {False})])
    # An alignment begins at one offset and stays less than n from it. Offsets are dealt to stretches of 2n, each with n more on both sides.
    part, inside = F.floor(F.col("shift") / (2 * F.col("n"))), F.pmod("shift", 2 * F.col("n"))
    met = met.withColumn("part", F.explode(F.array(part, F.when(inside < F.col("n"), part - 1).otherwise(part + 1))))
    pair = met.groupBy(F.col("doc_id").alias("d_id"), F.col("tkey").alias("d_key"), "item_id", "ikey", "n", "differ", "width", "part").agg(F.collect_set(F.struct("shift", "i_at")).alias("anchors"))
    pair = pair.withColumn("near", F.array_sort(F.array_distinct(F.col("anchors.shift"))))
    pair = pair.withColumn("shifts", F.filter("near", lambda x: F.floor(x / (2 * F.col("n"))) == F.col("part"))).where("size(shifts) > 0")
    # A token that differs spoils width windows at most, a change of the offset width - 1.
    least = F.col("n") - F.col("width") + 1 - F.col("differ") * F.col("width")
    pair = pair.where(F.size("anchors") >= least - (F.size("near") - 1) * (F.col("width") - 1))
    # Offsets that can do alone, and by item token the offsets at which a met window begins.
    pair = pair.withColumn("singles", F.filter("shifts", lambda x: F.size(F.filter("anchors", lambda y: y["shift"] == x)) >= least))
    pair = pair.withColumn("begin", F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.transform(F.filter("anchors", lambda x: x["i_at"] == i), lambda x: x["shift"])))

    same_doc = F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("tkey") == F.col("d_key"))
    # Read twice below, and made from all windows of all documents.
    pair = keep(pair.drop("n", "differ", "width", "part", "anchors"), "leak-pairs")
    found = d.join(pair, same_doc, "left_semi").dropDuplicates(["doc_id", "tkey"]).select("doc_id", "tkey", _words(F.col("text")).alias("words"))
    aligned = found.join(pair, same_doc).drop("d_id", "d_key")
    right = b.select(F.col("item_id").alias("b_id"), F.col("ikey").alias("b_key"), "item_words", F.col("n").cast("long").alias("n_tokens"))
    pairs = aligned.join(F.broadcast(right) if small else right, F.col("item_id").eqNullSafe(F.col("b_id")) & (F.col("ikey") == F.col("b_key")))

    def place(i: Column, shift: Column) -> Column:
        """Item token i against the document's at shift: i, its slot's kind or its word, both words in lower case, whether they match."""
        iw, dw = F.get("item_words", i), F.get("words", shift + i)
        kind = _template(iw)
        kind = F.when(_folded(iw).startswith("\x01"), _folded(iw)).otherwise(kind)
        other = F.when(_folded(dw).startswith("\x01"), _folded(dw)).otherwise(_template(dw))
        slot = kind.startswith("\x01")
        return F.struct(i.alias("i"), F.lower(iw).alias("iw"), F.lower(dw).alias("dw"), slot.alias("slot"), F.coalesce((F.lower(iw) == F.lower(dw)) | (slot & (kind == other)), F.lit(False)).alias("met"))

    def at(shift: Column) -> Column:
        return F.filter(F.transform(F.sequence(F.lit(0), F.size("item_words") - 1), lambda i: place(i, shift)), lambda p: p["met"])

    def chain(start: Column) -> Column:
        """From the offset start on: a token that differs there may move to another met offset, nearest first, where a met window begins, further on in the document."""
        def step(acc: Column, i: Column) -> Column:
            def others() -> Column:
                ahead = F.filter(F.get("begin", i), lambda x: (x + i > acc["last"]) & (F.abs(x - start) < F.col("n_tokens")))
                near = F.array_min(F.transform(ahead, lambda x: F.struct(F.abs(x - acc["now"]).alias("far"), x.alias("shift"))))
                return F.coalesce(near["shift"], acc["now"])

            def put(now: Column) -> Column:
                return F.transform(F.array(place(i, now)), lambda p: moved(now, p))[0]

            def moved(now: Column, p: Column) -> Column:
                return F.struct(now.alias("now"), F.when(p["met"], now + i).otherwise(acc["last"]).alias("last"), F.when(p["met"], F.concat(acc["spots"], F.array(p))).otherwise(acc["spots"]).alias("spots"))

            return F.transform(F.array(F.when(place(i, acc["now"])["met"], acc["now"]).otherwise(others())), put)[0]

        none = F.slice(at(start), 1, 0)
        begin = F.struct(start.alias("now"), F.lit(-1).alias("last"), none.alias("spots"))
        return F.aggregate(F.sequence(F.lit(0), F.size("item_words") - 1), begin, step)["spots"]

    def judge(spots: Column) -> Column:
        slots = F.filter(spots, lambda p: p["slot"])
        equal = F.filter(spots, lambda p: p["iw"] == p["dw"])
        literal = F.size(F.filter(equal, lambda p: ~p["slot"]))
        maps, of, to = (F.size(F.array_distinct(F.transform(slots, f))) for f in (lambda p: F.struct(p["iw"], p["dw"]), lambda p: p["iw"], lambda p: p["dw"]))
        consistent = (maps == of) & (maps == to)
        verbatim = F.size(equal) * 100 >= F.col("n_tokens") * PERCENT
        template = consistent & (literal >= LITERALS) & (F.size(spots) * 100 >= F.col("n_tokens") * PERCENT)
        # In the order of preference.
        return F.struct(verbatim.alias("verbatim"), template.alias("template"), F.size(spots).cast("long").alias("n_matched"), F.size(equal).cast("long").alias("n_equal"), F.size(slots).cast("long").alias("n_slots"), consistent.alias("consistent"))

    alone = F.transform(F.transform("singles", at), judge)
    chained = F.when(F.size("near") > 1, F.transform(F.transform("shifts", chain), judge)).otherwise(F.array().cast("array<struct<verbatim:boolean,template:boolean,n_matched:long,n_equal:long,n_slots:long,consistent:boolean>>"))
    # No alignment has more than all offsets together.
    reach = F.size(F.array_distinct(F.flatten(F.transform("near", lambda s: F.transform(at(s), lambda p: p["i"])))))
    judged = pairs.select("doc_id", "tkey", "item_id", "ikey", "n_tokens", F.explode_outer(F.array(F.when(reach * 100 >= F.col("n_tokens") * PERCENT, F.array_max(F.concat(alone, chained))))).alias("best")).where("best.verbatim OR best.template")
    judged = judged.groupBy("doc_id", "tkey", "item_id", "ikey", "n_tokens").agg(F.max("best").alias("best"))
    return judged.select("doc_id", "item_id", "n_tokens", "best.n_matched", "best.n_equal", "best.n_slots", "best.consistent", F.when(F.col("best.verbatim"), F.lit("verbatim")).otherwise(F.lit("template")).alias("kind"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_M = MARKS.replace("'", "''")
_SQL_WORDS = f"list_filter(string_split_regex(translate(coalesce(text, ''), '{_M}', ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
_SQL_UNITS = ", ".join(f"'{u}'" for u in UNITS)
_SQL_TEMPLATE = f"lambda w: CASE WHEN w[1] BETWEEN '0' AND '9' THEN chr(1) || 'number' WHEN w IN ({_SQL_UNITS}) THEN chr(1) || 'unit' WHEN w[1] <> lower(w[1]) THEN chr(1) || 'name' ELSE w END"
ORACLE_SQL = f"""
WITH d0 AS (SELECT DISTINCT doc_id, text FROM documents), d1 AS (SELECT doc_id, text, {_SQL_WORDS} AS w FROM d0), d AS (SELECT *, list_transform(w, {_SQL_TEMPLATE}) AS t FROM d1),
b0 AS (SELECT DISTINCT item_id, text FROM benchmark), b1 AS (SELECT item_id, text, {_SQL_WORDS} AS w FROM b0), b AS (SELECT *, list_transform(w, {_SQL_TEMPLATE}) AS t FROM b1),
dp AS (SELECT doc_id, text, t, unnest(range(0, len(t) - {WINDOW} + 1, {WINDOW})) AS p FROM d), dw AS (SELECT doc_id, text, p, t[p + 1 : p + {WINDOW}] AS g FROM dp),
bp AS (SELECT item_id, text, t, unnest(range(0, len(t) - {WINDOW} + 1)) AS p FROM b), bw AS (SELECT item_id, text, p, t[p + 1 : p + {WINDOW}] AS g FROM bp),
m AS (SELECT DISTINCT dw.doc_id, dw.text AS dt, bw.item_id, bw.text AS bt, dw.p - bw.p AS shift FROM dw JOIN bw USING (g) WHERE len(list_filter(bw.g, lambda x: x[1] <> chr(1))) >= {LITERALS}),
a AS (SELECT m.doc_id, m.dt, m.item_id, m.bt, m.shift, d.w AS dwords, d.t AS dtok, b.w AS bwords, b.t AS btok, unnest(range(0, len(b.t))) AS i FROM m JOIN d ON d.doc_id = m.doc_id AND d.text = m.dt JOIN b ON b.item_id = m.item_id AND b.text = m.bt),
s AS (SELECT doc_id, dt, item_id, bt, len(btok) AS n_tokens, i, bwords[i + 1] AS iw, dwords[shift + i + 1] AS dw, btok[i + 1] AS t FROM a WHERE shift + i >= 0 AND shift + i < len(dtok) AND dtok[shift + i + 1] = btok[i + 1]),
c AS (SELECT doc_id, dt, item_id, bt, n_tokens, count(DISTINCT i) AS n_matched, count(DISTINCT i) FILTER (WHERE iw = dw) AS n_equal, count(DISTINCT i) FILTER (WHERE t[1] = chr(1)) AS n_slots,
  count(DISTINCT (iw, dw)) FILTER (WHERE t[1] = chr(1)) AS maps, count(DISTINCT iw) FILTER (WHERE t[1] = chr(1)) AS f, count(DISTINCT dw) FILTER (WHERE t[1] = chr(1)) AS o FROM s GROUP BY ALL),
j AS (SELECT *, maps = f AND maps = o AS consistent, n_equal * 100 >= n_tokens * {PERCENT} AS verbatim FROM c)
SELECT doc_id, item_id, n_tokens, n_matched, n_equal, n_slots, consistent, CASE WHEN verbatim THEN 'verbatim' ELSE 'template' END AS kind
FROM j WHERE verbatim OR (consistent AND n_matched * 100 >= n_tokens * {PERCENT})
"""
