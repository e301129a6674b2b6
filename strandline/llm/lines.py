"""Line dedup: exact copies by digest, near copies by a segment-partition edit join, all in Spark expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, components, keep, table

#: Greatest edit distance (code points) of near copies. The segments below are worked out for two.
EDITS = 2
#: Least length (code points) of a line that the near join looks at, by default; exact copies go whatever their length.
LEAST = 16
#: Characters whose counts are compared before a pair of lines is, those of BAG in the join, those of MORE beside their texts; any choice gives the same links.
BAG, MORE = "etaoinsrhdlcumgw", "bfpvykz ,.éñóüäí"
#: Lines with candidates up to this many are sent to every executor as 8-byte ids, to fetch their texts; more are met in a shuffle join.
BROADCAST_IDS = 1_000_000
_ID = (1 << 62) - 1


def _not_blank(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITE)) != ""


def line_rows(docs: DataFrame) -> DataFrame:
    """docs(doc_id, tkey, text) to a row a line that isn't blank: doc_id, tkey, no, line, lkey."""
    rows = docs.select("doc_id", "tkey", F.posexplode(F.split("text", "\n")).alias("no", "line")).where(_not_blank(F.col("line")))
    return rows.withColumn("lkey", F.coalesce(F.unhex(F.md5(F.encode("line", "UTF-8"))), F.lit(b"")))


def _id(lkey: Column) -> Column:
    """A 62-bit number of a line; lines that share one are only more candidates."""
    return F.xxhash64(lkey).bitwiseAND(F.lit(_ID))


def _class(n: Column) -> Column:
    """The length class of n, named by its least length: classes are an eighth of a power of two wide, and 2 at least."""
    wide = F.call_function("shiftleft", F.lit(1), F.greatest(F.lit(1), F.length(F.bin(n)) - 4))
    return n - n % wide


def signatures(line: Column, own: Column, lower: Column) -> Column:
    """Hashes of a line's segments, (length class, segment, substring): two lines within EDITS share one.

    A line is cut into EDITS + 1 segments: the first third, the last third and the middle, sized by
    the least length of its class, so that lines of one class are cut alike. A line of length n
    also stands in the class of n - EDITS; classes are so wide that those two hold every length
    between. Of three segments two edits leave one whole. If neither the first nor the last is
    whole, one edit lies in each, and the middle is whole but shifted by -1, 0 or 1: the index
    holds each line's middle, and each line asks for its substrings at shifts 0 and 1 (a pair
    shifted by -1 meets the other way round). So each class gives four hashes, of which the last
    is only asked for. own and lower are those two classes.
    """

    def of(c: Column) -> Column:
        part = F.floor(c / 3).cast("int")
        middle = (c - 2 * part).cast("int")
        cuts = ((0, F.left(line, part)), (1, F.right(line, part)), (2, F.substring(line, part + 1, middle)), (2, F.substring(line, part + 2, middle)))
        return F.array(*[F.xxhash64(c, F.lit(k), x) for k, x in cuts])

    return F.when(own == lower, of(own)).otherwise(F.concat(of(own), of(lower)))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def banded_distance(a: Column, b: Column, edits: int) -> Column:
    """The edit distance of a and b if it is at most edits, else some greater number; lengths must differ by at most edits and exceed it.

    Bit-parallel over a band of 2 * edits + 1 diagonals (Hyyro, 2003): bit k of a column j stands
    for row j - edits + k of the matrix. a and b are arrays of characters, b the longer one.
    """
    top, every = 2 * edits, (1 << (2 * edits + 1)) - 1
    m, n = F.size(a), F.size(b)
    one = F.lit(1).cast("long")

    def step(acc: Column, j: Column) -> Column:
        met = reduce(
            lambda x, y: x.bitwiseOR(y),
            [F.when((j - edits + k >= 1) & (F.get(a, j - edits + k - 1) == F.get(b, j - 1)), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")) for k in range(top + 1)],
        )
        vp, vn = acc["vp"], acc["vn"]

        def with_met(x: Column) -> Column:
            d0 = ((x.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(F.lit(every))

            def with_d0(d: Column) -> Column:
                hp = vn.bitwiseOR(F.bitwise_not(d.bitwiseOR(vp))).bitwiseAND(F.lit(every))
                hn = d.bitwiseAND(vp)
                half = F.shiftright(d, 1)
                row = F.call_function("shiftleft", one, F.greatest(F.lit(0), m - j + edits))
                change = F.when(j <= m - edits, F.when(d.bitwiseAND(F.lit(1 << top)) != 0, 0).otherwise(1)).otherwise(
                    F.when(hp.bitwiseAND(row) != 0, 1).when(hn.bitwiseAND(row) != 0, -1).otherwise(0)
                )
                return F.struct(hn.bitwiseOR(F.bitwise_not(half.bitwiseOR(hp))).bitwiseAND(F.lit(every)).alias("vp"), half.bitwiseAND(hp).alias("vn"), (acc["d"] + change).cast("int").alias("d"))

            return _let(d0, with_d0)

        # The diagonal's value never falls and the last row's by 1 a column: beyond 2 * edits + n - m nothing comes back.
        return F.when(acc["d"] > 2 * edits + n - m, acc).otherwise(_let(met, with_met))

    start = F.struct(F.lit(every ^ ((1 << edits) - 1)).cast("long").alias("vp"), F.lit(0).cast("long").alias("vn"), F.lit(edits).cast("int").alias("d"))
    return F.aggregate(F.sequence(F.lit(1), n), start, step)["d"]


def with_bag(rows: DataFrame, name: str, letters: str = BAG) -> DataFrame:
    """rows with how often line has each of sixteen letters, modulo 16, four bits a letter. Each letter is taken out of what the last one left, so lines shrink on the way."""
    out, counts, last = rows, [], "line"
    for k, c in enumerate(letters):
        out = out.withColumn(f"__left{k}", F.replace(F.col(last), F.lit(c), F.lit("")))
        gone = F.octet_length(last) - F.octet_length(f"__left{k}")
        counts.append(F.shiftleft(((gone if len(c.encode()) == 1 else F.floor(gone / len(c.encode()))) % 16).cast("long"), 4 * k))
        last = f"__left{k}"
    return out.withColumn(name, reduce(lambda x, y: x.bitwiseOR(y), counts)).select(*rows.columns, name)


def _apart(x: Column, y: Column) -> Column:
    """How far two bags differ, at least: what is left of a difference modulo 16 is no more than the difference. An edit changes the counts by 2 in all at most."""
    apart = []
    for k in range(16):
        d = F.abs(F.shiftrightunsigned(x, 4 * k).bitwiseAND(F.lit(15)) - F.shiftrightunsigned(y, 4 * k).bitwiseAND(F.lit(15)))
        apart.append(F.least(d, 16 - d))
    return reduce(lambda a, b: a + b, apart)


def _common(a: Column, b: Column) -> Column:
    """Length of the common prefix, by binary lifting over substring comparisons."""
    most = F.least(F.length(a), F.length(b))
    steps = F.array(*[F.lit(1 << k) for k in range(23, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= most) & (F.substring(a, F.lit(1), at + step) == F.substring(b, F.lit(1), at + step)), at + step).otherwise(at))


def _core(a: Column, b: Column, body) -> Column:
    """body(u, v) of a and b without their common prefix and suffix, but for EDITS + 1 characters of each: the same edit distance. Null where that is above EDITS for certain.

    Without their common ends, two edits are the first and the last step from one to the other, so
    what lies between them must be equal.
    """
    spare, steps = EDITS + 1, ((1, 1), (0, 1), (1, 0))

    def within(u: Column, v: Column) -> Column:
        between = [F.substring(u, F.lit(i + 1), F.length(u) - i - j) == F.substring(v, F.lit(k + 1), F.length(v) - k - l) for i, k in steps for j, l in steps]
        return reduce(lambda x, y: x | y, between, F.length(u) <= EDITS)

    def cut_front(n: Column) -> Column:
        return _let(F.struct(F.reverse(F.substring(a, n + 1, F.length(a))).alias("u"), F.reverse(F.substring(b, n + 1, F.length(b))).alias("v")), lambda r: _let(_common(r["u"], r["v"]), lambda m: cut_back(n, m)))

    def cut_back(n: Column, m: Column) -> Column:
        def part(x: Column, left: Column, right: Column) -> Column:
            return F.substring(x, left + 1, F.length(x) - left - right)

        left, right = F.greatest(F.lit(0), n - spare), F.greatest(F.lit(0), m - spare)
        cores = F.struct(part(a, n, m).alias("u"), part(b, n, m).alias("v"))
        wider = _let(F.split(part(a, left, right), ""), lambda u: _let(F.split(part(b, left, right), ""), lambda v: body(u, v)))
        return _let(cores, lambda r: F.when(within(r["u"], r["v"]), wider))

    return _let(_common(a, b), cut_front)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b, edits) of pairs(x, y) of ids, by the texts(id, lkey, line) they may stand for."""
    bagged = with_bag(with_bag(texts.select("id", "lkey", "line"), "b"), "m", MORE).select("id", "lkey", "line", F.struct("b", "m").alias("bags"))
    left = bagged.toDF("x", "a", "s", "p")
    right = bagged.toDF("y", "b", "t", "q")
    both = pairs.join(left, "x").join(right, "y").where((F.abs(F.length("s") - F.length("t")) <= EDITS) & (_apart(F.col("p.b"), F.col("q.b")) + _apart(F.col("p.m"), F.col("q.m")) <= 2 * EDITS))
    first = F.length("s") <= F.length("t")
    ordered = both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(first, F.col("s")).otherwise(F.col("t")).alias("u"), F.when(first, F.col("t")).otherwise(F.col("s")).alias("v"))
    # Few bytes but much work: adaptive execution would leave it to one task.
    ordered = ordered.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    edits = _core(F.col("u"), F.col("v"), lambda u, v: banded_distance(u, v, EDITS))
    # A filter on a generator's output stays here; one on a column would be pushed down into the join.
    return ordered.select("a", "b", F.explode_outer(F.array(edits)).alias("edits")).where(F.col("edits") <= EDITS).dropDuplicates(["a", "b"])


def near_lines(rows: DataFrame, distinct: DataFrame, broadcast_ids: int = BROADCAST_IDS) -> tuple[DataFrame, DataFrame]:
    """(links, texts): links(a, b, edits) between different lines, each pair once; texts(id, lkey, line, first, last) of all candidates.

    distinct(id, sigs, bag) has the lines' hashes without their texts. Both sides of the join are
    one exchange of them. Lines that share a segment but differ in their letters are told apart
    inside the join, so a family of lines with one word exchanged gives few pairs; a hot segment
    is split by adaptive execution. Texts are read for candidates only, from rows(lkey, line, ...).
    """
    shifted = F.lit(1 << 62)
    held = distinct.where("sigs IS NOT NULL").select("bag", F.posexplode("sigs").alias("k", "sig"), "id")
    held = held.select("sig", F.when(F.col("k") % 4 == 3, F.col("id").bitwiseOR(shifted)).otherwise(F.col("id")).alias("code"), "bag")
    other = held.toDF("sig", "code2", "bag2")
    # Codes of shifted middles are above all others: each pair of the index, and of the index and what is asked, is met once.
    differ = F.col("code").bitwiseAND(F.lit(_ID)) != F.col("code2").bitwiseAND(F.lit(_ID))
    met = held.join(other, "sig").where((F.col("code") < F.col("code2")) & differ & (_apart(F.col("bag"), F.col("bag2")) <= 2 * EDITS))
    x, y = F.col("code").bitwiseAND(F.lit(_ID)), F.col("code2").bitwiseAND(F.lit(_ID))
    pairs = keep(met.select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y")).distinct(), "line-pairs")
    wanted = pairs.select(F.col("x").alias("id")).union(pairs.select("y")).distinct()
    few = wanted.count() <= broadcast_ids
    here = F.struct("doc_id", "tkey", "no")
    found = rows.withColumn("id", _id(F.col("lkey"))).join(F.broadcast(wanted) if few else wanted, "id", "left_semi")
    texts = keep(found.groupBy("id", "lkey").agg(F.first("line").alias("line"), F.min(here).alias("first"), F.max(here).alias("last")), "line-texts")
    return _verified(pairs, texts), texts


def hashed_lines(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """rows of lines to a row a different line: id, sigs and bag, and for repeated lines lkey and the first place."""
    here = F.struct("doc_id", "tkey", "no")
    # Column by column, so that lengths and classes are computed once.
    sized = with_bag(rows, "bag").withColumn("n", F.length("line")).withColumn("own", _class(F.col("n"))).withColumn("lower", _class(F.col("n") - EDITS))
    hashed = sized.select("doc_id", "tkey", "no", "lkey", F.when(F.col("n") >= max(least, 2 * EDITS), signatures(F.col("line"), F.col("own"), F.col("lower"))).alias("sigs"), "bag")
    lines = hashed.groupBy("lkey").agg(F.first("sigs").alias("sigs"), F.first("bag").alias("bag"), F.min(here).alias("first"), F.max(here).alias("last"))
    again = F.col("first") != F.col("last")
    return keep(lines.select(_id(F.col("lkey")).alias("id"), "sigs", "bag", F.when(again, F.col("lkey")).alias("lkey"), F.when(again, F.col("first")).alias("first")), "lines")


def line_marks(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """docs(doc_id, tkey, text) to a row a line that is repeated or linked: doc_id, tkey, no, removed, near, links."""
    rows = line_rows(docs)
    here = F.struct("doc_id", "tkey", "no")
    kept = hashed_lines(rows, least)
    links, texts = near_lines(rows, kept)
    links = keep(links, "line-links")
    roots = components(links.select("a", "b"))
    degree = links.select(F.col("a").alias("lkey")).union(links.select("b")).groupBy("lkey").agg(F.count("*").alias("links"))
    classed = roots.withColumnRenamed("node", "lkey").join(texts.select("lkey", "first"), "lkey").join(degree, "lkey")
    starts = classed.groupBy("root").agg(F.min("first").alias("start"))
    linked = classed.join(starts, "root").select("lkey", "first", "start", "links")
    repeated = kept.where("lkey IS NOT NULL").select("lkey", "first", F.col("first").alias("start"), F.lit(0).cast("long").alias("links"))
    open_ = keep(repeated.union(linked).groupBy("lkey").agg(F.min("first").alias("first"), F.min("start").alias("start"), F.max("links").alias("links")), "line-classes")
    met = rows.select("doc_id", "tkey", "no", "lkey").join(open_, "lkey")
    return met.select("doc_id", "tkey", "no", (here != F.col("start")).alias("removed"), ((here == F.col("first")) & (F.col("first") != F.col("start"))).alias("near"), "links")


def line_dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", out: str | None = None, least: int = LEAST) -> DataFrame:
    """Remove lines that an earlier line of any document equals or resembles.

    Lines that aren't blank (white space only) are linked when equal, whatever their length, and
    those of `least` code points or more (4 at least) also within EDITS edits; of each connected
    class of lines only the first occurrence stays, by (doc_id, digest of the text, line number),
    null ids first. Returns docs with n_lines (lines that aren't blank), n_removed, n_near (of
    those, first occurrences of a text that resembles an earlier one), n_links (links of its lines
    to different lines) and removed_lines, line numbers from 0; with out, also the text that is
    left under that name. Null texts have no lines and stay null; empty texts and blank lines lose
    nothing; rows equal in doc_id and text are one document, so each copy of the row keeps and
    loses the same lines; columns of docs that clash with a result column give way to it; an empty
    table gives an empty result.

    Hashes are taken where a line is read, and equal lines collapse, combined on the map side,
    before anything is paired. Only texts of candidate pairs are shuffled, and documents only if
    out asks for them.
    """
    made = ["n_lines", "n_removed", "n_near", "n_links", "removed_lines"] + ([out] if out else [])
    id_, tkey = F.col(f"`{doc_id}`"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    marks = line_marks(docs.select(id_.alias("doc_id"), tkey.alias("tkey"), F.col(f"`{text}`").alias("text")), least)
    by_doc = marks.groupBy(F.col("doc_id").alias("__d"), F.col("tkey").alias("__k")).agg(
        F.sort_array(F.collect_set(F.when(F.col("removed"), F.col("no")))).alias("__gone"),
        F.sort_array(F.collect_set(F.when(F.col("near"), F.col("no")))).alias("__near"),
        F.collect_set(F.struct("no", "links")).alias("__links"),
    )
    lines = F.split(F.col(f"`{text}`"), "\n")
    keep_cols = [F.col(f"`{c}`") for c in docs.columns if c not in made or c in (doc_id, text)]
    base = docs.select(*keep_cols, F.coalesce(F.size(F.filter(lines, _not_blank)), F.lit(0)).cast("long").alias("__n"), tkey.alias("__t"))
    if not out and text not in (doc_id,):
        base = base.drop(text)
    both = base.join(by_doc, id_.eqNullSafe(F.col("__d")) & (F.col("__t") == F.col("__k")), "left")
    gone = F.coalesce("__gone", F.array().cast("array<int>"))
    figures = [
        F.greatest("__n", F.lit(0)).alias("n_lines"),
        F.size(gone).cast("long").alias("n_removed"),
        F.coalesce(F.size("__near"), F.lit(0)).cast("long").alias("n_near"),
        F.coalesce(F.aggregate("__links", F.lit(0).cast("long"), lambda s, x: s + x["links"]), F.lit(0)).alias("n_links"),
        gone.alias("removed_lines"),
    ]
    left = [F.when(F.size(gone) == 0, F.col(f"`{text}`")).otherwise(F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(gone, i)), "\n")).alias(out)] if out else []
    same = [F.col(f"`{c}`") for c in base.columns if not c.startswith("__") and c not in made]
    return both.select(*same, *figures, *left)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document: how many of its lines go, and which."""
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: DuckDB measures edits in bytes: characters beyond ASCII are put as control characters first, enough for 26 different ones. Documents are ordered by doc_id alone, so ids must differ.
ORACLE_SQL = f"""
WITH RECURSIVE cut AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
every AS (SELECT doc_id, unnest(parts) AS line, CAST(unnest(range(len(parts))) AS INTEGER) AS no FROM cut),
rows_ AS (SELECT * FROM every WHERE trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''),
beyond AS (SELECT c, row_number() OVER (ORDER BY c) AS k FROM (SELECT DISTINCT unnest(string_split(line, '')) AS c FROM rows_) WHERE ord(c) > 127),
spelled AS (SELECT coalesce(string_agg(c, '' ORDER BY k), '') AS was, coalesce(string_agg(chr(CAST(CASE WHEN k <= 8 THEN k ELSE k + 5 END AS INTEGER)), '' ORDER BY k), '') AS now FROM beyond),
kinds AS (SELECT line, min((doc_id, no)) AS first FROM rows_ GROUP BY line),
long_ AS (SELECT line, length(line) AS n, translate(line, was, now) AS plain FROM kinds, spelled WHERE length(line) >= {LEAST}),
sized AS (SELECT *, unnest(range(n - {EDITS}, n + {EDITS} + 1)) AS m FROM long_),
near AS (SELECT a.line AS x, b.line AS y FROM sized a JOIN long_ b ON a.m = b.n WHERE a.line <> b.line AND levenshtein(a.plain, b.plain) <= {EDITS}),
reach AS (SELECT line AS a, line AS b FROM kinds WHERE line IN (SELECT x FROM near) UNION SELECT reach.a, near.y FROM reach JOIN near ON near.x = reach.b),
starts AS (SELECT a AS line, min(first) AS start FROM reach JOIN kinds ON kinds.line = reach.b GROUP BY a),
degree AS (SELECT x AS line, count(*) AS links FROM near GROUP BY x),
marks AS (SELECT r.doc_id, r.no, (r.doc_id, r.no) <> coalesce(s.start, k.first) AS removed, (r.doc_id, r.no) = k.first AND k.first <> coalesce(s.start, k.first) AS near, coalesce(g.links, 0) AS links FROM rows_ r JOIN kinds k USING (line) LEFT JOIN starts s USING (line) LEFT JOIN degree g USING (line)),
docs AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (removed) AS BIGINT) AS n_removed, CAST(count(*) FILTER (near) AS BIGINT) AS n_near, CAST(sum(links) AS BIGINT) AS n_links, list(no ORDER BY no) FILTER (removed) AS gone FROM marks GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_near, 0) AS n_near, coalesce(n_links, 0) AS n_links, coalesce(gone, CAST([] AS INTEGER[])) AS removed_lines FROM documents LEFT JOIN docs USING (doc_id)
"""
