"""Overlap graphs of segments (name, seq): terminals, edges, walks, cycles and stitched sequences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import seq as S
from ..functions.align import Floors, align
from ..plans.options import GraphOptions
from ..storage import keep

NODE = "struct<seg:string,orient:string>"


def oriented_terminals(segments: DataFrame, window: int) -> DataFrame:
    """Both orientations of every segment with the first and last window bases: seg, orient, length, head, tail."""
    both = segments.select("name", "seq", F.explode(F.array(F.lit("+"), F.lit("-"))).alias("orient"))
    seq = S.oriented(F.col("seq"), F.col("orient"))
    return both.select(F.col("name").alias("seg"), "orient", F.length("seq").alias("length"), S.head(seq, window).alias("head"), S.tail(seq, window).alias("tail"))


def self_terminals(segments: DataFrame, window: int = 500) -> DataFrame:
    """The tail of every oriented segment against its own head, best score first."""
    hits = align(oriented_terminals(segments, window).select("seg", "orient", "length", F.col("tail").alias("query"), F.col("head").alias("target")))
    rows = hits.select("seg", "orient", "length", F.round("identity", 2).alias("identity"), "overlap", (F.round("identity", 2) * F.col("overlap")).alias("score"))
    return rows.orderBy(F.desc("score"), F.desc("identity"), F.desc("overlap"), "seg", "orient")


def circular(hits: DataFrame, min_identity: float = 75.0, min_overlap: int = 100, window: int | None = None) -> DataFrame:
    """hits with circular_possible, on rounded identity; with window, segments no longer than it are not flagged."""
    ok = (F.col("identity") >= min_identity) & (F.col("overlap") >= min_overlap)
    return hits.withColumn("circular_possible", ok if window is None else ok & (F.col("length") > window))


#: A q-gram of so many letters is rare in windows of some hundred: such grams are joined on, shorter ones leave no pair out.
SELECTIVE = 12


def _grams(rows: DataFrame, seq: str, q: int) -> DataFrame:
    """rows with a row for each distinct q-gram of seq."""
    cut = F.transform(F.sequence(F.lit(1), F.greatest(F.length(seq) - q + 1, F.lit(1))), lambda i: F.substring(F.col(seq), i, F.lit(q)))
    return rows.withColumn("__gram", F.explode(F.array_distinct(F.filter(cut, lambda x: F.length(x) == q))))


def possible_pairs(left: DataFrame, right: DataFrame, query: str, target: str, on, floors: Floors, by: tuple[list[str], list[str]]) -> DataFrame:
    """Pairs of left and right for which on holds and whose alignment may reach the floors.

    Where the floors imply a common q-gram that is rare by chance, pairs are found by a join on
    grams, each once; by names the columns that tell rows of either side apart. Else nearly all pairs have such a gram
    by chance, and all are returned; the alignment leaves most of them out by counting matches.
    """
    q = floors.gram()
    if q < SELECTIVE:
        return left.join(right, on)
    a, b = _grams(left.select(*by[0], query), query, q).drop(query), _grams(right.select(*by[1], target), target, q).drop(target)
    named = a.join(b, "__gram").select(*by[0], *by[1]).distinct()
    return named.join(left, by[0]).join(right, by[1]).where(on)


def build_edges(segments: DataFrame, options: GraphOptions = GraphOptions(), exact: bool = False) -> DataFrame:
    """Edges between oriented segments whose tail and head align well, the best top_out a node.

    The operator is about all pairs of different segments of an assembly. Only those that can reach
    the floors are aligned (all with exact, to the same result). Pairs are dealt out evenly before the alignment.
    """
    t = oriented_terminals(segments, options.window)
    n = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    src = t.select(F.col("seg").alias("src_seg"), F.col("orient").alias("src_orient"), F.col("length").alias("src_len"), F.col("tail").alias("query"))
    dst = t.select(F.col("seg").alias("dst_seg"), F.col("orient").alias("dst_orient"), F.col("length").alias("dst_len"), F.col("head").alias("target"))
    floors, differ = Floors(options.min_identity, options.min_overlap), F.col("src_seg") != F.col("dst_seg")
    pairs = src.join(dst, differ) if exact else possible_pairs(src, dst, "query", "target", differ, floors, (["src_seg", "src_orient"], ["dst_seg", "dst_orient"]))
    hits = align(pairs.repartition(n), floors=None if exact else floors).where((F.col("identity") >= options.min_identity) & (F.col("overlap") >= options.min_overlap))
    edges = hits.select("src_seg", "src_orient", "dst_seg", "dst_orient", F.round("identity", 2).alias("identity"), "overlap", "src_len", "dst_len")
    return top_edges(edges.withColumn("score", F.col("identity") * F.col("overlap")), options.top_out)


def top_edges(edges: DataFrame, k: int) -> DataFrame:
    """The best k edges out of each oriented node."""
    w = Window.partitionBy("src_seg", "src_orient").orderBy(F.desc("score"), F.desc("identity"), F.desc("overlap"), "dst_seg", "dst_orient")
    return edges.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= k).drop("__r")


def edge_index(edges: DataFrame) -> DataFrame:
    """The best edge of each pair of oriented nodes."""
    w = Window.partitionBy("src_seg", "src_orient", "dst_seg", "dst_orient").orderBy(F.desc("score"), F.desc("identity"), F.desc("overlap"))
    return edges.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def degree(edges: DataFrame) -> DataFrame:
    """Edges in and out of each segment."""
    return edges.select(F.explode(F.array("src_seg", "dst_seg")).alias("seg")).groupBy("seg").agg(F.count("*").alias("edge_degree"))


def _node(seg: str, orient: str) -> Column:
    return F.struct(F.col(seg).alias("seg"), F.col(orient).alias("orient"))


def walks(edges: DataFrame, max_depth: int, longest: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(walks, closures) from every node with edges: walks visit a segment once, closures return to their oriented start.

    Columns: nodes, total_len, depth, sum_identity, min_identity, total_overlap, score. Each step is
    one join, whose result is written to shared storage, so no step is planned or run again for
    the next; walks beyond `longest` end. Edges carry a bounded fan-out, so growth is bounded by it.
    """
    e = keep(edges.select(_node("src_seg", "src_orient").alias("src"), _node("dst_seg", "dst_orient").alias("dst"), "identity", "overlap", F.col("score").alias("e_score"), "src_len", "dst_len"), "edges")
    first = e.groupBy("src").agg(F.max("src_len").alias("len"))
    front = first.select(F.array("src").alias("nodes"), F.col("len").cast("long").alias("total_len"), F.lit(0).alias("depth"), F.lit(0.0).alias("sum_identity"), F.lit(None).cast("double").alias("min_identity"), F.lit(0).cast("long").alias("total_overlap"), F.lit(0.0).alias("score"))
    found, closed = [], []
    for step in range(max_depth):
        grown = front.join(e, F.element_at("nodes", -1) == F.col("src"))
        closes = (F.col("dst") == F.col("nodes")[0]) & F.lit(step > 0)
        total = F.col("total_len") - F.col("overlap") + F.when(closes, 0).otherwise(F.col("dst_len"))
        fits = F.lit(True) if longest is None else total <= longest
        grown = grown.where(closes | (~F.exists("nodes", lambda x: x["seg"] == F.col("dst.seg")) & fits))
        rest = [(F.col("depth") + 1).alias("depth"), (F.col("sum_identity") + F.col("identity")).alias("sum_identity"), F.coalesce(F.least("min_identity", "identity"), "identity").alias("min_identity"), (F.col("total_overlap") + F.col("overlap")).alias("total_overlap"), (F.col("score") + F.col("e_score")).alias("score")]
        grown = keep(grown.select(closes.alias("closes"), F.concat("nodes", F.array("dst")).alias("nodes"), total.alias("total_len"), *rest), "walks")
        front = grown.where("NOT closes").drop("closes")
        found.append(front)
        closed.append(grown.where("closes").drop("closes"))
        if front.isEmpty():
            break
    return reduce(DataFrame.union, found), reduce(DataFrame.union, closed)


def _finished(paths: DataFrame, kind: str) -> DataFrame:
    return paths.select(F.lit(kind).alias("kind"), "nodes", "total_len", F.round(F.col("sum_identity") / F.col("depth"), 2).alias("mean_identity"), "min_identity", "total_overlap", F.round("score", 2).alias("score"))


def distinct_cycles(closed: DataFrame) -> DataFrame:
    """One cycle a canonical key; of a cycle and its reversal the better score stays, then the smaller walk."""
    keyed = closed.withColumn("key", S.cycle_key(F.slice("nodes", F.lit(1), F.size("nodes") - 1)))
    w = Window.partitionBy("key").orderBy(F.desc("score"), "nodes")
    return keyed.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r", "key")


def _by_size(expected: int) -> list[Column]:
    return [F.abs(F.col("total_len") - expected), F.desc("mean_identity"), F.desc("score"), F.col("nodes").asc()]


def sized_paths(edges: DataFrame, options: GraphOptions = GraphOptions()) -> tuple[DataFrame, DataFrame]:
    """(cycles, linear paths) within the size window, nearest to the expected size first, as many as asked for."""
    lo, hi = int(options.expected_size * (1 - options.size_tolerance)), int(options.expected_size * (1 + options.size_tolerance))
    open_, closed = walks(edges, options.max_depth, hi)
    fits = F.col("total_len").between(lo, hi)
    cycles = _finished(distinct_cycles(closed), "cycle").where(fits)
    linear = _finished(open_.where(fits), "linear")
    order = _by_size(options.expected_size)
    return cycles.orderBy(*order).limit(options.max_cycles), linear.orderBy(*order).limit(options.max_linear)


def closed_walks(edges: DataFrame, max_depth: int) -> DataFrame:
    """The cycles of up to max_depth edges, each as one closed walk from its smallest segment, with the columns of walks.

    A cycle is a walk out of that segment and a walk back into it, of as many edges or one less,
    which meet in a node and share no other segment. So walks of half the depth are joined on both
    ends, and no walk of full depth is made. Each step is written to shared storage.
    """
    e = keep(edges.select(_node("src_seg", "src_orient").alias("src"), _node("dst_seg", "dst_orient").alias("dst"), "identity", "overlap", F.col("score").alias("e_score"), "src_len", "dst_len"), "edges")
    nodes = e.select(F.col("src").alias("start")).distinct()
    none = [F.lit(0).alias("depth"), F.lit(0.0).alias("sum_identity"), F.lit(None).cast("double").alias("min_identity"), F.lit(0).cast("long").alias("total_overlap"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("len")]
    add = [(F.col("depth") + 1).alias("depth"), (F.col("sum_identity") + F.col("identity")).alias("sum_identity"), F.coalesce(F.least("min_identity", "identity"), "identity").alias("min_identity"), (F.col("total_overlap") + F.col("overlap")).alias("total_overlap"), (F.col("score") + F.col("e_score")).alias("score")]

    def halves(forward: bool, steps: int) -> list[DataFrame]:
        """Walks of 1 to steps edges out of, or back into, every start over greater segments: start, end, path without the start, and sums."""
        prefix = "a" if forward else "b"
        front, out = nodes.select("start", F.col("start").alias("end"), F.array().cast(f"array<{NODE}>").alias("path"), *none), []
        here, there = ("src", "dst") if forward else ("dst", "src")
        # The edge that closes the cycle adds no length.
        size = F.col("dst_len") if forward else F.when(F.col("depth") > 0, F.col("dst_len")).otherwise(0)
        for _ in range(steps):
            grown = front.join(e, F.col("end") == F.col(here)).where((F.col(f"{there}.seg") > F.col("start.seg")) & ~F.exists("path", lambda x: x["seg"] == F.col(f"{there}.seg")))
            path = F.concat("path", F.array(there)) if forward else F.concat(F.array(there), "path")
            front = keep(grown.select("start", F.col(there).alias("end"), path.alias("path"), *add, (F.col("len") + size).cast("long").alias("len")), "half-walks")
            out.append(front.select(*[F.col(c).alias(f"{prefix}_{c}") for c in front.columns]))
        return out

    forth, back = halves(True, (max_depth + 1) // 2), halves(False, max_depth // 2)
    starts, found = e.groupBy("src").agg(F.max("src_len").alias("start_len")), []
    for n in range(2, max_depth + 1):
        # Both paths hold the node where they meet, the one at its end and the other at its beginning.
        meet = (F.col("a_start") == F.col("b_start")) & (F.col("a_end") == F.col("b_end"))
        rest = F.slice("b_path", F.lit(2), F.size("b_path"))
        apart = ~F.exists(rest, lambda x: F.exists("a_path", lambda y: x["seg"] == y["seg"]))
        found.append(forth[(n + 1) // 2 - 1].join(back[n // 2 - 1], meet).where(apart).select("a_start", F.concat(F.array("a_start"), "a_path", rest, F.array("a_start")).alias("nodes"), *[F.col(f"{x}_{c}") for x in "ab" for c in ("len", "depth", "sum_identity", "min_identity", "total_overlap", "score")]))
    if not found:
        return walks(edges, max_depth)[1]
    both = reduce(DataFrame.union, found).join(starts, F.col("a_start") == F.col("src"))
    plus = lambda c: F.col(f"a_{c}") + F.col(f"b_{c}")
    overlap = plus("total_overlap")
    return both.select("nodes", (F.col("start_len") + plus("len") - overlap).cast("long").alias("total_len"), plus("depth").alias("depth"), plus("sum_identity").alias("sum_identity"), F.least("a_min_identity", "b_min_identity").alias("min_identity"), overlap.alias("total_overlap"), plus("score").alias("score"))


def any_cycles(edges: DataFrame, options: GraphOptions = GraphOptions()) -> DataFrame:
    """Cycles of any size, best identity first, as many as asked for."""
    closed = closed_walks(edges, options.max_depth)
    return _finished(distinct_cycles(closed), "cycle_any").orderBy(F.desc("mean_identity"), F.desc("score"), "total_len", F.col("nodes").asc()).limit(options.max_any)


def fasta_choice(any_size: DataFrame, cycles: DataFrame, linear: DataFrame, top: int, expected: int = 494_000) -> DataFrame:
    """The top paths to write: cycles of any size by identity, then sized cycles and then linear paths, each nearest to the expected size first."""
    far, total = (F.when(F.col("source") == 0, 0).otherwise(F.abs(F.col("total_len") - expected)), F.when(F.col("source") == 0, F.col("total_len")).otherwise(0))
    ranked = [p.withColumn("source", F.lit(i)) for i, p in enumerate((any_size, cycles, linear))]
    return reduce(DataFrame.unionByName, ranked).orderBy("source", far, F.desc("mean_identity"), F.desc("score"), total, F.col("nodes").asc()).limit(top)


def cycle_membership(cycles: DataFrame) -> DataFrame:
    return cycles.select(F.explode(F.array_distinct(F.transform("nodes", lambda n: n["seg"]))).alias("seg")).groupBy("seg").agg(F.count("*").alias("cycle_count"))


def stitch(paths: DataFrame, segments: DataFrame, edges: DataFrame) -> DataFrame:
    """Sequences of paths: oriented segments without their leading overlaps; a cycle also loses the closing overlap if it is shorter than the whole. Paths with a step that no edge backs are left out."""
    steps = paths.withColumn("path", F.monotonically_increasing_id()).select("path", "kind", "nodes", F.posexplode("nodes").alias("i", "node"))
    steps = steps.withColumn("last", F.get("nodes", F.col("i") - 1))
    idx = edge_index(edges).select(_node("src_seg", "src_orient").alias("src"), _node("dst_seg", "dst_orient").alias("dst"), F.col("overlap").alias("ov"))
    backed = steps.join(idx, (F.col("last") == F.col("src")) & (F.col("node") == F.col("dst")), "left")
    whole = backed.join(segments.select(F.col("name").alias("s_name"), "seq"), F.col("node.seg") == F.col("s_name"), "left")
    is_cycle = F.col("nodes")[0] == F.element_at("nodes", -1)
    closing = is_cycle & (F.col("i") == F.size("nodes") - 1)
    part = F.when(closing, F.lit("")).otherwise(F.substring(S.oriented(F.col("seq"), F.col("node.orient")), F.coalesce("ov", F.lit(0)).cast("int") + 1, F.length("seq")))
    rows = whole.select("path", "kind", "nodes", "i", part.alias("part"), F.when(closing, F.col("ov")).alias("close"), ((F.col("i") == 0) | F.col("ov").isNotNull()).alias("ok"))
    made = rows.groupBy("path").agg(F.first("kind").alias("kind"), F.first("nodes").alias("nodes"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "part"))), lambda x: x["part"]), "").alias("seq"), F.max("close").alias("close"), F.min("ok").alias("ok")).where("ok")
    cut = F.when((F.col("close") > 0) & (F.col("close") < F.length("seq")), F.col("close")).otherwise(F.lit(0))
    return made.select("kind", "nodes", F.substring("seq", F.lit(1), (F.length("seq") - cut).cast("int")).alias("seq"))


def contig_support(segments: DataFrame, hits: DataFrame, edges: DataFrame, cycles: DataFrame, options: GraphOptions = GraphOptions()) -> DataFrame:
    """One row a contig: whether cycles hold it, whether its ends meet, its best self hit, edge degree and cycle count."""
    best = hits.groupBy("seg").agg(F.max_by(F.struct("identity", "overlap"), F.struct("score", "identity", "overlap")).alias("h"))
    out = segments.select(F.col("name").alias("seg"), F.length("seq").cast("long").alias("len")).join(best, "seg", "left").join(degree(edges), "seg", "left").join(cycle_membership(cycles), "seg", "left")
    count = F.coalesce("cycle_count", F.lit(0))
    meets = F.coalesce((F.col("h.identity") >= options.min_identity) & (F.col("h.overlap") >= options.min_overlap), F.lit(False))
    yes = lambda c: F.when(c, "yes").otherwise("no")
    return out.select(F.col("seg").alias("contig"), yes(count > 0).alias("cycle_possible"), yes(meets).alias("self_terminal_possible"), "len", F.coalesce("h.overlap", F.lit(0)).alias("self_ovlp"), F.coalesce("h.identity", F.lit(0.0)).alias("self_id"), F.coalesce("edge_degree", F.lit(0)).alias("edge_degree"), count.alias("cycle_count"))


#: The four orientations of a join: either end of either segment may be reversed.
_NOTES = {(False, False): "direct", (True, False): "first reversed", (False, True): "second reversed", (True, True): "both reversed"}
ORIENTATIONS = tuple((f"tail{'_rc' * a}", f"head{'_rc' * b}", f"{'+-'[a]}/{'+-'[b]}", _NOTES[a, b]) for a in (False, True) for b in (False, True))


def join_terminals(segments: DataFrame, window: int = 500) -> DataFrame:
    return segments.select("ord", "name", F.length("seq").alias("length"), S.head(F.col("seq"), window).alias("head"), S.tail(F.col("seq"), window).alias("tail")).withColumn("head_rc", S.revcomp(F.col("head"))).withColumn("tail_rc", S.revcomp(F.col("tail")))


def join_candidates(segments: DataFrame, window: int = 500, compat: bool = False) -> DataFrame:
    """Pairs of segments in four orientations, with the two ends; every ordered pair, or with compat the earlier segment first only."""
    t = join_terminals(segments, window)
    a = t.select(*[F.col(c).alias(f"a_{c}") for c in t.columns])
    b = t.select(*[F.col(c).alias(f"b_{c}") for c in t.columns])
    pairs = a.join(b, F.col("a_ord") < F.col("b_ord") if compat else F.col("a_ord") != F.col("b_ord"))
    kinds = F.array(*[F.struct(F.lit(x).alias("end_a"), F.lit(y).alias("end_b"), F.lit(o).alias("orientation"), F.lit(n).alias("note"), F.col(f"a_{x}").alias("query"), F.col(f"b_{y}").alias("target")) for x, y, o, n in ORIENTATIONS])
    return pairs.select(F.col("a_name").alias("seg_a"), F.col("b_name").alias("seg_b"), F.col("a_length").alias("len_a"), F.col("b_length").alias("len_b"), F.explode(kinds).alias("k")).select("seg_a", "k.end_a", "seg_b", "k.end_b", "k.orientation", "k.note", "len_a", "len_b", "k.query", "k.target")


def candidate_joins(segments: DataFrame, window: int = 500, min_identity: float = 75.0, min_overlap: int = 100, compat: bool = False, exact: bool = False) -> DataFrame:
    """Joins whose ends align well enough, on unrounded identity; best identity first. Only pairs that can reach the floors are aligned (all with exact, to the same result)."""
    n = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    floors = None if exact else Floors(min_identity, min_overlap)
    hits = align(join_candidates(segments, window, compat).repartition(n), floors=floors).where((F.col("identity") >= min_identity) & (F.col("overlap") >= min_overlap))
    return hits.select("seg_a", "end_a", "seg_b", "end_b", "orientation", F.round("identity", 2).alias("identity_pct"), F.col("overlap").alias("overlap_bp"), (F.col("len_a") + F.col("len_b") - F.col("overlap")).alias("combined_len_bp"), "note").orderBy(F.desc("identity_pct"))


def circular_joins(joins: DataFrame, segments: DataFrame, expected: float = 494000, tolerance: float = 0.20) -> DataFrame:
    """Rings of '+/+' joins whose size fits the expected one; every rotation is its own row: path, total, size.

    size is the sum of the segments' lengths without their overlaps, the closing one included, and
    is what is tested; total is the plain sum of lengths. A rotation counts only if its open path,
    before the closing overlap, stays within the window at every step; rings may have any number of segments.

    A ring is found once, from its smallest segment over greater ones, and turned afterwards; an open
    path ends where no closing overlap could bring it back. Each step is one join, written to shared storage.
    """
    lo, hi = expected * (1 - tolerance), expected * (1 + tolerance)
    lens = segments.select("name", F.length("seq").cast("long").alias("length"))
    e = joins.where("orientation = '+/+'").select("seg_a", "seg_b", "overlap_bp").join(lens.select(F.col("name").alias("seg_b"), F.col("length").alias("b_len")), "seg_b")
    e = keep(e.select(F.col("seg_a").alias("src"), F.col("seg_b").alias("dst"), F.col("overlap_bp").cast("long").alias("ov"), "b_len"), "ring-edges")
    most, least = e.agg(F.coalesce(F.max("ov"), F.lit(0)), F.coalesce(F.min(F.col("b_len") - F.col("ov")), F.lit(0))).first()
    front = e.select("src").distinct().join(lens, F.col("src") == F.col("name")).select(F.array("src").alias("path"), F.array("length").alias("lens"), F.array().cast("array<bigint>").alias("ovs"), F.col("length").alias("size"))
    rings = []
    while True:
        closes = F.col("dst") == F.col("path")[0]
        size = F.col("size") - F.col("ov") + F.when(closes, 0).otherwise(F.col("b_len"))
        # Where an overlap is longer than what follows it, later steps may take back more than the closing one.
        room = F.lit(True) if least < 0 else size - most <= hi
        grown = front.join(e, F.element_at("path", -1) == F.col("src")).where((closes & size.between(lo, hi)) | ((F.col("dst") > F.col("path")[0]) & ~F.array_contains("path", F.col("dst")) & room))
        more = lambda c, x: F.when(closes, F.col(c)).otherwise(F.concat(c, F.array(x)))
        grown = keep(grown.select(closes.alias("closes"), more("path", "dst").alias("path"), more("lens", "b_len").alias("lens"), F.concat("ovs", F.array("ov")).alias("ovs"), size.alias("size")), "rings")
        rings.append(grown.where("closes").drop("closes"))
        front = grown.where("NOT closes").drop("closes")
        if front.isEmpty():
            break
    turn = lambda c: F.concat(F.slice(c, F.col("k") + 1, F.size(c)), F.slice(c, F.lit(1), F.col("k")))
    turned = reduce(DataFrame.union, rings).withColumn("k", F.explode(F.sequence(F.lit(0), F.size("path") - 1))).select(turn("path").alias("path"), turn("lens").alias("lens"), turn("ovs").alias("ovs"), "size")
    upto = lambda c, n: F.aggregate(F.slice(c, F.lit(1), n), F.lit(0).cast("long"), lambda s, x: s + x)
    # The path of m segments is m lengths less the m - 1 overlaps between them.
    over = F.exists(F.sequence(F.lit(1), F.size("path")), lambda m: (m > 1) & (upto("lens", m) - upto("ovs", m - 1) > hi))
    return turned.where(~over).select("path", upto("lens", F.size("lens")).alias("total"), "size")
