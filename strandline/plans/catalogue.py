"""Queries of the library's own operators over the driver's tables, and their SQL.

The tables stand in for sequencing data: lines of orders are alignments and intervals, documents
are reads and, spelled in four letters, sequences, and suppliers, customers and orders give the
edges of a graph.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import seq as S
from ..functions.align import align
from ..operators import coverage as C
from ..operators import downsample as D
from ..operators import graph as G
from ..operators import pools as P
from ..operators import stats as T
from ..storage import keep
from .options import PRESETS, DownsampleOptions, GraphOptions, PoolOptions, ScrubOptions, presets
from .run import downsample_stats

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Thresholds on the stand-in tables, whose lengths are about ten times those of reads.
SCALED = PoolOptions(50_000, 0.93, 30_000, 0.98)
TARGET, BIN, SPAN = 20, 500, 0.04
LETTERS = "abcdefghijklmnopqrstuvwxyz"
BASES = "ACGTACGTACGTACGTACGTACGTAC"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def aln(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("qname"), F.concat("l_returnflag", "l_linestatus").alias("tname"), F.floor("l_extendedprice").cast("long").alias("aln_len"), "l_discount", "l_quantity", "l_linenumber")
    return rows.withColumn("n_match", F.floor(F.col("aln_len") * (1 - F.col("l_discount"))).cast("long"))


def iv(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("name"), F.concat("l_returnflag", "l_linestatus").alias("ref"), ((F.col("l_partkey") * 7919) % 40000).alias("st"), (F.col("l_quantity").cast("long") * 40).alias("length"), F.col("l_tax").alias("mean_q"))
    return rows.withColumn("en", F.col("st") + F.col("length"))


def contigs(spark: SparkSession, d: str) -> DataFrame:
    return iv(spark, d).select(F.col("ref").alias("name")).distinct().withColumn("length", F.lit(42_000).cast("long"))


def dna(spark: SparkSession, d: str, name: str = "documents", key: str = "doc_id") -> DataFrame:
    seq = F.regexp_replace(F.translate(F.lower(F.coalesce("text", F.lit(""))), LETTERS, BASES), "[^ACGT]", "")
    return _t(spark, d, name).select(F.col(key).alias("ord"), F.concat(F.lit("s"), F.col(key).cast("string")).alias("name"), seq.alias("seq")).where(F.length("seq") > 0)


def graph_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges between nations: supplier's to customer's, of large orders; overlap and identity follow from the keys."""
    li = _t(spark, d, "lineitem").where("l_quantity >= 50 AND l_discount >= 0.09").select("l_orderkey", "l_suppkey")
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey")
    s = _t(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    pairs = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    pairs = pairs.select(F.col("s_nationkey").cast("long").alias("a"), (F.col("o_custkey") % 25).cast("long").alias("b")).where("a != b").distinct()
    e = pairs.select(F.concat(F.lit("n"), F.lpad(F.col("a").cast("string"), 2, "0")).alias("src_seg"), F.lit("+").alias("src_orient"), F.concat(F.lit("n"), F.lpad(F.col("b").cast("string"), 2, "0")).alias("dst_seg"), F.lit("+").alias("dst_orient"), (F.lit(75.0) + (F.col("a") * 7 + F.col("b") * 3) % 25).alias("identity"), (F.lit(100) + (F.col("a") * 13 + F.col("b") * 5) % 200).alias("overlap"), (F.lit(1000) + F.col("a") * 100).alias("src_len"), (F.lit(1000) + F.col("b") * 100).alias("dst_len"))
    return e.withColumn("score", F.col("identity") * F.col("overlap"))


def top2(spark: SparkSession, d: str) -> DataFrame:
    return G.top_edges(graph_edges(spark, d), 2)


ALN = "aln AS (SELECT l_orderkey AS qname, l_returnflag || l_linestatus AS tname, CAST(floor(l_extendedprice) AS BIGINT) AS aln_len, CAST(floor(CAST(floor(l_extendedprice) AS BIGINT) * (1 - l_discount)) AS BIGINT) AS n_match, l_quantity, l_linenumber FROM lineitem)"
PASSED = f"{ALN}, passed AS (SELECT * FROM aln WHERE aln_len > 0 AND ((aln_len >= {SCALED.len_a} AND CAST(n_match AS DOUBLE) / aln_len >= {SCALED.id_a}) OR (aln_len >= {SCALED.len_b} AND CAST(n_match AS DOUBLE) / aln_len >= {SCALED.id_b})))"
IV = "iv AS (SELECT l_orderkey * 10 + l_linenumber AS name, l_returnflag || l_linestatus AS ref, (l_partkey * 7919) % 40000 AS st, CAST(l_quantity AS BIGINT) * 40 AS length, l_tax AS mean_q, (l_partkey * 7919) % 40000 + CAST(l_quantity AS BIGINT) * 40 AS en FROM lineitem), contigs AS (SELECT DISTINCT ref AS name, CAST(42000 AS BIGINT) AS length FROM iv)"
DNA = f"dna AS (SELECT * FROM (SELECT doc_id AS ord, 's' || doc_id AS name, regexp_replace(translate(lower(coalesce(text, '')), '{LETTERS}', '{BASES}'), '[^ACGT]', '', 'g') AS seq FROM documents) WHERE length(seq) > 0)"
EDGES = "pairs AS (SELECT DISTINCT CAST(s_nationkey AS BIGINT) AS a, CAST(o_custkey % 25 AS BIGINT) AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey WHERE l_quantity >= 50 AND l_discount >= 0.09 AND s_nationkey <> o_custkey % 25), edges AS (SELECT 'n' || lpad(CAST(a AS VARCHAR), 2, '0') AS src_seg, 'n' || lpad(CAST(b AS VARCHAR), 2, '0') AS dst_seg, CAST(75 + (a * 7 + b * 3) % 25 AS DOUBLE) AS identity, 100 + (a * 13 + b * 5) % 200 AS overlap, 1000 + a * 100 AS src_len, 1000 + b * 100 AS dst_len FROM pairs), scored AS (SELECT *, identity * overlap AS score FROM edges), top2 AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY src_seg ORDER BY score DESC, identity DESC, overlap DESC, dst_seg) <= 2)"
WALKS = f"WITH RECURSIVE {EDGES}, w AS (SELECT [src_seg] AS nodes, max(src_len) AS total_len, 0 AS depth, CAST(0 AS DOUBLE) AS ids, CAST(0 AS BIGINT) AS ov FROM top2 GROUP BY src_seg UNION ALL SELECT list_append(w.nodes, e.dst_seg), w.total_len + e.dst_len - e.overlap, w.depth + 1, w.ids + e.identity, w.ov + e.overlap FROM w JOIN top2 e ON w.nodes[len(w.nodes)] = e.src_seg WHERE w.depth < {{depth}} AND NOT list_contains(w.nodes, e.dst_seg)), closed AS (SELECT w.nodes AS body, w.total_len - e.overlap AS total_len, w.depth + 1 AS depth, w.ids + e.identity AS ids, w.ov + e.overlap AS ov FROM w JOIN top2 e ON w.nodes[len(w.nodes)] = e.src_seg WHERE w.depth >= 1 AND w.depth < {{depth}} AND e.dst_seg = w.nodes[1])"


@query(f"WITH {PASSED}, c AS (SELECT DISTINCT tname AS chrom FROM aln) SELECT chrom, (SELECT count(*) FROM aln WHERE tname = chrom) AS n_seen, (SELECT count(*) FROM passed WHERE tname = chrom) AS n_passed, (SELECT count(DISTINCT qname) FROM passed WHERE tname = chrom) AS n_reads FROM c")
def dual_threshold_pools(spark, d):
    return P.pool_stats(aln(spark, d), contigs(spark, d), SCALED)


@query(f"WITH {PASSED} SELECT tname AS chrom, count(DISTINCT qname) AS n_reads FROM passed WHERE tname IN ('AF', 'RF', 'NO') GROUP BY tname")
def pool_known_targets(spark, d):
    known = contigs(spark, d).where(F.col("name").isin("AF", "RF", "NO"))
    return P.pools(P.known_targets(P.dual_threshold(aln(spark, d), SCALED), known)).groupBy("chrom").agg(F.count("*").alias("n_reads"))


@query(f"WITH {PASSED} SELECT DISTINCT qname AS read FROM passed")
def pool_union(spark, d):
    return P.pool_union(P.pools(P.dual_threshold(aln(spark, d), SCALED)))


@query(f"WITH {PASSED} SELECT qname, tname, aln_len, n_match FROM passed QUALIFY row_number() OVER (PARTITION BY qname ORDER BY n_match DESC, aln_len DESC, tname) = 1")
def pool_best_hit(spark, d):
    return P.best_hit(P.dual_threshold(aln(spark, d), SCALED).select("qname", "tname", "aln_len", "n_match"))


_PRESET_ROWS = ", ".join(f"({k}, {a * 10}, CAST({ia} AS DOUBLE), {b * 10}, CAST({ib} AS DOUBLE))" for k, (a, ia, b, ib) in PRESETS.items())


@query(f"WITH {ALN}, p(preset, len_a, id_a, len_b, id_b) AS (VALUES {_PRESET_ROWS}) SELECT preset, tname AS chrom, count(*) AS n_passed, count(DISTINCT qname) AS n_reads FROM aln, p WHERE aln_len > 0 AND ((aln_len >= len_a AND CAST(n_match AS DOUBLE) / aln_len >= id_a) OR (aln_len >= len_b AND CAST(n_match AS DOUBLE) / aln_len >= id_b)) GROUP BY preset, tname")
def preset_grid(spark, d):
    return P.preset_grid(aln(spark, d), presets(spark, 10))


@query(f"WITH {PASSED}, m AS (SELECT DISTINCT tname AS chrom, qname FROM passed) SELECT m.chrom, count(*) AS n_reads, CAST(sum(length(o_orderstatus || o_orderpriority)) AS BIGINT) AS bases FROM m JOIN orders ON o_orderkey = qname GROUP BY m.chrom")
def pool_reads(spark, d):
    reads = _t(spark, d, "orders").select(F.col("o_orderkey").alias("ord"), F.col("o_orderkey").alias("name"), F.concat("o_orderstatus", "o_orderpriority").alias("seq"), F.lit("").alias("qual"))
    return P.pool_reads(P.pools(P.dual_threshold(aln(spark, d), SCALED)), reads).groupBy("chrom").agg(F.count("*").alias("n_reads"), F.sum(F.length("seq")).alias("bases"))


BINS_SQL = f"{IV}, b AS (SELECT iv.*, st // {BIN} AS f, least((en - 1) // {BIN}, (42000 + {BIN} - 1) // {BIN} - 1) AS l FROM iv), x AS (SELECT *, (en - st) // greatest(l - f + 1, 1) AS credit, unnest(range(f, l + 1)) AS bin FROM b WHERE f <= l)"
FILL_SQL = f"{BINS_SQL}, k AS (SELECT *, coalesce(sum(credit) OVER (PARTITION BY ref, bin ORDER BY length DESC, mean_q DESC, st, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM x), kept AS (SELECT DISTINCT name FROM k WHERE before < {TARGET * BIN})"


@query(f"WITH {FILL_SQL} SELECT ref, count(*) AS n_reads FROM iv JOIN kept USING (name) GROUP BY ref")
def bin_fill_sql(spark, d):
    reads = iv(spark, d)
    return P.keep_reads(reads, D.fill_bins(reads, contigs(spark, d), TARGET, BIN)).groupBy("ref").agg(F.count("*").alias("n_reads"))


@query(f"WITH {IV}, s AS (SELECT name, ref FROM iv WHERE CAST(en - st AS DOUBLE) / 42000 >= {SPAN}) SELECT ref, count(*) AS n_reads FROM s GROUP BY ref")
def spanning_reads(spark, d):
    return D.spanning(iv(spark, d), contigs(spark, d), SPAN).groupBy("ref").agg(F.count("*").alias("n_reads"))


@query(f"WITH {FILL_SQL}, s AS (SELECT DISTINCT name FROM iv WHERE CAST(en - st AS DOUBLE) / 42000 >= {SPAN}), u AS (SELECT name FROM kept UNION SELECT name FROM s), o AS (SELECT name FROM s EXCEPT SELECT name FROM kept) SELECT c.name AS ref, coalesce((SELECT sum(en - st) FROM iv WHERE iv.ref = c.name AND iv.name IN (SELECT name FROM u)), 0) / CAST(42000 AS DOUBLE) AS coverage, (SELECT count(*) FROM o) AS spanning_only FROM contigs c")
def achieved_coverage(spark, d):
    reads, cs = iv(spark, d), contigs(spark, d)
    fill, span = D.fill_bins(reads, cs, TARGET, BIN), D.spanning(reads, cs, SPAN)
    names = fill.withColumn("filled", F.lit(True)).union(span.select("name", F.lit(False)))
    names = keep(names.groupBy("name").agg(F.max("filled").alias("filled")), "kept-names")
    only = names.agg(F.count_if(~F.col("filled")).alias("spanning_only"))
    return D.achieved(reads, names, cs).join(F.broadcast(only))


@query(f"WITH {FILL_SQL}, s AS (SELECT DISTINCT ref, name FROM iv WHERE CAST(en - st AS DOUBLE) / 42000 >= {SPAN}) SELECT ref AS chrom, count(*) AS input_alignments, count(DISTINCT name) FILTER (WHERE (ref, name) IN (SELECT (ref, name) FROM s)) AS spanning_reads, count(DISTINCT name) FILTER (WHERE name IN (SELECT name FROM kept)) AS selected_reads, CAST({TARGET} AS INTEGER) AS target_coverage, round(coalesce(sum(en - st) FILTER (WHERE name IN (SELECT name FROM kept)), 0) / CAST(42000 AS DOUBLE), 6) AS coverage FROM iv GROUP BY ref")
def downsample_document(spark, d):
    """The statistics of a downsampling by bins, a row a contig."""
    reads, cs = iv(spark, d), contigs(spark, d)
    made = downsample_stats(reads, cs, DownsampleOptions(TARGET, BIN, SPAN), D.fill_bins(reads, cs, TARGET, BIN))
    return made.select("chrom", "input_alignments", "spanning_reads", "selected_reads", "target_coverage", F.round(F.element_at("achieved_coverage", F.col("chrom")), 6).alias("coverage"))


#: A bin's reads are taken in order until it is full, counting what reads taken in earlier bins that reach it left there; each taking credits all bins from this one on.
GREEDY_SQL = f"WITH RECURSIVE {BINS_SQL}, k AS (SELECT name, ref, bin, credit, l AS last, coalesce(sum(credit) OVER (PARTITION BY ref, bin ORDER BY length DESC, mean_q DESC, st, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM x), g(ref, bin, name, last, credit, taken) AS (SELECT name, CAST(-1 AS BIGINT), CAST(NULL AS BIGINT), length // {BIN} + 1, CAST(0 AS BIGINT), false FROM contigs UNION ALL (SELECT ref, bin + 1, name, last, credit, false FROM g WHERE last > bin UNION ALL SELECT k.ref, k.bin, k.name, k.last, k.credit, true FROM k JOIN (SELECT ref, bin + 1 AS bin, sum(credit) AS have FROM g WHERE last > bin GROUP BY ref, bin) h ON h.ref = k.ref AND h.bin = k.bin WHERE have + before < {TARGET * BIN}))"


@query(f"{GREEDY_SQL} SELECT ref, count(*) AS n_reads, CAST(sum(en - st) AS BIGINT) AS bases FROM iv WHERE name IN (SELECT name FROM g WHERE taken) GROUP BY ref")
def greedy_bins_exact(spark, d):
    reads = iv(spark, d)
    return P.keep_reads(reads, D.greedy(reads, contigs(spark, d), TARGET, BIN)).groupBy("ref").agg(F.count("*").alias("n_reads"), F.sum(F.col("en") - F.col("st")).alias("bases"))


@query(f"WITH {IV}, e AS (SELECT ref, st AS pos, 1 AS d FROM iv UNION ALL SELECT ref, en, -1 FROM iv), s AS (SELECT ref, pos, sum(d) AS d FROM e GROUP BY ref, pos HAVING sum(d) <> 0), r AS (SELECT ref, pos AS start, lead(pos) OVER w AS \"end\", sum(d) OVER w AS depth FROM s WINDOW w AS (PARTITION BY ref ORDER BY pos)) SELECT ref, start, \"end\", CAST(depth AS BIGINT) AS depth FROM r WHERE depth > 0")
def depth_profile(spark, d):
    return C.depth_runs(iv(spark, d))


MEANS_SQL = f"{IV}, g AS (SELECT name AS ref, unnest(range(0, length - 500 + 1, 100)) AS win_start FROM contigs), x AS (SELECT ref, st, en, unnest(range(greatest(0, CAST(ceil((st - 499) / 100.0) AS BIGINT)), (en - 1) // 100 + 1)) * 100 AS win_start FROM iv), b AS (SELECT ref, win_start, sum(least(en, win_start + 500) - greatest(st, win_start)) AS bases FROM x GROUP BY ref, win_start), means AS (SELECT ref, win_start, coalesce(bases, 0) / CAST(500 AS DOUBLE) AS mean_cov FROM g LEFT JOIN b USING (ref, win_start))"


@query(f"WITH {MEANS_SQL} SELECT ref, win_start, mean_cov FROM means")
def sliding_coverage(spark, d):
    return C.window_means(iv(spark, d), contigs(spark, d))


@query(f"WITH {MEANS_SQL}, a AS (SELECT median(mean_cov) AS all_baseline FROM means) SELECT ref, median(mean_cov) AS baseline, max(all_baseline) AS all_baseline FROM means, a GROUP BY ref")
def coverage_baseline(spark, d):
    means = C.value_counts(C.window_means(iv(spark, d), contigs(spark, d)))
    return C.baselines(means).join(F.broadcast(C.global_baseline(means).withColumnRenamed("baseline", "all_baseline")))


BLOCKS_SQL = "al AS (SELECT l_returnflag || l_linestatus AS ref, (l_partkey * 7919) % 40000 AS st, CAST(l_quantity AS BIGINT) AS q, l_linenumber AS k FROM lineitem), bl AS (SELECT ref, st, st + q * 20 AS en FROM al UNION ALL SELECT ref, st + q * 20 + k, st + q * 20 + k + 50 FROM al UNION ALL SELECT ref, st + q * 20 + k + 50 + 100 * k, st + q * 20 + k + 80 + 100 * k FROM al)"


@query(f"WITH {BLOCKS_SQL}, e AS (SELECT ref, st AS pos, 1 AS d FROM bl UNION ALL SELECT ref, en, -1 FROM bl), s AS (SELECT ref, pos, sum(d) AS d FROM e GROUP BY ref, pos HAVING sum(d) <> 0), r AS (SELECT ref, pos AS start, lead(pos) OVER w AS \"end\", sum(d) OVER w AS depth FROM s WINDOW w AS (PARTITION BY ref ORDER BY pos)) SELECT ref, start, \"end\", CAST(depth AS BIGINT) AS depth FROM r WHERE depth > 0")
def aligned_depth(spark, d):
    """Depth of lines as alignments with clips, insertions, deletions and skips, which cover their matches only."""
    q, k = F.col("l_quantity").cast("long"), F.col("l_linenumber").cast("long")
    cigar = F.format_string("3S%dM2I%dD50M%dN30=4H", q * 20, k, k * 100)
    rows = _t(spark, d, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("tname"), ((F.col("l_partkey") * 7919) % 40000).alias("ref_start"), cigar.alias("cigar"), F.lit("").alias("seq"))
    return C.depth_runs(C.aligned_blocks(rows))


LOCAL_SQL = f"{MEANS_SQL}, base AS MATERIALIZED (SELECT ref, median(mean_cov) * 0.95 AS threshold FROM means GROUP BY ref), e AS (SELECT ref, st AS pos, 1 AS d FROM iv UNION ALL SELECT ref, en, -1 FROM iv), s AS (SELECT ref, pos, sum(d) AS d FROM e GROUP BY ref, pos), cu AS MATERIALIZED (SELECT ref, pos, CAST(pos * sum(d) OVER w - sum(pos * d) OVER w AS BIGINT) AS below FROM s WINDOW w AS (PARTITION BY ref ORDER BY pos)), loc AS MATERIALIZED (SELECT iv.*, (h.below - l.below) / CAST(iv.en - iv.st AS DOUBLE) AS local_cov FROM iv JOIN cu l ON l.ref = iv.ref AND l.pos = iv.st JOIN cu h ON h.ref = iv.ref AND h.pos = iv.en)"


@query(f"WITH {LOCAL_SQL} SELECT loc.name, loc.ref, local_cov FROM loc JOIN base USING (ref) WHERE local_cov < threshold")
def low_coverage_regions(spark, d):
    reads, cs = iv(spark, d), contigs(spark, d)
    base = C.baselines(C.window_means(reads, cs)).select("ref", (F.col("baseline") * 0.95).alias("threshold"))
    return C.local_coverage(reads).join(base, "ref").where("local_cov < threshold").select("name", "ref", "local_cov")


def _judged(spark, d):
    rows = aln(spark, d).select("qname", F.col("tname"), (F.col("l_linenumber") * 10).alias("mapq"), (F.col("n_match") / F.col("aln_len")).alias("mapped_fraction"), (F.col("l_quantity") / 100).alias("softclip_fraction"))
    return C.outcomes(rows, ScrubOptions(min_mapq=20, min_mapped_fraction=0.92, max_softclip_fraction=0.40))


JUDGED = f"{ALN}, judged AS (SELECT qname, tname, CASE WHEN l_linenumber * 10 < 20 THEN 'failed_mapq' WHEN CAST(n_match AS DOUBLE) / aln_len < 0.92 THEN 'failed_mapped_fraction' WHEN l_quantity / 100 > 0.40 THEN 'failed_softclip' ELSE 'clean' END AS outcome FROM aln)"


@query(f"WITH {JUDGED} SELECT tname, outcome, count(*) AS n FROM judged GROUP BY tname, outcome")
def classify_outcomes(spark, d):
    return _judged(spark, d).groupBy("tname", "outcome").agg(F.count("*").alias("n"))


@query(f"WITH {JUDGED} SELECT count(*) AS total_alignments, count(*) FILTER (WHERE outcome = 'failed_mapq') AS failed_mapq, count(*) FILTER (WHERE outcome = 'failed_mapped_fraction') AS failed_mapped_fraction, count(*) FILTER (WHERE outcome = 'failed_softclip') AS failed_softclip, CAST(0 AS BIGINT) AS failed_low_coverage, count(DISTINCT qname) FILTER (WHERE outcome = 'clean') AS clean_reads, count(DISTINCT qname) FILTER (WHERE outcome <> 'clean') AS numt_or_chimeric_reads FROM judged")
def clean_reads(spark, d):
    return C.read_verdicts(_judged(spark, d))


@query(f"WITH {DNA} SELECT name, length(seq) AS length, substr(seq, 1, 50) AS head, right(seq, 50) AS tail, reverse(translate(substr(seq, 1, 50), 'ACGT', 'TGCA')) AS head_rc FROM dna")
def revcomp_terminals(spark, d):
    return dna(spark, d).select("name", F.length("seq").cast("long").alias("length"), S.head(F.col("seq"), 50).alias("head"), S.tail(F.col("seq"), 50).alias("tail"), S.revcomp(S.head(F.col("seq"), 50)).alias("head_rc"))


FLAGS = (0, 16, 2048, 256, 4, 1024, 0)
READS_SQL = f"rd AS (SELECT l_orderkey AS qname, CASE l_linenumber {' '.join(f'WHEN {k + 1} THEN {f}' for k, f in enumerate(FLAGS))} END AS flag, l_returnflag || l_linestatus AS ref, (l_partkey * 7919) % 40000 AS st, (l_partkey * 7919) % 40000 + CAST(l_quantity AS BIGINT) * 40 AS en, (l_suppkey * 31) % 60 AS mapq, CAST(l_quantity AS BIGINT) * 40 AS m, CAST(l_tax * 100 AS BIGINT) * 60 AS s FROM lineitem), contigs AS (SELECT DISTINCT ref AS name, CAST(42000 AS BIGINT) AS length FROM rd)"
CLASSIFY_SQL = f"WITH {READS_SQL}, iv AS (SELECT * FROM rd WHERE flag NOT IN (4, 256, 1024))" + MEANS_SQL[MEANS_SQL.index(", g AS (") :] + ", base AS MATERIALIZED (SELECT ref, median(mean_cov) * 0.97 AS threshold FROM means GROUP BY ref), e AS (SELECT ref, st AS pos, CASE flag WHEN 1024 THEN 0 ELSE 1 END AS d FROM rd WHERE flag NOT IN (4, 256) UNION ALL SELECT ref, en, CASE flag WHEN 1024 THEN 0 ELSE -1 END FROM rd WHERE flag NOT IN (4, 256)), ss AS (SELECT ref, pos, sum(d) AS d FROM e GROUP BY ref, pos), cu AS MATERIALIZED (SELECT ref, pos, CAST(pos * sum(d) OVER w - sum(pos * d) OVER w AS BIGINT) AS below FROM ss WINDOW w AS (PARTITION BY ref ORDER BY pos)), j AS (SELECT rd.ref, CASE WHEN mapq < 20 THEN 'failed_mapq' WHEN m / CAST(m + s AS DOUBLE) < 0.8 THEN 'failed_mapped_fraction' WHEN s / CAST(m + s AS DOUBLE) > 0.15 THEN 'failed_softclip' WHEN (h.below - l.below) / CAST(en - st AS DOUBLE) < threshold THEN 'failed_low_coverage' ELSE 'clean' END AS outcome FROM rd JOIN cu l ON l.ref = rd.ref AND l.pos = rd.st JOIN cu h ON h.ref = rd.ref AND h.pos = rd.en JOIN base ON base.ref = rd.ref WHERE flag NOT IN (4, 256, 2048))"


@query(CLASSIFY_SQL + " SELECT ref, outcome, count(*) AS n FROM j GROUP BY ref, outcome")
def classify_reads(spark, d):
    """The whole classifier over lines as alignments of all kinds of flags."""
    li = _t(spark, d, "lineitem")
    flag = F.get(F.array(*[F.lit(f) for f in FLAGS]), F.col("l_linenumber") - 1)
    m, clip, start = F.col("l_quantity").cast("long") * 40, (F.col("l_tax") * 100).cast("decimal(10,0)").cast("long") * 60, (F.col("l_partkey") * 7919) % 40000
    rows = li.select(F.col("l_orderkey").alias("qname"), flag.alias("flag"), F.concat("l_returnflag", "l_linestatus").alias("tname"), start.alias("ref_start"), (start + m).alias("ref_end"), ((F.col("l_suppkey") * 31) % 60).cast("int").alias("mapq"), F.concat(F.when(clip > 0, F.concat(clip.cast("string"), F.lit("S"))).otherwise(""), m.cast("string"), F.lit("M")).alias("cigar"), F.lit("").alias("seq"))
    judged = C.classify(rows, contigs(spark, d), ScrubOptions(min_mapq=20, min_mapped_fraction=0.8, max_softclip_fraction=0.15, coverage_ratio=0.97))
    return judged.groupBy(F.col("ref"), "outcome").agg(F.count("*").alias("n"))


B_DNA = DNA.replace("doc_id", "item_id").replace("documents", "benchmark")


@query(f"WITH {B_DNA}, t AS (SELECT ord, name, length(seq) AS len, substr(seq, 1, 40) AS head, right(seq, 40) AS tail FROM dna), o(end_a, end_b, orientation) AS (VALUES ('tail', 'head', '+/+'), ('tail_rc', 'head', '-/+'), ('tail', 'head_rc', '+/-'), ('tail_rc', 'head_rc', '-/-')) SELECT a.name AS seg_a, b.name AS seg_b, end_a, end_b, orientation, CASE end_a WHEN 'tail' THEN a.tail ELSE reverse(translate(a.tail, 'ACGT', 'TGCA')) END AS query, CASE end_b WHEN 'head' THEN b.head ELSE reverse(translate(b.head, 'ACGT', 'TGCA')) END AS target FROM t a JOIN t b ON a.ord <> b.ord, o")
def join_orientations(spark, d):
    return G.join_candidates(dna(spark, d, "benchmark", "item_id"), 40).select("seg_a", "seg_b", "end_a", "end_b", "orientation", "query", "target")


@query("WITH r AS (SELECT source, length(coalesce(text, '')) AS len FROM documents), c AS (SELECT source, len, sum(len) OVER (PARTITION BY source ORDER BY len DESC RANGE UNBOUNDED PRECEDING) AS run, sum(len) OVER (PARTITION BY source) AS total FROM r) SELECT source, CAST(max(len) AS BIGINT) AS n50 FROM c WHERE run * 2 >= total GROUP BY source")
def n50_by_source(spark, d):
    rows = _t(spark, d, "documents").select("source", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("len0"))
    return T.n50(rows, "len0", ["source"])


@query("WITH g AS (SELECT unnest(range(0, 9)) AS bin), h AS (SELECT least(CAST(floor(value / 5) AS BIGINT), 8) AS bin, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1) SELECT CAST(bin AS INTEGER) AS bin, CASE WHEN bin < 8 THEN 'Q' || bin * 5 || '-' || (bin * 5 + 5) ELSE 'Q40+' END AS label, coalesce(n, 0) AS n FROM g LEFT JOIN h USING (bin)")
def quality_histogram(spark, d):
    return T.quality_histogram(_t(spark, d, "events").select("value"), "value")


@query("SELECT count(*) AS count, CAST(sum(n_chars) AS BIGINT) AS total_bases, CAST(floor(sum(n_chars) / count(*)) AS BIGINT) AS mean_length, round(avg(doc_id % 40 + 0.5), 2) AS mean_q FROM documents")
def read_stats(spark, d):
    return T.read_stats(_t(spark, d, "documents").select(F.col("n_chars").alias("length"), (F.col("doc_id") % 40 + 0.5).cast("double").alias("mean_q")))


@query("WITH c AS (SELECT c_nationkey AS nation, sum(c_acctbal) / 1000 AS cov FROM customer GROUP BY 1) SELECT nation, CASE WHEN cov >= 80 THEN 'green' WHEN cov >= 30 THEN 'yellow' ELSE 'red' END AS badge FROM c")
def coverage_badges(spark, d):
    return _t(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg((F.sum("c_acctbal") / 1000).alias("cov")).select("nation", T.coverage_badge(F.col("cov")).alias("badge"))


@query("WITH c AS (SELECT c_nationkey AS k, CAST(count(*) AS DOUBLE) AS coverage FROM customer GROUP BY 1), l AS (SELECT *, CASE WHEN k % 3 <> 0 THEN CAST(1000 + k * 100 AS BIGINT) END AS length FROM c), m AS (SELECT sum(coverage * coalesce(length, 0)) / sum(coalesce(length, 0)) AS mean FROM l) SELECT 'n' || k AS chrom, coverage, length, CASE WHEN coverage >= 80 THEN 'green' WHEN coverage >= 30 THEN 'yellow' ELSE 'red' END AS badge, round(mean, 6) AS mean FROM l, m")
def coverage_with_lengths(spark, d):
    """Coverage joined with the lengths that are known, and the mean by length."""
    c = _t(spark, d, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").cast("double").alias("coverage"))
    name = F.concat(F.lit("n"), F.col("k").cast("string"))
    lengths = F.when(F.col("k") % 3 != 0, F.create_map(name, (F.lit(1000) + F.col("k") * 100).cast("long"))).otherwise(F.create_map().cast("map<string,bigint>"))
    documents = c.select(F.create_map(name, "coverage").alias("achieved_coverage"), lengths.alias("ref_lengths"))
    return T.coverage_rows(documents).join(F.broadcast(T.displayed_coverage(documents).select(F.round("mean", 6).alias("mean"))))


@query("WITH c AS (SELECT o_custkey AS name, CAST(sum(floor(o_totalprice / 10)) AS BIGINT) AS length FROM orders GROUP BY 1) SELECT CASE WHEN length > 50000 THEN 'chromosome-scale' WHEN length > 10000 THEN 'large' ELSE 'fragment' END AS status, count(*) AS n_contigs, CAST(sum(length) AS BIGINT) AS total_length, max(length) AS longest FROM c GROUP BY 1")
def assembly_status(spark, d):
    c = _t(spark, d, "orders").groupBy(F.col("o_custkey").alias("name")).agg(F.sum(F.floor(F.col("o_totalprice") / 10)).cast("long").alias("length"))
    return c.groupBy(T.contig_status(F.col("length")).alias("status")).agg(F.count("*").alias("n_contigs"), F.sum("length").alias("total_length"), F.max("length").alias("longest"))


@query("WITH c AS (SELECT o_custkey AS name, CAST(sum(floor(o_totalprice / 10)) AS BIGINT) AS length FROM orders GROUP BY 1) SELECT count(*) AS n_contigs, CAST(sum(length) AS BIGINT) AS total_length, max(length) AS longest, md5(string_agg(CAST(length AS VARCHAR), ',' ORDER BY length DESC)) AS lengths_md5 FROM c")
def assembly_stats(spark, d):
    c = _t(spark, d, "orders").groupBy(F.col("o_custkey").alias("name")).agg(F.sum(F.floor(F.col("o_totalprice") / 10)).cast("long").alias("length"))
    return T.assembly_stats(c).select("n_contigs", "total_length", "longest", F.md5(F.array_join(F.transform("lengths", lambda x: x.cast("string")), ",")).alias("lengths_md5"))


@query("WITH c AS (SELECT l_suppkey, sum(CAST(l_quantity AS BIGINT)) AS coverage, count(*) AS length FROM lineitem GROUP BY 1) SELECT sum(CAST(coverage AS DOUBLE) * length) / sum(length) AS weighted, avg(CAST(coverage AS DOUBLE)) AS plain FROM c")
def weighted_coverage(spark, d):
    c = _t(spark, d, "lineitem").groupBy("l_suppkey").agg(F.sum(F.col("l_quantity").cast("long")).cast("double").alias("coverage"), F.count("*").alias("length"))
    return T.weighted_coverage(c)


@query(f"WITH {EDGES} SELECT seg, count(*) AS edge_degree FROM (SELECT src_seg AS seg FROM top2 UNION ALL SELECT dst_seg FROM top2) GROUP BY seg")
def node_degree(spark, d):
    return G.degree(top2(spark, d))


@query(f"WITH {EDGES} SELECT src_seg, dst_seg, identity, overlap, score FROM top2")
def top_edges_per_node(spark, d):
    return top2(spark, d).select("src_seg", "dst_seg", "identity", "overlap", "score")


@query(f"WITH {EDGES}, twice AS (SELECT * FROM scored UNION ALL SELECT src_seg, dst_seg, identity - 1, overlap, src_len, dst_len, (identity - 1) * overlap FROM scored) SELECT src_seg, dst_seg, identity, overlap FROM twice QUALIFY row_number() OVER (PARTITION BY src_seg, dst_seg ORDER BY score DESC) = 1")
def edge_index(spark, d):
    e = graph_edges(spark, d)
    worse = e.withColumn("identity", F.col("identity") - 1).withColumn("score", F.col("identity") * F.col("overlap"))
    return G.edge_index(e.unionByName(worse)).select("src_seg", "dst_seg", "identity", "overlap")


@query(WALKS.format(depth=5) + " SELECT CAST(depth AS INTEGER) AS depth, count(*) AS n, CAST(sum(total_len) AS BIGINT) AS total FROM w WHERE depth > 0 GROUP BY depth")
def bounded_walks(spark, d):
    open_, _ = G.walks(top2(spark, d), 5)
    return open_.groupBy("depth").agg(F.count("*").alias("n"), F.sum("total_len").alias("total"))


CYCLES = WALKS.format(depth=6) + ", k AS (SELECT *, list_min(list_concat(list_transform(range(0, len(body)), lambda i: list_concat(body[i + 1 :], body[: i])), list_transform(range(0, len(body)), lambda i: list_concat(list_reverse(body)[i + 1 :], list_reverse(body)[: i])))) AS key FROM closed), u AS (SELECT key, max(ov) AS ov, count(*) AS found, len(key) AS n FROM k GROUP BY key)"


@query(CYCLES + " SELECT array_to_string(key, ' ') AS cycle, n AS size FROM u")
def cycles_canonical(spark, d):
    _, closed = G.walks(top2(spark, d), 6)
    keyed = closed.select(S.cycle_key(F.slice("nodes", F.lit(1), F.size("nodes") - 1)).alias("key")).distinct()
    return keyed.select(F.array_join(F.transform("key", lambda n: n["seg"]), " ").alias("cycle"), F.size("key").cast("long").alias("size"))


@query(CYCLES + ", m AS (SELECT unnest(key) AS seg FROM u) SELECT seg, count(*) AS cycle_count FROM m GROUP BY seg")
def cycle_membership(spark, d):
    return G.cycle_membership(G.distinct_cycles(G.walks(top2(spark, d), 6)[1]))


_SIZED = GraphOptions(expected_size=6000, size_tolerance=0.20, max_depth=4)


@query(WALKS.format(depth=4) + " SELECT array_to_string(nodes, ' ') AS path, CAST(total_len AS BIGINT) AS total_len, round(ids / depth, 2) AS mean_identity, CAST(ov AS BIGINT) AS total_overlap FROM w WHERE depth > 0 AND total_len BETWEEN 4800 AND 7200")
def sized_paths(spark, d):
    open_, _ = G.walks(top2(spark, d), _SIZED.max_depth, 7200)
    return open_.where("total_len BETWEEN 4800 AND 7200").select(F.array_join(F.transform("nodes", lambda n: n["seg"]), " ").alias("path"), "total_len", F.round(F.col("sum_identity") / F.col("depth"), 2).alias("mean_identity"), "total_overlap")


RANKED = WALKS.format(depth=4).replace("AS ov FROM top2 GROUP", "AS ov, CAST(0 AS DOUBLE) AS sc, CAST(1000 AS DOUBLE) AS mn FROM top2 GROUP").replace("w.ov + e.overlap FROM w JOIN top2 e", "w.ov + e.overlap, w.sc + e.score, least(w.mn, e.identity) FROM w JOIN top2 e").replace("w.ov + e.overlap AS ov FROM w JOIN top2 e", "w.ov + e.overlap AS ov, w.sc + e.score AS sc, least(w.mn, e.identity) AS mn FROM w JOIN top2 e")
RANKED += ", k AS (SELECT *, list_append(body, body[1]) AS nodes, list_min(list_concat(list_transform(range(0, len(body)), lambda i: list_concat(body[i + 1 :], body[: i])), list_transform(range(0, len(body)), lambda i: list_concat(list_reverse(body)[i + 1 :], list_reverse(body)[: i])))) AS key FROM closed), u AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY key ORDER BY sc DESC, nodes) = 1)"
RANKED += ", f AS (SELECT 'cycle' AS kind, nodes, total_len, round(ids / depth, 2) AS mean_identity, mn AS min_identity, ov AS total_overlap, round(sc, 2) AS score FROM u UNION ALL SELECT 'linear', nodes, total_len, round(ids / depth, 2), mn, ov, round(sc, 2) FROM w WHERE depth > 0)"
RANKED += ", sized AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY abs(total_len - 6000), mean_identity DESC, score DESC, nodes) AS r FROM f WHERE total_len BETWEEN 4800 AND 7200), best AS (SELECT * FROM sized WHERE r <= CASE kind WHEN 'cycle' THEN 30 ELSE 50 END)"
_AS_TEXT = "array_to_string(list_transform(nodes, lambda x: x || '+'), ' -> ') AS path, CAST(total_len AS BIGINT) AS total_len"


@query(RANKED + f" SELECT kind, {_AS_TEXT}, mean_identity, min_identity, CAST(total_overlap AS BIGINT) AS total_overlap, score FROM best")
def sized_paths_ranked(spark, d):
    cycles, linear = G.sized_paths(top2(spark, d), _SIZED)
    return cycles.unionByName(linear).select("kind", S.path_text(F.col("nodes")).alias("path"), "total_len", "mean_identity", "min_identity", "total_overlap", "score")


@query(RANKED + f", c AS (SELECT 0 AS source, *, row_number() OVER (ORDER BY mean_identity DESC, score DESC, total_len, nodes) AS r FROM f WHERE kind = 'cycle' UNION ALL SELECT CASE kind WHEN 'cycle' THEN 1 ELSE 2 END, * FROM best) SELECT CAST(source AS INTEGER) AS source, {_AS_TEXT} FROM c WHERE source > 0 OR r <= 5 ORDER BY source, r LIMIT 20")
def written_paths(spark, d):
    """Five cycles of any size first, then sized cycles and linear paths in their own order."""
    e = top2(spark, d)
    some = GraphOptions(expected_size=6000, size_tolerance=0.20, max_depth=4, max_any=5)
    cycles, linear = G.sized_paths(e, some)
    return G.fasta_choice(G.any_cycles(e, some), cycles, linear, some.fasta_top, some.expected_size).select("source", S.path_text(F.col("nodes")).alias("path"), "total_len")


@query(f"WITH RECURSIVE {EDGES}, r AS (SELECT [src_seg] AS path, max(src_len) AS total, max(src_len) AS size FROM top2 GROUP BY src_seg UNION ALL SELECT list_append(r.path, e.dst_seg), r.total + e.dst_len, r.size + e.dst_len - e.overlap FROM r JOIN top2 e ON r.path[len(r.path)] = e.src_seg WHERE NOT list_contains(r.path, e.dst_seg) AND r.size + e.dst_len - e.overlap <= 9600) SELECT array_to_string(r.path, ' ') AS path, CAST(r.total AS BIGINT) AS total, CAST(r.size - e.overlap AS BIGINT) AS size FROM r JOIN top2 e ON r.path[len(r.path)] = e.src_seg AND r.path[1] = e.dst_seg WHERE r.size - e.overlap BETWEEN 6400 AND 9600")
def circular_joins(spark, d):
    """Rings of 8000 bases, a fifth more or less, of the graph's edges as joins."""
    joins = top2(spark, d).select(F.col("src_seg").alias("seg_a"), F.col("dst_seg").alias("seg_b"), F.lit("+/+").alias("orientation"), F.col("overlap").alias("overlap_bp"))
    return G.circular_joins(joins, _segments(spark, d), 8000, 0.2).select(F.array_join("path", " ").alias("path"), "total", "size")


@query(WALKS.format(depth=3) + " SELECT array_to_string(list_transform(nodes, lambda x: x || '+'), ' -> ') AS path, array_to_string(nodes, '__') || '|linear|' || CAST(total_len AS BIGINT) || '|' || printf('%.2f', ids / depth) AS name FROM w WHERE depth > 0")
def path_names(spark, d):
    open_, _ = G.walks(top2(spark, d), 3)
    return open_.select(S.path_text(F.col("nodes")).alias("path"), S.merged_name(F.col("nodes"), F.lit("linear"), F.col("total_len"), F.col("sum_identity") / F.col("depth")).alias("name"))


def _segments(spark, d):
    """A segment a nation, as long as its node, spelled from its key."""
    n = _t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("k"))
    return n.select(F.concat(F.lit("n"), F.lpad(F.col("k").cast("string"), 2, "0")).alias("name"), F.translate(F.array_join(F.transform(F.sequence(F.lit(1), (F.lit(1000) + F.col("k") * 100).cast("int")), lambda i: ((i * i + i * F.col("k")) % 7 % 4).cast("string")), ""), "0123", "ACGT").alias("seq"))


SEGMENTS = "segs AS (SELECT 'n' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS name, translate(array_to_string(list_transform(range(1, 1000 + n_nationkey * 100 + 1), lambda i: (i * i + i * n_nationkey) % 7 % 4), ''), '0123', 'ACGT') AS seq FROM nation)"


@query(f"WITH {EDGES}, {SEGMENTS} SELECT src_seg || ' ' || dst_seg AS path, md5(a.seq || substr(b.seq, CAST(overlap AS INTEGER) + 1)) AS seq_md5, length(a.seq) + length(b.seq) - overlap AS length FROM top2 JOIN segs a ON a.name = src_seg JOIN segs b ON b.name = dst_seg")
def stitched_sequences(spark, d):
    e = top2(spark, d)
    made = G.stitch(G._finished(G.walks(e, 1)[0], "linear"), _segments(spark, d), e)
    return made.select(F.array_join(F.transform("nodes", lambda n: n["seg"]), " ").alias("path"), F.md5("seq").alias("seq_md5"), F.length("seq").cast("long").alias("length"))


@query(CYCLES + f", {SEGMENTS}, dg AS (SELECT seg, count(*) AS edge_degree FROM (SELECT src_seg AS seg FROM top2 UNION ALL SELECT dst_seg FROM top2) GROUP BY seg), cm AS (SELECT seg, count(*) AS c FROM (SELECT unnest(key) AS seg FROM u) GROUP BY seg) SELECT s.name AS contig, CASE WHEN coalesce(c, 0) > 0 THEN 'yes' ELSE 'no' END AS cycle_possible, CASE WHEN s.name < 'n10' THEN 'yes' ELSE 'no' END AS self_terminal_possible, length(s.seq) AS len, CASE WHEN s.name < 'n10' THEN 150 ELSE 0 END AS self_ovlp, CASE WHEN s.name < 'n10' THEN CAST(90 AS DOUBLE) ELSE 0 END AS self_id, coalesce(edge_degree, 0) AS edge_degree, coalesce(c, 0) AS cycle_count FROM segs s LEFT JOIN dg ON dg.seg = s.name LEFT JOIN cm ON cm.seg = s.name")
def contig_support(spark, d):
    e, segs = top2(spark, d), _segments(spark, d)
    hits = segs.where("name < 'n10'").select(F.col("name").alias("seg"), F.lit("+").alias("orient"), F.lit(90.0).alias("identity"), F.lit(150).alias("overlap"), F.lit(13500.0).alias("score"))
    return G.contig_support(segs, hits, e, G.distinct_cycles(G.walks(e, 6)[1]))


def alignment_sql(before: str, width: int) -> str:
    """A WITH clause over pairs(pid, query, target) of up to `width` letters that ends in aligned(pid, score, span, identity).

    Affine local alignment by anti-diagonals: a step of the recursion takes a row for every query offset i of every pair from one
    diagonal to the next. A state is one number, 1000 * (2 * score) + where it began, so the greater number is the better
    state; of alignments of the best score the first end counts, then the shortest span.
    """
    low = -1_000_000_000
    return (
        f"WITH RECURSIVE {before}, dp(pid, i, d, v, v2, e, f, best, span) AS (SELECT pid, CAST(i AS INTEGER), 1, CAST(i AS INTEGER), CAST(i AS INTEGER), {low}, {low}, 0, 0 FROM pairs, range(0, {width} + 1) r(i) "
        f"UNION ALL SELECT pid, i, d, v, v1, e, f, CASE WHEN v // 1000 > best THEN v // 1000 ELSE best END, CASE WHEN v // 1000 > best THEN i - v % 1000 WHEN v // 1000 = best AND best > 0 THEN least(span, i - v % 1000) ELSE span END "
        f"FROM (SELECT pid, i, d, v1, e, f, best, span, CASE WHEN inside AND greatest(g, e, f) >= 1000 THEN greatest(g, e, f) ELSE i END AS v "
        f"FROM (SELECT x.pid, x.i, x.d + 1 AS d, x.v AS v1, x.best, x.span, x.i >= 1 AND x.d + 1 - x.i BETWEEN 1 AND {width} AS inside, "
        f"CASE WHEN inside THEN greatest(x.v - 4000, x.e - 1000) ELSE {low} END AS e, CASE WHEN inside THEN greatest(y.v - 4000, y.f - 1000) ELSE {low} END AS f, "
        f"y.v2 + CASE WHEN x.i <= length(query) AND substr(query, x.i, 1) = substr(target, x.d + 1 - x.i, 1) THEN 2000 ELSE -2000 END AS g "
        f"FROM dp x JOIN pairs USING (pid) LEFT JOIN dp y ON y.pid = x.pid AND y.i = x.i - 1 WHERE x.d < 2 * {width}))), "
        f"ends AS (SELECT pid, best, span, i FROM dp WHERE d = 2 * {width} QUALIFY row_number() OVER (PARTITION BY pid ORDER BY best DESC, i, span) = 1), "
        f"aligned AS (SELECT pid, best / CAST(2 AS DOUBLE) AS score, CAST(span AS BIGINT) AS span, CASE WHEN span > 0 THEN 100 * (best / CAST(2 AS DOUBLE)) / span ELSE CAST(0 AS DOUBLE) END AS identity FROM ends)"
    )


ENDS = "t AS (SELECT ord, name, length(seq) AS len, substr(seq, 1, {w}) AS head, right(seq, {w}) AS tail FROM dna), flipped AS (SELECT ord, name AS seg, len AS length, '+' AS orient, head, tail FROM t UNION ALL SELECT ord, name, len, '-', reverse(translate(tail, 'ACGT', 'TGCA')), reverse(translate(head, 'ACGT', 'TGCA')) FROM t)"
NEXT_SQL = alignment_sql(f"{B_DNA}, pairs AS (SELECT a.name AS pid, b.name AS other, right(a.seq, 60) AS query, substr(b.seq, 1, 60) AS target FROM dna a JOIN dna b ON b.ord = a.ord + 1)", 60)
SELF_SQL = alignment_sql(f"{B_DNA}, {ENDS.format(w=60)}, pairs AS (SELECT seg || orient AS pid, seg, orient, length, tail AS query, head AS target FROM flipped)", 60)
OVERLAP_SQL = alignment_sql(f"{B_DNA}, {ENDS.format(w=40)}, pairs AS (SELECT a.seg || a.orient || b.seg || b.orient AS pid, a.seg AS src_seg, a.orient AS src_orient, b.seg AS dst_seg, b.orient AS dst_orient, a.length AS src_len, b.length AS dst_len, a.tail AS query, b.head AS target FROM flipped a JOIN flipped b ON a.seg <> b.seg)", 40)
JOINS_SQL = alignment_sql(f"{B_DNA}, {ENDS.format(w=40)}, pairs AS (SELECT a.seg || b.seg || orientation AS pid, a.seg AS seg_a, b.seg AS seg_b, end_a, end_b, orientation, note, a.length + b.length AS bases, CASE end_a WHEN 'tail' THEN a.tail ELSE reverse(translate(a.tail, 'ACGT', 'TGCA')) END AS query, CASE end_b WHEN 'head' THEN b.head ELSE reverse(translate(b.head, 'ACGT', 'TGCA')) END AS target FROM flipped a JOIN flipped b ON a.seg <> b.seg AND a.orient = '+' AND b.orient = '+', (VALUES ('tail', 'head', '+/+', 'direct'), ('tail_rc', 'head', '-/+', 'first reversed'), ('tail', 'head_rc', '+/-', 'second reversed'), ('tail_rc', 'head_rc', '-/-', 'both reversed')) o(end_a, end_b, orientation, note))", 40)


@query(f"{NEXT_SQL} SELECT pid AS name, other, score AS align_score, span AS overlap, identity FROM aligned JOIN pairs USING (pid)")
def local_alignment(spark, d):
    """Every benchmark sequence's last 60 bases against the first 60 of the next."""
    s = dna(spark, d, "benchmark", "item_id").select("ord", "name", "seq")
    nxt = s.select((F.col("ord") - 1).alias("ord"), F.col("name").alias("other"), S.head(F.col("seq"), 60).alias("target"))
    return align(s.join(nxt, "ord").select("name", "other", S.tail(F.col("seq"), 60).alias("query"), "target")).select("name", "other", "align_score", "overlap", "identity")


@query(f"{SELF_SQL}, r AS (SELECT seg, orient, length, round(identity, 2) AS identity, span AS overlap FROM aligned JOIN pairs USING (pid)) SELECT *, identity * overlap AS score, identity >= 75 AND overlap >= 10 AS circular_possible FROM r")
def self_terminals(spark, d):
    return G.circular(G.self_terminals(dna(spark, d, "benchmark", "item_id"), 60), 75.0, 10)


@query(f"{OVERLAP_SQL}, r AS (SELECT src_seg, src_orient, dst_seg, dst_orient, round(identity, 2) AS identity, span AS overlap, src_len, dst_len FROM aligned JOIN pairs USING (pid) WHERE identity >= 50 AND span >= 10) SELECT *, identity * overlap AS score FROM r QUALIFY row_number() OVER (PARTITION BY src_seg, src_orient ORDER BY identity * overlap DESC, identity DESC, overlap DESC, dst_seg, dst_orient) <= 5")
def overlap_edges(spark, d):
    return G.build_edges(dna(spark, d, "benchmark", "item_id"), GraphOptions(window=40, min_identity=50.0, min_overlap=10))


@query(f"{JOINS_SQL} SELECT seg_a, end_a, seg_b, end_b, orientation, round(identity, 2) AS identity_pct, span AS overlap_bp, bases - span AS combined_len_bp, note FROM aligned JOIN pairs USING (pid) WHERE identity >= 50 AND span >= 10")
def candidate_joins(spark, d):
    return G.candidate_joins(dna(spark, d, "benchmark", "item_id"), 40, 50.0, 10)
