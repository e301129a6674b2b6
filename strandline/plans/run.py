"""Runs from files to files: pools, downsampling and scrubbing of all chromosomes in one job each, with their statistics and the run's record."""

from __future__ import annotations

import json
from dataclasses import asdict, fields
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import seq as S
from ..operators import coverage as C
from ..operators import downsample as D
from ..operators import graph as G
from ..operators import pools as P
from ..operators import stats as T
from ..sources import bam
from ..sources import readers as R
from ..sources import writers as W
from ..storage import keep
from . import report
from .options import DownsampleOptions, GraphOptions, JoinOptions, PoolOptions, RunOptions, ScrubOptions

#: Options whose values are shares of one, and those that are percent.
SHARES = ("id_a", "id_b", "spanning_fraction", "min_mapped_fraction", "max_softclip_fraction", "coverage_ratio", "size_tolerance")
PERCENTS = ("min_identity",)


def validate(*options: PoolOptions | DownsampleOptions | ScrubOptions | GraphOptions | JoinOptions | RunOptions) -> None:
    """Raise ValueError, naming every option that can't be right."""
    wrong = []
    for o in options:
        for f in fields(o):
            v, name = getattr(o, f.name), f"{type(o).__name__}.{f.name}"
            if isinstance(v, bool) or not isinstance(v, int | float):
                continue
            if f.name in SHARES and not 0 <= v <= 1:
                wrong.append(f"{name} = {v} is not between 0 and 1")
            elif f.name in PERCENTS and not 0 <= v <= 100:
                wrong.append(f"{name} = {v} is not between 0 and 100")
            elif v < (1 if f.name in ("window", "step", "bin_size", "target_coverage", "max_depth", "expected_size") else 0):
                wrong.append(f"{name} = {v} is too small")
    if wrong:
        raise ValueError("; ".join(wrong))


def extract_reads(reads: DataFrame, names: DataFrame, path: str) -> int:
    """Write the reads named in names, in input order and in their own format (FASTQ if they have qualities, else FASTA); returns how many."""
    kept = keep(P.keep_reads(reads, names), "kept-reads")
    if kept.where("qual IS NOT NULL").isEmpty():
        W.write_fasta(kept.orderBy("ord"), path)
    else:
        W.write_fastq(kept.orderBy("ord"), path)
    return kept.count()


def is_binary(path: str) -> bool:
    return R.blocked(path)


def read_alignment_file(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(alignments, contigs) of SAM text or a binary file."""
    if is_binary(path):
        return bam.read_bam(spark, path), bam.read_bam_contigs(spark, path)
    return R.read_sam(spark, path), R.read_sam_contigs(spark, path)


def keep_alignments(spark: SparkSession, path: str, names: DataFrame, out: str) -> None:
    """The header and the alignments of names(name), every one of them with all its fields.

    Of SAM text: text parts that make up one file in order, the header first, then the alignments as
    they came. Of a binary file: a sorted binary folder with its index.
    """
    wanted = names.select("name").distinct()
    if is_binary(path):
        text, refs, _ = bam.read_header(path)
        rows = bam.read_bam(spark, path, columns=("qname", "record"))
        bam.write_bam(rows.join(wanted, F.col("qname") == F.col("name"), "left_semi").select("record"), out, text, refs)
        return
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    head = lines.where("value LIKE '@%'")
    body = lines.where("value NOT LIKE '@%'").withColumn("name", F.split("value", "\t")[0]).join(wanted, "name", "left_semi")
    rows = head.select(F.lit(0).alias("kind"), "file", "block", "id", "value").unionByName(body.select(F.lit(1).alias("kind"), "file", "block", "id", "value"))
    rows.orderBy("kind", "file", "block", "id").select("value").write.mode("overwrite").text(out)


def restricted(reads: DataFrame, chroms: list[str] | None) -> DataFrame:
    """Reads on the given chromosomes, all without any given."""
    return reads if not chroms else reads.where(F.col("ref").isin(*chroms))


def downsample_stats(reads: DataFrame, contigs: DataFrame, options: DownsampleOptions = DownsampleOptions(), names: DataFrame | None = None) -> DataFrame:
    """One row a contig: chrom, input_alignments, spanning_reads, selected_reads, output_reads, target_coverage, achieved_coverage and ref_lengths (maps of one entry).

    names are the kept reads, worked out by the rules when they aren't given.
    """
    kept = D.downsample(reads, contigs, options.target_coverage, options.bin_size, options.spanning_fraction, options.skip) if names is None else names
    kept = keep(kept.select("name").distinct().withColumn("taken", F.lit(True)), "kept-names")
    seen = P.with_names(D.marked_spanning(reads, contigs, options.spanning_fraction), kept, "left").withColumn("taken", F.coalesce("taken", F.lit(False)))
    # Only reads that span or were taken are counted by name; the rest is combined where it is.
    by_name = seen.groupBy("ref", F.when(F.col("spans") | F.col("taken"), F.col("name")).alias("name")).agg(F.count("*").alias("n"), F.max("spans").alias("spans"), F.max("taken").alias("taken"), F.sum(F.when(F.col("taken"), F.col("en") - F.col("st"))).alias("bases"))
    named = F.col("name").isNotNull()
    counts = by_name.groupBy("ref").agg(F.sum("n").alias("input_alignments"), F.count_if(named & F.col("spans")).alias("spanning_reads"), F.count_if(named & F.col("taken")).alias("selected_reads"), F.sum("bases").alias("bases"))
    out = contigs.select(F.col("name").alias("chrom"), F.col("length").cast("long").alias("length")).join(counts.withColumnRenamed("ref", "chrom"), "chrom", "left").na.fill(0)
    return out.select("chrom", "input_alignments", "spanning_reads", "selected_reads", F.col("selected_reads").alias("output_reads"), F.lit(options.target_coverage).alias("target_coverage"), F.create_map("chrom", F.col("bases") / F.col("length")).alias("achieved_coverage"), F.create_map("chrom", "length").alias("ref_lengths"))


def scrub_stats(judged: DataFrame, baselines: DataFrame) -> DataFrame:
    """One row: the outcome counts, output_reads (clean names) and the map of baselines by contig (one entry a contig)."""
    of = baselines.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("ref", F.round("baseline", 2))))).alias("per_contig_baselines"))
    return C.read_verdicts(judged).withColumn("output_reads", F.col("clean_reads")).join(F.broadcast(of))


def run_totals(stats: DataFrame) -> DataFrame:
    """Sums over all chromosomes, one row."""
    return stats.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("input_alignments", "spanning_reads", "selected_reads", "output_reads")])


def first_nonempty(choices: list[DataFrame], otherwise: DataFrame) -> DataFrame:
    """The first of choices that has a row, in their order; otherwise if none has."""
    return next((c for c in choices if not c.isEmpty()), otherwise)


def removed(raw: int, left: int) -> int:
    return max(0, raw - left)


class Record:
    """A run's parameters, written when it starts and again, with times and artefacts, when it ends."""

    def __init__(self, spark: SparkSession, path: str, **options):
        self.spark, self.path, self.began = spark, path, datetime.now(UTC)
        self.what = {k: asdict(v) if hasattr(v, "__dataclass_fields__") else v for k, v in options.items()} | {"started": self.began.isoformat()}
        self._write()

    def _write(self) -> None:
        self.spark.createDataFrame([(json.dumps(self.what, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(self.path)

    def end(self, **artefacts) -> None:
        now = datetime.now(UTC)
        self.what |= {"finished": now.isoformat(), "elapsed_seconds": round((now - self.began).total_seconds(), 3)} | artefacts
        self._write()


def pool_run(spark: SparkSession, paf: str, reads: R.Paths, reference: R.Paths, out: str, options: PoolOptions = PoolOptions()) -> DataFrame:
    """PAF, reads and reference to one FASTQ folder a chromosome under out/reads; returns and writes the counts of all chromosomes."""
    validate(options)
    contigs = R.read_fasta(spark, reference).select("name", "length")
    aln = P.known_targets(R.read_paf(spark, paf), contigs)
    pools = P.pools(P.dual_threshold(aln, options))
    W.write_fastq(P.pool_reads(pools, R.read_reads(spark, reads)), f"{out}/reads", by="chrom")
    stats = P.pool_stats(aln, contigs, options)
    W.write_json(stats, f"{out}/pool_stats")
    return stats


def downsample_run(spark: SparkSession, sam: str, reads: R.Paths, out: str, options: DownsampleOptions = DownsampleOptions(), chroms: list[str] | None = None, keep_sam: bool = False) -> DataFrame:
    """Alignments and reads to a normalised set of reads, all chromosomes in one job; returns and writes their statistics."""
    validate(options)
    aln, contigs = read_alignment_file(spark, sam)
    placed = restricted(R.read_alignments(aln, options.min_mapq), chroms)
    names = keep(D.downsample(placed, contigs, options.target_coverage, options.bin_size, options.spanning_fraction, options.skip), "downsampled")
    extract_reads(R.read_reads(spark, reads), names, f"{out}/reads")
    stats = downsample_stats(placed, contigs, options, names)
    W.write_json(stats, f"{out}/downsample_stats")
    if keep_sam:
        keep_alignments(spark, sam, names, f"{out}/alignments")
    return stats


def scrub_run(spark: SparkSession, sam: str, reads: R.Paths, out: str, options: ScrubOptions = ScrubOptions(), keep_sam: bool = False) -> DataFrame:
    """Alignments and reads to the reads whose alignments pass; returns and writes the outcome counts."""
    validate(options)
    aln, contigs = read_alignment_file(spark, sam)
    judged, base = C.classified(aln, contigs, options)
    judged = keep(judged, "judged")
    clean = judged.where("outcome = 'clean'").select(F.col("qname").alias("name")).distinct()
    extract_reads(R.read_reads(spark, reads), clean, f"{out}/reads")
    stats = scrub_stats(judged, base)
    W.write_json(stats, f"{out}/scrub_stats")
    if keep_sam:
        keep_alignments(spark, sam, clean, f"{out}/alignments")
    return stats


def graph_run(spark: SparkSession, gfa: R.Paths, out: str, options: GraphOptions = GraphOptions()) -> dict[str, DataFrame]:
    """Segments to terminal overlaps, self hits, paths, cycles of any size, contig support, the sequences of the chosen paths and a text report, all under out.

    Returns the tables: edges, hits, cycles, linear, any, support, fasta. Only the excerpts of the report reach the driver.
    """
    validate(options)
    segments = keep(R.read_gfa(spark, gfa), "segments")
    edges = keep(G.build_edges(segments, options), "graph-edges")
    hits = keep(G.circular(G.self_terminals(segments, options.window), options.min_identity, options.min_overlap), "self-hits")
    cycles, linear = (keep(x, "paths") for x in G.sized_paths(edges, options))
    any_size = keep(G.any_cycles(edges, options), "any-cycles")
    support = keep(G.contig_support(segments, hits, edges, any_size, options), "support")
    chosen = keep(G.fasta_choice(any_size, cycles, linear, options.fasta_top, options.expected_size).withColumn("rank", F.monotonically_increasing_id()), "chosen")
    made = G.stitch(chosen.select(F.concat_ws(":", F.col("rank").cast("string"), "kind").alias("kind"), "nodes"), segments, edges).select(F.split("kind", ":")[0].cast("long").alias("rank"), "seq")
    named = chosen.join(made, "rank").select("rank", S.merged_name(F.col("nodes"), F.col("kind"), F.col("total_len"), F.col("mean_identity")).alias("name"), "seq")
    W.write_edges(edges, f"{out}/edges")
    W.write_self_hits(hits, f"{out}/self_hits")
    W.write_paths(cycles.unionByName(linear), f"{out}/paths")
    W.write_paths(any_size, f"{out}/cycles_any")
    support.orderBy("contig").write.mode("overwrite").csv(f"{out}/support", sep="\t", header=True)
    W.write_fasta(named.orderBy("rank"), f"{out}/fasta")
    text = report.graph_text(edges, hits, any_size, support)
    spark.createDataFrame([(text.rstrip("\n"),)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/report")
    return {"edges": edges, "hits": hits, "cycles": cycles, "linear": linear, "any": any_size, "support": support, "fasta": named}


def joins_run(spark: SparkSession, contigs: R.Paths, out: str, options: JoinOptions = JoinOptions()) -> dict[str, DataFrame]:
    """Contigs (FASTA) or segments (GFA, by its name's end) to candidate joins, circular paths and a text report under out; returns joins and rings."""
    validate(options)
    first = contigs if isinstance(contigs, str) else contigs[0]
    segments = keep((R.read_gfa if first.endswith(".gfa") else R.read_fasta)(spark, contigs), "segments")
    joins = keep(G.candidate_joins(segments, options.window, options.min_identity, options.min_overlap, options.compat), "joins")
    rings = keep(G.circular_joins(joins, segments, options.expected_size, options.size_tolerance), "rings")
    W.write_joins(joins, f"{out}/joins")
    rings.select(F.array_join("path", " -> ").alias("path"), "total", "size").orderBy(F.desc("total"), "path").write.mode("overwrite").csv(f"{out}/rings", sep="\t", header=True)
    text = report.joins_text(joins, rings)
    spark.createDataFrame([(text.rstrip("\n"),)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/report")
    return {"joins": joins, "rings": rings}


def report_run(spark: SparkSession, raw: R.Paths, scrubbed: R.Paths, final: R.Paths, scrub_json: str, downsample_json: R.Paths, contigs: R.Paths, out: str, title: str = "Run") -> str:
    """The HTML page of a run from its files; written under out and returned."""
    scrub = R.read_scrub_json(spark, scrub_json).first().asDict()
    outcomes = {k: v for k, v in scrub.items() if isinstance(v, int) and k != "total_alignments"}
    sizes = [(r.name, r.length) for r in R.read_fasta(spark, contigs).select("name", "length").collect()]
    page = report.run_report(title, *(read_figures(R.read_reads(spark, x)) for x in (raw, scrubbed, final)), outcomes, R.read_stats_json(spark, downsample_json), sizes)
    spark.createDataFrame([(page,)], "value string").coalesce(1).write.mode("overwrite").text(out)
    return page


def read_figures(reads: DataFrame) -> dict:
    """Count, bases, mean length, N50, mean quality and the nine-bin histogram of reads(seq, qual), for a report."""
    rows = reads.select(F.length("seq").cast("long").alias("length"), S.mean_phred(F.col("qual")).alias("mean_q"))
    one = T.read_stats(rows).first().asDict()
    n50 = T.n50(rows, "length").first()
    bars = T.quality_histogram(rows, "mean_q").orderBy("bin").collect()
    return one | {"n50": (n50 and n50.n50) or 0, "q_bins": [r.label for r in bars], "q_histogram": [r.n for r in bars]}
