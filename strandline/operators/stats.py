"""Read and assembly statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 9


def n50(rows: DataFrame, length: str, by: list[str] | None = None) -> DataFrame:
    """N50 by group: the length at which the running total of lengths, longest first, reaches half. Lengths are summed before they are ranked, so a group's window holds its distinct lengths only."""
    by = by or []
    sums = rows.groupBy(*by, F.col(length).alias("len")).agg(F.sum(length).alias("bases"))
    w = Window.partitionBy(*by).orderBy(F.desc("len"))
    whole = Window.partitionBy(*by)
    return sums.withColumn("run", F.sum("bases").over(w)).withColumn("total", F.sum("bases").over(whole)).where("run * 2 >= total").groupBy(*by).agg(F.max("len").alias("n50"))


def quality_bin(q: Column) -> Column:
    return F.least(F.floor(q / 5), F.lit(BINS - 1)).cast("int")


def quality_histogram(rows: DataFrame, q: str) -> DataFrame:
    """Counts of nine 5-wide bins, the last open; empty bins stay."""
    found = rows.where(F.col(q).isNotNull()).groupBy(quality_bin(F.col(q)).alias("bin")).agg(F.count("*").alias("n"))
    grid = rows.sparkSession.range(BINS).select(F.col("id").cast("int").alias("bin"))
    label = F.when(F.col("bin") < BINS - 1, F.concat(F.lit("Q"), (F.col("bin") * 5).cast("string"), F.lit("-"), (F.col("bin") * 5 + 5).cast("string"))).otherwise(F.lit(f"Q{(BINS - 1) * 5}+"))
    return grid.join(found, "bin", "left").select("bin", label.alias("label"), F.coalesce("n", F.lit(0)).alias("n"))


def read_stats(reads: DataFrame, length: str = "length", mean_q: str = "mean_q") -> DataFrame:
    """One row: count, total_bases, mean_length (whole number), mean_q; zeros without reads."""
    return reads.agg(
        F.count("*").alias("count"),
        F.coalesce(F.sum(length), F.lit(0)).alias("total_bases"),
        F.coalesce(F.floor(F.sum(length) / F.count("*")), F.lit(0)).cast("long").alias("mean_length"),
        F.coalesce(F.round(F.avg(mean_q), 2), F.lit(0.0)).alias("mean_q"),
    )


#: Labels from the highest bound down. A contig is longer than its bound, a coverage reaches it.
STATUS = ((50_000, "chromosome-scale"), (10_000, "large"))
BADGES = ((80, "green"), (30, "yellow"))


def contig_status(length: Column) -> Column:
    return F.when(length > STATUS[0][0], STATUS[0][1]).when(length > STATUS[1][0], STATUS[1][1]).otherwise("fragment")


def coverage_badge(cov: Column) -> Column:
    return F.when(cov >= BADGES[0][0], BADGES[0][1]).when(cov >= BADGES[1][0], BADGES[1][1]).otherwise("red")


def status_of(length: int) -> str:
    return next((label for bound, label in STATUS if length > bound), "fragment")


def badge_of(coverage: float) -> str:
    return next((label for bound, label in BADGES if coverage >= bound), "red")


def coverage_rows(documents: DataFrame) -> DataFrame:
    """chrom, coverage, length, badge from downsampling documents (maps achieved_coverage and ref_lengths): contigs without a length stay, with a null one."""
    cover = documents.select(F.explode("achieved_coverage").alias("chrom", "coverage"))
    lengths = documents.select(F.explode("ref_lengths").alias("chrom", "length")).groupBy("chrom").agg(F.max("length").alias("length"))
    return cover.join(lengths, "chrom", "left").select("chrom", "coverage", "length", coverage_badge(F.col("coverage")).alias("badge"))


def displayed_coverage(documents: DataFrame) -> DataFrame:
    """One row, mean: by length where documents have lengths (null if those of their contigs sum to 0), plain without any."""
    rows = coverage_rows(documents).agg(F.sum(F.col("coverage") * F.coalesce("length", F.lit(0))).alias("s"), F.sum(F.coalesce("length", F.lit(0))).alias("n"), F.avg("coverage").alias("plain"))
    known = documents.agg(F.coalesce(F.sum(F.size(F.coalesce("ref_lengths", F.create_map().cast("map<string,bigint>")))), F.lit(0)).alias("known"))
    return rows.join(F.broadcast(known)).select(F.when(F.col("known") > 0, F.col("s") / F.nullif("n", F.lit(0))).otherwise(F.col("plain")).alias("mean"))


def assembly_stats(contigs: DataFrame) -> DataFrame:
    """One row: n_contigs, total_length, longest, and lengths, longest first (one number a contig)."""
    return contigs.agg(F.reverse(F.sort_array(F.collect_list("length"))).alias("lengths"), F.count("*").alias("n_contigs"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_length"), F.coalesce(F.max("length"), F.lit(0)).alias("longest"))


def weighted_coverage(cov: DataFrame) -> DataFrame:
    """Mean coverage by length (null without length), and the plain mean."""
    return cov.agg((F.sum(F.col("coverage") * F.col("length")) / F.nullif(F.sum("length"), F.lit(0))).alias("weighted"), F.avg("coverage").alias("plain"))


def reduction(raw: Column, final: Column) -> Column:
    """Percent of reads that went, one decimal; 0 without reads."""
    return F.when(raw > 0, F.round((1 - final / raw) * 100, 1)).otherwise(F.lit(0.0))
