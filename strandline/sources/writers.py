"""Reads, sequences, tables and statistics written out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.seq import path_text, wrap


def write_fastq(reads: DataFrame, path: str, by: str | None = None, sort: str = "ord") -> None:
    """Four-line records, one folder for each value of by; in the order of sort within a file."""
    rec = F.concat_ws("\n", F.concat(F.lit("@"), F.col("read" if "read" in reads.columns else "name")), "seq", F.lit("+"), F.coalesce("qual", F.lit(""))).alias("value")
    if by:
        reads.repartition(by).sortWithinPartitions(by, sort).select(by, rec).write.mode("overwrite").partitionBy(by).text(path)
    else:
        reads.sortWithinPartitions(sort).select(rec).write.mode("overwrite").text(path)


def write_fasta(rows: DataFrame, path: str, name: str = "name", seq: str = "seq", width: int = 80) -> None:
    rows.select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), wrap(F.col(seq), width)).alias("value")).write.mode("overwrite").text(path)


def _two(c: str):
    return F.format_string("%.2f", F.col(c).cast("double")).alias(c)


def write_edges(edges: DataFrame, path: str) -> None:
    rows = edges.orderBy(F.desc("score")).select("src_seg", "src_orient", "dst_seg", "dst_orient", _two("identity").alias("identity_pct"), F.col("overlap").alias("overlap_bp"), _two("score"))
    rows.write.mode("overwrite").csv(path, sep="\t", header=True)


def write_paths(paths: DataFrame, path: str) -> None:
    rows = paths.select("kind", "total_len", _two("mean_identity"), _two("min_identity"), "total_overlap", _two("score"), path_text(F.col("nodes")).alias("nodes"))
    rows.write.mode("overwrite").csv(path, sep="\t", header=True)


def write_self_hits(hits: DataFrame, path: str) -> None:
    rows = hits.orderBy(F.desc("score"), F.desc("identity"), F.desc("overlap")).select("seg", "orient", "length", _two("identity").alias("identity_pct"), F.col("overlap").alias("overlap_bp"), _two("score"), F.when(F.col("circular_possible"), "yes").otherwise("no").alias("circular_possible"))
    rows.write.mode("overwrite").csv(path, sep="\t", header=True)


def write_joins(joins: DataFrame, path: str) -> None:
    joins.orderBy(F.desc("identity_pct")).write.mode("overwrite").csv(path, sep="\t", header=True)


def write_json(row: DataFrame, path: str) -> None:
    """One-row statistics as JSON."""
    row.write.mode("overwrite").json(path)
