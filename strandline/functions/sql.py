"""The library's expressions as functions of a session's SQL, and the aligner as a table function."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .align import align_batch

#: Name and parameters, result and expression: each is inlined where it is called, so plans are those of the columns' own functions.
FUNCTIONS = {
    "revcomp(s STRING)": ("STRING", "reverse(translate(s, 'ACGTacgtNn', 'TGCAtgcaNn'))"),
    "oriented(s STRING, orient STRING)": ("STRING", "CASE WHEN orient = '+' THEN s ELSE reverse(translate(s, 'ACGTacgtNn', 'TGCAtgcaNn')) END"),
    "softclip_length(cigar STRING)": ("BIGINT", "aggregate(regexp_extract_all(coalesce(cigar, ''), '([0-9]+)S', 1), 0L, (s, x) -> s + CAST(x AS BIGINT))"),
    "aligned_query_length(cigar STRING)": ("BIGINT", "aggregate(regexp_extract_all(coalesce(cigar, ''), '([0-9]+)[MI=X]', 1), 0L, (s, x) -> s + CAST(x AS BIGINT))"),
    "mean_phred(qual STRING)": ("DOUBLE", "CASE WHEN length(qual) > 0 THEN aggregate(filter(split(qual, ''), c -> c != ''), 0L, (s, c) -> s + ascii(c) - 33) / length(qual) END"),
    "cycle_key(body ARRAY<STRING>)": ("ARRAY<STRING>", "array_min(concat(transform(sequence(0, size(body) - 1), i -> concat(slice(body, i + 1, size(body)), slice(body, 1, i))), transform(sequence(0, size(body) - 1), i -> concat(slice(reverse(body), i + 1, size(body)), slice(reverse(body), 1, i)))))"),
    "path_text(nodes ARRAY<STRUCT<seg: STRING, orient: STRING>>)": ("STRING", "array_join(transform(nodes, n -> concat(n.seg, n.orient)), ' -> ')"),
    "contig_status(length BIGINT)": ("STRING", "CASE WHEN length > 50000 THEN 'chromosome-scale' WHEN length > 10000 THEN 'large' ELSE 'fragment' END"),
    "coverage_badge(coverage DOUBLE)": ("STRING", "CASE WHEN coverage >= 80 THEN 'green' WHEN coverage >= 30 THEN 'yellow' ELSE 'red' END"),
    "read_identity(n_match BIGINT, aln_len BIGINT)": ("DOUBLE", "CAST(n_match AS DOUBLE) / aln_len"),
}


@F.arrow_udtf(returnType="id long, score double, overlap long, identity double")
class AlignPairs:
    """Rows of TABLE(id, query, target) to their local alignments, many at a time."""

    def eval(self, pairs: pa.RecordBatch) -> Iterator[pa.Table]:
        ids, queries, targets = (pairs.column(k).to_pylist() for k in range(3))
        for at in range(0, len(ids), 128):
            score, span = align_batch([x or "" for x in queries[at : at + 128]], [x or "" for x in targets[at : at + 128]])
            score = score.astype(float)
            share = [max(0.0, 100.0 * s / n) if n else 0.0 for s, n in zip(score.tolist(), span.tolist(), strict=True)]
            yield pa.table([pa.array(ids[at : at + 128], pa.int64()), pa.array(score), pa.array(span), pa.array(share)], names=["id", "score", "overlap", "identity"])


def register(spark: SparkSession) -> list[str]:
    """Make the functions, and align_pairs(TABLE(...)), known to the session's SQL; returns their names."""
    for head, (kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
    spark.udtf.register("align_pairs", AlignPairs)
    return [*(h.split("(")[0] for h in FUNCTIONS), "align_pairs"]
