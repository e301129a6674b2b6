"""Column expressions on sequences, CIGAR strings and qualities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def revcomp(seq: Column) -> Column:
    """Reverse complement; letters other than ACGTN in either case stay as they are."""
    return F.reverse(F.translate(seq, "ACGTacgtNn", "TGCAtgcaNn"))


def oriented(seq: Column, orient: Column) -> Column:
    return F.when(orient == "+", seq).otherwise(revcomp(seq))


def head(seq: Column, window: int) -> Column:
    if window < 1:
        raise ValueError("window must be at least 1")
    return F.left(seq, F.lit(window))


def tail(seq: Column, window: int) -> Column:
    if window < 1:
        raise ValueError("window must be at least 1")
    return F.right(seq, F.lit(window))


def cigar_length(cigar: Column, ops: str) -> Column:
    """Total length of the given operations in a CIGAR string."""
    found = F.regexp_extract_all(F.coalesce(cigar, F.lit("")), F.lit(f"(\\d+)[{ops}]"), F.lit(1))
    return F.aggregate(found, F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))


def softclip_length(cigar: Column) -> Column:
    return cigar_length(cigar, "S")


def aligned_query_length(cigar: Column) -> Column:
    return cigar_length(cigar, "MI=X")


def read_length(cigar: Column, seq: Column) -> Column:
    """Inferred from the CIGAR, else the stored sequence's length, else 1."""
    return F.coalesce(F.nullif(cigar_length(cigar, "MIS=XH"), F.lit(0)), F.nullif(F.length(seq).cast("long"), F.lit(0)), F.lit(1).cast("long"))


def mean_phred(qual: Column) -> Column:
    """Mean of code minus 33 over a quality string; null without one."""
    codes = F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)
    return F.when(F.length(qual) > 0, F.aggregate(codes, F.lit(0).cast("long"), lambda s, x: s + x) / F.length(qual))


def first_bin(start: Column, size: int) -> Column:
    return F.floor(start / size).cast("long")


def last_bin(end: Column, contig_length: Column, size: int) -> Column:
    """Bin of the last base, within the contig's bins."""
    bins = F.greatest(F.lit(1), F.floor((contig_length + size - 1) / size))
    return F.least(F.floor((end - 1) / size), bins - 1).cast("long")


def path_text(nodes: Column) -> Column:
    """'a+ -> b-' of array<struct<seg, orient>>."""
    return F.array_join(F.transform(nodes, lambda n: F.concat(n["seg"], n["orient"])), " -> ")


def merged_name(nodes: Column, kind: Column, total: Column, mean_identity: Column) -> Column:
    """Segments in walk order, once each, with kind, length and mean identity."""
    segs = F.array_join(F.array_distinct(F.transform(nodes, lambda n: n["seg"])), "__")
    return F.concat_ws("|", segs, kind, total.cast("string"), F.format_string("%.2f", mean_identity))


def cycle_key(body: Column) -> Column:
    """Least rotation of a cycle's nodes or of their reversal."""
    n = F.size(body)

    def turns(x: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(F.slice(x, i + 1, n), F.slice(x, F.lit(1), i)))

    return F.array_min(F.concat(turns(body), turns(F.reverse(body))))


def wrap(seq: Column, width: int = 80) -> Column:
    """Lines of width characters."""
    return F.regexp_replace(seq, f"(.{{{width}}})(?=.)", "$1\n")
