"""Read pools by chromosome from alignments (qname, tname, n_match, aln_len)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.options import PoolOptions


def identity():
    return F.col("n_match").cast("double") / F.col("aln_len")


def dual_threshold(aln: DataFrame, options: PoolOptions = PoolOptions()) -> DataFrame:
    """Alignments that are long at a lower identity or shorter at a higher one; bounds are inclusive.

    The smaller length bound is stated on its own, so that it reaches the Parquet scan.
    """
    o = options
    long_ = (F.col("aln_len") >= o.len_a) & (identity() >= o.id_a)
    short = (F.col("aln_len") >= o.len_b) & (identity() >= o.id_b)
    return aln.where((F.col("aln_len") > 0) & (F.col("aln_len") >= min(o.len_a, o.len_b))).where(long_ | short)


def known_targets(aln: DataFrame, contigs: DataFrame) -> DataFrame:
    return aln.join(contigs.select(F.col("name").alias("tname")).distinct(), "tname", "left_semi")


def pools(aln: DataFrame) -> DataFrame:
    """Distinct (chrom, read)."""
    return aln.select(F.col("tname").alias("chrom"), F.col("qname").alias("read")).distinct()


def pool_stats(aln: DataFrame, contigs: DataFrame, options: PoolOptions = PoolOptions()) -> DataFrame:
    """chrom, n_seen, n_passed, n_reads; contigs without alignments keep a row of zeros."""
    seen = aln.groupBy(F.col("tname").alias("chrom")).agg(F.count("*").alias("n_seen"))
    passed = dual_threshold(aln, options).groupBy(F.col("tname").alias("chrom")).agg(F.count("*").alias("n_passed"), F.count_distinct("qname").alias("n_reads"))
    names = contigs.select(F.col("name").alias("chrom")).distinct()
    return names.join(seen, "chrom", "left").join(passed, "chrom", "left").na.fill(0, ["n_seen", "n_passed", "n_reads"])


def pool_union(pool_rows: DataFrame) -> DataFrame:
    return pool_rows.select("read").distinct()


def best_hit(aln: DataFrame) -> DataFrame:
    """One target a read: most matches, then longest, then first name."""
    w = Window.partitionBy("qname").orderBy(F.desc("n_match"), F.desc("aln_len"), "tname")
    return aln.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


#: Presets that fit the bits of one mask.
MASK_BITS = 62


def preset_grid(aln: DataFrame, presets: DataFrame) -> DataFrame:
    """Passed alignments and reads for every preset and chromosome; presets are a dozen rows, which become the bits of a mask (in turns of 62), and their least length goes to the scan.

    An alignment is a row once, whatever the number of presets: alignments are counted by
    chromosome and mask, reads by chromosome and the union of their masks, and only these few counts
    meet the presets again.
    """
    spark = aln.sparkSession
    held = sorted(presets.select("preset", "len_a", "id_a", "len_b", "id_b").collect(), key=repr)
    names = list(dict.fromkeys(r[0] for r in held))
    kind = presets.schema["preset"].dataType.simpleString()
    lengths = sorted({n for r in held for n in (r[1], r[3]) if n is not None})
    identities = sorted({n for r in held for n in (r[2], r[4]) if n is not None})
    least = aln.where((F.col("aln_len") > 0) & (F.col("aln_len") >= min(lengths, default=0))).select(F.col("tname").alias("chrom"), "qname", "aln_len", identity().alias("__id"))

    def reached(value, bounds):
        """How many of the rising bounds a value reaches."""
        return F.coalesce(*[F.when(value >= F.lit(x), F.lit(k)) for k, x in sorted(enumerate(bounds, 1), reverse=True)], F.lit(0))

    def meets(length: int, identity_: int, row) -> bool:
        """Whether a preset passes what reaches so many of the bounds."""
        return any(n is not None and i is not None and length > lengths.index(n) and identity_ > identities.index(i) for n, i in ((row[1], row[2]), (row[3], row[4])))

    turns = [held[k : k + MASK_BITS] for k in range(0, max(1, len(held)), MASK_BITS)]
    masks = [f"__m{k}" for k in range(len(turns))]
    # What an alignment passes depends on the bounds that it reaches only, so its mask is looked up.
    at = F.col("__l") * (len(identities) + 1) + F.col("__i") + 1
    tables = [F.array(*[F.lit(sum(1 << k for k, r in enumerate(part) if meets(n, i, r))).cast("long") for n in range(len(lengths) + 1) for i in range(len(identities) + 1)]) for part in turns]
    placed = least.select("chrom", "qname", reached(F.col("aln_len"), lengths).alias("__l"), reached(F.col("__id"), identities).alias("__i"))
    marked = placed.select("chrom", "qname", *[F.element_at(x, at).alias(c) for c, x in zip(masks, tables, strict=True)])
    n = lambda rows, of: rows.groupBy("chrom", *masks).agg(F.count("*").alias(of))
    none = F.lit(0).cast("long")
    alignments = n(marked, "n_passed").withColumn("n_reads", none)
    # Alignments that pass nothing have no read to count, and are combined where they are.
    read = F.when(reduce(lambda x, y: x | y, [F.col(c) != 0 for c in masks]), F.col("qname")).alias("qname")
    by_read = marked.groupBy("chrom", read).agg(*[F.bit_or(c).alias(c) for c in masks])
    reads = n(by_read.where("qname IS NOT NULL"), "n_reads").withColumn("n_passed", none)
    # By preset, a mask for each turn of the bits that stand for it.
    table = spark.createDataFrame([(p, *(sum(1 << i for i, r in enumerate(part) if r[0] == p) for part in turns)) for p in names], f"preset {kind}, " + ", ".join(f"p{c} long" for c in masks))
    both = alignments.unionByName(reads).join(F.broadcast(table))
    hits = reduce(lambda x, y: x + y, [F.bit_count(F.col(c).bitwiseAND(F.col(f"p{c}"))) for c in masks])
    counted = both.withColumn("__hits", hits).where("__hits > 0").groupBy("preset", "chrom").agg(F.sum(F.col("n_passed") * F.col("__hits")).alias("n_passed"), F.sum("n_reads").alias("n_reads"))
    return counted


def pool_reads(pool_rows: DataFrame, reads: DataFrame) -> DataFrame:
    """Pool members with their sequence and quality; of reads of one name the last in input order (ord) counts."""
    last = reads.groupBy("name").agg(F.max_by(F.struct("ord", "seq", "qual"), "ord").alias("r"))
    return pool_rows.join(last, F.col("read") == F.col("name")).select("chrom", "read", "r.ord", F.coalesce("r.seq", F.lit("")).alias("seq"), F.coalesce("r.qual", F.lit("")).alias("qual"))


#: Names up to this many are broadcast; beyond, reads are dealt by name to a task for so many of them.
NAMES = 1_000_000


def with_names(reads: DataFrame, names: DataFrame, how: str) -> DataFrame:
    """The join of reads with names(name and more), counted first: reads stay where they are for few names; else a task sorts a bounded number of reads, however many there are."""
    if names.count() <= NAMES:
        return reads.join(F.broadcast(names), "name", how)
    n = max(int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-reads.count() // NAMES))
    return reads.repartition(n, "name").join(names.repartition(n, "name"), "name", how)


def keep_reads(reads: DataFrame, names: DataFrame) -> DataFrame:
    """Reads named in names(name), duplicates and all. names are counted first: write them if they are work."""
    return with_names(reads.where("name IS NOT NULL"), names.select("name"), "left_semi")
