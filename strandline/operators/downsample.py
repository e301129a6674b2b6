"""Coverage-normalised subsets of reads (name, length, mean_q, ref, st, en)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions import seq as S
from ..storage import keep
from .pools import keep_reads


def _with_length(reads: DataFrame, contigs: DataFrame) -> DataFrame:
    """Unknown contigs count as one base long. Contigs are broadcast, so reads stay where they are."""
    return reads.join(F.broadcast(contigs.select(F.col("name").alias("ref"), F.col("length").alias("contig_len"))), "ref", "left").withColumn("contig_len", F.coalesce("contig_len", F.lit(1)))


def _spans(fraction: float):
    return (F.col("en") - F.col("st")) / F.col("contig_len") >= fraction


def spanning(reads: DataFrame, contigs: DataFrame, fraction: float = 0.80) -> DataFrame:
    """Reads that cover at least that fraction of their contig."""
    return _with_length(reads, contigs).where(_spans(fraction)).drop("contig_len")


def marked_spanning(reads: DataFrame, contigs: DataFrame, fraction: float = 0.80) -> DataFrame:
    """Reads with spans, whether they are among spanning()."""
    return _with_length(reads, contigs).withColumn("spans", F.coalesce(_spans(fraction), F.lit(False))).drop("contig_len")


def binned(reads: DataFrame, contigs: DataFrame, size: int) -> DataFrame:
    """A row a read and bin, with credit, the read's span over its number of bins."""
    rows = _with_length(reads, contigs).withColumn("first", S.first_bin(F.col("st"), size)).withColumn("last", S.last_bin(F.col("en"), F.col("contig_len"), size)).where("first <= last")
    return rows.select(*reads.columns, "first", "last", F.floor((F.col("en") - F.col("st")) / F.greatest(F.col("last") - F.col("first") + 1, F.lit(1))).cast("long").alias("credit"), F.explode(F.sequence("first", "last")).alias("bin"))


def _grade(value, steps: int):
    """A whole number that never falls where value rises, steps of it an octave; of 0 and less, null and NaN one each."""
    x = value.cast("double")
    return F.when(F.isnan(x), F.lit(1 << 30)).when(x > 0, F.floor(F.log2(F.least(x, F.lit(1.7e308))) * steps).cast("int")).when(x.isNull(), F.lit(-(1 << 30))).otherwise(F.lit(-(1 << 29)))


#: Rows that leading() sorts without parting them further.
SORTED = 1_000_000


def _until_full(rows: DataFrame, full: int, order: list[str]) -> tuple[DataFrame, int]:
    """(binned rows up to the value of the columns order, which fall along a bin, in which it holds full bases, an upper bound of their number)."""
    zero = F.lit(0).cast("long")
    sums = rows.groupBy("ref", "bin", *order).agg(F.sum("credit").alias("all"), F.sum(F.least("credit", zero)).alias("less"), F.count("*").alias("n"))
    down = Window.partitionBy("ref", "bin").orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    # A negative span takes bases away, so a value is left out only if the bin is full there whatever such rows take.
    open_ = sums.withColumn("ahead", F.coalesce(F.sum("all").over(down), zero)).withColumn("to", F.coalesce(F.sum("n").over(down), zero) + F.col("n")).where(F.col("ahead") + F.col("less") < full)
    ends = keep(open_.groupBy(F.col("ref").alias("e_ref"), F.col("bin").alias("e_bin")).agg(F.min(F.struct(*order)).alias("end"), F.max("to").alias("to")), "fill-ends")
    near = rows.join(ends.drop("to"), F.col("ref").eqNullSafe(F.col("e_ref")) & (F.col("bin") == F.col("e_bin"))).where(F.struct(*order) >= F.col("end"))
    return near.drop("e_ref", "e_bin", "end"), ends.agg(F.coalesce(F.sum("to"), zero)).first()[0]


def leading(reads: DataFrame, contigs: DataFrame, target: int, size: int) -> DataFrame:
    """Of binned rows, the first of every bin until it holds target * size bases, longest reads first: with before, the bases ahead of a row, and its place.

    Sums by bin and grade of length, which are combined where the reads are, tell the grade in which
    a bin is full; where reads up to that grade are still many, as they are all of one length, sums
    by length and grade of quality do. Only the rows up to there are dealt out and sorted, so what a
    task sorts depends on target and on one grade's rows, not on a bin's depth.
    """
    rows = binned(reads, contigs, size).withColumn("__length", _grade(F.col("length"), 16))
    near, n = _until_full(rows, target * size, ["__length"])
    if n > SORTED:
        near, _ = _until_full(near.withColumn("__q", _grade(F.col("mean_q"), 8)), target * size, ["length", "__q"])
    w = Window.partitionBy("ref", "bin").orderBy(F.desc("length"), F.desc("mean_q"), "st", "name")
    before = F.coalesce(F.sum("credit").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    return near.drop("__length", "__q").withColumn("before", before).withColumn("place", F.row_number().over(w)).where(F.col("before") < target * size)


def fill_bins(reads: DataFrame, contigs: DataFrame, target: int, size: int) -> DataFrame:
    """Names kept when every bin is filled on its own: longest reads first until the bin holds target * size bases. Bins are independent, so contigs are not tasks. The names are written, so that joins know how many there are."""
    return keep(leading(reads, contigs, target, size).select("name").distinct(), "fill")


class _Fill:
    """The sequential rule over reads by bin and place, holding only what later bins can still ask for: the bases of bins not yet left, and the names of taken reads that reach them."""

    def __init__(self, target: int, size: int, once: bool):
        self.full, self.once, self.key = target * size, once, None
        self.most = 0

    def take(self, key: tuple, name, bin_: int, first: int, last: int, credit: int) -> bool:
        """Whether the next read is taken, and for the first time."""
        if key != self.key:
            self.key, self.bin, self.have, self.kept = key, bin_, {}, {}
        if bin_ != self.bin:
            self.bin = bin_
            self.have = {x: n for x, n in self.have.items() if x >= bin_}
            self.kept = {x: end for x, end in self.kept.items() if end >= bin_}
        if self.have.get(bin_, 0) >= self.full or (self.once and name in self.kept):
            return False
        for x in range(max(first, bin_), last + 1):
            self.have[x] = self.have.get(x, 0) + credit
        new = name not in self.kept
        self.kept[name] = max(last, self.kept.get(name, last))
        self.most = max(self.most, len(self.have) + len(self.kept))
        return new


def stretches(rows: DataFrame) -> DataFrame:
    """(ref, first, stretch): stretches of bins that no row of rows(ref, first, last) leaves, numbered by their first bin. A contig's window holds a row a bin at most."""
    ends = rows.groupBy("ref", "first").agg(F.max("last").alias("last"))
    along = Window.partitionBy("ref").orderBy("first")
    reach = F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1))
    begun = ends.withColumn("begin", F.when(reach.isNull() | (reach < F.col("first")), F.col("first")))
    return begun.select("ref", "first", F.max("begin").over(along).alias("stretch"))


def greedy(reads: DataFrame, contigs: DataFrame, target: int = 200, size: int = 500, credit_once: bool = False) -> DataFrame:
    """Names kept by the sequential rule: a taken read credits all its bins, again for each bin that takes it (unless credit_once).

    A read is looked at in a bin only while the reads before it there, all of them credited by
    then, are short of target * size. So the rule runs over those prefixes of the bins alone,
    which depend on target and not on depth, in order along each stretch of bins that no such read
    leaves. What is held is that of the bins which reads at the current one reach, so it doesn't grow
    with a contig's length.
    fill_bins is the variant in which bins are independent.
    """
    near = keep(leading(reads, contigs, target, size).select("ref", "name", "first", "last", "credit", "bin", "place"), "fill-prefixes")
    cols = ["ref", "stretch", "bin", "place", "name", "first", "last", "credit"]
    rows = near.join(stretches(near), ["ref", "first"]).select(*cols).repartition("ref", "stretch").sortWithinPartitions("ref", "stretch", "bin", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fill = _Fill(target, size, credit_once)
        for b in batches:
            ref, stretch, bin_, _, name, first, last, credit = (b.column(k).to_pylist() for k in range(len(cols)))
            taken = [fill.take(key, *read) for key, *read in zip(zip(ref, stretch, strict=True), name, bin_, first, last, credit, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(4).filter(pa.array(taken, pa.bool_()))], names=["name"])

    return keep(rows.mapInArrow(run, StructType([StructField("name", reads.schema["name"].dataType)])).distinct(), "greedy")


def achieved(reads: DataFrame, names: DataFrame, contigs: DataFrame) -> DataFrame:
    """Aligned bases of kept reads over contig length, by contig; 0 where nothing was kept. names are counted first: write them if they are work."""
    sums = keep_reads(reads.select("name", "ref", "st", "en"), names).groupBy("ref").agg(F.sum(F.col("en") - F.col("st")).alias("bases"))
    return contigs.select(F.col("name").alias("ref"), "length").join(sums, "ref", "left").select("ref", (F.coalesce("bases", F.lit(0)) / F.col("length")).alias("coverage"))


def downsample(reads: DataFrame, contigs: DataFrame, target: int = 200, size: int = 500, fraction: float = 0.80, skip: bool = False) -> DataFrame:
    """Names of the greedy set and all spanning reads; all reads with skip."""
    if skip:
        return reads.select("name").distinct()
    return greedy(reads, contigs, target, size).union(spanning(reads, contigs, fraction).select("name")).distinct()
