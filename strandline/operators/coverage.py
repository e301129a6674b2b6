"""Depth, window coverage and the outcome of alignments (ref, st, en and more)."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.options import ScrubOptions
from ..storage import keep

#: Positions of one block: running sums are taken within blocks and over block totals, so that a contig is not one task.
BLOCK = 1 << 14


def _running(rows: DataFrame, sums: list[str]) -> DataFrame:
    """Running sums of columns over (ref, pos), ties included at once."""
    blocked = rows.withColumn("block", F.floor(F.col("pos") / BLOCK))
    totals = blocked.groupBy("ref", "block").agg(*[F.sum(c).alias(f"t_{c}") for c in sums])
    before = Window.partitionBy("ref").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("ref", "block", *[F.coalesce(F.sum(f"t_{c}").over(before), F.lit(0)).alias(f"b_{c}") for c in sums])
    inside = Window.partitionBy("ref", "block").orderBy("pos").rangeBetween(Window.unboundedPreceding, 0)
    joined = blocked.join(bases, ["ref", "block"])
    return joined.select(*[c for c in rows.columns], *[(F.sum(c).over(inside) + F.col(f"b_{c}")).alias(f"run_{c}") for c in sums])


def covered(start: int, cigar: str, seq: str) -> list[tuple[int, int]]:
    """The reference bases that an alignment covers as (first, first behind): its matches, without deletions, skips and bases other than A, C, G and T. Without a sequence all matches count."""
    out: list[tuple[int, int]] = []
    ref, at = start, 0
    for size, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar or ""):
        n = int(size)
        if op in "M=X":
            for a, b in [m.span() for m in re.finditer("[ACGT]+", seq[at : at + n].upper())] if seq else [(0, n)]:
                if out and out[-1][1] == ref + a:
                    out[-1] = (out[-1][0], ref + b)
                else:
                    out.append((ref + a, ref + b))
        ref += n * (op in "M=XDN")
        at += n * (op in "M=XIS")
    return out


_DIGIT, _MATCH, _ON_REF, _ON_READ = (np.isin(np.arange(256), np.frombuffer(x, np.uint8)) for x in (b"0123456789", b"M=X", b"M=XDN", b"M=XIS"))
_OP = np.isin(np.arange(256), np.frombuffer(b"MIDNSHP=X", np.uint8))


def _covered_many(start: np.ndarray, cigar: pa.Array, seq: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """covered() of many alignments at once: (row, st, en) of all blocks in order. CIGARs of another form than (digits letter)*, and sequences with other bases or too short for their CIGAR, go through covered()."""
    texts = pc.fill_null(cigar, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    text = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    row_of = np.repeat(np.arange(len(texts)), np.diff(offsets))
    digit, op = _DIGIT[text], _OP[text]
    first = np.zeros(len(text), bool)
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    after_digit = np.append(False, digit[:-1]) & ~first
    bad = ~(digit | op) | (op & ~after_digit)
    last = offsets[1:][np.diff(offsets) > 0] - 1
    bad[last] |= digit[last]
    at = np.flatnonzero(op)
    begun = np.flatnonzero(digit & ~after_digit)
    odd = np.zeros(len(texts), bool)
    odd[row_of[bad]] = True
    # Operations of rows in form, each with the digits before it; more than 15 digits don't fit.
    at, begun = at[~odd[row_of[at]]], begun[~odd[row_of[begun]]]
    width = at - begun
    odd[row_of[at[width > 15]]] = True
    good = ~odd[row_of[at]]
    at, width = at[good], width[good]
    size = np.zeros(len(at), np.int64)
    for k in range(int(width.max(initial=0)), 0, -1):
        has = width >= k
        size[has] = size[has] * 10 + (text[at[has] - k] - 48)
    row, letter = row_of[at], text[at]

    def before(moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sum of moves ahead of each operation in its row, and of all by row."""
        run = np.append(0, np.cumsum(moves))
        borders = np.searchsorted(row, np.arange(len(texts) + 1))
        return run[:-1] - run[borders[:-1]][row], run[borders[1:]] - run[borders[:-1]]

    ref, _ = before(np.where(_ON_REF[letter], size, 0))
    length = pc.fill_null(pc.utf8_length(seq), 0).to_numpy(zero_copy_only=False)
    has_seq = length > 0
    if has_seq.any():
        _, asked = before(np.where(_ON_READ[letter], size, 0))
        odd |= has_seq & ((length < asked) | ~pc.fill_null(pc.match_substring_regex(seq, "^[ACGTacgt]*$"), True).to_numpy(zero_copy_only=False))
    # A match of no bases is a block only where there is no sequence to look at.
    use = _MATCH[letter] & ~odd[row] & ((size > 0) | ~has_seq[row])
    row, st = row[use], start[row[use]] + ref[use]
    en = st + size[use]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (st[1:] != en[:-1])
    heads = np.flatnonzero(new)
    row, st, en = row[heads], st[heads], en[np.append(heads[1:], len(en)) - 1] if len(heads) else en
    if odd.any():
        slow = [(k, *block) for k in np.flatnonzero(odd).tolist() for block in covered(int(start[k]), cigar[k].as_py(), seq[k].as_py() or "")]
        more = np.array(slow, np.int64).reshape(-1, 3)
        row, st, en = (np.concatenate([x, y]) for x, y in zip((row, st, en), more.T, strict=True))
        order = np.argsort(row, kind="stable")
        row, st, en = row[order], st[order], en[order]
    return row, st, en


def aligned_blocks(aln: DataFrame) -> DataFrame:
    """Alignments (tname, ref_start, cigar, seq) as the blocks they cover: ref, st, en, and the other columns but cigar and seq. Alignments that cover nothing have no row. CIGARs are parsed an Arrow batch at a time."""

    @F.arrow_udf("array<struct<st:long,en:long>>")
    def blocks(start: pa.Array, cigar: pa.Array, seq: pa.Array) -> pa.Array:
        row, st, en = _covered_many(start.to_numpy(zero_copy_only=False).astype(np.int64), cigar, seq)
        ends = np.searchsorted(row, np.arange(len(start) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(st), pa.array(en)], names=["st", "en"]))

    others = [c for c in aln.columns if c not in ("tname", "cigar", "seq", "st", "en", "ref")]
    made = aln.where("ref_start IS NOT NULL").withColumn("__b", F.explode(blocks("ref_start", "cigar", "seq")))
    return made.select(F.col("tname").alias("ref"), F.col("__b.st").alias("st"), F.col("__b.en").alias("en"), *others)


def depth_runs(iv: DataFrame) -> DataFrame:
    """Maximal runs (ref, start, end, depth) of equal positive depth between events."""
    ends = iv.select("ref", F.explode(F.array(F.struct(F.col("st").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("en").alias("pos"), F.lit(-1).alias("d")))).alias("e"))
    return runs_of(ends.select("ref", "e.pos", "e.d"))


def runs_of(changes: DataFrame) -> DataFrame:
    """Runs as in depth_runs of changes(ref, pos, d): by how much the depth changes at a position, in any number of rows."""
    # Written, as three branches below read it, which would each work out the changes.
    events = keep(changes.groupBy("ref", "pos").agg(F.sum("d").alias("d")).where("d != 0"), "depth-changes")
    run = _running(events, ["d"])
    # The next event may lie blocks ahead: within a block by lead, across blocks by the next block's first event.
    block = F.floor(F.col("pos") / BLOCK)
    firsts = events.groupBy("ref", block.alias("block")).agg(F.min("pos").alias("p"))
    after = firsts.select("ref", "block", F.lead("p").over(Window.partitionBy("ref").orderBy("block")).alias("after"))
    near = F.lead("pos").over(Window.partitionBy("ref", "block").orderBy("pos"))
    out = run.withColumn("block", block).join(after, ["ref", "block"]).withColumn("end", F.coalesce(near, F.col("after")))
    return out.where("run_d > 0").select("ref", F.col("pos").alias("start"), "end", F.col("run_d").alias("depth"))


def window_means(iv: DataFrame, contigs: DataFrame, window: int = 500, step: int = 100) -> DataFrame:
    """Mean depth (ref, win_start, mean_cov) of full windows; of the whole contig where it is shorter than one. Windows without reads count as 0.

    An interval is two events, whatever its length: the bases below x are x * (starts - ends) -
    (sum of starts - sum of ends), both up to x, and a window's bases are the difference of two
    such values at its ends.
    """
    grid = contigs.select(F.col("name").alias("ref"), "length", F.explode(F.when(F.col("length") < window, F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), (F.col("length") - window).cast("long"), F.lit(step).cast("long")))).alias("win_start"))
    grid = grid.withColumn("width", F.least(F.lit(window), F.greatest("length", F.lit(1))).cast("long"))
    none = F.lit(0).cast("long")
    ends = iv.where("en > st").select("ref", F.explode(F.array(F.struct(F.col("st").cast("long").alias("pos"), F.lit(1).cast("long").alias("d")), F.struct(F.col("en").cast("long").alias("pos"), F.lit(-1).cast("long").alias("d")))).alias("e"))
    # What lies before position 0 counts there: sums stand for the window, not for the contig.
    events = ends.select("ref", F.col("e.pos").alias("pos"), F.col("e.d").alias("d"), (F.col("e.pos") * F.col("e.d")).alias("s"))
    marks = grid.select("ref", F.explode(F.array(F.col("win_start"), F.col("win_start") + F.col("width"))).alias("pos")).distinct()
    both = events.unionByName(marks.select("ref", "pos", none.alias("d"), none.alias("s"))).groupBy("ref", "pos").agg(F.sum("d").alias("d"), F.sum("s").alias("s"))
    below = _running(both, ["d", "s"]).select("ref", "pos", (F.col("pos") * F.col("run_d") - F.col("run_s")).alias("below"))
    lo = below.select("ref", F.col("pos").alias("win_start"), F.col("below").alias("lo"))
    hi = below.select("ref", F.col("pos").alias("win_end"), F.col("below").alias("hi"))
    out = grid.withColumn("win_end", F.col("win_start") + F.col("width")).join(lo, ["ref", "win_start"]).join(hi, ["ref", "win_end"])
    return out.select("ref", "win_start", ((F.col("hi") - F.col("lo")) / F.col("width")).alias("mean_cov"))


def value_counts(means: DataFrame) -> DataFrame:
    """ref, mean_cov, n: how many windows have each mean; written, since medians read it more than once."""
    return keep(means.where("mean_cov IS NOT NULL").groupBy("ref", "mean_cov").agg(F.count("*").alias("n")), "window-values")


def median_of_counts(counts: DataFrame, value: str, by: list[str]) -> DataFrame:
    """by and median, the exact median of value, n times each, in every group.

    Ranks are first found over the sums of the values' integer parts, then over the distinct values
    of the one or two parts that hold the middle. So no task sorts a group: a window has a row an
    integer part, or a row a distinct value within one.
    """
    counts = counts.withColumn("__b", F.floor(value))
    parts = counts.groupBy(*by, "__b").agg(F.sum("n").alias("__n"))
    along = Window.partitionBy(*by).orderBy("__b")
    parts = parts.withColumn("__end", F.sum("__n").over(along)).withColumn("__all", F.sum("__n").over(Window.partitionBy(*by)))
    holds = lambda n: ((F.col("__end") > n) & (F.col("__end") - F.col("__n") <= n))
    low, high = F.floor((F.col("__all") - 1) / 2), F.floor(F.col("__all") / 2)
    middle = parts.where(holds(low) | holds(high)).select(*by, "__b", (F.col("__end") - F.col("__n")).alias("__base"), low.alias("__low"), high.alias("__high"))
    # Null groups are groups, too.
    both = counts.alias("c").join(middle.alias("m"), [F.col(f"c.{k}").eqNullSafe(F.col(f"m.{k}")) for k in [*by, "__b"]])
    both = both.select(*[F.col(f"c.{k}") for k in [*by, "__b", value, "n"]], "__base", "__low", "__high")
    inside = F.sum("n").over(Window.partitionBy(*by, "__b").orderBy(value)) + F.col("__base")
    placed = both.withColumn("__to", inside).withColumn("__from", inside - F.col("n"))
    at = lambda k: F.max(F.when((F.col("__from") <= F.col(k)) & (F.col("__to") > F.col(k)), F.col(value)))
    return placed.groupBy(*by).agg(((at("__low") + at("__high")) / 2).alias("median"))


def baselines(means: DataFrame) -> DataFrame:
    """The median window of each contig. means may be value_counts of them."""
    counts = means if "n" in means.columns else value_counts(means)
    return median_of_counts(counts, "mean_cov", ["ref"]).select("ref", F.col("median").alias("baseline"))


def global_baseline(means: DataFrame) -> DataFrame:
    """The median of all windows, one row; 0 without any. means may be value_counts of them."""
    counts = means if "n" in means.columns else value_counts(means)
    whole = median_of_counts(counts.groupBy("mean_cov").agg(F.sum("n").alias("n")), "mean_cov", [])
    return whole.agg(F.coalesce(F.max("median"), F.lit(0.0)).alias("baseline"))


def local_coverage(iv: DataFrame, depth: DataFrame | None = None) -> DataFrame:
    """iv(name, ref, st, en) with local_cov, the mean depth over each interval. The depth is that of depth(ref, st, en) if given, else of iv; with a boolean column counted, of those where it holds.

    Bases below x are x * (starts - ends) - (sum of starts - sum of ends), both up to x; so two
    lookups in running sums replace the join of intervals with positions.
    """
    one = F.col("counted").cast("int") if "counted" in iv.columns else F.lit(1)
    both = lambda rows, d: rows.select("ref", F.explode(F.array(F.struct(F.col("st").cast("long").alias("pos"), d.alias("d")), F.struct(F.col("en").cast("long").alias("pos"), (-d).alias("d")))).alias("e"))
    # With a depth of its own, the intervals only mark where it is looked up.
    ends = both(iv, one) if depth is None else both(depth, F.lit(1)).unionAll(both(iv, F.lit(0)))
    events = ends.groupBy("ref", F.col("e.pos").alias("pos")).agg(F.sum("e.d").alias("d")).withColumn("s", F.col("pos") * F.col("d"))
    below = _running(events, ["d", "s"]).select("ref", "pos", (F.col("pos") * F.col("run_d") - F.col("run_s")).alias("below"))
    lo = below.select("ref", F.col("pos").alias("st"), F.col("below").alias("below_st"))
    hi = below.select("ref", F.col("pos").alias("en"), F.col("below").alias("below_en"))
    out = iv.join(lo, ["ref", "st"]).join(hi, ["ref", "en"])
    return out.withColumn("local_cov", F.when(F.col("en") > F.col("st"), (F.col("below_en") - F.col("below_st")) / (F.col("en") - F.col("st"))).otherwise(F.lit(0.0))).drop("below_st", "below_en")


def outcomes(aln: DataFrame, options: ScrubOptions = ScrubOptions()) -> DataFrame:
    """aln with its outcome: the first rule it fails, in order; aln has mapq, mapped_fraction, softclip_fraction and, for the last rule, local_cov and threshold."""
    o = options
    rule = F.when(F.col("mapq") < o.min_mapq, "failed_mapq").when(F.col("mapped_fraction") < o.min_mapped_fraction, "failed_mapped_fraction").when(F.col("softclip_fraction") > o.max_softclip_fraction, "failed_softclip")
    if {"local_cov", "threshold"} <= set(aln.columns):
        rule = rule.when(F.coalesce("local_cov", F.lit(0.0)) < F.coalesce("threshold", F.lit(0.0)), "failed_low_coverage")
    return aln.withColumn("outcome", rule.otherwise("clean"))


#: SAM flags.
UNMAPPED, SECONDARY, QC_FAIL, DUPLICATE, SUPPLEMENTARY = 4, 256, 512, 1024, 2048


def without(flags: int):
    return F.col("flag").bitwiseAND(flags) == 0


def primary(aln: DataFrame) -> DataFrame:
    """Mapped, primary alignments."""
    return aln.where(without(SECONDARY + SUPPLEMENTARY + UNMAPPED))


def classify(aln: DataFrame, contigs: DataFrame, options: ScrubOptions = ScrubOptions()) -> DataFrame:
    """Primary alignments (qname, flag, tname, ref_start, ref_end, mapq, cigar, seq) with their outcome."""
    return classified(aln, contigs, options)[0]


def classified(aln: DataFrame, contigs: DataFrame, options: ScrubOptions = ScrubOptions()) -> tuple[DataFrame, DataFrame]:
    """(primary alignments with their outcome, baselines of all contigs: ref, baseline).

    Depth is that of the blocks that mapped alignments cover, supplementary ones included, without
    secondary, duplicate and failed ones; it is taken for baselines and for the rule. Only primary
    alignments are judged.
    """
    from ..functions import seq as S

    p = aln.where(without(UNMAPPED + SECONDARY)).withColumn("read_len", S.read_length(F.col("cigar"), F.col("seq")))
    p = p.withColumn("mapped_fraction", S.aligned_query_length(F.col("cigar")) / F.col("read_len")).withColumn("softclip_fraction", S.softclip_length(F.col("cigar")) / F.col("read_len"))
    depth = keep(aligned_blocks(aln.where(without(UNMAPPED + SECONDARY + QC_FAIL + DUPLICATE)).select("tname", "ref_start", "cigar", "seq")).select("ref", "st", "en"), "aligned-blocks")
    base = keep(baselines(window_means(depth, contigs, options.window, options.step)), "baselines")
    judged = p.where(without(SUPPLEMENTARY)).withColumnsRenamed({"tname": "ref", "ref_start": "st", "ref_end": "en"})
    limits = base.select("ref", (F.col("baseline") * options.coverage_ratio).alias("threshold"))
    return outcomes(local_coverage(judged, depth).join(limits, "ref", "left"), options), base


def read_verdicts(judged: DataFrame) -> DataFrame:
    """clean_reads, dirty_reads (distinct names; a name can be in both) and counts by outcome, one row."""
    names = ("failed_mapq", "failed_mapped_fraction", "failed_softclip", "failed_low_coverage")
    return judged.agg(
        F.count("*").alias("total_alignments"),
        *[F.count_if(F.col("outcome") == n).alias(n) for n in names],
        F.count_distinct(F.when(F.col("outcome") == "clean", F.col("qname"))).alias("clean_reads"),
        F.count_distinct(F.when(F.col("outcome") != "clean", F.col("qname"))).alias("numt_or_chimeric_reads"),
    )
