import json

import pytest

from strandline.plans import report, run
from strandline.plans.options import DownsampleOptions, JoinOptions, PoolOptions, ScrubOptions
from strandline.sources import readers as R
from strandline.sources import writers as W


def put(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


@pytest.fixture
def files(tmp_path):
    names = [f"r{k}" for k in range(6)]
    fastq = put(tmp_path, "reads.fq", "".join(f"@{n}\n{'ACGT' * 25}\n+\n{'I' * 100}\n" for n in names))
    fasta = put(tmp_path, "ref.fa", ">c1\n" + "A" * 200 + "\n>c2\nACGT\n")
    paf = put(tmp_path, "a.paf", "".join(f"{n}\t100\t0\t100\t+\t{t}\t200\t0\t100\t{m}\t100\t60\n" for n, t, m in (("r0", "c1", 99), ("r1", "c1", 50), ("r2", "c2", 95), ("r3", "zz", 99))))
    sam = "@SQ\tSN:c1\tLN:200\n@SQ\tSN:c2\tLN:4\n" + "".join(f"{n}\t{f}\tc1\t{p}\t{q}\t{c}\t*\t0\t0\t{'ACGT' * 25}\t{'I' * 100}\n" for n, f, p, q, c in (("r0", 0, 1, 60, "100M"), ("r1", 0, 101, 60, "100M"), ("r2", 0, 51, 5, "100M"), ("r3", 0, 51, 60, "50S50M"), ("r4", 256, 1, 60, "100M")))
    return fastq, fasta, paf, put(tmp_path, "a.sam", sam)


def one(spark, path):
    return [json.loads(r.value) for r in spark.read.text(path).collect()]


def test_runs_from_files_to_files(spark, tmp_path, files):
    fastq, fasta, paf, sam = files
    out = str(tmp_path / "out")
    stats = {r.chrom: (r.n_seen, r.n_passed, r.n_reads) for r in run.pool_run(spark, paf, fastq, fasta, out, PoolOptions(100, 0.9, 50, 0.98)).collect()}
    assert stats == {"c1": (2, 1, 1), "c2": (1, 1, 1)}
    assert [r.name for r in R.read_fastq(spark, f"{out}/reads/chrom=c2").collect()] == ["r2"]

    down = {r.chrom: r for r in run.downsample_run(spark, sam, fastq, out + "/d", DownsampleOptions(1, 50, 0.8, 10), keep_sam=True).collect()}
    assert (down["c1"].input_alignments, down["c1"].selected_reads, down["c1"].achieved_coverage["c1"], down["c2"].output_reads) == (3, 2, 1.0, 0)
    assert sorted(r.name for r in R.read_fastq(spark, out + "/d/reads").collect()) == ["r0", "r1"]
    assert sorted(r.qname for r in R.read_sam(spark, out + "/d/alignments").collect()) == ["r0", "r1"] and R.read_sam_contigs(spark, out + "/d/alignments").count() == 2
    total = run.run_totals(R.read_stats_json(spark, out + "/d/downsample_stats")).first()
    assert (total.input_alignments, total.output_reads) == (3, 2)
    assert run.downsample_run(spark, sam, fastq, out + "/e", DownsampleOptions(1, 50, 0.8, 10), chroms=["c2"]).agg({"input_alignments": "sum"}).first()[0] == 0

    scrub = run.scrub_run(spark, sam, fastq, out + "/s", ScrubOptions(window=100, step=50)).first()
    assert (scrub.total_alignments, scrub.failed_mapq, scrub.failed_mapped_fraction, scrub.clean_reads, scrub.output_reads) == (4, 1, 1, 2, 2)
    assert R.read_scrub_json(spark, out + "/s/scrub_stats").first().per_contig_baselines == scrub.per_contig_baselines
    assert sorted(r.name for r in R.read_fastq(spark, out + "/s/reads").collect()) == ["r0", "r1"]

    reads = R.read_reads(spark, fasta)
    assert run.extract_reads(reads, spark.createDataFrame([("c2",)], "name string"), out + "/fa") == 1
    assert R.detect_format(spark, out + "/fa") == "fasta"
    assert run.first_nonempty([reads.limit(0), reads.where("name = 'c2'")], reads).first().name == "c2" and run.first_nonempty([], reads).count() == 2


def test_record_and_options(spark, tmp_path):
    path = str(tmp_path / "record")
    rec = run.Record(spark, path, pools=PoolOptions(), reads="x.fq")
    assert "finished" not in one(spark, path)[0]
    rec.end(graph="a.gfa")
    done = one(spark, path)[0]
    assert done["pools"]["len_a"] == 5000 and done["graph"] == "a.gfa" and done["elapsed_seconds"] >= 0
    assert R.read_parameters_json(spark, path).first()["graph"] == "a.gfa"
    run.validate(PoolOptions(), DownsampleOptions(), ScrubOptions(), JoinOptions())
    with pytest.raises(ValueError, match="id_a.*bin_size"):
        run.validate(PoolOptions(id_a=1.5), DownsampleOptions(bin_size=0))


def test_report_of_a_run(spark):
    reads = spark.createDataFrame([("AC", "II"), ("ACGT", "!!!!")], "seq string, qual string")
    raw = run.read_figures(reads)
    assert (raw["count"], raw["total_bases"], raw["n50"], sum(raw["q_histogram"])) == (2, 6, 4, 2)
    assert report.pad_hist([1, 2, 3], 2) == [1, 2] and report.pad_hist([1], 3) == [1, 0, 0] and run.removed(3, 5) == 0
    down = spark.createDataFrame([("c", {"c": 90.0}, {"c": 10}), ("d", {"d": 20.0}, {"d": 30})], "chrom string, achieved_coverage map<string,double>, ref_lengths map<string,long>")
    page = report.run_report("Run", raw, raw | {"count": 1}, raw | {"count": 1}, {"clean": 1, "failed_mapq": 0}, down, [("k", 60_000)])
    assert "37.5x" in page and "50.0 %" in page and "class=stage" in page and page.count("class=part") == 1 and "class=green" in page


def test_sinks_and_text_reports(spark, tmp_path):
    node = "array<struct<seg:string,orient:string>>"
    edges = spark.createDataFrame([("A", "+", "B", "-", 91.0, 120, 10920.0)], "src_seg string, src_orient string, dst_seg string, dst_orient string, identity double, overlap int, score double")
    hits = spark.createDataFrame([("A", "+", 900, 80.0, 150, 12000.0, True), ("B", "+", 800, 99.0, 150, 14850.0, False)], "seg string, orient string, length int, identity double, overlap int, score double, circular_possible boolean")
    paths = spark.createDataFrame([("cycle", 1600, 90.0, 88.0, 240, 1.5, [("A", "+"), ("B", "-"), ("A", "+")])], f"kind string, total_len long, mean_identity double, min_identity double, total_overlap long, score double, nodes {node}")
    joins = spark.createDataFrame([("A", "tail", "B", "head", "+/+", 75.5, 100, 1600, "direct")], "seg_a string, end_a string, seg_b string, end_b string, orientation string, identity_pct double, overlap_bp int, combined_len_bp long, note string")
    for f, df in ((W.write_edges, edges), (W.write_paths, paths), (W.write_self_hits, hits), (W.write_joins, joins)):
        f(df, str(tmp_path / f.__name__))
    table = lambda f: [tuple(r) for r in spark.read.csv(str(tmp_path / f.__name__), sep="\t", header=True).collect()]
    assert table(W.write_edges) == [("A", "+", "B", "-", "91.00", "120", "10920.00")]
    assert table(W.write_paths) == [("cycle", "1600", "90.00", "88.00", "240", "1.50", "A+ -> B- -> A+")]
    assert [r[0] for r in table(W.write_self_hits)] == ["B", "A"] and table(W.write_self_hits)[1][-1] == "yes"
    assert table(W.write_joins)[0][5] == "75.5"
    support = spark.createDataFrame([("A", "yes"), ("B", "no")], "contig string, cycle_possible string")
    text = report.graph_text(edges, hits, paths, support)
    assert "edges: 1  self hits: 2  cycles: 1" in text and "A+ -> B- -> A+" in text and text.index("B+\t99.00") < text.index("A+\t80.00")
    rings = spark.createDataFrame([(["A", "B"], 100), (["C", "D"], 300)], "path array<string>, total long")
    said = report.joins_text(joins, rings)
    assert said.index("300") < said.index("A -> B")


def test_kept_alignments_are_a_valid_file(spark, tmp_path, files):
    sam = files[3]
    run.keep_alignments(spark, sam, spark.createDataFrame([("r3",), ("r0",), ("r4",)], "name string"), str(tmp_path / "kept"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "kept").glob("part-*")))
    whole = open(sam).read().splitlines()
    assert text.splitlines() == whole[:2] + [x for x in whole[2:] if x.split("\t")[0] in ("r0", "r3", "r4")]


def test_baselines_do_not_need_a_ratio(spark, tmp_path, files):
    fastq, _, _, sam = files
    got = [run.scrub_run(spark, sam, fastq, str(tmp_path / str(r)), ScrubOptions(window=100, step=50, coverage_ratio=r)).first().per_contig_baselines for r in (0.0, 0.2)]
    assert got[0] == got[1] and got[0]["c1"] > 0 and got[0]["c2"] == 0.0


def test_binary_alignments_give_the_same_run(spark, tmp_path, files):
    from strandline.sources import bam, blocks

    fastq, _, _, sam = files
    head, rows = "@SQ\tSN:c1\tLN:200\n@SQ\tSN:c2\tLN:4\n", [x for x in open(sam).read().splitlines() if x[0] != "@"]
    data = bam.header_bytes(head, [("c1", 200), ("c2", 4)]) + b"".join(bam.encode_line(x, {"c1": 0, "c2": 1}) for x in rows)
    (tmp_path / "a.bam").write_bytes(blocks.pack_block(data) + blocks.LAST)
    for f, o in ((run.scrub_run, ScrubOptions(window=100, step=50)), (run.downsample_run, DownsampleOptions(1, 50, 0.8, 10))):
        a = f(spark, sam, fastq, str(tmp_path / "a" / f.__name__), o, keep_sam=True).collect()
        b = f(spark, str(tmp_path / "a.bam"), fastq, str(tmp_path / "b" / f.__name__), o, keep_sam=True).collect()
        assert sorted(map(repr, a)) == sorted(map(repr, b))
        texts = sorted(map(tuple, R.read_sam(spark, str(tmp_path / "a" / f.__name__ / "alignments")).collect()))
        assert sorted(map(tuple, bam.read_bam(spark, str(tmp_path / "b" / f.__name__ / "alignments")).collect())) == texts and texts


def test_graph_and_joins_from_files_to_files(spark, tmp_path):
    import random

    from strandline.plans.options import GraphOptions

    rng = random.Random(12)
    seq = {n: "".join(rng.choices("ACGT", k=400)) for n in "ABC"}
    # A ring A -> B -> C -> A: each begins with the last 120 bases of the one before.
    seq["B"] = seq["A"][-120:] + seq["B"][120:]
    seq["C"] = seq["B"][-120:] + seq["C"][120:]
    seq["A"] = seq["C"][-120:] + seq["A"][120:]
    gfa = put(tmp_path, "g.gfa", "".join(f"S\t{n}\t{s}\n" for n, s in seq.items()))
    out = str(tmp_path / "graph")
    made = run.graph_run(spark, gfa, out, GraphOptions(window=150, expected_size=840, size_tolerance=0.2, max_depth=4))
    ring = [r.nodes for r in made["any"].collect()]
    # The other strand goes round the other way.
    assert sorted("".join(x.seg + x.orient for x in n) for n in ring) == ["A+B+C+A+", "A-C-B-A-"] and made["cycles"].count() == 2
    got = {r.name: r.seq for r in R.read_fasta(spark, f"{out}/fasta").collect()}
    whole = (seq["A"] + seq["B"][120:] + seq["C"][120:])[: 1200 - 3 * 120]
    assert got["A__B__C|cycle|840|100.00"] == whole and any(n.startswith("A__B__C|cycle_any") for n in got)
    text = "".join(r.value + "\n" for r in spark.read.text(f"{out}/report").collect())
    assert "A+ -> B+" in text and spark.read.csv(f"{out}/support", sep="\t", header=True).count() == 3
    assert {r.nodes for r in spark.read.csv(f"{out}/paths", sep="\t", header=True).where("kind = 'cycle'").collect()} == {"A+ -> B+ -> C+ -> A+", "A- -> C- -> B- -> A-"}

    fasta = put(tmp_path, "c.fa", "".join(f">{n}\n{s}\n" for n, s in seq.items()))
    for path in (fasta, gfa):
        both = run.joins_run(spark, path, str(tmp_path / "joins"), JoinOptions(window=150, expected_size=840, size_tolerance=0.3))
        assert sorted(r.path for r in both["rings"].collect()) == [["A", "B", "C"], ["B", "C", "A"], ["C", "A", "B"]]
    assert spark.read.csv(str(tmp_path / "joins/rings"), sep="\t", header=True).first().path == "A -> B -> C"


def test_html_report_of_a_run(spark, tmp_path, files):
    fastq, fasta, _, sam = files
    out = str(tmp_path / "r")
    run.scrub_run(spark, sam, fastq, out + "/s", ScrubOptions(window=100, step=50))
    run.downsample_run(spark, sam, fastq, out + "/d", DownsampleOptions(1, 50, 0.8, 10))
    page = run.report_run(spark, fastq, out + "/s/reads", out + "/d/reads", out + "/s/scrub_stats", out + "/d/downsample_stats", fasta, out + "/page")
    assert "66.7 %" in page and "class=red>1.0x" in page and spark.read.text(out + "/page").count() > 5
    none = spark.createDataFrame([({"c": 9.0}, {"c": 0}), ({"d": 3.0}, {})], "achieved_coverage map<string,double>, ref_lengths map<string,long>")
    assert run.T.displayed_coverage(none).first()[0] is None and run.T.displayed_coverage(none.selectExpr("achieved_coverage", "CAST(NULL AS MAP<STRING,BIGINT>) AS ref_lengths")).first()[0] == 6.0
