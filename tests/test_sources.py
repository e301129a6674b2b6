from strandline.plans.report import report_html
from strandline.sources import readers as R
from strandline.sources import writers as W
from strandline.streaming.incremental import stream_counts, stream_pools


def put(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_fasta(spark, tmp_path):
    p = put(tmp_path, "a.fa", ">c1 first\nACGT\nAC\n>c2\nGG\n>c1\n\n")
    assert [(r.name, r.seq) for r in R.read_fasta(spark, p).orderBy("ord").collect()] == [("c1", "ACGTAC"), ("c2", "GG"), ("c1", "")]
    assert R.detect_format(spark, p) == "fasta" and R.read_reads(spark, p).where("qual IS NULL").count() == 3


def test_fastq_quality_may_begin_with_at(spark, tmp_path):
    p = put(tmp_path, "a.fq", "@r1 x\nAC\n+\n@I\n@r2\nGGT\n+\n!!!\n")
    rows = R.read_reads(spark, p).orderBy("ord").collect()
    assert [(r.name, r.seq, r.qual) for r in rows] == [("r1", "AC", "@I"), ("r2", "GGT", "!!!")]


def test_paf_sam_gfa(spark, tmp_path):
    line = "q\t10\t0\t10\t+\tt\t100\t0\t10\t9\t10\t60"
    paf = R.read_paf(spark, put(tmp_path, "a.paf", f"{line}\tcg:Z:10M\nshort\tline\n{line}\n"))
    assert paf.count() == 2 and sorted(len(r.tags) for r in paf.collect()) == [0, 1]
    sam = put(tmp_path, "a.sam", "@HD\tVN:1\n@SQ\tSN:c1\tLN:42\nq\t0\tc1\t5\t30\t2S8M\t*\t0\t0\tACGTACGTAC\tIIIIIIIIII\nq\t256\tc1\t5\t30\t10M\t*\t0\t0\t*\t*\n")
    assert [tuple(r) for r in R.read_sam_contigs(spark, sam).collect()] == [("c1", 42)]
    placed = R.read_alignments(R.read_sam(spark, sam)).collect()
    assert [(r.name, r.length, r.mean_q, r.st, r.en) for r in placed] == [("q", 10, 40.0, 4, 12)]
    gfa = put(tmp_path, "a.gfa", "H\tx\nS\ta\tACGT\nS\tb\t*\nS\tc\tTT\nS\ta\tGG\nL\ta\t+\tc\t+\t0M\n")
    assert [(r.name, r.seq) for r in R.read_gfa(spark, gfa).orderBy("ord").collect()] == [("a", "GG"), ("c", "TT")]


def test_round_trip(spark, tmp_path):
    reads = spark.createDataFrame([("c1", "r1", 0, "ACG", "III"), ("c2", "r2", 1, "GG", None)], "chrom string, read string, ord long, seq string, qual string")
    W.write_fastq(reads, str(tmp_path / "fq"), by="chrom")
    assert [(r.name, r.seq) for r in R.read_fastq(spark, str(tmp_path / "fq" / "chrom=c1")).collect()] == [("r1", "ACG")]
    rows = spark.createDataFrame([("x", "A" * 170)], "name string, seq string")
    W.write_fasta(rows, str(tmp_path / "fa"))
    assert R.read_fasta(spark, str(tmp_path / "fa")).first().seq == "A" * 170


def test_report():
    page = report_html("Run", {"reads": 1234}, [("Q0-5", 1)], [("c", 80.0)], [("k", 60_000)], {"clean": 2, "none": 0})
    assert "1,234" in page and "class=green" in page and "chromosome-scale" in page and "none" not in page and '"histogram": [1]' in page


def test_streams(spark, tmp_path):
    spark.createDataFrame([("a", "c", 4500, 5000)] * 3, "qname string, tname string, n_match long, aln_len long").write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema("qname string, tname string, n_match long, aln_len long").parquet(str(tmp_path / "in"))
    q = stream_pools(src).writeStream.format("memory").queryName("pools_out").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("pools_out").count() == 1
    ev = spark.readStream.schema("ts timestamp, event_type string, value double").option("pathGlobFilter", "events.parquet").parquet("/root/testdata/sf0.001")
    q = stream_counts(ev).writeStream.format("memory").queryName("counts_out").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("counts_out").count() > 0


def test_order_over_files(spark, tmp_path):
    a, b = put(tmp_path, "a.fa", ">a1\nAC\n>a2\nGG\n"), put(tmp_path, "b.fa", ">b1 x\n" + "ACGT\n" * 500 + ">b2\nT\n")
    names = lambda df: [r.name for r in df.orderBy("ord").collect()]
    assert names(R.read_fasta(spark, [a, b])) == ["a1", "a2", "b1", "b2"] == names(R.read_fasta(spark, str(tmp_path / "*.fa")))
    assert names(R.read_fasta(spark, [b, a])) == ["b1", "b2", "a1", "a2"] and R.contig_count(spark, [a, b]) == 4
    one, two = put(tmp_path, "1.fq", "@r1\nA\n+\nI\n"), put(tmp_path, "2.fq", "@r2\nA\n+\nI\n@r3\nC\n+\nI\n" * 300)
    both = R.read_fastq(spark, [one, two])
    assert both.count() == both.select("ord").distinct().count() == 601 and names(both)[0] == "r1"
    g1, g2 = put(tmp_path, "a.gfa", "S\ts\tAAAA\n"), put(tmp_path, "b.gfa", "S\ts\tCC\n" + "S\tother\tGG\n" * 300)
    assert {r.name: r.seq for r in R.read_gfa(spark, [g1, g2]).collect()} == {"s": "CC", "other": "GG"}
    assert {r.name: r.seq for r in R.read_gfa(spark, [g2, g1]).collect()}["s"] == "AAAA"
