import gzip
import random
import struct
import warnings

import pytest

from strandline.sources import bam, blocks, fastx
from strandline.sources import readers as R


def sam_text(n=700, seed=1):
    rng = random.Random(seed)
    head = "@HD\tVN:1.6\n@SQ\tSN:c1\tLN:100000\n@SQ\tSN:c2\tLN:5000\n@CO\tabc\n"
    rows = []
    for k in range(n):
        size = rng.choice([0, 1, 7, 150, 2000])
        seq, qual = "".join(rng.choice("ACGTN") for _ in range(size)) or "*", "".join(chr(33 + rng.randrange(60)) for _ in range(size)) or "*"
        if rng.random() < 0.1:
            qual = "*"
        if rng.random() < 0.05:
            rows.append(f"u{k}\t4\t*\t0\t0\t*\t*\t0\t0\t{seq}\t{qual}")
            continue
        cigar = f"{size}M" if size and rng.random() < 0.6 else f"{rng.randrange(1, 9)}S{max(1, size)}=2D3N1X4H" if size else "*"
        rows.append(f"r{k}\t{rng.choice([0, 16, 256, 2048])}\tc{rng.choice('12')}\t{rng.randrange(1, 4000)}\t{rng.randrange(61)}\t{cigar}\t=\t5\t-3\t{seq}\t{qual}\tNM:i:{k}\tXA:A:q\tXF:f:1.5\tXZ:Z:text here\tXB:B:s,1,-2,3")
    return head, rows


def as_bam(head, rows, block=5000):
    refs = [("c1", 100000), ("c2", 5000)]
    data = bam.header_bytes(head, refs) + b"".join(bam.encode_line(x, {"c1": 0, "c2": 1}) for x in rows)
    return b"".join(blocks.pack_block(data[k : k + block]) for k in range(0, len(data), block)) + blocks.LAST


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("bam")
    head, rows = sam_text()
    (d / "a.sam").write_text(head + "\n".join(rows) + "\n")
    (d / "a.bam").write_bytes(as_bam(head, rows))
    return d, head, rows


def test_binary_equals_text(spark, files):
    d, head, rows = files
    text = sorted(map(tuple, R.read_sam(spark, str(d / "a.sam")).collect()), key=repr)
    for split in (1 << 30, 30_000):
        df = bam.read_bam(spark, str(d / "a.bam"), split=split)
        assert sorted(map(tuple, df.collect()), key=repr) == text
        if split < 1 << 30:
            assert df.rdd.getNumPartitions() > 5
    assert [tuple(r) for r in bam.read_bam_contigs(spark, str(d / "a.bam")).collect()] == [tuple(r) for r in R.read_sam_contigs(spark, str(d / "a.sam")).collect()]
    few = bam.read_bam(spark, str(d / "a.bam"), columns=("mapq", "qname"))
    assert few.columns == ["mapq", "qname"] and few.agg({"mapq": "sum"}).first()[0] == sum(t[5] for t in text)
    assert R.read_alignments(df).count() == R.read_alignments(R.read_sam(spark, str(d / "a.sam"))).count()


def test_many_operations_are_kept_in_a_tag():
    cigar = "1M1I" * 40_000
    line = f"q\t0\tc1\t5\t9\t{cigar}\t*\t0\t0\t{'A' * 80_000}\t*"
    raw = bam.encode_line(line, {"c1": 0})
    got = bam.decode(raw, [0, len(raw)], ["c1"], ["cigar", "ref_start", "ref_end"])
    assert got.column(0)[0].as_py() == cigar and got.column(2)[0].as_py() == 40_004


def test_truncated_and_damaged_files_are_errors(spark, files, tmp_path):
    d, _, _ = files
    raw = (d / "a.bam").read_bytes()
    for name, data in (("end", raw[: -len(blocks.LAST)]), ("half", raw[: len(raw) // 2]), ("mid", raw[: len(raw) // 2] + blocks.LAST), ("bit", raw[:3000] + bytes([raw[3000] ^ 1]) + raw[3001:])):
        (tmp_path / name).write_bytes(data)
        with pytest.raises(Exception, match="truncated|damaged"):
            bam.read_bam(spark, str(tmp_path / name)).count()


def test_a_wrong_guess_is_an_error(files):
    d, _, _ = files
    size = (d / "a.bam").stat().st_size
    with open(d / "a.bam", "rb") as f:
        good = blocks.records(f, size, 0, size // 2, bam.cut, bam.border(2), bam.read_header(str(d / "a.bam"))[2])
        assert sum(len(s) - 1 for _, s in good) > 50
        with pytest.raises(ValueError, match="taken for another"):
            list(blocks.records(f, size, 0, size // 2, bam.cut, lambda buf, at, whole: at + 1, bam.read_header(str(d / "a.bam"))[2]))


def test_sorted_sink(spark, files, tmp_path):
    d, head, rows = files
    out = str(tmp_path / "sorted")
    refs = bam.read_header(str(d / "a.bam"))[1]
    bam.write_bam(bam.read_bam(spark, str(d / "a.bam"), columns=("record",), split=200_000), out, head, refs)
    whole = b"".join((tmp_path / "sorted" / n).read_bytes() for n in sorted(x.name for x in (tmp_path / "sorted").glob("*.bam")))
    (tmp_path / "one.bam").write_bytes(whole)
    text = sorted(map(tuple, R.read_sam(spark, str(d / "a.sam")).collect()), key=repr)
    for path in (out, str(tmp_path / "one.bam")):
        got = [tuple(r) for r in bam.read_bam(spark, path, split=150_000).collect()]
        assert sorted(got, key=repr) == text
    # The concatenated file in one pass, by the format's own rules.
    data = gzip.decompress(whole)
    said, _, at = bam.parse_header(data)
    starts, end = bam.cut(data, at, True)
    order = [struct.unpack_from("<ii", data, a + 4) for a in starts]
    assert order == sorted(order, key=lambda x: (x[0] < 0, x)) and len(order) == len(rows) and "SO:coordinate" in said and end == len(data)
    before = sorted(bam.encode_line(x, {"c1": 0, "c2": 1}) for x in rows)
    assert sorted(data[a:b] for a, b in zip(starts, [*starts[1:], end], strict=True)) == before

    want = sorted((t for t in text if t[2] == "c1" and t[3] < 1200 and max(t[4], t[3] + 1) > 1000), key=repr)
    assert sorted(map(tuple, bam.read_region(spark, out, "c1", 1000, 1200).collect()), key=repr) == want and want
    assert bam.read_region(spark, out, "c2", 9000, 9001).count() == 0
    # Other blocks aren't touched: with all of them damaged the region is still there.
    index = spark.read.parquet(out + "/_index").collect()
    used = {(r.part, r.offset) for r in index if r.ref == 0 and r["first"] < 1200 and r.behind > 1000}
    assert 0 < len(used) < len(index)
    for r in index:
        if (r.part, r.offset) not in used:
            with open(f"{out}/{r.part:06d}.bam", "r+b") as f:
                f.seek(r.offset)
                f.write(b"\0" * r.bytes)
    assert sorted(map(tuple, bam.read_region(spark, out, "c1", 1000, 1200).collect()), key=repr) == want
    with pytest.raises(FileExistsError):
        bam.write_bam(spark.createDataFrame([], "record binary"), out, head, refs, overwrite=False)
    bam.write_bam(spark.createDataFrame([], "record binary"), out, head, refs)
    assert bam.read_bam(spark, out).count() == 0 and bam.read_header(out)[1] == refs


def pack(text, size):
    data = text.encode()
    return b"".join(blocks.pack_block(data[k : k + size]) for k in range(0, len(data), size)) + blocks.LAST


@pytest.mark.parametrize("end", ["\n", "", "\n\n"])
def test_blocked_reads_equal_plain_ones(spark, tmp_path, end):
    rng = random.Random(4)
    sizes = [rng.choice([1, 30, 900]) for _ in range(600)]
    recs = [(f"r{k} x@y", "".join(rng.choices("ACGT", k=n)), "".join(rng.choices("@+>I!", k=n))) for k, n in enumerate(sizes)]
    fq = "\n".join(f"@{a}\n{s}\n+\n{q}" for a, s, q in recs) + end
    fa = "\n".join(f">{a}\n{s[:40]}\n{s[40:]}" for a, s, _ in recs) + end
    for name, text, reader in (("fq", fq, R.read_fastq), ("fa", fa, lambda s, p: R.read_fasta(s, p).selectExpr("ord", "name", "seq", "CAST(NULL AS STRING) AS qual"))):
        (tmp_path / name).write_text(text)
        (tmp_path / f"{name}.bgz").write_bytes(pack(text, 3000))
        plain = sorted(map(tuple, reader(spark, str(tmp_path / name)).collect()))
        got = fastx.read_blocked(spark, str(tmp_path / f"{name}.bgz"), split=20_000)
        assert got.rdd.getNumPartitions() > 2 and sorted(map(tuple, got.collect())) == plain and len(plain) == 600
        assert sorted(map(tuple, R.read_reads(spark, str(tmp_path / f"{name}.bgz")).collect())) == plain
        assert R.detect_format(spark, str(tmp_path / f"{name}.bgz")) == ("fastq" if name == "fq" else "fasta")
    two = R.read_reads(spark, [str(tmp_path / "fq.bgz"), str(tmp_path / "fq.bgz")])
    if end == "\n":
        assert two.select("ord").distinct().count() == 1200 and two.agg({"ord": "max"}).first()[0] == 4 * 1199


def test_plain_gzip_is_read_by_one_task_and_says_so(spark, tmp_path):
    (tmp_path / "a.fq.gz").write_bytes(gzip.compress(b"@r1\nAC\n+\nII\n@r2\nG\n+\n!\n"))
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        rows = R.read_reads(spark, str(tmp_path / "a.fq.gz")).orderBy("ord").collect()
    assert [r.name for r in rows] == ["r1", "r2"] and any("one task" in str(w.message) for w in said)
    cut = pack("@r1\nAC\n+\nII\n@r2\nG\n+", 100)
    (tmp_path / "cut.bgz").write_bytes(cut)
    with pytest.raises(Exception, match="truncated"):
        fastx.read_blocked(spark, str(tmp_path / "cut.bgz")).collect()
