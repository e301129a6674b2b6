"""Binary alignment files: a batch source whose partitions begin at records, and a sorted sink with a position index."""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from . import blocks as B

#: Operations and bases by code, sizes of tag values, what consumes the reference.
OPS, BASES = "MIDNSHP=X", "=ACMGRSVTWYHKDBN"
_SIZES = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
_ON_REFERENCE = np.array([c in "MDN=X" for c in OPS] + [False] * 7)
_PAIRS = np.array([a + b for a in BASES for b in BASES], "S2")
_COLUMNS = StructType().add("qname", "string").add("flag", "integer").add("tname", "string").add("ref_start", "long").add("ref_end", "long").add("mapq", "integer").add("cigar", "string").add("seq", "string").add("qual", "string").add("record", "binary")
#: What a reader of SAM text gives.
PLAIN = tuple(c for c in _COLUMNS.names if c != "record")
#: Compressed bytes in one partition.
SPLIT = 32 << 20


def parse_header(data: bytes) -> tuple[str, list[tuple[str, int]], int] | None:
    """(text, contigs with their lengths, bytes) of the header that data begins with, None if it isn't whole."""
    if data[:4] != b"BAM\1"[: len(data)]:
        raise ValueError("not a binary alignment file")
    try:
        n = struct.unpack_from("<i", data, 4)[0]
        text, at = data[8 : 8 + n].rstrip(b"\0").decode(), 8 + n
        refs = []
        count = struct.unpack_from("<i", data, at)[0]
        at += 4
        for _ in range(count):
            m = struct.unpack_from("<i", data, at)[0]
            refs.append((data[at + 4 : at + 3 + m].decode(), struct.unpack_from("<i", data, at + 4 + m)[0]))
            at += 8 + m
        return text, refs, at
    except struct.error:
        return None


def read_header(uri: str) -> tuple[str, list[tuple[str, int]], int]:
    """(text, contigs with their lengths, uncompressed bytes) of the header of a file or of a folder's first file."""
    system, _ = B.place(uri)
    files = B.listing(uri)
    if not files:
        raise ValueError(f"{uri} holds no files")
    with system.open_input_file(files[0][0]) as f:
        data = b""
        for _, payload in B.blocks(f, files[0][1], 0):
            data += payload
            if len(data) >= 4 and (got := parse_header(data)):
                return got
    raise ValueError(f"{files[0][0]}: the header is cut off")


def header_bytes(text: str, refs: list[tuple[str, int]]) -> bytes:
    names = b"".join(struct.pack("<i", len(n.encode()) + 1) + n.encode() + b"\0" + struct.pack("<i", size) for n, size in refs)
    return b"BAM\1" + struct.pack("<i", len(text.encode())) + text.encode() + struct.pack("<i", len(refs)) + names


def cut(buf: bytes, at: int, whole: bool) -> tuple[list[int], int]:
    starts, n, read = [], len(buf), struct.Struct("<i").unpack_from
    while at + 4 <= n:
        size = read(buf, at)[0]
        if size < 32:
            raise ValueError("a record's size can't be right: the file is damaged")
        if at + 4 + size > n:
            break
        starts.append(at)
        at += 4 + size
    if whole and at != n:
        raise ValueError("the last record is cut off: the file is truncated")
    return starts, at


def border(n_refs: int) -> B.Border:
    """The first position behind another at which a chain of records that could be right begins."""

    def fits(b: np.ndarray, at: np.ndarray) -> np.ndarray:
        i32 = lambda k: np.ascontiguousarray(b[at[:, None] + np.arange(k, k + 4)]).view("<i4").ravel().astype(np.int64)
        size, ref, pos, n_seq, ref2, pos2 = (i32(k) for k in (0, 4, 8, 20, 24, 28))
        n_name, n_cigar = b[at + 12].astype(np.int64), b[at + 16].astype(np.int64) + (b[at + 17].astype(np.int64) << 8)
        ok = (size >= 32) & (ref >= -1) & (ref < n_refs) & (ref2 >= -1) & (ref2 < n_refs) & (pos >= -1) & (pos2 >= -1) & (n_seq >= 0) & (n_name > 0)
        return ok & (32 + n_name + 4 * n_cigar + (n_seq + 1) // 2 + n_seq <= size)

    def find(buf: bytes, behind: int, whole: bool) -> int | None:
        b = np.frombuffer(buf, np.uint8)
        for low in range(behind + 1, len(b) - 35, 1 << 16):
            at = np.arange(low, min(low + (1 << 16), len(b) - 35))
            for x in at[fits(b, at)].tolist():
                y, seen = x, 0
                while seen < 16 and y + 36 <= len(b) and fits(b, np.array([y]))[0]:
                    end = y + 35 + int(b[y + 12])
                    if end < len(b) and (b[end] or not ((b[y + 36 : end] > 32) & (b[y + 36 : end] < 127)).all()):
                        break
                    y, seen = y + 4 + int(struct.unpack_from("<i", buf, y)[0]), seen + 1
                else:
                    if seen >= 16 or y == len(b) or (not whole and y > len(b) - 36 and seen >= 2):
                        return x
        return None

    return find


def _tag(tags: bytes, name: bytes) -> bytes | None:
    """The value bytes of an integer array tag."""
    at = 0
    while at + 3 <= len(tags):
        kind = chr(tags[at + 2])
        if kind in _SIZES:
            n = _SIZES[kind]
        elif kind in "ZH":
            n = tags.index(b"\0", at + 3) - at - 2
        else:
            n = 5 + _SIZES[chr(tags[at + 3])] * struct.unpack_from("<i", tags, at + 4)[0]
            if tags[at : at + 2] == name:
                return tags[at + 8 : at + 3 + n]
        at += 3 + n
    return None


def decode(buf: bytes, starts: list[int], refs: list[str], columns: list[str]) -> pa.RecordBatch:
    """Records, whose last edge is the end, as the given columns only."""
    at, ends = np.array(starts[:-1]), starts[1:]
    core = np.frombuffer(buf, np.uint8)[at[:, None] + np.arange(36)]
    i32 = lambda k: np.ascontiguousarray(core[:, k : k + 4]).view("<i4").ravel()
    u16 = lambda k: np.ascontiguousarray(core[:, k : k + 2]).view("<u2").ravel()
    ref, pos, n_name, n_cigar, n_seq = i32(4), i32(8).astype(np.int64), core[:, 12], u16(16), i32(20)
    names = at + 36
    cigars = names + n_name
    seqs = cigars + 4 * n_cigar.astype(np.int64)
    quals = seqs + (n_seq.astype(np.int64) + 1) // 2
    out: dict[str, pa.Array] = {}
    if {"cigar", "ref_end"} & set(columns):
        ops = []
        for k, (a, n, m) in enumerate(zip(cigars.tolist(), n_cigar.tolist(), n_seq.tolist(), strict=True)):
            x = np.frombuffer(buf, "<u4", n, a)
            if n == 2 and x[0] == m << 4 | 4 and x[1] & 15 == 3 and (long := _tag(buf[quals[k] + m : ends[k]], b"CG")) is not None:
                # More operations than the field holds are kept in a tag.
                x = np.frombuffer(long, "<u4")
            ops.append(x)
        if "cigar" in columns:
            out["cigar"] = pa.array(["".join([f"{v >> 4}{OPS[v & 15]}" for v in x.tolist()]) or "*" for x in ops])
        if "ref_end" in columns:
            span = [int((x >> 4)[_ON_REFERENCE[x & 15]].sum()) for x in ops]
            out["ref_end"] = pa.array(pos + np.array(span, np.int64), pa.int64())
    if "qname" in columns:
        out["qname"] = pa.array([buf[a : a + n - 1].decode() for a, n in zip(names.tolist(), n_name.tolist(), strict=True)])
    if "tname" in columns:
        out["tname"] = pa.array([refs[r] if r >= 0 else "*" for r in ref.tolist()])
    if "seq" in columns:
        raw = np.frombuffer(buf, np.uint8)
        out["seq"] = pa.array([_PAIRS[raw[a : a + (n + 1) // 2]].tobytes()[:n].decode() for a, n in zip(seqs.tolist(), n_seq.tolist(), strict=True)])
    if "qual" in columns:
        raw = np.frombuffer(buf, np.uint8)
        out["qual"] = pa.array(["" if not n or raw[a] == 255 else (raw[a : a + n] + 33).tobytes().decode("latin-1") for a, n in zip(quals.tolist(), n_seq.tolist(), strict=True)])
    if "record" in columns:
        out["record"] = pa.array([buf[a:b] for a, b in zip(starts[:-1], ends, strict=True)], pa.binary())
    out |= {"flag": pa.array(u16(18).astype(np.int32)), "ref_start": pa.array(pos), "mapq": pa.array(core[:, 13].astype(np.int32))}
    return pa.RecordBatch.from_arrays([out[c] for c in columns], names=columns)


@dataclass
class Part(InputPartition):
    path: str
    size: int
    start: int
    stop: int
    skip: int | None


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.uri, self.columns, self.split = options["path"], schema.names, int(options.get("split", SPLIT))
        _, refs, self.header = read_header(self.uri)
        self.refs = [n for n, _ in refs]

    def partitions(self) -> list[InputPartition]:
        """Parts of `split` bytes; a folder's files are read as one, the header in the first."""
        system, _ = B.place(self.uri)
        files, out = B.listing(self.uri), []
        with system.open_input_file(files[-1][0]) as f:
            f.seek(max(0, files[-1][1] - len(B.LAST)))
            if f.read() != B.LAST:
                raise ValueError(f"{files[-1][0]} doesn't end with the empty block: it is truncated")
        for k, (path, size) in enumerate(files):
            out += [Part(path, size, a, min(size, a + self.split), (0 if k else self.header) if not a else None) for a in range(0, size, self.split)]
        return out

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        system, _ = B.place(self.uri)
        with system.open_input_file(part.path) as f:
            for buf, starts in B.records(f, part.size, part.start, part.stop, cut, border(len(self.refs)), part.skip):
                for k in range(0, len(starts) - 1, 5000):
                    yield decode(buf, starts[k : k + 5001], self.refs, self.columns)


@dataclass
class _Written(WriterCommitMessage):
    part: int
    name: str | None


class _Writer(DataSourceArrowWriter):
    """Tasks write their blocks, and the position index of them, beside the target; the commit puts the header first, the parts in order and the empty block last."""

    def __init__(self, options: dict, overwrite: bool):
        self.uri, self.overwrite = options["path"], overwrite
        self.header = bytes.fromhex(options["header"])
        self.tmp = f"{B.place(self.uri)[1]}/_writing-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        import pyarrow.parquet as pq

        task, (system, _) = TaskContext.get(), B.place(self.uri)
        part, name = task.partitionId(), f"{task.partitionId() + 1:06d}-{task.taskAttemptId()}"
        system.create_dir(self.tmp, recursive=True)
        index, at, run, size, last = [], 0, [], 0, None

        def flush(out) -> None:
            nonlocal at, run, size
            if run:
                raw = b"".join(run)
                packed = b"".join(B.pack_block(raw[k : k + B.PAYLOAD]) for k in range(0, len(raw), B.PAYLOAD))
                places = [_span(x) for x in run]
                index.append((part + 1, at, len(packed), last, min(p for p, _ in places), max(e for _, e in places), len(run)))
                out.write(packed)
                at, run, size = at + len(packed), [], 0

        with system.open_output_stream(f"{self.tmp}/{name}") as out:
            for b in batches:
                for record in b.column(b.schema.get_field_index("record")).to_pylist():
                    ref = struct.unpack_from("<i", record, 4)[0]
                    if size + len(record) > B.PAYLOAD or ref != last:
                        flush(out)
                    last = ref
                    run.append(record)
                    size += len(record)
            flush(out)
        rows = list(zip(*index, strict=True)) or [()] * 7
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        pq.write_table(pa.table([pa.array(c, t) for c, t in zip(rows, kinds, strict=True)], names=["part", "offset", "bytes", "ref", "first", "behind", "n"]), f"{self.tmp}/{name}.parquet", filesystem=system)
        return _Written(part, name if index else None)

    def commit(self, messages: list[_Written | None]) -> None:
        system, path = B.place(self.uri)
        done = sorted((m.part, m.name) for m in messages if m and m.name)
        old = [x for x in system.get_file_info(_children(path)) if x.path != self.tmp]
        if old and not self.overwrite:
            raise FileExistsError(self.uri)
        for x in old:
            system.delete_file(x.path) if x.is_file else system.delete_dir(x.path)
        system.create_dir(f"{path}/_index", recursive=True)
        with system.open_output_stream(f"{path}/000000.bam") as f:
            for k in range(0, len(self.header), B.PAYLOAD):
                f.write(B.pack_block(self.header[k : k + B.PAYLOAD]))
        for part, name in done:
            system.move(f"{self.tmp}/{name}", f"{path}/{part + 1:06d}.bam")
            system.move(f"{self.tmp}/{name}.parquet", f"{path}/_index/{part + 1:06d}.parquet")
        # Behind all parts, whose names have six digits.
        with system.open_output_stream(f"{path}/999999.bam") as f:
            f.write(B.LAST)
        if system.get_file_info(self.tmp).type.name == "Directory":
            system.delete_dir(self.tmp)

    def abort(self, messages: list[_Written | None]) -> None:
        system, _ = B.place(self.uri)
        if system.get_file_info(self.tmp).type.name == "Directory":
            system.delete_dir(self.tmp)


def _children(path: str):
    from pyarrow import fs

    return fs.FileSelector(path, allow_not_found=True)


def _span(record: bytes) -> tuple[int, int]:
    """(first base, first base behind) of a record on its contig; one base where nothing is aligned."""
    pos, n_name, n_cigar, n_seq = struct.unpack_from("<i", record, 8)[0], record[12], *struct.unpack_from("<H", record, 16), struct.unpack_from("<i", record, 20)[0]
    x = np.frombuffer(record, "<u4", n_cigar, 36 + n_name)
    if n_cigar == 2 and x[0] == n_seq << 4 | 4 and x[1] & 15 == 3:
        return pos, pos + int(x[1] >> 4)
    return pos, pos + max(1, int((x >> 4)[_ON_REFERENCE[x & 15]].sum()))


class BamSource(DataSource):
    """spark.read.format("bam") and df.write.format("bam"). Options: path, split (bytes of a partition), columns (comma-separated), and, to write, header in hex."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> StructType:
        names = [c for c in self.options.get("columns", ",".join(PLAIN)).split(",") if c]
        return StructType([_COLUMNS[c] for c in names])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options), schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(dict(self.options), overwrite)


def read_bam(spark: SparkSession, path: str, columns: tuple[str, ...] = PLAIN, split: int = SPLIT) -> DataFrame:
    """Alignments as read_sam gives them, from a block-compressed binary file or a written folder; 'record' is the record's bytes. Only the given columns are decoded. A truncated file is an error."""
    spark.dataSource.register(BamSource)
    return spark.read.format("bam").option("path", path).option("columns", ",".join(columns)).option("split", str(split)).load()


def read_bam_contigs(spark: SparkSession, path: str) -> DataFrame:
    """name, length of the header's contigs."""
    return spark.createDataFrame(read_header(path)[1], "name string, length long")


def encode_line(line: str, refs: dict[str, int]) -> bytes:
    """One line of SAM text as a record."""
    f = line.split("\t")
    name, cigar, seq, qual = f[0].encode() + b"\0", re.findall(r"(\d+)([MIDNSHP=X])", f[5]), "" if f[9] == "*" else f[9], f[10]
    ref, pos = refs[f[2]] if f[2] != "*" else -1, int(f[3]) - 1
    mate = ref if f[6] == "=" else refs[f[6]] if f[6] != "*" else -1
    ops, extra = [int(n) << 4 | OPS.index(o) for n, o in cigar], b""
    span = sum(x >> 4 for x in ops if _ON_REFERENCE[x & 15])
    if len(ops) > 65535:
        extra = b"CGBI" + struct.pack(f"<i{len(ops)}I", len(ops), *ops)
        ops = [len(seq) << 4 | 4, span << 4 | 3]
    codes = [BASES.find(c.upper()) % 16 for c in seq] + [0] * (len(seq) % 2)
    packed = bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2], strict=True))
    scores = b"\xff" * len(seq) if qual == "*" else bytes(ord(c) - 33 for c in qual)
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(name), int(f[4]), _bin(pos, pos + max(1, span)), len(ops), int(f[1]), len(seq), mate, int(f[7]) - 1, int(f[8])) + name + struct.pack(f"<{len(ops)}I", *ops) + packed + scores
    body += b"".join(map(_tag_bytes, f[11:])) + extra
    return struct.pack("<i", len(body)) + body


def _bin(a: int, b: int) -> int:
    """The smallest interval of the format's six-level binning that holds positions a to b - 1."""
    for shift, levels in ((14, 5), (17, 4), (20, 3), (23, 2), (26, 1)):
        if a >> shift == (b - 1) >> shift:
            return (((1 << 3 * levels) - 1) // 7 + (a >> shift)) & 0xFFFF
    return 0


def _tag_bytes(text: str) -> bytes:
    name, kind, value = text.split(":", 2)
    if kind == "i":
        v = int(value)
        return name.encode() + (b"i" + struct.pack("<i", v) if v < 1 << 31 else b"I" + struct.pack("<I", v))
    if kind == "f":
        return name.encode() + b"f" + struct.pack("<f", float(value))
    if kind == "B":
        sub, *items = value.split(",")
        code = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}[sub]
        return name.encode() + b"B" + sub.encode() + struct.pack(f"<i{len(items)}{code}", len(items), *(float(x) if sub == "f" else int(x) for x in items))
    return name.encode() + kind.encode() + value.encode() + (b"" if kind == "A" else b"\0")


def encode_sam(lines: DataFrame, refs: list[str]) -> DataFrame:
    """Lines of SAM text (value) without their header as records."""
    number = {n: k for k, n in enumerate(refs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([encode_line(x, number) for x in b.column(0).to_pylist()], pa.binary())], names=["record"])

    return lines.select("value").mapInArrow(run, "record binary")


def write_bam(records: DataFrame, path: str, text: str, refs: list[tuple[str, int]], overwrite: bool = True) -> None:
    """Records (record) sorted by contig and position, those without a contig last, as a folder of parts whose bytes in order are one valid file, and an index of their blocks under _index.

    Records are dealt out by ranges of (contig, position, a hash of the record), so one position with
    very many of them is no hot spot; among equal positions forward strands come first, as in other
    sorters, then the hash decides. A part's blocks begin at records and hold one contig each.
    """
    spark = records.sparkSession
    spark.dataSource.register(BamSource)
    system, where = B.place(path)
    if not overwrite and system.get_file_info(_children(where)):
        raise FileExistsError(path)
    text = re.sub(r"\tSO:\w+", "\tSO:coordinate", text) if "\tSO:" in text.split("\n")[0] else re.sub(r"^(@HD[^\n]*)", "\\1\tSO:coordinate", text)
    if not text.startswith("@HD"):
        text = "@HD\tVN:1.6\tSO:coordinate\n" + text
    byte = lambda k: F.conv(F.hex(F.substring("record", k, 1)), 16, 10).cast("long")
    i32 = lambda k: sum(((byte(k + i + 1) * (1 << 8 * i)) for i in range(1, 4)), byte(k + 1)).cast("long")
    # -1 reads as 2^32 - 1 here, which puts records without a contig last.
    keyed = records.select("record", i32(4).alias("r"), i32(8).alias("p"), byte(19).bitwiseAND(16).alias("s"), F.xxhash64("record").alias("h"))
    order = ["r", "p", "s", "h"]
    n = max(1, min(999_998, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).select("record").write.format("bam").mode("overwrite").option("path", path).option("columns", "record").option("header", header_bytes(text, refs).hex()).save()


def read_region(spark: SparkSession, path: str, contig: str, start: int, end: int, columns: tuple[str, ...] = PLAIN) -> DataFrame:
    """Alignments of a written folder that overlap bases start to end - 1 of a contig. Only the blocks that the index gives for them are read, a row of the index at a time."""
    _, refs, _ = read_header(path)
    names = [n for n, _ in refs]
    hits = spark.read.parquet(f"{path}/_index").where((F.col("ref") == names.index(contig)) & (F.col("first") < end) & (F.col("behind") > start)).select("part", "offset", "bytes")
    wanted = list(dict.fromkeys([*columns, "ref_start", "ref_end"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = B.place(path)
        for b in batches:
            for part, at, size in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with system.open_input_file(f"{top}/{part:06d}.bam") as f:
                    data = b"".join(p for _, p in B.blocks(pa.BufferReader(f.read_at(size, at)), size, 0))
                starts, last = cut(data, 0, True)
                yield decode(data, [*starts, last], names, wanted)

    made = hits.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(run, StructType([_COLUMNS[c] for c in wanted]))
    return made.where((F.col("ref_start") < end) & (F.greatest("ref_end", F.col("ref_start") + 1) > start)).select(*columns)
