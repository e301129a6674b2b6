"""Block-compressed reads and sequences: a batch source whose partitions begin at records."""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from . import blocks as B

SPLIT = 16 << 20
_ROWS = StructType().add("part", "integer").add("k", "long").add("name", "string").add("seq", "string").add("qual", "string")
_COUNTS = StructType().add("part", "integer").add("n", "long")


def _line_ends(buf: bytes, at: int, whole: bool) -> np.ndarray:
    ends = np.flatnonzero(np.frombuffer(buf, np.uint8)[at:] == 10) + at
    return np.append(ends, len(buf)) if whole and len(buf) > at and buf[-1:] != b"\n" else ends


def cut_fastq(buf: bytes, at: int, whole: bool) -> tuple[list[int], int]:
    ends = _line_ends(buf, at, whole)
    n = len(ends) // 4
    stops = np.minimum(ends[3 : 4 * n : 4] + 1, len(buf)).tolist()
    end = stops[-1] if stops else at
    if whole and end < len(buf):
        if buf[end:].strip():
            raise ValueError("the last record is cut off: the file is truncated")
        end = len(buf)
    return [at, *stops[:-1]] if stops else [], end


def border_fastq(buf: bytes, behind: int, whole: bool) -> int | None:
    """The first line behind a position that begins a record: '@', and two lines on '+', between them as much sequence as there is quality after. A quality line that begins with '@' has a sequence two lines on, which doesn't begin with '+'."""
    ends = _line_ends(buf, behind, whole).tolist()
    line = lambda k: buf[ends[k - 1] + 1 : ends[k]].rstrip(b"\r")
    for k in range(1, len(ends) - 3):
        if buf[ends[k - 1] + 1 : ends[k - 1] + 2] == b"@" and line(k + 2)[:1] == b"+" and len(line(k + 1)) == len(line(k + 3)):
            return ends[k - 1] + 1
    return None


def cut_fasta(buf: bytes, at: int, whole: bool) -> tuple[list[int], int]:
    starts = [m.start() for m in re.finditer(rb"^>", buf[at:], re.M)]
    starts = [at + x for x in starts]
    return (starts, len(buf)) if whole else (starts[:-1], starts[-1] if starts else at)


def border_fasta(buf: bytes, behind: int, whole: bool) -> int | None:
    k = buf.find(b"\n>", behind)
    return k + 1 if k >= 0 else None


@dataclass
class Part(InputPartition):
    number: int
    path: str
    size: int
    start: int
    stop: int
    fastq: bool


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.uris, self.split, self.count = options["paths"].split("\n"), int(options["split"]), options.get("count") == "true"

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        for uri in self.uris:
            system, _ = B.place(uri)
            for path, size in B.listing(uri):
                with system.open_input_file(path) as f:
                    first = next((p[:1] for _, p in B.blocks(f, size, 0) if p), b"")
                out += [Part(len(out) + k, f"{uri}\n{path}", size, a, min(size, a + self.split), first == b"@") for k, a in enumerate(range(0, size, self.split))]
        return out

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        uri, path = part.path.split("\n")
        rules, n = (cut_fastq, border_fastq) if part.fastq else (cut_fasta, border_fasta), 0
        with B.place(uri)[0].open_input_file(path) as f:
            for buf, starts in B.records(f, part.size, part.start, part.stop, *rules, None if part.start else 0):
                if not self.count:
                    for k in range(0, len(starts) - 1, 5000):
                        yield _fastq_rows(part.number, n + k, buf, starts[k : k + 5001]) if part.fastq else _fasta_rows(part.number, n + k, buf, starts[k : k + 5001])
                n += len(starts) - 1
        if self.count:
            yield pa.RecordBatch.from_arrays([pa.array([part.number], pa.int32()), pa.array([n], pa.int64())], names=_COUNTS.names)


def _rows(part: int, at: int, names: list, seqs: list, quals: list) -> pa.RecordBatch:
    n = len(names)
    cols = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n)), pa.array([x.split(None, 1)[0].decode() if x.strip() else "" for x in names], pa.string()), pa.array([x.decode() for x in seqs], pa.string()), pa.array([x if x is None else x.decode() for x in quals], pa.string())]
    return pa.RecordBatch.from_arrays(cols, names=_ROWS.names)


def _fastq_rows(part: int, at: int, buf: bytes, starts: list[int]) -> pa.RecordBatch:
    lines = [x.rstrip(b"\r") for x in buf[starts[0] : starts[-1]].rstrip(b"\r\n").split(b"\n")]
    n = len(starts) - 1
    lines += [b""] * (4 * n - len(lines))
    if any(x[:1] != b"@" for x in lines[: 4 * n : 4]):
        raise ValueError("a record doesn't begin with '@'")
    return _rows(part, at, [x[1:] for x in lines[: 4 * n : 4]], lines[1 : 4 * n : 4], lines[3 : 4 * n : 4])


def _fasta_rows(part: int, at: int, buf: bytes, starts: list[int]) -> pa.RecordBatch:
    split = [buf[a + 1 : b].split(b"\n", 1) for a, b in zip(starts, starts[1:], strict=False)]
    return _rows(part, at, [x[0] for x in split], [b"".join(x[1].split()) if len(x) > 1 else b"" for x in split], [None] * len(split))


class ReadsSource(DataSource):
    """spark.read.format("blocked_reads"); read_blocked gives it its options."""

    @classmethod
    def name(cls) -> str:
        return "blocked_reads"

    def schema(self) -> StructType:
        return _COUNTS if self.options.get("count") == "true" else _ROWS

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))


def read_blocked(spark: SparkSession, paths: str | list[str], split: int = SPLIT) -> DataFrame:
    """ord, name, seq, qual of block-compressed FASTQ or FASTA files (qual null), in as many partitions as `split` compressed bytes make.

    ord is what the plain files' readers give: lines of FASTQ, records of FASTA, over all files in
    order. The records of each part are counted first; a row a part is ordered and broadcast.
    """
    spark.dataSource.register(ReadsSource)
    given = [paths] if isinstance(paths, str) else paths
    source = spark.read.format("blocked_reads").option("paths", "\n".join(given)).option("split", str(split))
    counts = source.option("count", "true").load()
    before = counts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    rows = spark.read.format("blocked_reads").option("paths", "\n".join(given)).option("split", str(split)).load()
    each = F.when(F.col("qual").isNull(), 1).otherwise(4)
    return rows.join(F.broadcast(before), "part").select(((F.col("before") + F.col("k")) * each).alias("ord"), "name", "seq", "qual")


def warn_of_gzip(paths: str | list[str]) -> None:
    for p in [paths] if isinstance(paths, str) else paths:
        if p.endswith(".gz"):
            warnings.warn(f"{p} is plain gzip, which can't be read in parts: one task reads it. Block-compressed files are read by many.", stacklevel=3)
