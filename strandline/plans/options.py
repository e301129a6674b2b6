"""Parameters and their defaults."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class PoolOptions:
    len_a: int = 5000
    id_a: float = 0.90
    len_b: int = 3000
    id_b: float = 0.98
    secondary: bool = True


@dataclass(frozen=True)
class DownsampleOptions:
    target_coverage: int = 200
    bin_size: int = 500
    spanning_fraction: float = 0.80
    min_mapq: int = 10
    skip: bool = False


@dataclass(frozen=True)
class ScrubOptions:
    min_mapq: int = 20
    min_mapped_fraction: float = 0.80
    max_softclip_fraction: float = 0.20
    window: int = 500
    step: int = 100
    coverage_ratio: float = 0.20


@dataclass(frozen=True)
class GraphOptions:
    window: int = 500
    min_identity: float = 75.0
    min_overlap: int = 100
    top_out: int = 5
    expected_size: int = 494000
    size_tolerance: float = 0.20
    max_depth: int = 8
    max_cycles: int = 30
    max_linear: int = 50
    max_any: int = 200
    fasta_top: int = 20


@dataclass(frozen=True)
class JoinOptions:
    window: int = 500
    min_identity: float = 75.0
    min_overlap: int = 100
    expected_size: int = 494000
    size_tolerance: float = 0.20
    compat: bool = False


@dataclass(frozen=True)
class RunOptions:
    """What the steps outside the library are told: threads and the genome size, which only the record keeps."""

    threads: int = 4
    genome_size: int = 494000
    assembler: str = "external"


#: Named presets (len_a, id_a, len_b, id_b).
PRESETS = {
    1: (8000, 0.92, 5000, 0.98),
    2: (5000, 0.90, 3000, 0.98),
    3: (5000, 0.90, 2000, 0.95),
    4: (4000, 0.85, 2000, 0.92),
    5: (5000, 0.80, 1500, 0.90),
    6: (5000, 0.70, 1000, 0.85),
    7: (3000, 0.80, 1000, 0.90),
    8: (3000, 0.75, 800, 0.85),
    9: (10000, 0.70, 5000, 0.80),
    10: (2000, 0.70, 500, 0.80),
    11: (1000, 0.85, 500, 0.90),
    12: (3000, 0.95, 1000, 0.98),
}


def presets(spark: SparkSession, scale: int = 1) -> DataFrame:
    """The presets as a table; lengths times scale."""
    return spark.createDataFrame([(k, a * scale, ia, b * scale, ib) for k, (a, ia, b, ib) in PRESETS.items()], "preset int, len_a long, id_a double, len_b long, id_b double")


def run_parameters(**options) -> dict:
    """One document of all options, for a run's record."""
    return {name: asdict(value) if hasattr(value, "__dataclass_fields__") else value for name, value in options.items()}
