"""Pools, best hits and depth over streams: an extension, the batch operators do not need it.

Best hits and depth keep keyed state with `transformWithStateInPandas`, so the session's state store
must be RocksDB (`stateful` sets it). They write updates; `best_hits_of` and `depth_of` turn a table of updates
into what the batch operator gives for all rows that arrived, however these were split into batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.coverage import BLOCK, runs_of
from ..operators.pools import best_hit, dual_threshold
from ..plans.options import PoolOptions


def stream_pools(aln: DataFrame, options: PoolOptions = PoolOptions(), event_time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Distinct (chrom, read) of arriving alignments; with an event time, state older than delay is dropped."""
    rows = dual_threshold(aln, options).select(F.col("tname").alias("chrom"), F.col("qname").alias("read"), *([event_time] if event_time else []))
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["chrom", "read"]) if event_time else rows.dropDuplicates(["chrom", "read"])


def stream_counts(events: DataFrame, every: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Counts and sums of events (ts, event_type, value) by window and type, late rows up to delay included."""
    return events.withWatermark("ts", delay).groupBy(F.window("ts", every), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def stateful(spark: SparkSession) -> SparkSession:
    """Set the state store that keyed state with timers needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return spark


class _Timed(StatefulProcessor):
    """State of a key that ends once the watermark has passed its last event by `idle` milliseconds; without an idle time it stays."""

    schema = ""

    def __init__(self, idle: int | None):
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("state", self.schema)

    def _wait(self, last: int) -> None:
        """One timer a key, at its last event and the idle time."""
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(last + self.idle)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """All that the key has to say is among its updates already."""
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def _rank(n_match: int, aln_len: int, tname: str | None) -> tuple:
    return -n_match, -aln_len, tname is not None, tname or ""


class _BestHits(_Timed):
    schema = "tname string, n_match long, aln_len long, last long"

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = self.state.get() if self.state.exists() else None
        best, last = (before[:3], before[3]) if before else (None, 0)
        for part in rows:
            for t, n, size, at in zip(part["tname"], part["n_match"], part["aln_len"], part["at"], strict=True):
                t, last = None if pd.isna(t) else t, max(last, int(at))
                if best is None or _rank(n, size, t) < _rank(best[1], best[2], best[0]):
                    best = (t, int(n), int(size))
        if self.idle is not None:
            self._wait(last)
        self.state.update((*best, last))
        if before is None or tuple(before[:3]) != tuple(best):
            yield pd.DataFrame({"qname": pd.Series([key[0]], dtype=object), "tname": pd.Series([best[0]], dtype=object), "n_match": [best[1]], "aln_len": [best[2]]})


def _millis(event_time: str | None):
    return F.unix_millis(F.col(event_time).cast("timestamp")) if event_time else F.lit(0).cast("long")


def _watched(rows: DataFrame, event_time: str | None, delay: str) -> DataFrame:
    """rows with `at` in milliseconds as an event time; the steps before this one lose the mark of a watermark."""
    return rows.withColumn("event_time", F.timestamp_millis("at")).withWatermark("event_time", delay) if event_time else rows


def stream_best_hits(aln: DataFrame, options: PoolOptions = PoolOptions(), event_time: str | None = None, delay: str = "1 hour", idle: str | None = None) -> DataFrame:
    """Updates qname, tname, n_match, aln_len of arriving alignments: a read's best hit whenever a better one comes, for the output mode `update`.

    The rules are those of `dual_threshold` and `best_hit`. With an event time, rows later than
    `delay` are dropped and a read's state ends when nothing came for `idle` (a pandas interval,
    `delay` by default). A read that comes again later starts anew, which `best_hits_of` settles, since
    updates are hits. Tasks pass one row a read and Arrow batch on to the state; an empty stream gives no update.
    """
    stateful(aln.sparkSession)
    rows = dual_threshold(aln, options).select("qname", "tname", F.col("n_match").cast("long").alias("n_match"), F.col("aln_len").cast("long").alias("aln_len"), _millis(event_time).alias("at"))

    def fewer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["at"] = b.groupby("qname", dropna=False)["at"].transform("max")
            yield b.sort_values(["n_match", "aln_len", "tname"], ascending=[False, False, True], na_position="first").drop_duplicates("qname")

    rows = _watched(rows.mapInPandas(fewer, rows.schema), event_time, delay)
    keep_for = int(pd.Timedelta(idle or delay).total_seconds() * 1000) if event_time else None
    return rows.groupBy("qname").transformWithStateInPandas(_BestHits(keep_for), "qname string, tname string, n_match long, aln_len long", "Update", "EventTime" if event_time else "None")


def best_hits_of(updates: DataFrame) -> DataFrame:
    """The best hit of each read from the updates of `stream_best_hits`; repeated updates change nothing."""
    return best_hit(updates.select("qname", "tname", "n_match", "aln_len"))


class _Depth(_Timed):
    schema = "born long, version long, last long, pos array<long>, d array<long>"

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            born, version, last, pos, d = self.state.get()
        else:
            born, version, last, pos, d = timerValues.getCurrentWatermarkInMs() if self.idle is not None else 0, 0, 0, [], []
        total = pd.Series(np.asarray(d, "int64"), index=np.asarray(pos, "int64"))
        for part in rows:
            last = max(last, int(part["at"].max()))
            total = total.add(part.groupby("pos")["d"].sum(), fill_value=0)
        total = total[total != 0].astype("int64").sort_index()
        if self.idle is not None:
            self._wait(last)
        pos, d = total.index.tolist(), total.tolist()
        self.state.update((int(born), version + 1, last, pos, d))
        yield pd.DataFrame({"ref": pd.Series([key[0]], dtype=object), "block": [int(key[1])], "born": [int(born)], "version": [version + 1], "pos": [pos], "d": [d]})


def stream_depth(iv: DataFrame, event_time: str | None = None, delay: str = "1 hour", idle: str | None = None) -> DataFrame:
    """Updates (ref, block, born, version, pos, d) of arriving intervals (ref, st, en): where the depth of a block changes and by how much, for the output mode `update`.

    An interval is cut at the borders of blocks of 16384 positions, so the depth of a block is its own and
    its state has at most a number a position. An update replaces those of the same (ref, block,
    born) with a smaller version. Event time, delay and idle are as in `stream_best_hits`; a block
    that comes again after its end is born again, at a later watermark, and adds to what it had. Tasks add up changes
    an Arrow batch before the shuffle, so a block that holds most intervals is still few rows. Intervals that
    are empty or have a null change nothing.
    """
    stateful(iv.sparkSession)
    st, en = F.col("st").cast("long"), F.col("en").cast("long")
    whole = iv.where("ref IS NOT NULL AND en > st").select("ref", st.alias("st"), en.alias("en"), _millis(event_time).alias("at"))
    cut = whole.withColumn("block", F.explode(F.sequence(F.floor(F.col("st") / BLOCK), F.floor((F.col("en") - 1) / BLOCK))))
    ends = F.array(F.struct(F.greatest("st", F.col("block") * BLOCK).alias("pos"), F.lit(1).cast("long").alias("d")), F.struct(F.least("en", (F.col("block") + 1) * BLOCK).alias("pos"), F.lit(-1).cast("long").alias("d")))
    rows = cut.select("ref", "block", "at", F.explode(ends).alias("e")).select("ref", "block", "e.pos", "e.d", "at")

    def fewer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.groupby(["ref", "block", "pos"], as_index=False, sort=False).agg({"d": "sum", "at": "max"})

    rows = _watched(rows.mapInPandas(fewer, rows.schema), event_time, delay)
    keep_for = int(pd.Timedelta(idle or delay).total_seconds() * 1000) if event_time else None
    return rows.groupBy("ref", "block").transformWithStateInPandas(_Depth(keep_for), "ref string, block long, born long, version long, pos array<long>, d array<long>", "Update", "EventTime" if event_time else "None")


def depth_of(updates: DataFrame) -> DataFrame:
    """Runs of depth, as `depth_runs` gives them, from the updates of `stream_depth`; repeated updates change nothing."""
    newest = updates.groupBy("ref", "block", "born").agg(F.max_by(F.arrays_zip("pos", "d"), "version").alias("c"))
    return runs_of(newest.select("ref", F.explode("c").alias("c")).select("ref", "c.pos", "c.d"))
