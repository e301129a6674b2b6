"""Text and HTML reports from one-row statistics and short ranked excerpts."""

from __future__ import annotations

import html
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.seq import path_text
from ..operators import stats as T

#: Rows of each excerpt.
EDGES, HITS, CYCLES, JOINS, RINGS = 15, 15, 20, 20, 5


def graph_text(edges: DataFrame, hits: DataFrame, cycles: DataFrame, support: DataFrame) -> str:
    """Counts and the best edges, self hits and cycles; the top of each is all that reaches the driver, and a row a contig."""
    lines = ["Overlap graph", f"edges: {edges.count()}  self hits: {hits.count()}  cycles: {cycles.count()}", "", "best edges"]
    lines += [f"{r.src_seg}{r.src_orient} -> {r.dst_seg}{r.dst_orient}\t{r.identity:.2f}\t{r.overlap}" for r in edges.orderBy(F.desc("score")).limit(EDGES).collect()]
    lines += ["", "best self hits"] + [f"{r.seg}{r.orient}\t{r.identity:.2f}\t{r.overlap}" for r in hits.orderBy(F.desc("score")).limit(HITS).collect()]
    lines += ["", "best cycles"] + [f"{r.total_len}\t{r.mean_identity:.2f}\t{r.path}" for r in cycles.select("total_len", "mean_identity", path_text(F.col("nodes")).alias("path")).limit(CYCLES).collect()]
    lines += ["", "contigs"] + ["\t".join(map(str, r)) for r in support.orderBy("contig").collect()]
    return "\n".join(lines) + "\n"


def joins_text(joins: DataFrame, rings: DataFrame) -> str:
    lines = ["candidate joins"] + ["\t".join(map(str, r)) for r in joins.orderBy(F.desc("identity_pct")).limit(JOINS).collect()]
    lines += ["", "circular paths"] + [f"{r.total}\t{' -> '.join(r.path)}" for r in rings.orderBy(F.desc("total"), "path").limit(RINGS).collect()]
    return "\n".join(lines) + "\n"


def pad_hist(h: list[int], n: int) -> list[int]:
    """A histogram of exactly n bins."""
    return (list(h) + [0] * n)[:n]


def thousands(n: float) -> str:
    return f"{n:,}"


def megabases(n: float) -> str:
    return f"{n / 1e6:.1f} Mb"


def kilobases(n: float) -> str:
    return f"{round(n / 1000, 1)} kb"


def stage_bar(stages: list[tuple[str, int]]) -> str:
    """Reads left after each stage, as bars against the first."""
    top = max((n for _, n in stages), default=0) or 1
    rows = [f"<tr><td>{html.escape(k)}</td><td><div class=stage style='background:#9c6;height:1em;width:{300 * n // top}px'></div></td><td>{n:,}</td><td>{100 * n / top:.1f} %</td></tr>" for k, n in stages]
    return "<h2>Stages</h2><table>" + "".join(rows) + "</table>"


def breakdown(parts: dict[str, int]) -> str:
    """Shares of positive counts, as one divided bar."""
    some = {k: n for k, n in parts.items() if n > 0}
    whole = sum(some.values()) or 1
    return "<h2>Breakdown</h2><div style='display:flex;width:400px'>" + "".join(f"<div class=part title='{html.escape(k)}: {n:,}' style='border:1px solid #fff;background:#c96;height:1em;width:{100 * n / whole:.1f}%'></div>" for k, n in some.items()) + "</div>"


def run_report(title: str, raw: dict, scrubbed: dict, final: dict, scrub: dict | None = None, downsample: DataFrame | None = None, contigs: list[tuple[str, int]] | None = None, parameters: dict | None = None) -> str:
    """The whole report of a run from the figures of its three read sets; downsample has one row a contig."""
    cover = [(r.chrom, r.coverage) for r in T.coverage_rows(downsample).collect()] if downsample is not None else []
    mean = T.displayed_coverage(downsample).first()[0] if downsample is not None else None
    cards = {"raw reads": raw["count"], "raw bases": megabases(raw["total_bases"]), "N50": kilobases(raw.get("n50", 0)), "removed": max(0, raw["count"] - scrubbed["count"]), "final reads": final["count"], "reduction": f"{round((1 - final['count'] / raw['count']) * 100, 1) if raw['count'] else 0} %", "coverage": "N/A" if mean is None else f"{mean:.1f}x"}
    bins = raw.get("q_bins", [])
    bars = list(zip(bins, pad_hist(raw.get("q_histogram", []), len(bins)), strict=True))
    page = report_html(title, cards, bars, cover, sorted(contigs or []), scrub, parameters)
    return page + stage_bar([("raw", raw["count"]), ("scrubbed", scrubbed["count"]), ("final", final["count"])]) + breakdown(scrub or {})


def report_html(title: str, cards: dict, histogram: list[tuple[str, int]], coverage: list[tuple[str, float]], contigs: list[tuple[str, int]], outcomes: dict[str, int] | None = None, parameters: dict | None = None) -> str:
    """A page of cards, the quality histogram, coverage badges, contig status and outcome counts. Numbers in scripts are plain JSON."""
    e = html.escape
    top = max((n for _, n in histogram), default=0) or 1
    parts = [f"<!doctype html><meta charset=utf-8><title>{e(title)}</title><h1>{e(title)}</h1>"]
    parts += ["<dl>"] + [f"<dt>{e(str(k))}</dt><dd>{v:,}</dd>" if isinstance(v, (int, float)) else f"<dt>{e(str(k))}</dt><dd>{e(str(v))}</dd>" for k, v in cards.items()] + ["</dl>"]
    parts += ["<h2>Read quality</h2><table>"] + [f"<tr><td>{e(k)}</td><td><div style='background:#69c;height:1em;width:{300 * n // top}px'></div></td><td>{n:,}</td></tr>" for k, n in histogram] + ["</table>"]
    parts += ["<h2>Coverage</h2><table>"] + [f"<tr><td>{e(k)}</td><td class={T.badge_of(c)}>{c:.1f}x</td></tr>" for k, c in sorted(coverage)] + ["</table>"]
    parts += ["<h2>Contigs</h2><table>"] + [f"<tr><td>{e(k)}</td><td>{n:,}</td><td>{T.status_of(n)}</td></tr>" for k, n in contigs] + ["</table>"]
    if outcomes:
        parts += ["<h2>Outcomes</h2><table>"] + [f"<tr><td>{e(k)}</td><td>{n:,}</td></tr>" for k, n in outcomes.items() if n > 0] + ["</table>"]
    parts.append(f"<script>const data = {json.dumps({'histogram': [n for _, n in histogram], 'parameters': parameters or {}})};</script>")
    return "\n".join(parts)
