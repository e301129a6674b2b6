"""Fill-in-the-middle: texts cut into prefix, middle and suffix at unit borders, which an automaton's events give."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import WHITE, table

#: What marks prefix, suffix and middle in the output.
SENTINELS = ("<P>", "<S>", "<M>")
#: The ASCII characters at which a text's class changes, by unit: a line ends behind its line feed, a word behind its white space. Single characters need none.
CHANGES = {"line": "\n", "word": WHITE, "char": ""}
_RESULT = StructType().add("n", "long").add("form", "string").add("prefix_chars", "long").add("middle_chars", "long").add("output", "string")
_ADDED = tuple(_RESULT.names)


def check_sentinels(sentinels: tuple[str, str, str]) -> None:
    """Refuse sentinels that could be read in two ways: where one holds another, or one's end is another's beginning, texts could not be rebuilt."""
    for a in sentinels:
        for b in sentinels:
            if not a or (a != b and a in b) or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)))):
                raise ValueError(f"sentinels {a!r} and {b!r} are empty or overlap")
    if len(set(sentinels)) != 3:
        raise ValueError("sentinels are not distinct")


class Scanner:
    """One pass over a text for its events, the class-changing characters and the sentinels; units are counted from the gaps between events, never one by one."""

    def __init__(self, unit: str, sentinels: tuple[str, str, str]):
        import ahocorasick

        self.unit, self.machine = unit, ahocorasick.Automaton()
        self.marks = CHANGES[unit]
        for c in self.marks:
            self.machine.add_word(c, 1)
        for s in sentinels:
            # A sentinel of one character may change the class, too.
            self.machine.add_word(s, 3 if s in self.marks else 2)
        self.machine.make_automaton()

    def borders(self, text: str) -> tuple[int, np.ndarray | None, bool]:
        """(number of units, offset at which each but the first begins, whether a sentinel is in the text). For characters the offsets are the ranks themselves, and None is returned."""
        events, found = [], False
        for at, kind in self.machine.iter(text):
            if kind & 1:
                events.append(at)
            found |= kind > 1
        if self.unit == "char":
            return len(text), None, found
        after = np.array(events, np.int64) + 1
        if self.unit == "word" and len(after):
            # White space side by side is one gap: a unit begins behind its last character. White space at the start is a unit of its own.
            after = after[np.append(np.diff(after) > 1, True)]
        after = after[after < len(text)]
        return len(after) + bool(text), after, found


def _four(seed: str, key: str) -> list[int]:
    h = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(h[k : k + 8], 16) for k in (0, 8, 16, 24)]


def fill_in_middle(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", unit: str = "line", rate: int = 100, spm_rate: int = 50, seed: int = 7, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """docs with n (units), form ('plain', 'psm' or 'spm'), prefix_chars, middle_chars and output, the transformed text.

    Two borders are drawn for each document from a digest of seed and doc_id, each with the same
    chance for every border, ends included; the part between is the middle. rate percent of the
    texts are cut, spm_rate percent of those have the suffix first. Texts that are empty or hold a
    sentinel stay plain, with null part sizes.

    A null text counts as empty, and its output is empty; a null doc_id draws as an empty one. Rows
    that repeat a doc_id and a text are cut alike; nothing depends on other rows, so there are no
    ties. An empty table gives an empty one. Other columns are kept; those named like a result give
    way. A text is held whole in one task, with eight bytes an event; nothing is shuffled.
    """
    check_sentinels(sentinels)
    if unit not in CHANGES:
        raise ValueError(f"unit {unit!r} is none of {sorted(CHANGES)}")
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in _ADDED])
    p, s, m = sentinels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(unit, sentinels)
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                b = whole.slice(start, 500)
                rows = []
                for key, t in zip(b.column(b.schema.get_field_index(doc_id)).to_pylist(), b.column(b.schema.get_field_index(text)).to_pylist(), strict=True):
                    t = t or ""
                    n, after, marked = scan.borders(t)
                    h1, h2, h3, h4 = _four(str(seed), "" if key is None else str(key))
                    if not t or marked or h3 % 100 >= rate:
                        rows.append((n, "plain", None, None, t))
                        continue
                    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
                    x, y = (k if after is None or not k else len(t) if k == n else int(after[k - 1]) for k in (i, j))
                    parts = (p, t[:x], s, t[y:], m, t[x:y])
                    if h4 % 100 < spm_rate:
                        rows.append((n, "spm", x, y - x, "".join((*parts[2:4], *parts[:2], *parts[4:]))))
                    else:
                        rows.append((n, "psm", x, y - x, "".join(parts)))
                cols = list(zip(*rows, strict=True)) or [()] * 5
                made = [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([*b.columns, *made], names=[*b.schema.names, *_ADDED])

    return kept.mapInArrow(run, StructType([*kept.schema.fields, *_RESULT.fields]))


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output was made of, from the output and its form alone."""
    parts = F.split(output, "|".join(re.escape(x) for x in sentinels))
    return F.when(form == "plain", output).when(form == "psm", F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))).otherwise(F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at lines: doc_id, n, form, part sizes, and digests of the output and of the text rebuilt from it."""
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS units FROM t),
d AS (SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM u),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1)) AS j,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
c AS (SELECT *, array_to_string(units[1:i], '') AS p, array_to_string(units[i + 1:j], '') AS m, array_to_string(units[j + 1:], '') AS s FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM c
"""
