"""Quality rules, line first: judge each line, drop those that fail, reject a document that loses too much."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Fixed values of the rules.
SYMBOLS = "#*$%&|<>"
BOILERPLATE = (
    # English
    "all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie policy", "use cookies", "enable javascript", "click here", "subscribe to our", "sign up for", "log in to", "share this", "lorem ipsum",
    # German
    "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "verwenden cookies", "javascript aktivieren", "hier klicken", "newsletter abonnieren", "jetzt anmelden", "weitersagen",
    # French
    "tous droits réservés", "politique de confidentialité", "conditions générales", "utilisons des cookies", "activer javascript", "cliquez ici", "abonnez-vous", "connectez-vous", "mentions légales",
    # Spanish
    "todos los derechos reservados", "política de privacidad", "condiciones de uso", "utilizamos cookies", "activar javascript", "haga clic aquí", "suscríbete", "inicia sesión", "aviso legal",
)
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: A line ends in a sentence mark, or it is a menu, a heading or a fragment; one with more symbols than one in SYMBOL_EVERY words, or with more than LINK_PERCENT percent of links, is markup or navigation; one with more than SHOUT_PERCENT percent of words ending in a doubled mark is shouting.
ENDS = ".!?…:;。！？"
SYMBOL_EVERY = 10
LINK_PERCENT = 30
SHOUT_PERCENT = 30
MAX_LOST_PERCENT = 50

_BOILER = re.compile("|".join(map(re.escape, BOILERPLATE)))
_END = rf"[{ENDS}][\"')\]»”’]*[\x20\x09-\x0D]*$"
_MARK = re.compile(_END)
_LINK = re.compile(r"https?://|www\.")
_SHOUT = re.compile(r"[!?]{2,}")


def line_fails(line: str, n_words: int) -> bool:
    """The rules of one line with a word: navigation and markup symbols, links, shouting, no sentence mark at its end, boilerplate."""
    symbols = sum(map(line.count, SYMBOLS))
    if symbols * SYMBOL_EVERY > n_words:
        return True
    if ("!!" in line or "??" in line or "!?" in line or "?!" in line) and len(_SHOUT.findall(line)) * 100 > SHOUT_PERCENT * n_words:
        return True
    if not _MARK.search(line[-200:]) or (("http" in line or "www." in line) and len(_LINK.findall(line)) * 100 > LINK_PERCENT * n_words):
        return True
    return bool(_BOILER.search(line.lower()))


_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)


def repeated_words(words: list, window: int = WINDOW) -> int:
    """Words that lie in a window of words which the text holds twice or more. Windows are compared by 64-bit fingerprints of exact word numbers."""
    n = len(words)
    if n <= window:
        return 0
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.uint64, count=n)
    if len(number) == n:
        return 0
    ids = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    ids ^= ids >> np.uint64(29)
    m = n - window + 1
    key = np.zeros(m, dtype=np.uint64)
    for k in range(window):
        key += ids[k : k + m] * _MIX[k]
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    twice = np.zeros(m, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    delta = np.zeros(n + 1, dtype=np.int32)
    at = np.flatnonzero(twice)
    np.add.at(delta, at, 1)
    np.add.at(delta, at + window, -1)
    return int((np.cumsum(delta[:n]) > 0).sum())


def judge(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines, n_failed_lines, lost_chars, clean)."""
    if not text:
        return 0, 0, 0, 0, 0, True, False, 0, 0, 0, text
    words = text.encode().split()
    n_words = len(words)
    word_chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    n_symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    kept_lines, n_lines, n_failed, n_dup, lost, whole = [], 0, 0, 0, 0, 0
    for line in text.split("\n"):
        here = len(line.encode().split())
        if not here:
            kept_lines.append(line)
            continue
        n_lines += 1
        size = len(line)
        whole += size
        again = line in seen
        n_dup += again
        if again or line_fails(line, here):
            n_failed += 1
            lost += size
        else:
            kept_lines.append(line)
        seen.add(line)
    n_repeat = repeated_words(words)
    base_failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
    kept = not base_failed and 100 * lost <= MAX_LOST_PERCENT * whole
    return n_words, word_chars, n_symbols, n_dup, n_repeat, base_failed, kept, n_lines, n_failed, lost, "\n".join(kept_lines) if n_failed else text


_FIELDS = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("n_lines", pa.int64()), ("n_failed_lines", pa.int64()), ("lost_chars", pa.int64())]
_DDL = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lines long, n_failed_lines long, lost_chars long"


def quality_rules(docs: DataFrame, *, text: str = "text", carry: list[str] | None = None, clean: str | None = None) -> DataFrame:
    """Judge every document of docs by its lines; no shuffle, one pass.

    Returns the columns in carry (all columns by default, unchanged) and the figures in _DDL; with
    clean, also the text without the failed lines. A line fails for navigation or markup symbols,
    links, shouting, boilerplate in one of four languages, a missing sentence mark at its end or
    equality to an earlier line of its document. A
    document stays if the base rules pass and at most MAX_LOST_PERCENT percent of the characters
    of its lines failed. Null and empty texts have no words and fail; repeated rows are judged
    alike; an empty table gives an empty result. A column of docs whose name clashes with a figure
    gives way to the figure.
    """
    names = [n for n, _ in _FIELDS] + ([clean] if clean else [])
    carry = [c for c in (docs.columns if carry is None else carry) if c not in names or c == text == clean]
    rest = [c for c in carry if not (clean and c == clean)]
    source = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").alias("__text"))
    out_ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]] + [_DDL] + ([f"`{clean}` string"] if clean else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                rows = [judge(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
                cols = list(batch.columns[:-1])
                cols += [pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(_FIELDS)]
                if clean:
                    cols.append(pa.array([r[-1] for r in rows], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=[*rest, *names])

    return source.mapInArrow(run, out_ddl)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document: base figures, base_failed and the line-first verdict."""
    return quality_rules(table(spark, sf_dir, "documents"), carry=["doc_id"])


_LINES = "string_split(coalesce(text, ''), chr(10))"
_ALNUM = f"[^{SYMBOLS}]"
_W = r"[^\x20\x09-\x0D]+"
_BOILER_SQL = "|".join(BOILERPLATE)
_END_SQL = _END.replace("'", "''")
ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{_W}') AS ws FROM d),
pos AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
win AS (SELECT doc_id, i, x, lead(x, 7) OVER o AS last, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o || ' ' || lead(x, 5) OVER o || ' ' || lead(x, 6) OVER o || ' ' || lead(x, 7) OVER o AS g FROM pos WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
cnt AS (SELECT doc_id, i, CASE WHEN g IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g) > 1 THEN 1 ELSE 0 END AS twice FROM win),
cov AS (SELECT doc_id, max(twice) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS c FROM cnt),
rep AS (SELECT doc_id, sum(c) AS n FROM cov GROUP BY doc_id),
ls AS (SELECT doc_id, unnest({_LINES.replace("text", "t")}) AS l, generate_subscripts({_LINES.replace("text", "t")}, 1) AS k FROM d),
lw AS (SELECT doc_id, k, l, length(l) AS size, len(regexp_extract_all(l, '{_W}')) AS n, row_number() OVER (PARTITION BY doc_id, l ORDER BY k) > 1 AS again, length(l) - length(regexp_replace(l, '[{SYMBOLS}]', '', 'g')) AS sy, len(regexp_extract_all(l, '[!?]{{2,}}')) AS sh FROM ls),
lf AS (SELECT *, again OR sy * {SYMBOL_EVERY} > n OR sh * 100 > {SHOUT_PERCENT} * n OR NOT regexp_matches(right(l, 200), '{_END_SQL}') OR len(regexp_extract_all(l, 'https?://|www\.')) * 100 > {LINK_PERCENT} * n OR regexp_matches(lower(l), '{_BOILER_SQL}') AS bad FROM lw WHERE n > 0),
la AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE again) AS n_dup, count(*) FILTER (WHERE bad) AS n_bad, coalesce(sum(size) FILTER (WHERE bad), 0) AS lost, sum(size) AS whole FROM lf GROUP BY doc_id),
b AS (SELECT doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars, length(t) - length(regexp_replace(t, '[{SYMBOLS}]', '', 'g')) AS n_symbols FROM w),
j AS (SELECT b.*, coalesce(n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_bad, 0) AS n_failed_lines, coalesce(lost, 0) AS lost_chars, coalesce(whole, 0) AS whole FROM b LEFT JOIN rep USING (doc_id) LEFT JOIN la USING (doc_id)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM j)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost_chars <= {MAX_LOST_PERCENT} * whole AS kept,
       CAST(n_lines AS BIGINT) AS n_lines, CAST(n_failed_lines AS BIGINT) AS n_failed_lines, CAST(lost_chars AS BIGINT) AS lost_chars
FROM f
"""
