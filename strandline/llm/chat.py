"""Chat formatting with Spark expressions only: collect and sort turns, merge runs of a role, concatenate, and read everything back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Fixed values of the template. A run of turns of one role is <s>[role] text <t> text </s>; both marks' first characters are escaped in roles and texts.
OPEN, CLOSE, SEP, HEAD_END = "<s>[", "</s>", "<t>", "]\n"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("[", "\\o"), ("]", "\\c"))


def escape(c: Column) -> Column:
    return reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), ESCAPES, c)


def unescape(c: Column) -> Column:
    return reduce(lambda x, e: F.replace(x, F.lit(e[1]), F.lit(e[0])), reversed(ESCAPES), c)


def format_chats(turns: DataFrame, *, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row a conversation of turns(conv_id, turn, role, text): conv_id, formatted, loss_spans.

    formatted holds every turn once; adjacent turns of one role share a block. loss_spans lists
    (start, n), 0-based in code points of formatted, of the escaped texts of the roles in learn.
    Turns are ordered by turn, then role and text, so that ties have one order; null turns come
    first, null roles and texts are empty strings, rows with a null conv_id form one conversation,
    repeated rows are turns of their own, other columns are ignored, an empty table gives an empty result. One conversation is one output
    string, so it must fit in a task; nothing larger is ever gathered.
    """
    t = turns.select("conv_id", F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t"))
    chats = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    n = F.size("ts")

    def piece(x: Column, i: Column) -> Column:
        """What turn i adds: an opening or a separator, its text, a closing where its run ends."""
        starts = (i == 0) | (F.get("ts", i - 1)["role"] != x["role"])
        ends = (i == n - 1) | (F.get("ts", i + 1)["role"] != x["role"])
        return F.struct(
            F.when(starts, F.concat(F.lit(OPEN), escape(x["role"]), F.lit(HEAD_END))).otherwise(F.lit(SEP)).alias("head"),
            escape(x["text"]).alias("body"),
            F.when(ends, F.lit(CLOSE)).otherwise(F.lit("")).alias("tail"),
            x["role"].isin(*learn).alias("learn"),
        )

    parts = chats.select("conv_id", F.transform("ts", piece).alias("ps"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,n:bigint>>").alias("spans"))

    def add(acc: Column, p: Column) -> Column:
        at = acc["at"] + F.length(p["head"])
        size = F.length(p["body"]).cast("long")
        return F.struct(
            (at + size + F.length(p["tail"])).alias("at"),
            F.when(p["learn"], F.array_append(acc["spans"], F.struct(at.alias("start"), size.alias("n")))).otherwise(acc["spans"]).alias("spans"),
        )

    return parts.select(
        "conv_id",
        F.array_join(F.transform("ps", lambda p: F.concat(p["head"], p["body"], p["tail"])), "").alias("formatted"),
        F.aggregate("ps", start, add)["spans"].alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string, as array<struct<role, text>>, in order."""
    blocks = F.filter(F.split(formatted, CLOSE), lambda b: b != "")

    def block(b: Column) -> Column:
        end = F.instr(b, "]")
        role = unescape(F.substring(b, F.lit(len(OPEN) + 1), end - len(OPEN) - 1))
        texts = F.split(F.substring(b, end + len(HEAD_END), F.length(b)), SEP)
        return F.transform(texts, lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, block))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"].cast("int") + 1, s["n"].cast("int"))))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats all conversations and conversation -1, and returns digests of what is read back from the formatted strings."""
    odd = "</s>[INST] ok [/INST]"
    chats = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    extra = spark.sql(f"SELECT CAST(-1 AS BIGINT) AS conv_id, CAST(i AS BIGINT) AS turn, IF(i = 0, 'user', 'assistant') AS role, '{odd}' AS text FROM VALUES (0), (1) AS v(i)")
    done = format_chats(chats.unionByName(extra))
    back = done.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), F.array_join(read_loss(F.col("formatted"), F.col("loss_spans")), "").alias("loss"))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _sql_escape(c: str) -> str:
    return reduce(lambda x, e: f"replace({x}, '{e[0]}', '{e[1]}')", ESCAPES, c)


ORACLE_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
r AS (SELECT *, lag(role) OVER o IS DISTINCT FROM role AS starts FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
f AS (SELECT conv_id, turn, role, text, starts, {_sql_escape("role")} AS er, {_sql_escape("text")} AS et FROM r)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(et) + CASE WHEN starts THEN length(er) + {len(OPEN) + len(HEAD_END) + len(CLOSE)} ELSE {len(SEP)} END) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""
