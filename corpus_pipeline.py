"""A training corpus from raw documents, in five stages; each reads all that the last one kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import bpe, leaks, lines, near, quality
from strandline.llm.common import shared_dir, table

#: The columns that every stage but the last returns.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of documents with the given text; n_chars follows it."""
    others = [F.col(f"`{c}`") for c in ("doc_id", "lang", "source") if c in docs.columns]
    out = docs.select(*others, F.col(f"`{text}`").alias("text"))
    out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    return out.select(*[c for c in COLUMNS if c in out.columns])


def _once(docs: DataFrame) -> DataFrame:
    """docs with one row of those that are equal in doc_id and text. Only texts of ids that repeat are shuffled."""
    again = docs.groupBy(F.col("doc_id").alias("again")).agg(F.count("*").alias("__n")).where("__n > 1").select("again")
    same = F.col("doc_id").eqNullSafe(F.col("again"))
    return docs.join(again, same, "left_anti").unionByName(docs.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail go, failed lines of the others go.

    Null and empty texts fail; repeated rows are judged alike, each by itself, and null ids stay; an empty table gives an empty one;
    columns other than those of documents go, in every stage but the last.
    """
    judged = quality.quality_rules(docs.select(*[c for c in COLUMNS if c in docs.columns and c != "n_chars"]), clean="cleaned")
    return _documents(judged.where("kept"), "cleaned")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: later copies of a line go; a document that has no text left goes.

    Ties between documents of one id go by the digest of the text; rows equal in id and text are one document and lose the same lines; null and empty texts lose nothing and stay;
    null ids come first; an empty table gives an empty one.
    """
    done = lines.line_dedup(docs, out="left_text")
    return _documents(done.where("n_removed = 0 OR trim(left_text) != ''"), "left_text")


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each group stays, the one with the smallest id.

    Rows equal in id and text are one document, of which one row stays, whichever; texts under one id are judged together and stay or go together. Null ids are in
    no group; nor are texts that are null, empty or without words: all of those stay. An empty table gives an empty one.
    """
    docs = _once(docs)
    groups = near.near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("gone")).distinct()
    return _documents(docs.join(groups, F.col("doc_id") == F.col("gone"), "left_anti"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold an item go.

    Where one text of an id holds one, all rows of that id go, null ids included; null and empty texts hold nothing; empty tables on either side take nothing away.
    """
    found = leaks.contaminated(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("gone")).distinct()
    return _documents(docs.join(found, F.col("doc_id").eqNullSafe(F.col("gone")), "left_anti"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: doc_id, n_tokens, ids (little-endian unsigned 32-bit), ids_sha256 and decoded_sha256 of every document.

    One row a row: null and empty texts have no ids, repeated rows and null ids stay, an empty table gives an empty result.
    """
    return bpe.encoded_digests(docs, with_ids=True)


STAGES = [("quality", clean_lines), ("lines", drop_lines), ("near", drop_near), ("leaks", drop_leaks), ("encode", encode)]

#: Components, rolling hashes and a tokenizer are beyond SQL; a test holds all stages against brute force on a small corpus.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    root = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{root}/{k}-{name}")
        docs = spark.read.schema(out.schema).parquet(f"{root}/{k}-{name}")
    return docs
