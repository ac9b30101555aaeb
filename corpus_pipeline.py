"""The corpus pipeline: toxic documents go, frequent lines go, near copies go, leaked test items go, the rest is packed.

A stage is f(spark, docs, sf_dir) and returns a table; docs has the columns of documents, and all stages but the last
return these. Each stage works on all rows that the one before it kept. An empty table goes through all stages as an
empty one; texts may be of any length; further columns stay as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamgrid.llm import decontam, line_dedup, near_dedup, packing, toxicity
from loamgrid.llm.common import cut, free_name, scratch, table
from loamgrid.llm.queries import tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below their language's threshold. Learnt from the labelled ones among docs.

    A score at its threshold goes; equal rows go or stay together. A null or empty text has the score of no evidence; a
    null language takes the common threshold; without labels all scores are alike and below it."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that five or more have, the last one's apart; n_chars follows the text.

    No document goes, one that loses all its lines has an empty text. A null text stays null. Rows of one doc_id are one
    document and all keep or lose a line; a null doc_id is one document below all others."""
    names = tuple(free_name(docs, n) for n in ("_n_lines", "_n_dropped", "_keep_runs"))
    out = line_dedup.dedup_lines(docs, names=names)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(names[1]) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Rows of that id all stay, equal or not; a null id comes after all others. Null, empty and blank texts are copies of
    nothing and stay."""
    doc_id, h = free_name(docs, "gone_id"), free_name(docs, "gone_h")
    gone = cut(near_dedup.near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias(doc_id), F.col("h").alias(h)), "gone")
    same = docs["doc_id"].cast("long").eqNullSafe(gone[doc_id]) & (F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == gone[h])
    return docs.join(gone, same, "left_anti")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark, edited copies included.

    A score at the threshold is a copy. Null and empty texts contain nothing and stay, as all do if there are no items;
    equal rows go or stay together."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: a row for each piece of a document.

    A null text is empty and has one token, the end; repeated rows are packed each by itself; of pieces of one length
    those that the scan numbered first go first."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_lines), ("MinHash near-dedup", drop_near_copies), ("benchmark decontamination", drop_leaks), ("best-fit packing", pack_documents)]

#: Trained scores, alignments and a tokenizer aren't SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark) as kept:
            docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            kept.append(docs)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
