"""Corpus pipeline: quality rules, line dedup, near-duplicate documents, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``.  A
stage's result is written as Parquet and read again as the next one's ``docs``.

Defined results: null text is empty (and rejected by the first stage); rows with the same doc_id are one document for
the dedup stages, and stay or go together; extra columns pass through unchanged, whatever their names; the line stage
replaces ``text`` and, where there is one, sets ``n_chars`` to its new length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import line_dedup, minhash, packing, quality
from marquee.llm.common import prepare, stored, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality cascade keeps."""
    prepare(spark)
    judged = quality.judge(docs, features=())
    return judged.where("kept").select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier document has."""
    prepare(spark)
    out = line_dedup.dedup_lines(docs)
    kind = docs.schema["text"].dataType
    new = {"text": F.col("_text").cast(kind)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return out.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near duplicates.  Shingles have five words here."""
    prepare(spark)
    gone = minhash.near_duplicates(docs, words=5).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    gone = gone.where("_gone is not null")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: one row per piece of a document."""
    prepare(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("drop_repeated_lines", drop_repeated_lines),
    ("drop_near_duplicates", drop_near_duplicates),
    ("pack_sequences", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


#: Components of near duplicates, the best-fit plan and byte-pair encoding are beyond SQL; tests/llm compares the
#: rows with a plain version.
ORACLE_SQL = None
