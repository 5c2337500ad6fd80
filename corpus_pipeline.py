"""A corpus pipeline: language, near duplicates, repeated passages, benchmark leaks, packing.

Each stage reads the Parquet table that the stage before has written. All but the last return the columns of documents.

Defined results: null and empty texts are of no language and go in the first stage. Of a near-duplicate
group the row with the least doc_id stays, rows without one last, of equal ids that with the least hash of its text; rows equal to it
in both go. Further stages tell rows apart by doc_id and text, so rows without a doc_id are documents like others. A document that loses all its text to the
third stage stays with an empty one. Extra columns are carried along, whatever their names. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm import decontaminate, language, packing, radix_dedup, simhash
from dayledger.llm.common import remove, scratch, table, text_keys
from dayledger.llm.queries import END_ID, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; those that language identification rejects go."""
    return language.accepted(docs, language.train(docs))


def _mark(doc_id: Column, key: Column) -> Column:
    """What tells documents apart, without nulls, so that one shuffle serves an aggregate and a join on it."""
    return F.struct(F.isnull(doc_id).alias("without"), F.coalesce(doc_id, F.lit(0)).alias("id"), key.alias("key"))


def _boxed(docs: DataFrame, *without: str) -> DataFrame:
    """(row, key, mark): the columns in a struct, so that no name clashes, the text's key, and what tells documents apart."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in without]
    key = text_keys(F.col("text"))
    return docs.select(F.struct(*kept).alias("row"), key.alias("key"), _mark(F.col("doc_id"), key).alias("mark"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    first = simhash.representatives(docs, text_keys(docs["text"])).select(_mark(F.col("doc_id"), F.col("key")).alias("mark"))
    return _boxed(docs).join(first, "mark", "left_semi").dropDuplicates(["mark"]).select("row.*")


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that start earlier in the corpus."""
    cut = radix_dedup.remove_repeats(docs, with_text=True).select(_mark(F.col("doc_id"), F.col("text_key")).alias("mark"), F.col("kept").alias("cut_text"))
    joined = _boxed(docs, "text", "n_chars").join(cut.dropDuplicates(["mark"]), "mark")
    changed = {"text": F.col("cut_text"), "n_chars": F.length("cut_text").cast("long")}
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(f"row.`{c}`") for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    keyed = docs.select(text_keys(F.col("text")).alias("doc_id"), "text")
    found = decontaminate.matches(keyed, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("leak")).distinct()
    return _boxed(docs).join(found, F.col("key") == F.col("leak"), "left_anti").select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_path(), END_ID)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", remove_repeated_passages),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack),
]

# Training, fingerprints, tokens and packing are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, from documents to packed pieces."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        folder = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:
            remove(before)
        before = folder
    return docs
