"""The training-data pipeline over the table documents.

Each stage takes what the one before it kept and calls one operator:

1. quality: a classifier from weak labels; documents it scores low go;
2. language: documents without a letter go, and those whose declared language
   another one beats by a clear margin;
3. near_dedup: of each group of near-duplicates, five words and a similarity of
   0.8, the document with the smallest id stays; so does one of repeated rows;
4. mixing: sources are interleaved, with equal target weights; all documents
   stay, in the mixed order of the rows;
5. tokens: the ids of every text, with its place in the mixed order. Tables
   read from several files do not keep the order of their rows, so the places
   are found again: they follow from the sources and ids alone, but for rows of
   one source with the same id, which may change places among themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.llm import bpe, language, minhash, mixing, quality
from pagelode.llm.scratch import Scratch

VOCABULARY = "byte_bpe_50k.json"
MARGIN = 0.1


def _packed(docs: DataFrame) -> DataFrame:
    """Each row as one column, but for its text, besides the columns an operator reads.

    So a text goes to a worker once, as what is read and as what is kept.
    """
    return docs.select(F.struct(*(c for c in docs.columns if c != "text")).alias("row"), "lang", "text")


def _unpacked(packed: DataFrame, columns: list[str]) -> DataFrame:
    return packed.select(*("text" if c == "text" else F.col("row").getField(c).alias(c) for c in columns))


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier keeps; those without a word go."""
    model = quality.fit_quality(docs)
    scored = quality.score_quality(_packed(docs), model, keep=("row", "text"))
    return _unpacked(scored.where("kept"), docs.columns)


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter whose declared language, if any, is not clearly another."""
    prototypes = language.train_prototypes(docs)
    found = language.predict_language(_packed(docs), prototypes, keep=("row", "lang", "text"))
    other = F.col("lang").isNotNull() & (F.col("lang") != F.col("lang_pred")) & (F.col("margin") >= MARGIN)
    lettered = (F.col("lang_pred") != language.UNKNOWN) | F.lit(not prototypes)
    return _unpacked(found.where(lettered & ~other), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; rows with a null id stay."""
    scratch = Scratch(spark, "pipeline-dedup")
    found = minhash.near_duplicates(docs, minhash.Settings(words=5, percent=80), scratch=scratch)
    told = found.where("doc_id is not null").groupBy("doc_id").agg(
        F.first("kept").alias("kept"), F.count(F.lit(1)).alias("n")
    )
    told = scratch.keep(told.where("not kept or n > 1").select(F.col("doc_id").alias("told_id"), "kept"), "told")
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")
    joined = rows.join(told.hint("merge"), rows["doc_id"] == told["told_id"], "left")
    once = joined.where("told_id is null").select("row.*")
    # Rows that repeat an id: one of each text.
    again = joined.where("kept").dropDuplicates(["doc_id", "text"]).select("row.*")
    return once.union(again)


def _in_mixed_order(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """All documents with mix_slot and mix_place, as row order and as columns."""
    mixed = mixing.mix_sources(docs)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return mixed.repartitionByRange(parts, "mix_slot").sortWithinPartitions("mix_slot", "mix_place")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the mixed order of their sources."""
    return _in_mixed_order(spark, docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, mix_slot, mix_place, n_tokens and ids of every document, in the mixed order."""
    keep = ("doc_id", "lang", "source", "mix_slot", "mix_place")
    return bpe.encode_documents(_in_mixed_order(spark, docs), VOCABULARY, keep=keep)


STAGES = [
    ("quality", by_quality),
    ("language", by_language),
    ("near_dedup", near_dedup),
    ("mixing", mix),
    ("tokens", tokens),
]

# The classifier, the language profiles and the vocabulary have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the shared folder for the next one.

    A stage's table is removed once the next one is written; the result reads the last.
    """
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = scratch.keep(docs, name)
            if at:
                scratch.drop(STAGES[at - 1][0])
    return docs
