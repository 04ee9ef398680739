"""From raw documents to packed training sequences: the stages, and a run over the documents of a folder."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import exact_dedup, language_id, near_copies, packing, suffix_dedup
from faultline.llm.shared import remainder, saved, table

#: A document goes if its text is null or has no letter, or if even its likeliest language scores less.
LEAST_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones among them teach. If none is labelled, only texts without a letter go."""
    model = language_id.fit(docs, remainder("doc_id", 4) != 2)
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = language_id.predict(docs, model)
    return found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by four fifths of equal five-word shingles the row with the smallest id."""
    return near_copies.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 200 bytes and more that stand elsewhere, too; ``n_chars`` follows."""
    found = suffix_dedup.remove_repeats(docs, keep=[x for x in docs.columns if x != "text"], with_text=True)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document in a sequence."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("packing", pack_sequences),
]

#: SQL can't express learning, fingerprints, suffix arrays and packing; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
