"""Corpus cleaning as stages over ``documents``; each calls one operator of
``editstream.llm`` and its decisions take effect on what the next one reads.

Stages keep all columns and rows of clean documents. Near duplicates are decided
row by row: null and repeated ids too leave one row of a class. Documents
without a word are no duplicates.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editstream.llm import op1_toxicity, op2_jaccard, op4_packing, op6_pii, op7_repeats
from editstream.llm.shared import read_table, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar predicts as toxic go."""
    model = op1_toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    names = [f"_{i}" if c != "text" else c for i, c in enumerate(docs.columns)]
    scored = op1_toxicity.score(docs.toDF(*names), model, names)
    return scored.filter("predicted = 0").select(*names).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates one row stays: of the smallest id, a null id last."""
    # Rows are told apart by a number that is written, so that ids may be null or repeat.
    rows = stored(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row")), "rows")
    gone = stored(op2_jaccard.surplus_rows(rows.select("doc.doc_id", "doc.text", "row")), "gone")
    return rows.join(gone.hint("merge"), "row", "left_anti").select("doc.*")


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Characters of byte strings that occurred before leave the texts."""
    return op7_repeats.removed(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to surrogates."""
    replaced = op6_pii.replace_entities(docs)
    if "n_chars" not in docs.columns:
        return replaced
    return replaced.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences."""
    return op4_packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_strings", drop_repeated_strings),
    ("personal_data", replace_personal_data),
    ("packing", pack),
]

ORACLE_SQL = None  # a fitted model and tokenizers: tested against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages in order; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
