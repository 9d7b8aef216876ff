"""A corpus pipeline of five stages, from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but
the last return the columns of ``documents``. Between stages the rows are a table in the shared
folder, so a lost executor costs at most the work of one stage; what a stage wrote on its way is
removed once its own table is there.

Null texts count as empty and go in the first stage (too few words). A document whose lines all go
stays as an empty text. Near copies share 80 percent or more of their five-word shingles; of a
component of them the smallest doc_id stays; rows of one id stay or go together. An empty table passes through all stages. Extra columns are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.best_fit_packing import best_fit_packing
from gaugeworks.llm.decontaminate import decontaminate
from gaugeworks.llm.line_bloom import line_dedup
from gaugeworks.llm.ngram_jaccard import jaccard_components
from gaugeworks.llm.quality_bands import compression_bands
from gaugeworks.session import settled

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Near copies: words of a shingle, and the lowest Jaccard similarity in percent.
COPY_WORDS = 5
COPY_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return compression_bands(docs).filter("kept").select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines; n_chars follows the new text."""
    rest = line_dedup(docs)
    if "n_chars" in docs.columns:
        rest = rest.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rest.select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of every component of near copies."""
    found = jaccard_components(docs, words=COPY_WORDS, percent=COPY_PERCENT)
    keep = (
        found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("doc_id").alias("__keep"))
        .distinct()
    )
    return docs.join(keep, docs["doc_id"].eqNullSafe(F.col("__keep")), "left_semi")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, benchmark).filter("NOT contaminated").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their sequence and offset."""
    return best_fit_packing(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_lines),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

# zstandard ratios and token ids have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(spark, f"stage-{name}", lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
