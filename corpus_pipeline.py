"""The training-data pipeline over a table of documents, stage by stage.

A null text counts as empty and is kept unless a stage's own rule drops it; a null id is larger than any other and never equal to one that
stays. Repeated rows and equal texts are copies. Extra columns, whatever their names, are carried along and not read, but
for ``n_chars``. An empty table gives an empty result; texts may be of any length.

Each stage takes all documents that its predecessor kept and returns those it keeps, with all their columns; the last one
returns the packed sequences' pieces. :func:`run` stores every stage's result before the next one starts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.llm.exact_dedup import drop_exact_duplicates
from headway.llm.jaccard_join import drop_near_duplicates
from headway.llm.packing import CAPACITY, pack
from headway.llm.quality_classifier import drop_low_quality, train
from headway.llm.substring_dedup import with_repeats_removed
from headway.llm.texts import read_documents, settle
from headway.llm.word_tokens import tokenized

LEAST_QUALITY = 0.3


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the classifier scores below ``LEAST_QUALITY`` go.

    It learns from the labels of documents whose crc32 of the id leaves a remainder by 5. A document labelled both 0 and 1 counts
    once for each; without both labels all documents score alike and stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = train(docs, labels, F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    return drop_low_quality(docs, machine, LEAST_QUALITY)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of equal texts the one with the largest id stays; of null and empty texts one."""
    return drop_exact_duplicates(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7, on five words and a similarity of 0.8 or more: of each group the least id stays. Texts without words stay."""
    return drop_near_duplicates(docs, n=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: passages of 50 words or more that a document with a smaller id has too are cut out; no row goes, untouched texts stay as they are."""
    return with_repeats_removed(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: token pieces with the sequence and the place they are packed to; an empty text is its end token."""
    pieces = tokenized(docs, public_tokenizers.path("word_bpe_49k.json"), CAPACITY)
    pieces = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(settle(pieces, "token-pieces"), CAPACITY)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]

#: A trained classifier and a tokenizer have no SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that all stages keep: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
