"""The registered queries of the operators, ``opN_<name>``, and their comparison SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from headway.llm.align import align_tokenizers
from headway.llm.byte_bpe import decode_documents, encode_documents
from headway.llm.exact_dedup import exact_duplicates
from headway.llm.jaccard_join import near_duplicate_classes
from headway.llm.language_id import identify_languages, language_prototypes
from headway.llm.packing import CAPACITY, pack
from headway.llm.piece_bpe import decode_pieces, encode_pieces
from headway.llm.quality_classifier import FactorisationMachine, quality_scores, train
from headway.llm.quality_rules import judge
from headway.llm.sharding import shard
from headway.llm.spelling import spelling_variants
from headway.llm.substring_dedup import removal_digests
from headway.llm.suffix_dedup import byte_removal_digests
from headway.llm.texts import read_documents, settle
from headway.llm.word_tokens import tokenized

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_documents(spark, sf_dir))


ORACLE_SQL["op1_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(read_documents(spark, sf_dir), 8)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(read_documents(spark, sf_dir))


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_removal_digests(read_documents(spark, sf_dir))


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = tokenized(read_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), CAPACITY)
    pieces = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(settle(pieces, "token-pieces"), CAPACITY)


@query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = encode_documents(read_documents(spark, sf_dir), path, public_tokenizers.PATTERN)
    return decode_documents(encoded, path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_duplicate_classes(read_documents(spark, sf_dir), n=4, percent=85)
    return classes.select("doc_id", "n_shingles", "component_id")


def _remainder(doc_id: Column, modulus: int) -> Column:
    return F.crc32(doc_id.cast("string")) % modulus


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    scored = quality_scores(docs, trained_quality(spark, docs, sf_dir))
    return scored.select(
        "doc_id",
        (_remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def trained_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> FactorisationMachine:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return train(docs, labels, _remainder(F.col("doc_id"), 5) != 0)


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    names, prototypes = language_prototypes(docs, _remainder(docs["doc_id"], 4) != 2)
    told = identify_languages(docs, names, prototypes)
    return told.select("doc_id", (_remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_documents(spark, sf_dir))


@query
def op11_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return decode_pieces(encode_pieces(read_documents(spark, sf_dir), path), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    byte_path, piece_path = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align_tokenizers(read_documents(spark, sf_dir), byte_path, public_tokenizers.PATTERN, piece_path)


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read_documents(spark, sf_dir)).select("word", "form", "root", "n", "n_near", "form_n")


# The checksum of every run is folded byte by byte over the table of the CRC-32 polynomial.
ORACLE_SQL["op13_spelling_variants"] = r"""
WITH RECURSIVE poly AS (
  SELECT list(v ORDER BY b) AS crc FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS v
    FROM range(256) AS bytes(b))
), runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]{7,}')) AS run FROM documents)
  GROUP BY ALL
), bytes AS (
  SELECT run, n, hex(encode(concat(doc_id, ':', run))) AS h FROM runs
), summed AS (
  SELECT run, n, xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) AS s
  FROM bytes, poly
), damaged AS (
  SELECT CASE WHEN s % 31 = 0 THEN left(run, s % length(run)) || substr(run, s % length(run) + 2) ELSE run END AS word, n FROM summed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cuts AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form,
         CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c USING (word) JOIN forms e ON e.word = c.root WHERE e.form IS NULL
"""
