"""Sharding by best-fit-decreasing bin packing of indivisible groups.

A group is all rows with the same text (its 64-bit hash: should two texts collide, they merely stay together). Groups that
weigh more than 1/``FINE`` of a shard are packed one by one; there are at most shards x FINE of them, whatever the input.
The others are first poured into ``shards x FINE`` *bundles* by hash, each a small fraction of a shard. So the
packing itself sees a bounded number of items, sorted by size, each going to the tightest bin that
holds it, found in a balanced tree. The capacity is the least one, to one part in ``shards x FINE``, for which the
wanted number of shards is enough; that makes their sizes near equal unless a single group
outweighs a shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from headway.llm.ranks import number_within
from headway.llm.texts import documents, settle
from headway.llm.trees import best_fit_decreasing

#: Groups above this fraction of a shard are packed one by one; it bounds the items that are packed.
FINE = 1_024


def _least_capacity(sizes: list[int], shards: int) -> list[int]:
    """Bins of a packing into at most ``shards`` bins of nearly the least capacity."""
    low = max([1, -(-sum(sizes) // shards)])
    step = max(1, low // (shards * FINE))
    high = max(low, max(sizes, default=1))
    placed, bins = best_fit_decreasing(sizes, high)
    while bins > shards:
        low, high = high, high + step
        step *= 2
        placed, bins = best_fit_decreasing(sizes, high)
    while high - low > max(1, low // (shards * FINE)):
        middle = (low + high) // 2
        tried, bins = best_fit_decreasing(sizes, middle)
        if bins <= shards:
            high, placed = middle, tried
        else:
            low = middle
    return placed


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row, repeated ones included.

    ``size`` is the text's UTF-8 bytes plus one, so empty and null texts (null is empty) count as well. Equal
    texts share a shard. ``slot`` is the row's place in its shard, gapless from 0. An empty table
    gives an empty result; texts may be of any length; null ids are kept.
    """
    texts = documents(docs)
    rows = settle(
        texts.select(
            "doc_id",
            (F.octet_length("text").cast("long") + 1).alias("size"),
            F.crc32("text").alias("text_crc32"),
            F.xxhash64("text").alias("_group"),
        ),
        "sizes",
    )
    groups = rows.groupBy("_group").agg(F.sum("size").alias("_size"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    limit = total // (shards * FINE)
    slots = shards * FINE
    bundle = F.pmod("_group", F.lit(slots)).cast("int")

    # At most shards * FINE groups exceed the limit, and there are as many bundles: both lists are bounded.
    large = settle(groups.where(F.col("_size") > limit), "large-groups")
    items = [(r["_group"], None, r["_size"]) for r in large.orderBy(F.desc("_size"), "_group").collect()]
    small = groups.where(F.col("_size") <= limit).groupBy(bundle.alias("_bundle")).agg(F.sum("_size").alias("_size"))
    items += [(None, r["_bundle"], r["_size"]) for r in small.orderBy("_bundle").collect()]

    placed = _least_capacity([size for _, _, size in items], shards)
    spark = docs.sparkSession
    plan = [(g, b, number) for (g, b, _), number in zip(items, placed, strict=True)]
    by_group = spark.createDataFrame([(g, n) for g, _, n in plan if g is not None], "_large long, _large_shard int")
    by_bundle = spark.createDataFrame([(b, n) for _, b, n in plan if b is not None], "_bundle int, _bundle_shard int")
    assigned = (
        rows.withColumn("_in_bundle", bundle)
        .join(F.broadcast(by_group), F.col("_group") == F.col("_large"), "left")
        .join(F.broadcast(by_bundle), F.col("_in_bundle") == F.col("_bundle"), "left")
        .withColumn("shard", F.coalesce("_large_shard", "_bundle_shard"))
        .select("doc_id", "size", "text_crc32", "shard")
    )
    counts = {r["shard"]: r["count"] for r in assigned.groupBy("shard").count().collect()}
    order = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    return number_within(assigned, "shard", order, F.xxhash64("doc_id", "text_crc32"), counts, "slot")


def write_shards(docs: DataFrame, path: str, shards: int = 8) -> None:
    """Write the documents as one folder per shard, ordered by nothing in particular inside."""
    placed = shard(docs, shards).select("doc_id", "text_crc32", "shard").distinct()
    crc = F.crc32(F.coalesce(docs["text"].cast("string"), F.lit("")))
    same = docs["doc_id"].cast("long").eqNullSafe(placed["doc_id"]) & (crc == placed["text_crc32"])
    joined = docs.join(placed, same).select(*[docs[c] for c in docs.columns], placed["shard"].alias("_shard"))
    joined.write.partitionBy("_shard").parquet(path)
