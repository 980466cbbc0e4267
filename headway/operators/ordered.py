"""Next or previous row within a key, safe when one key holds a large part of all rows.

``lead`` and ``lag`` put a whole key into one task. :func:`with_neighbour` cuts keys that hold more than a task's share
(see :mod:`headway.operators.cuts`), shuffles every row once and exchanges one row per cut.

Version histories compare a row with several others. Their keys whose rows would swamp a task are found first and take a way of
their own, :func:`neighbour_by_range`:

1. range-partition their rows by (key, order), which cuts a big key into many ranges;
2. take the neighbour inside each range;
3. a second window supplies the neighbour across the cut. All rows pass through it, but only the
   first and last row of every range meet there per key; the others stay in groups of their range,
   so the ranges need not be computed twice.

Finding hot keys reads the key columns only and counts rows per *slot* of the key hash, so its
result has a fixed size whatever the data: at most ``KEY_SLOTS`` slot numbers, which is what makes
broadcasting it safe. All keys of a hot slot take the second way; it is exact for any key. The
search runs when the plan is built, so data without hot keys gets the plain one-shuffle plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from headway.operators.cuts import KeyCuts
from headway.session import shuffle_partitions

KEY_SLOTS = 65_536
HOT_SLOT_ROWS = 1_000_000
_SLOT = "_key_slot"


def key_slot(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(KEY_SLOTS)).cast("int")


def split_by_heat(df: DataFrame, keys: Sequence[str], hot_rows: int | None = HOT_SLOT_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys or None); ``hot_rows=None`` skips the search.

    A slot is hot when it holds ``hot_rows`` rows more than an evenly filled slot, plus a quarter
    of the even share for chance. Two numbers come to the driver, never rows.
    """
    if hot_rows is None:
        return df, None
    slotted = df.withColumn(_SLOT, key_slot(keys))
    per_slot = slotted.groupBy(_SLOT).agg(F.count(F.lit(1)).alias("rows"))
    total, largest = per_slot.agg(F.sum("rows"), F.max("rows")).first()
    limit = (total or 0) / KEY_SLOTS * 1.25 + hot_rows
    if (largest or 0) < limit:
        return df, None
    hot = F.broadcast(per_slot.where(F.col("rows") >= limit).select(_SLOT))
    return (
        slotted.join(hot, _SLOT, "left_anti").drop(_SLOT),
        slotted.join(hot, _SLOT, "left_semi").drop(_SLOT),
    )


def _shift(column: Column, step: int) -> Column:
    return F.lead(column) if step > 0 else F.lag(column)


def neighbour_by_range(df: DataFrame, keys: Sequence[str], order: Sequence[Column], picks: dict[str, Column], step: int = 1) -> DataFrame:
    """Like :func:`with_neighbour`, over ranges of all rows."""
    columns = df.columns
    ranges = shuffle_partitions(df.sparkSession)
    cut = df.repartitionByRange(ranges, *[F.col(k) for k in keys], *order).withColumn("_range", F.spark_partition_id())

    inside = Window.partitionBy("_range", *keys).orderBy(*order)
    found = F.struct(*[value.alias(name) for name, value in picks.items()])
    cut = cut.withColumns(
        {
            "_found": _shift(found, step).over(inside),
            "_is_first": F.lag(F.lit(1)).over(inside).isNull(),
            "_is_last": F.lead(F.lit(1)).over(inside).isNull(),
        }
    )

    # Edges of all ranges of a key meet in group -1 (two rows per range at most); rows inside a range
    # keep their neighbour and stay in groups of their own, so no task sees a whole key.
    on_edge = F.col("_is_first") | F.col("_is_last")
    cut = cut.withColumn("_group", F.when(on_edge, F.lit(-1)).otherwise(F.col("_range")))
    along = Window.partitionBy("_group", *keys).orderBy("_range", "_is_last", *order)
    cut = cut.withColumn("_across", _shift(found, step).over(along))
    at_cut = F.col("_is_last") if step > 0 else F.col("_is_first")
    answer = F.when(at_cut, F.col("_across")).otherwise(F.col("_found"))
    return cut.select(*columns, *[answer[name].alias(name) for name in picks])


def with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    picks: dict[str, Column],
    step: int = 1,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``picks`` evaluated on the next (``step=1``) or previous (``step=-1``) row of the same key.

    ``order`` are ascending columns; rows equal in all of them should be equal in what is picked.
    """
    return neighbour_in_chunks(df, KeyCuts.of(df, keys, order, ranges), picks, step).drop("_chunk")


def neighbour_in_chunks(df: DataFrame, cuts: KeyCuts, picks: dict[str, Column], step: int = 1) -> DataFrame:
    """:func:`with_neighbour` for given cuts; rows stay dealt by the keys and ``_chunk``, which is kept.

    Rows are shuffled once, by key and chunk. What the outermost row of a chunk lacks is the nearest row of the next chunk: of each
    chunk that one row is exchanged, found by an aggregation that map tasks do most of.
    """
    keys, found = list(cuts.keys), F.struct(*[value.alias(name) for name, value in picks.items()])
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*cuts.order)
    paired = cuts.chunked(df).withColumn("_found", _shift(found, step).over(inside))
    nearest = F.min_by if step > 0 else F.max_by
    place = F.struct(*cuts.order)
    edges = cuts.chunked(df, "inner").groupBy(*keys, "_chunk").agg(nearest(found, place).alias("_edge"))
    across = _shift(F.col("_edge"), step).over(Window.partitionBy(*keys).orderBy("_chunk"))
    # A row per chunk of a cut key: no more than there are cuts and cut keys.
    beyond = edges.select(*[F.col(k).alias(f"_edge_{k}") for k in keys], F.col("_chunk").alias("_edge_chunk"), across.alias("_across"))
    beyond = F.broadcast(beyond.where(F.col("_across").isNotNull()))
    same = paired["_chunk"] == beyond["_edge_chunk"]
    for key in keys:
        same &= paired[key].eqNullSafe(beyond[f"_edge_{key}"])
    answer = F.coalesce("_found", "_across")
    joined = paired.join(beyond, same, "left")
    return joined.select(*df.columns, "_chunk", *[answer[name].alias(name) for name in picks])
