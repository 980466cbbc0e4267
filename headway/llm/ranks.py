"""Gapless numbers within few, possibly huge, groups, without bringing a group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Rows that one numbering task sorts, on average, per group and cell.
CELL_ROWS = 8_192
#: The most cells a group is cut into; their counts are what one window sees per group.
MOST_CELLS = 1 << 20


def number_within(df: DataFrame, group: str, order: list[Column], spread: Column, counts: dict[int, int], name: str) -> DataFrame:
    """Adds ``name``: 0, 1, 2, ... within each value of the integer column ``group``.

    Each group is cut into cells by the hash ``spread``, as many as its row count (``counts``, one entry per group)
    asks for. Rows are numbered inside their cell; a cell starts after the rows of the cells before it.
    """
    cells = {k: min(MOST_CELLS, 1 + n // CELL_ROWS) for k, n in counts.items() if n >= CELL_ROWS}
    wide = F.lit(1)
    if cells:
        wide = F.coalesce(F.create_map(*[F.lit(x) for pair in cells.items() for x in pair])[F.col(group)], F.lit(1))
    celled = df.withColumn("_cell", F.pmod(spread, wide.cast("long")).cast("int"))
    sizes = celled.groupBy(group, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col(group).alias("_g"), F.col("_cell").alias("_c"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
    inside = F.row_number().over(Window.partitionBy(group, "_cell").orderBy(*order)) - 1
    numbered = celled.withColumn("_inside", inside)
    joined = numbered.join(starts, (F.col(group) == F.col("_g")) & (F.col("_cell") == F.col("_c")))
    return joined.withColumn(name, (F.col("_first") + F.col("_inside")).cast("long")).select(*df.columns, name)
