"""Type 1 and type 2 change tracking as batch operators, and slices of a version history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from headway.operators.latest import content_hash, keep_latest
from headway.operators.ordered import HOT_SLOT_ROWS, neighbour_by_range, split_by_heat

START_AT = "__START_AT"
END_AT = "__END_AT"


def _tracked(df: DataFrame, keys: Sequence[str], sequence: str, except_columns: Sequence[str]) -> list[str]:
    hidden = {*keys, sequence, *except_columns}
    return [c for c in df.columns if c not in hidden]


def scd1(df: DataFrame, keys: Sequence[str], sequence: str, except_columns: Sequence[str] = ()) -> DataFrame:
    """Current row of each key: the one with the highest sequence value."""
    tracked = _tracked(df, keys, sequence, except_columns)
    latest = keep_latest(
        df.select(*keys, *tracked, sequence), keys, [F.col(sequence).desc()], tie_columns=[*keys, *tracked]
    )
    kept = [c for c in df.columns if c not in set(except_columns)]
    return latest.select(*kept)


def _versions_by_window(df: DataFrame, keys: Sequence[str], sequence: str, tracked: Sequence[str]) -> DataFrame:
    """All steps share one shuffle and one sort: the later windows order by a prefix of the first."""
    ordered = Window.partitionBy(*keys).orderBy(sequence, "_tie")
    by_sequence = Window.partitionBy(*keys).orderBy(sequence)

    last_of_sequence = F.lead(F.struct(sequence)).over(ordered)
    df = df.withColumn("_next", last_of_sequence).where(
        F.col("_next").isNull() | ~F.col(f"_next.{sequence}").eqNullSafe(F.col(sequence))
    )
    df = df.withColumn("_before", F.lag("_attributes").over(by_sequence)).where(
        F.col("_before").isNull() | ~F.col("_before").eqNullSafe(F.col("_attributes"))
    )
    df = df.withColumn(END_AT, F.lead(sequence).over(by_sequence))
    return df.select(*keys, *tracked, F.col(sequence).alias(START_AT), END_AT)


def _versions_by_range(df: DataFrame, keys: Sequence[str], sequence: str, tracked: Sequence[str]) -> DataFrame:
    df = keep_latest(df, [*keys, sequence], [F.col("_tie").desc()], tie_columns=["_tie"])
    order = [F.col(sequence)]
    df = neighbour_by_range(df, keys, order, {"_before": F.col("_attributes"), "_seen": F.lit(True)}, step=-1)
    df = df.where(F.col("_seen").isNull() | ~F.col("_before").eqNullSafe(F.col("_attributes"))).drop("_before", "_seen")
    df = neighbour_by_range(df, keys, order, {END_AT: F.col(sequence)}, step=1)
    return df.select(*keys, *tracked, F.col(sequence).alias(START_AT), END_AT)


def scd2(
    df: DataFrame,
    keys: Sequence[str],
    sequence: str,
    except_columns: Sequence[str] = (),
    hot_rows: int | None = HOT_SLOT_ROWS,
) -> DataFrame:
    """Version history: a row per change of a tracked attribute, valid in [__START_AT, __END_AT).

    Attributes are compared with the version just before, so A, B, A makes three versions. Rows of
    one key and sequence value count once. The bounds have the type of the sequence column.
    """
    tracked = _tracked(df, keys, sequence, except_columns)
    rows = df.select(*keys, sequence, *tracked).withColumns(
        {"_attributes": F.struct(*tracked), "_tie": content_hash([*keys, *tracked])}
    )
    ordinary, hot = split_by_heat(rows, keys, hot_rows)
    versions = _versions_by_window(ordinary, keys, sequence, tracked)
    if hot is None:
        return versions
    return versions.unionByName(_versions_by_range(hot, keys, sequence, tracked))


def valid_at(moment: Column | str) -> Column:
    """Condition: the version held at ``moment`` (a column, or a literal sequence value)."""
    at = moment if isinstance(moment, Column) else F.lit(moment)
    return (F.col(START_AT) <= at) & (F.col(END_AT).isNull() | (at < F.col(END_AT)))


def current_versions(versions: DataFrame) -> DataFrame:
    return versions.where(F.col(END_AT).isNull())


def versions_as_of(versions: DataFrame, moment: Column | str) -> DataFrame:
    return versions.where(valid_at(moment))
