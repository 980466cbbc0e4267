"""Row expectations: rows that fail are dropped, and how many is observed, not counted in a second pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F


def drop_violations(df: DataFrame, expectations: dict[str, Column], observation: Observation | str | None = None) -> DataFrame:
    """Keep the rows for which every predicate is true; NULL counts as a violation.

    ``observation`` receives ``rows_in`` and one ``dropped_<name>`` per expectation when the result
    is written. Pass an :class:`Observation` for a batch, a name for a stream listener.
    """
    passed = {name: F.coalesce(predicate, F.lit(False)) for name, predicate in expectations.items()}
    if observation is not None:
        df = df.observe(
            observation,
            F.count(F.lit(1)).alias("rows_in"),
            *[F.count_if(~ok).alias(f"dropped_{name}") for name, ok in passed.items()],
        )
    for ok in passed.values():
        df = df.where(ok)
    return df


def not_null(*columns: str) -> dict[str, Column]:
    return {f"{column}_not_null": F.col(column).isNotNull() for column in columns}
