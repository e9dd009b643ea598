"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ordered(column: str, newest: bool, nulls_are_largest: bool) -> Column:
    c = F.col(column)
    if newest:
        return c.desc_nulls_first() if nulls_are_largest else c.desc_nulls_last()
    return c.asc_nulls_last() if nulls_are_largest else c.asc_nulls_first()


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    newest: bool = True,
    nulls_are_largest: bool = True,
    together: str | None = None,
) -> DataFrame:
    """Keep the row with the largest (or smallest) ``order_by`` of each key.

    Ties are settled by the remaining columns in ascending order, so the result
    does not depend on how the data was split. The ``rank = 1`` filter lets
    Spark keep one row per key and task *before* the shuffle, so a key that
    holds a large share of all rows costs one row per map task, not one huge
    reduce task.

    ``together`` names a column that follows from the key, as a claim's order does:
    all rows of a key have the same value of it. Rows that have been dealt out by it,
    for a join, are then not shuffled again. It is not part of the result.
    """
    by = [c for c in (together, *keys) if c is not None]
    ties = [F.col(c).asc_nulls_last() for c in df.columns if c not in by and c != order_by]
    ranked = Window.partitionBy(*by).orderBy(_ordered(order_by, newest, nulls_are_largest), *ties)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop(
        "_rank", *[c for c in by if c not in keys])
