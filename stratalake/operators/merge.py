"""Idempotent merges of a batch into a target, as plain joins.

A batch has at most one row per key when it gets here (see ``latest_by``). A
NULL key never matches, so such a row is inserted each time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions import safe_timestamp

#: Batches of more rows are never broadcast, nor are the keys they meet. Spark goes by the size of files,
#: where a column of keys beside columns of NULLs or repeated values is far smaller than in memory.
BROADCAST_ROWS = 100_000


def unmatched(
    batch: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    within: Mapping[str, Sequence] | None = None,
    batch_keys: DataFrame | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Batch rows whose key is not in the target.

    The target is read for its key columns only, and first cut down to the keys
    of the batch: when the batch's keys are small Spark broadcasts them, and
    the large target is scanned without being shuffled. A batch known to have more than
    ``BROADCAST_ROWS`` ``rows`` is joined with the target's keys at once, by a shuffle that may
    spill and that uses how the batch was dealt out to find one row per key. ``within`` restricts
    the target by values of key columns that cover the whole batch, such as its
    source files; being part of the key, they cannot hide a match. Pass
    ``batch_keys`` when the batch's distinct keys can be had more cheaply than
    from ``batch`` itself, say from the rows it was deduplicated from.
    """
    known = target
    for column, values in (within or {}).items():
        if column not in keys:
            raise ValueError(f"{column} is not a key column")
        known = known.where(F.col(column).isin(list(values)))
    if rows is not None and rows > BROADCAST_ROWS:
        return batch.join(known.select(*keys).hint("merge"), list(keys), "left_anti")
    if batch_keys is None:
        batch_keys = batch.select(*keys)
    hits = known.select(*keys).join(batch_keys, list(keys), "left_semi")
    return batch.join(hits, list(keys), "left_anti")


def insert_only(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    within: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Target plus the batch rows with new keys; known keys stay as they are."""
    return target.unionByName(unmatched(batch, target, keys, within))


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    keep: Sequence[str] = (),
    newer_by: str | None = None,
    flags: bool = False,
) -> DataFrame:
    """Target with matching rows replaced by the batch's and new keys added.

    ``keep`` names columns whose first value survives an update. With
    ``newer_by`` a row is only replaced when the batch's timestamp there is not
    older. One join, so target and batch are each shuffled once. ``flags`` adds
    the columns ``_inserted`` and ``_matched``, for whoever counts rows.
    """
    tgt = target.withColumn("_in_target", F.lit(True)).alias("tgt")
    src = batch.withColumn("_in_batch", F.lit(True)).alias("src")
    same_key = reduce(lambda a, b: a & b, [F.col(f"tgt.{k}") == F.col(f"src.{k}") for k in keys])

    in_target, in_batch = F.col("_in_target").isNotNull(), F.col("_in_batch").isNotNull()
    take_batch = in_batch
    if newer_by:
        old, new = safe_timestamp(F.col(f"tgt.{newer_by}")), safe_timestamp(F.col(f"src.{newer_by}"))
        not_older = old.isNull() | F.coalesce(new >= old, F.lit(False))
        take_batch = in_batch & (~in_target | not_older)

    def pick(column: str):
        mine, theirs = F.col(f"tgt.{column}"), F.col(f"src.{column}")
        chosen = F.when(in_target, mine).otherwise(theirs) if column in keep else \
            F.when(take_batch, theirs).otherwise(mine)
        return chosen.alias(column)

    marks = [(in_batch & ~in_target).alias("_inserted"), (in_batch & in_target).alias("_matched")] if flags else []
    return tgt.join(src, same_key, "full_outer").select(*[pick(c) for c in target.columns], *marks)
