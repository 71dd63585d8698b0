"""Ordered windows over groups of any size.

A window partitioned by a natural key sends the whole group to one task, and one trip or
station can hold a large part of all rows. There are two ways around it, both exact:

* ``in_blocks`` and ``with_previous``: rows are range-partitioned by key and order, so that a
  large group is cut where the data say, and stored with their block. Each block is ordered by
  itself; a small table, one row per block at most, brings what came before it.
* ``with_halo``: where positions are whole numbers, so that a slice has a bounded number of rows,
  rows that a slice needs from the one before are copied over and dropped afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railstream.session import scratch_path
from railstream.sources.tables import replace_table

SLICE = "_slice"
HOME = "_home"
BLOCK = "_block"


def in_blocks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], *, blocks: int | None = None
) -> DataFrame:
    """Store ``df`` range-partitioned by ``keys`` and ``order``, each row with its ``_block``.

    Blocks have about the same number of rows and follow the order. They are stored in the
    scratch folder, because a range partition computed anew may be cut elsewhere.
    """
    columns = [F.col(c) for c in (*keys, *order)]
    ranged = df.repartitionByRange(blocks, *columns) if blocks else df.repartitionByRange(*columns)
    return replace_table(ranged.withColumn(BLOCK, F.spark_partition_id()),
                         scratch_path(df.sparkSession, "blocks"), as_path=True)


def with_previous(
    stored: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str | None = None
) -> DataFrame:
    """Add ``_previous``, the first order column of the row before, and ``_before``, the sum of
    ``weight`` over all rows before, both within ``keys``; NULL keys are equal.

    ``stored`` comes from ``in_blocks`` with the same keys and order.
    """
    earlier = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    total = F.sum(weight) if weight else F.lit(0).cast("bigint")
    rows = stored.withColumn("_lag", F.lag(order[0]).over(inside)).withColumn(
        "_inside", total.over(inside.rowsBetween(*earlier)) if weight else total)
    by_key = Window.partitionBy(*keys).orderBy(BLOCK)
    parts = stored.groupBy(*keys, BLOCK).agg(
        F.max(order[0]).alias("_last"), (total if weight else F.max(F.lit(0))).alias("_sum"))
    # Only a block's first group can go on from an earlier block: one row per block at most.
    goes_on = parts.select(
        *[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)], F.col(BLOCK).alias("_at"),
        F.lag("_last").over(by_key).alias("_last_before"),
        F.sum("_sum").over(by_key.rowsBetween(*earlier)).alias("_sum_before"),
    ).where(F.col("_last_before").isNotNull())
    match = [F.col(BLOCK) == F.col("_at"),
             *[F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)]]
    return (rows.join(F.broadcast(goes_on), match, "left")
            .withColumn("_previous", F.coalesce("_lag", "_last_before"))
            .withColumn("_before", F.coalesce("_inside", F.lit(0)) + F.coalesce("_sum_before", F.lit(0)))
            .drop("_lag", "_inside", "_last_before", "_sum_before", "_at",
                  *[f"_{i}" for i in range(len(keys))]))


def with_halo(df: DataFrame, position: Column, reach: Column, width: int) -> DataFrame:
    """Repeat each row in every slice that can look back at it.

    ``position`` is a whole number along the order, ``reach`` how far ahead of the row a
    later row may still refer to it, ``width`` the slice length. Adds ``_slice`` and
    ``_home`` (true in the row's own slice; keep only those after the window).
    """
    own = F.floor(position / F.lit(width))
    last = F.floor((position + reach) / F.lit(width))
    return (df.withColumn(SLICE, F.explode(F.sequence(own, last)))
              .withColumn(HOME, F.col(SLICE) == own))
