"""Writing and replacing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def replace_table(
    df: DataFrame,
    target: str,
    *,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    as_path: bool = False,
) -> DataFrame:
    """Create or replace a Parquet table (or folder) from ``df`` and return it as read back.

    Rows are rebalanced by the partition columns first, so that files have an even size
    and a large partition value is split over several tasks; ``sort_by`` orders rows
    inside a file, for compression and row-group pruning.
    """
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    order = [*partition_by, *sort_by]
    if sort_by:
        rows = rows.sortWithinPartitions(*order)
    writer = rows.write.format("parquet").mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if as_path:
        writer.save(target)
        return df.sparkSession.read.schema(df.schema).parquet(target)
    writer.saveAsTable(target)
    return df.sparkSession.table(target)
