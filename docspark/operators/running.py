"""Running totals and positions that stay spread out for very large keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(
    df: DataFrame, keys: Sequence[str], order: str, value: Column, name: str, chunk: int = 10_000, narrow: DataFrame | None = None
) -> DataFrame:
    """Add the sum of ``value`` over the earlier rows of each key, 0 for the first.

    Rows are summed within chunks of the order value, and the chunk sums are
    summed up on their own, so no task sorts a whole large key: a key with very
    many rows is spread over its chunks. ``order`` is a non-negative integer,
    unique within the key. ``narrow`` may give the same rows with the columns
    needed here alone, so that costly rows are made once and not once more for the sums.
    """

    def in_chunks(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_chunk", F.floor(F.col(order) / chunk)).withColumn("_v", value)

    chunked = in_chunks(df)
    sums = in_chunks(df if narrow is None else narrow).groupBy(*keys, "_chunk").agg(F.sum("_v").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, "_chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        chunked.withColumn("_i", F.coalesce(F.sum("_v").over(within), F.lit(0)))
        .join(starts, [*keys, "_chunk"])
        .withColumn(name, F.col("_start") + F.col("_i"))
        .drop("_chunk", "_v", "_i", "_start")
    )


def number_in_order(
    df: DataFrame, key: str, order: str, name: str = "row_no", chunk: int = 10_000, narrow: DataFrame | None = None
) -> DataFrame:
    """Add the 0-based position of each row within its key."""
    return running_total(df, [key], order, F.lit(1), name, chunk, narrow)
