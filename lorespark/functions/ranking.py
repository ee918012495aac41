"""Row numbers and running sums within groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of the slices of the order column within which rows are numbered at once.
SLICE = 1_000_000


def number_rows(df: DataFrame, keys: list[str], order_col: str, ties: list[str] | None = None, out: str = "n", width: int = SLICE) -> DataFrame:
    """`out`: 1, 2, .. within `keys` by the integer `order_col`, then `ties`.

    Rows are numbered inside slices of the order column and slices are offset by the counts before
    them, so a key with very many rows is spread over as many tasks as it has slices. Null orders
    come first.
    """
    sliced = df.withColumn("__slice", F.coalesce(F.floor(F.col(order_col) / F.lit(width)), F.lit(-(2**62))).cast("bigint"))
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = sliced.groupBy(*keys, "__slice").agg(F.count("*").alias("__c"))
    offsets = counts.withColumn("__o", F.coalesce(F.sum("__c").over(before), F.lit(0))).drop("__c")
    inside = Window.partitionBy(*keys, "__slice").orderBy(order_col, *(ties or []))
    numbered = sliced.withColumn("__r", F.row_number().over(inside))
    link = [numbered[k].eqNullSafe(offsets[k]) for k in [*keys, "__slice"]]
    joined = numbered.join(offsets, link, "left")
    return joined.select(*[numbered[c] for c in df.columns], (F.col("__r") + F.col("__o")).alias(out))


def running_sum(df: DataFrame, keys: list[str], order_col: str, value: Column, out: str, width: int = SLICE) -> DataFrame:
    """`out`: the sum of the integers `value` within `keys` up to and with each row, by the integer `order_col`.

    Taken slice by slice as row numbers are. Rows of equal order share the sum up to the last of
    them, as in a window without frame; null values count as 0, null orders come first.
    """
    valued = df.withColumn("__value", F.coalesce(value.cast("bigint"), F.lit(0)))
    sliced = valued.withColumn("__slice", F.coalesce(F.floor(F.col(order_col) / F.lit(width)), F.lit(-(2**62))).cast("bigint"))
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sliced.groupBy(*keys, "__slice").agg(F.sum("__value").alias("__s"))
    offsets = sums.withColumn("__o", F.coalesce(F.sum("__s").over(before), F.lit(0))).drop("__s")
    summed = sliced.withColumn("__r", F.sum("__value").over(Window.partitionBy(*keys, "__slice").orderBy(order_col)))
    link = [summed[k].eqNullSafe(offsets[k]) for k in [*keys, "__slice"]]
    return summed.join(offsets, link, "left").select(*[summed[c] for c in df.columns], (F.col("__r") + F.col("__o")).alias(out))
