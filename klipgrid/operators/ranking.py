"""Exact ranks and order statistics without a single-task sort.

A range-partitioned sort puts rows in a total order over many balanced tasks.
Counting rows per partition (and key) gives a small table whose prefix sums say
where each partition starts, hence the rank of each row and the partition that
holds the row of any wanted rank.  Keys may be as skewed as they like: a hot key
is spread over as many partitions as it fills.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

_LOW = 33  # monotonically_increasing_id(): partition above, row in partition in these bits


def range_sorted(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` in the total order ``order``, written, with ``_part`` and ``_row``.

    The partition bounds come from sampling, so they are fixed by writing the
    table once; later readers agree on them even if executors are lost.
    """
    out = df.repartitionByRange(*order).sortWithinPartitions(*order)
    out = out.withColumn("_at", F.monotonically_increasing_id())
    out = out.withColumn("_part", F.shiftright("_at", _LOW)).withColumn("_row", F.col("_at").bitwiseAND((1 << _LOW) - 1))
    return cut(out.drop("_at"))


def with_position(df: DataFrame, *order: Column, name: str = "pos") -> DataFrame:
    """``df`` with the dense 0-based position of each row in the order ``order``.

    ``order`` should be total; rows that tie get different positions all the
    same.  The table of partition counts has as many rows as the sort has
    partitions, which bounds both its window and its broadcast.
    """
    rows = range_sorted(df, *order)
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(parts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_start")))
    return rows.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col("_row")).drop("_part", "_row", "_start")


def row_at_weight(df: DataFrame, key: list[str], order: list[Column], weight: str, targets: DataFrame, target: str) -> DataFrame:
    """For each key, the first row in ``order`` where the summed weight reaches ``target``.

    Returns the row's columns, ``target`` and ``_reached`` (the sum up to and
    with it).  ``targets`` has one row per key; keys without one, or whose total
    is below it, give no row.  Only rows of the partitions that hold a wanted
    row are looked at again.
    """
    rows = range_sorted(df, *[F.col(k) for k in key], *order)
    counts = rows.groupBy(*key, "_part").agg(F.sum(weight).alias("_w"))
    before = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_w").over(before), F.lit(0)))
    found = (
        counts.join(targets.select(*key, target), key)
        .where((F.col("_before") < F.col(target)) & (F.col("_before") + F.col("_w") >= F.col(target)))
        .select(*key, "_part", "_before", target)
    )
    near = rows.join(cut(found), [*key, "_part"])
    upto = Window.partitionBy(*key).orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("_reached", F.col("_before") + F.sum(weight).over(upto))
    hit = (F.col("_reached") >= F.col(target)) & (F.col("_reached") - F.col(weight) < F.col(target))
    return near.where(hit).drop("_part", "_row", "_before")


def running_sum(df: DataFrame, key: list[str], order: list[Column], value: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of the key up to and with each, in ``order``.

    Windows hold one key within one partition of the range sort, so a key with
    most of the rows is worked on by as many tasks as it fills.  What is carried
    over a partition's border belongs to the one key that goes on behind it, so
    the table of carries has at most one row per partition, which bounds its
    broadcast.  Null keys are a key; a null value counts as 0.
    """
    rows = range_sorted(df, *[F.col(k) for k in key], *order)
    sums = rows.groupBy("_part", *key).agg(F.coalesce(F.sum(value), F.lit(0)).alias("_sum"))
    past = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.withColumn("_carry", F.sum("_sum").over(past)).where("_carry is not null")
    carry = carry.select(F.col("_part").alias("_at"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], "_carry")
    same = F.col("_part") == F.col("_at")
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    here = Window.partitionBy("_part", *key).orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumn("_here", F.coalesce(F.sum(value).over(here), F.lit(0))).join(F.broadcast(carry), same, "left")
    return out.withColumn(name, F.col("_here") + F.coalesce("_carry", F.lit(0))).select(*df.columns, name)
