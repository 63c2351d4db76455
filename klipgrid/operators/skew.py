"""Per-key results when a few keys hold most rows: two-stage salted aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .identity import fingerprint


def heavy_keys(df: DataFrame, key: list[str], share: float) -> DataFrame:
    """Keys with more than ``share`` of all rows, and into how many salts each is cut.

    At most ``1/share`` keys can qualify, whatever the size of ``df``: that is
    the proven bound under which the result may be broadcast.
    """
    counts = cut(df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")))
    total = counts.agg(F.sum("_n").alias("_total"))
    return (
        counts.join(F.broadcast(total))  # one row
        .where(F.col("_n") > F.col("_total") * share)
        .select(*key, F.ceil(F.col("_n") / (F.col("_total") * share)).cast("int").alias("_salts"))
    )


def hot_values(df: DataFrame, key: str, share: float = 1 / 512) -> list:
    """Non-null values of ``key`` that more than ``share`` of the rows have: at most ``1 / share`` of them."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.orderBy(F.desc("_n")).limit(int(1 / share)).collect()
    if not top:
        return []
    least = df.count() * share
    return [r[key] for r in top if r["_n"] > least]


def join_unique(many: DataFrame, one: DataFrame, key: str, how: str = "inner", heavy_share: float = 1 / 512, hot: list | None = None) -> DataFrame:
    """``many`` joined to ``one``, in which ``key`` is unique, when some keys hold much of ``many``.

    Rows of ``one`` for the hot keys, of which there are at most
    ``1 / heavy_share``, are broadcast; all other rows meet by hash.  So no task
    gets more than about ``heavy_share`` of ``many``, however hot a key is.
    ``how`` is 'inner' or 'left'; null keys meet nothing.  ``hot`` are the hot
    values if they are known; ``many`` should be a written table, as it is read for
    each part.
    """
    hot = hot_values(many, key, heavy_share) if hot is None else hot
    if not hot:
        return many.join(one, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    fast = many.where(is_hot).join(F.broadcast(one.where(is_hot)), key, how)
    return fast.unionByName(many.where(~is_hot).join(one, key, how))


def salted_distinct_count(df: DataFrame, key: list[str], name: str = "n", heavy_share: float = 1 / 512) -> DataFrame:
    """Exact number of different rows of ``df`` for each ``key``.

    Stage one cuts each heavy key into salts, drops repeated rows and counts per
    (key, salt); stage two merges the partial counts by key.  The salt is taken
    from the row's fingerprint: as even as a random one, but the same when a
    lost task is run again, and equal for identical rows, which therefore meet.
    No task of stage one gets more than about ``heavy_share`` of the rows.

    Null keys form groups of their own; an empty table gives no rows; other
    columns take part only in deciding which rows are identical.
    """
    heavy = F.broadcast(heavy_keys(df, key, heavy_share).toDF(*[f"_h{i}" for i in range(len(key))], "_salts"))
    rows = df.select(*[F.col(k) for k in key], *fingerprint(df))
    same = F.lit(True)
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"_h{i}"))
    rows = rows.join(heavy, same, "left")
    rows = rows.withColumn("_salt", F.pmod("_fp1", F.coalesce("_salts", F.lit(1)))).select(*key, "_salt", "_fp1", "_fp2")
    spread = rows.repartition(*key, "_salt")  # both groupings below keep this partitioning
    partial = spread.groupBy(*key, "_salt", "_fp1", "_fp2").agg(F.lit(1).alias("_one"))
    partial = partial.groupBy(*key, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    return partial.groupBy(*key).agg(F.sum("_n").alias(name))


def counts_that_differ(rows: DataFrame, recorded: DataFrame, key: list[str], count: str) -> DataFrame:
    """Keys whose recorded count is null, absent or not the number of rows.

    ``rows`` are counted by :func:`salted_distinct_count`; ``recorded`` has
    ``key`` and ``count``.  A key recorded for no row is a case, whatever its
    count.  If a key is recorded more than once, each record must be right.
    """
    found = salted_distinct_count(rows, key, "_found").withColumns({"_rec": F.lit(0), "_null": F.lit(0), "_lo": F.lit(None).cast("long"), "_hi": F.lit(None).cast("long")})
    said = recorded.select(
        *key, F.lit(0).cast("long").alias("_found"), F.lit(1).alias("_rec"),
        F.isnull(count).cast("int").alias("_null"), F.col(count).cast("long").alias("_lo"), F.col(count).cast("long").alias("_hi"),
    )
    both = found.unionByName(said).groupBy(*key).agg(
        F.sum("_found").alias("_found"), F.sum("_rec").alias("_rec"), F.sum("_null").alias("_null"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")
    )
    wrong = (F.col("_rec") == 0) | (F.col("_null") > 0) | (F.col("_found") == 0) | (F.col("_lo") != F.col("_found")) | (F.col("_hi") != F.col("_found"))
    return both.where(wrong).select(*key)
