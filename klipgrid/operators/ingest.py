"""Bookkeeping of ingest: eligibility, first-wins inserts, resume, status, streaks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import Listing, Screening
from ..session import cut
from .series import even_picks


def eligible(duration: Column, live: Column, url: Column, p: Listing = Listing()) -> Column:
    """Manifest rule: no live state, unknown duration or one in range, no short."""
    is_live = F.coalesce(live, F.lit("")).isin(*p.live)
    in_range = duration.isNull() | duration.between(p.min_duration, p.max_duration)
    return ~is_live & in_range & ~F.coalesce(url, F.lit("")).contains("/shorts/")


def screenable(duration: Column, live: Column, url: Column, p: Screening = Screening()) -> Column:
    """Screening rule: one live state more, and an unknown duration counts as 0."""
    is_live = F.coalesce(live, F.lit("")).isin(*p.live)
    return ~is_live & F.coalesce(duration, F.lit(0.0)).between(p.min_duration, p.max_duration) & ~F.coalesce(url, F.lit("")).contains("/shorts/")


def screen_picks(listing: DataFrame, planned: DataFrame, ok: Column, by: str, order: list[Column], k: int) -> DataFrame:
    """Rows of ``listing`` to sample: ``k`` evenly spaced ones of the eligible rows of each ``by``.

    A source that lists one video only keeps it even if it isn't eligible (a flat
    listing knows no duration).  Picks that are in ``planned`` (id) already are
    dropped, not replaced, and an id picked for two sources is taken once.
    """
    rows = listing.where(F.col("id").isNotNull()).withColumn("_ok", F.coalesce(ok, F.lit(False)))
    rows = cut(rows)
    alone = rows.groupBy(by).agg(F.count(F.lit(1)).alias("_n"), F.count_if("_ok").alias("_k")).where("_n = 1 and _k = 0").select(F.col(by).alias("_by"))
    fit = rows.where("_ok").unionByName(rows.join(alone, F.col(by).eqNullSafe(F.col("_by")), "left_semi")).drop("_ok")
    return insert_new(even_picks(fit, by, order, k), planned, "id", [F.col(by), *order])


def insert_new(new: DataFrame, existing: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``; the first in ``order`` of each key."""
    fresh = new.where(F.col(key).isNotNull()).join(existing.select(key), key, "left_anti")
    first = Window.partitionBy(key).orderBy(*order)
    return fresh.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")


def pending(work: DataFrame, log: DataFrame, key: str, done: tuple[str, ...] = ("ok", "unavailable")) -> DataFrame:
    """Work whose key never had a final status."""
    return work.join(log.where(F.col("status").isin(*done)).select(key), key, "left_anti")


def latest_status(log: DataFrame, key: str, seq: str) -> DataFrame:
    """(key, status): the status of the last line written for each key."""
    return log.groupBy(key).agg(F.max_by("status", seq).alias("status"))


def pending_by_latest(work: DataFrame, log: DataFrame, key: str, seq: str, done: tuple[str, ...] = ("ok", "unavailable")) -> DataFrame:
    """Work whose last status isn't final: an error after a success makes it pending again."""
    return pending(work, latest_status(log, key, seq), key, done)


def limit_streaks(log: DataFrame, by: list[str], seq: str, resets: Column, counts: Column) -> DataFrame:
    """``log`` with ``hits``: limits in a row since the last reset, other rows not counting.

    ``by`` splits the log into independent sessions (empty: one session, one task).
    """
    w = Window.partitionBy(*by).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    log = log.withColumn("_run", F.sum(resets.cast("int")).over(w))
    run = Window.partitionBy(*by, "_run").orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    return log.withColumn("hits", F.sum(counts.cast("int")).over(run)).drop("_run")


def limit_streaks_in_blocks(log: DataFrame, block: Column, seq: str, resets: Column, counts: Column) -> DataFrame:
    """``limit_streaks`` of the whole log, worked on in blocks.

    ``block`` must not fall as ``seq`` rises.  What each block leaves open, its limits
    since its last reset or all of them, is summed over the table of blocks and
    carried to the rows before the next block's first reset.
    """
    zero = F.lit(0)
    w = Window.partitionBy("_block").orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    log = log.withColumns({"_block": block, "_reset": F.coalesce(resets.cast("int"), zero), "_count": F.coalesce(counts.cast("int"), zero)})
    log = log.withColumn("_run", F.sum("_reset").over(w))
    per = log.groupBy("_block", "_run").agg(F.sum("_count").alias("_open"))
    per = per.groupBy("_block").agg(F.max("_run").alias("_runs"), F.max_by("_open", "_run").alias("_open"))
    # a block with a reset starts a new sum; one row per block
    order = Window.orderBy(F.col("_block").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumn("_since", F.count_if(F.col("_runs") > 0).over(order))
    since = Window.partitionBy("_since").orderBy(F.col("_block").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumn("_sum", F.sum("_open").over(since))
    carry = per.select(F.col("_block").alias("_of"), F.lag("_sum", 1, 0).over(Window.orderBy(F.col("_block").asc_nulls_last())).alias("_carry"))
    run = Window.partitionBy("_block", "_run").orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    log = log.withColumn("hits", F.sum("_count").over(run)).join(carry, F.col("_block").eqNullSafe(F.col("_of")))
    return log.withColumn("hits", F.col("hits") + F.when(F.col("_run") == 0, F.col("_carry")).otherwise(0)).drop("_block", "_reset", "_count", "_run", "_of", "_carry")


def rolling_count(log: DataFrame, by: list[str], t: str, seconds: int) -> DataFrame:
    """``log`` with ``in_window``: rows of the same ``by`` in the ``seconds`` up to each row."""
    w = Window.partitionBy(*by).orderBy(t).rangeBetween(-seconds, 0)
    return log.withColumn("in_window", F.count(F.lit(1)).over(w))


def rolling_count_in_buckets(log: DataFrame, t: str, seconds: int, bucket: int = 86_400) -> DataFrame:
    """``log`` with ``in_window``: rows of the whole log in the ``seconds`` up to each row.

    A window holds one ``bucket`` of time and the ``seconds`` before it, whose rows
    are given to it a second time and not returned; so no task holds the whole log.
    """
    if not 0 <= seconds <= bucket:
        raise ValueError("seconds must fit into a bucket")
    own = F.floor(F.col(t) / bucket)
    late = F.pmod(F.col(t), F.lit(bucket)) >= bucket - seconds
    at = F.explode(F.when(late, F.array(own, own + 1)).otherwise(F.array(own)))
    rows = log.withColumn("_at", at)
    return rolling_count(rows, ["_at"], t, seconds).where(F.col("_at") == own).drop("_at")


def newest(rows: DataFrame, by: str, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each ``by``; 0 keeps all."""
    if n <= 0:
        return rows
    w = Window.partitionBy(by).orderBy(*order)
    return rows.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= n)


def flatten_listing(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(root, leaf): leaves under each root of a parent/child listing of any depth.

    ``edges`` has parent and child, ``roots`` has root; a root without children
    is its own leaf; null children count as none.  A node is followed once per
    root, so a listing that contains itself ends, and its cycle has no leaf.  Each
    level is written to the shared folder.
    """
    edges = cut(edges.where("child is not null").select(F.col("parent").alias("node"), "child").distinct())
    level = cut(roots.select("root", F.col("root").alias("node")).where("root is not null").distinct())
    seen = [level]
    while True:
        step = level.join(edges, "node").select("root", F.col("child").alias("node")).distinct()
        known = reduce(DataFrame.unionByName, seen)
        level = cut(step.join(known, ["root", "node"], "left_anti"))
        if level.isEmpty():
            break
        seen.append(level)
    return reduce(DataFrame.unionByName, seen).join(edges.select("node"), "node", "left_anti").select("root", F.col("node").alias("leaf"))
