"""Sequential operators on series: greedy merge, gap filling, shot distances, picks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import bhattacharyya
from ..session import cut
from .ranking import running_sum


def merged_chunks(spans: Column, longest: float = 20.0, gap: float = 1.0, shortest: float = 1.0) -> Column:
    """Speech spans <s, e> joined while the chunk stays short and the gap small.

    Whether a span joins depends on where its chunk began, so this is a fold over
    the sorted spans, inside the executor, in time linear in their number.
    """
    return F.filter(_merge(spans, F.lit(float(longest)), F.lit(float(gap))), lambda c: c.e - c.s >= shortest)


def _fold(spans: pd.Series, longest: pd.Series, gap: pd.Series) -> pd.Series:
    out = []
    for row, most, near in zip(spans, longest, gap, strict=True):
        chunks: list[dict] = []
        for s, e in sorted((x["s"], x["e"]) for x in (row if row is not None else [])):
            if chunks and e - chunks[-1]["s"] <= most and s - chunks[-1]["e"] < near:
                chunks[-1]["e"] = e
            else:
                chunks.append({"s": s, "e": e})
        out.append(chunks)
    return pd.Series(out)


_merge = F.pandas_udf(_fold, T.ArrayType(T.StructType([T.StructField("s", T.DoubleType()), T.StructField("e", T.DoubleType())])))


def filled_gaps(rows: DataFrame, by: list[str], at: str, value: str) -> DataFrame:
    """``rows`` with ``filled``: nulls of ``value`` linear between neighbours, ends held."""
    past = Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    future = Window.partitionBy(*by).orderBy(at).rowsBetween(0, Window.unboundedFollowing)
    has = F.when(F.col(value).isNotNull(), F.col(at))
    rows = rows.withColumns({
        "_a": F.last(has, True).over(past), "_va": F.last(value, True).over(past), "_b": F.first(has, True).over(future), "_vb": F.first(value, True).over(future),
    })
    w = (F.col(at) - F.col("_a")) / (F.col("_b") - F.col("_a"))
    between = (1 - w) * F.col("_va") + w * F.col("_vb")
    out = F.when(F.col(value).isNotNull(), F.col(value)).when(F.col("_a").isNull(), F.col("_vb")).when(F.col("_b").isNull(), F.col("_va")).otherwise(between)
    return rows.withColumn("filled", out).drop("_a", "_va", "_b", "_vb")


def shot_distances(frames: DataFrame, by: str, at: str, hist: str) -> DataFrame:
    """``frames`` with ``shot_dist`` to the frame before, 0 for the first."""
    w = Window.partitionBy(by).orderBy(at)
    before = F.lag(hist).over(w)
    return frames.withColumn("_h", before).withColumn("shot_dist", F.when(F.col("_h").isNull(), F.lit(0.0)).otherwise(bhattacharyya(F.col("_h"), F.col(hist)))).drop("_h")


def even_picks(rows: DataFrame, by: str, order: list[Column], k: int) -> DataFrame:
    """At most ``k`` rows of each ``by``, evenly spaced: row round(i (n - 1) / max(1, k - 1)).

    Rounding is half to even; with k > n all rows are picked; k <= 0 picks none.
    Positions come from a range sort and counts, so a large group is no window.
    """
    if k <= 0:
        return rows.where("false")
    placed = cut(running_sum(rows.withColumn("_one", F.lit(1).cast("long")), [by], order, "_one", "_nth"))
    n = placed.groupBy(F.col(by).alias("_by")).agg(F.max("_nth").alias("_n"))
    m = F.least(F.lit(k).cast("long"), F.col("_n"))
    step = (F.col("_n") - 1) / F.greatest(F.lit(1), m - 1)
    want = F.transform(F.sequence(F.lit(0).cast("long"), m - 1), lambda i: F.rint(i * step).cast("long") + 1)
    picks = n.select("_by", F.explode(want).alias("_pick")).distinct()
    same = F.col(by).eqNullSafe(F.col("_by")) & (F.col("_nth") == F.col("_pick"))
    return placed.join(picks, same).select(*rows.columns)


def cut_segments(rows: DataFrame, by: str, at: str, is_cut: Column) -> DataFrame:
    """``rows`` with ``segment``: number of cuts up to and with each row."""
    w = Window.partitionBy(by).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("segment", F.sum(is_cut.cast("int")).over(w))


def frame_spans(spans: DataFrame, by: str, start: Column, end: Column, fps: int) -> DataFrame:
    """(by, a, b): the frames a to b - 1 of each span, each pair once."""
    return spans.select(by, F.floor(start * fps).cast("int").alias("a"), F.ceil(end * fps).cast("int").alias("b")).where("b > a").distinct()


def swept(rows: DataFrame, by: str, a: str, b: str) -> DataFrame:
    """``rows`` with ``new``, the frames a to b - 1 that no row before covers, and ``inside``, whether a span covers a.

    Rows whose b is null are single frames that are asked about.  The sum of ``new``
    counts the covered frames once, without a row for each.
    """
    w = Window.partitionBy(by).orderBy(a, F.col(b).desc_nulls_last())
    past, upto = F.max(b).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.max(b).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumns({"new": F.greatest(F.lit(0), F.col(b) - F.greatest(F.col(a), past)), "inside": F.coalesce(upto > F.col(a), F.lit(False))})
