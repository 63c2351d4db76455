"""Score cutoffs that keep a target fraction of each source's records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.identity import distinct_rows
from ..operators.ranking import row_at_weight
from ..session import cut


def fraction_cutoffs(df: DataFrame, source: str, score: str, targets: DataFrame, permille: str) -> DataFrame:
    """For each source the highest score that keeps at least its share of records.

    A record is a different row of ``df`` with non-null ``source`` and a
    ``score`` that is a number (null and NaN are none).  Equal scores are kept
    or dropped together.  Records are first counted per (source, score), so a
    source with many ties shrinks before anything is sorted; then follow the
    range sort by source and score, counts per partition and source, prefix sums
    that locate the partition, and the read of the exact row.

    Returns ``source``, ``cutoff``, ``n_kept``, ``n``.  A source without records
    or without a target gives no row; a share of 0 (or less) keeps the records
    of the best score, a share over 1000 keeps all.  Of several targets for one
    source the largest counts.
    """
    df = df.where(F.col(source).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score))
    hist = cut(distinct_rows(df, source, score).groupBy(source, score).agg(F.count(F.lit(1)).alias("_n")))
    goal = targets.groupBy(source).agg(F.max(permille).alias("_permille"))
    total = hist.groupBy(source).agg(F.sum("_n").alias("n"))
    need = F.expr("(n * _permille + 999) div 1000")
    goal = total.join(goal.where(F.col("_permille").isNotNull()), source)
    goal = goal.withColumn("_need", F.least(F.col("n"), F.greatest(F.lit(1).cast("long"), need)))
    hit = row_at_weight(hist, [source], [F.col(score).desc()], "_n", goal, "_need")
    return hit.join(total, source).select(source, F.col(score).alias("cutoff"), F.col("_reached").alias("n_kept"), "n")
