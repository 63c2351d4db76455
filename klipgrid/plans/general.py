"""Problems 4 and 5: counts under skew, and covered periods with their gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.intervals import periods_and_gaps
from ..operators.skew import counts_that_differ, salted_distinct_count
from ..sources import table


def p4_counts(spark: SparkSession, d: str) -> DataFrame:
    """Clips of every run and word, identical rows once."""
    return salted_distinct_count(table(spark, d, "word_clip"), ["run_id", "word"], "n_clips")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """(run_id, word) whose recorded count is null, absent or wrong."""
    return counts_that_differ(table(spark, d, "word_clip"), table(spark, d, "word_counts"), ["run_id", "word"], "count")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Covered periods and gaps of every video, over both clip tables."""
    cols = ["video_id", "frame_start", "frame_end"]
    clips = table(spark, d, "word_clip").select(*cols).unionAll(table(spark, d, "sentence_clip").select(*cols))
    out = periods_and_gaps(clips, *cols)
    return out.select(F.col("key").alias("video_id"), "kind", F.col("start").cast("int").alias("frame_start"), F.col("end").cast("int").alias("frame_end"))


QUERIES = {"p4_found": p4_found, "p4_counts": p4_counts, "p5_found": p5_found}

SQL = {
    "p4_counts": """
        SELECT run_id, word, count(*) AS n_clips FROM (SELECT DISTINCT * FROM word_clip) GROUP BY run_id, word""",
    "p4_found": """
        WITH n AS (SELECT run_id, word, count(*) AS c FROM (SELECT DISTINCT * FROM word_clip) GROUP BY run_id, word),
        r AS (SELECT DISTINCT run_id, word, count AS c FROM word_counts)
        SELECT DISTINCT coalesce(n.run_id, r.run_id) AS run_id, coalesce(n.word, r.word) AS word
        FROM n FULL JOIN r ON n.run_id = r.run_id AND n.word = r.word
        WHERE n.c IS NULL OR r.c IS NULL OR n.c <> r.c""",
    "p5_found": """
        WITH v AS (SELECT video_id, frame_start AS s, frame_end AS e FROM word_clip
                   UNION ALL SELECT video_id, frame_start, frame_end FROM sentence_clip),
        c AS (SELECT * FROM v WHERE video_id IS NOT NULL AND e >= s),
        o AS (SELECT *, max(e) OVER (PARTITION BY video_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM c),
        g AS (SELECT *, sum(CASE WHEN p IS NULL OR s > p + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS no FROM o),
        w AS (SELECT video_id, no, min(s) AS s, max(e) AS e FROM g GROUP BY video_id, no),
        n AS (SELECT *, lead(s) OVER (PARTITION BY video_id ORDER BY s) AS nx FROM w)
        SELECT video_id, 'period' AS kind, s AS frame_start, e AS frame_end FROM n
        UNION ALL
        SELECT video_id, 'gap', CAST(e + 1 AS INTEGER), CAST(nx - 1 AS INTEGER) FROM n WHERE nx IS NOT NULL""",
}
