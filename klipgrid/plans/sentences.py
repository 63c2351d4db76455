"""Queries of sentence clips: windows, words on their frames, the gate, and the rejects of both kinds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timeline as L
from ..operators import gate as G
from ..session import cut
from ..sources import table
from . import faces as A
from .transcripts import words


def _lengths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "word_clip").where("frame_end is not null").groupBy("video_id").agg((F.max("frame_end") + 1).alias("n_frames"))


def sentence_windows(spark: SparkSession, d: str) -> DataFrame:
    """(video_id, chunk, i0, i1, n_words, score, n_frames): chunks of videos with faces on the frames of their video."""
    c = table(spark, d, "align").select("video_id", F.posexplode("chunks").alias("chunk", "c")).join(_lengths(spark, d), "video_id")
    i0, i1 = L.sentence_window(F.col("c.start"), F.col("c.end"), F.col("n_frames"))
    n = F.greatest(F.size(F.coalesce("c.words", F.array())), F.lit(0)).alias("n_words")
    return c.select("video_id", "chunk", i0.alias("i0"), i1.alias("i1"), n, F.col("c.score").alias("score"), "n_frames").distinct()


def sentence_clip_rows(spark: SparkSession, d: str) -> DataFrame:
    """Windows in frames and seconds, and how many frames of each may lack the face."""
    w = sentence_windows(spark, d)
    n = F.col("i1") - F.col("i0")
    return w.select(
        "video_id", "chunk", F.col("i0").alias("frame_start"), (F.col("i1") - 1).alias("frame_end"), n.alias("n_frames"), L.time_of(F.col("i0")).alias("clip_start"), L.time_of(F.col("i1")).alias("clip_end"),
        "n_words", F.floor(n * 0.05 + 1e-9).cast("int").alias("max_missing"),
    )


def sentence_words(spark: SparkSession, d: str) -> DataFrame:
    """Words of each sentence, their times (ms) from its start and their frames in it."""
    w = words(spark, d).where("s is not null and e is not null").join(sentence_windows(spark, d).select("video_id", "chunk", "i0", "i1").distinct(), ["video_id", "chunk"])
    a, b = L.sentence_word_frames(F.col("s"), F.col("e"), F.col("i0"), F.col("i1"))
    ms = lambda c: F.floor((F.col(c) - L.time_of(F.col("i0"))) * 1000 + 0.5).cast("long")
    return w.select("video_id", "chunk", "idx", "word", "label", "i0", ms("s").alias("start_ms"), ms("e").alias("end_ms"), a.alias("start_frame"), b.alias("end_frame"), "score")


def _gated(spark: SparkSession, d: str, det: DataFrame | None = None) -> DataFrame:
    det = cut(A.detections(spark, d)) if det is None else det
    return G.sentence_reasons(cut(sentence_windows(spark, d)), det, A.frames_of(det), A.GATE, A.CUT, missing=A.SENTENCE_MISSING)


def _measured(rows: DataFrame, *first: str) -> DataFrame:
    return rows.select(*first, "reason", *[F.col(f"metrics.{m}").alias(m) for m in G.METRICS])


def sentence_gate(spark: SparkSession, d: str) -> DataFrame:
    """Every sentence with the first test it fails, and what was measured of its face."""
    return _measured(_gated(spark, d), "video_id", "chunk", "i0", "i1")


def reject_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rejected words and sentences with their reason, and the metrics of those whose face was looked at."""
    det = cut(A.detections(spark, d))
    w = G.word_reasons(cut(A.candidates(spark, d)), det, A.frames_of(det), A.GATE, A.CUT)
    w = w.select(F.lit("words").alias("kind"), "video_id", "chunk", "label", F.col("i0").alias("frame_start"), "reason", "metrics")
    s = _gated(spark, d, det).select(F.lit("sentences").alias("kind"), "video_id", "chunk", F.lit(None).cast("string").alias("label"), F.col("i0").alias("frame_start"), "reason", "metrics")
    return _measured(w.unionByName(s).where("reason <> 'ok'"), "kind", "video_id", "chunk", "label", "frame_start")


def reject_counts(spark: SparkSession, d: str) -> DataFrame:
    """The summary of a run of each kind: candidates, written, and the rejected by reason as rows."""
    det = cut(A.detections(spark, d))
    w = G.word_reasons(cut(A.candidates(spark, d)), det, A.frames_of(det), A.GATE, A.CUT).select(F.lit("words").alias("kind"), "reason")
    s = _gated(spark, d, det).select(F.lit("sentences").alias("kind"), "reason")
    return w.unionByName(s).groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (sentence_clip_rows, sentence_words, sentence_gate, reject_rows, reject_counts)}

_WINDOWS = """nfs AS (SELECT video_id, max(frame_end) + 1 AS n_frames FROM word_clip WHERE frame_end IS NOT NULL GROUP BY video_id),
    c0 AS (SELECT video_id, unnest(chunks) AS c, generate_subscripts(chunks, 1) - 1 AS chunk FROM align),
    sw AS (SELECT DISTINCT video_id, chunk, CAST(ceil(c.start * 25) AS INTEGER) AS i0, least(n_frames, CAST(floor(c."end" * 25) AS INTEGER) + 1) AS i1, coalesce(len(c.words), 0) AS n_words, c.score AS score, n_frames
        FROM c0 JOIN nfs USING (video_id))"""
_GATED = f"""{_WINDOWS}, early AS (SELECT *, CASE WHEN n_words = 0 OR score IS NULL OR score < -1.0::DOUBLE THEN 'low_align_score' WHEN NOT coalesce((i1 - i0) / 25::DOUBLE BETWEEN 1 AND 20, false) THEN 'length'
        WHEN i0 < 0 THEN 'video_edge' END AS early FROM sw),
    ins AS (SELECT * FROM early WHERE early IS NULL),
    sper AS (SELECT c.video_id, chunk, i0, i1, track, count(*) AS n, min(frame * 1000 + ord) AS seen, min(width) AS w_min, median(width) AS w_med, quantile_cont(abs(yaw), 0.95) AS yaw, quantile_cont(abs(pitch), 0.95) AS pitch,
        quantile_cont(abs(roll), 0.95) AS roll, median(sharp) AS sharp FROM ins c JOIN det t ON c.video_id = t.video_id AND frame >= i0 AND frame < i1 GROUP BY c.video_id, chunk, i0, i1, track),
    srank AS (SELECT *, row_number() OVER (PARTITION BY video_id, chunk, i0, i1 ORDER BY n DESC, seen) AS k, count(*) FILTER (WHERE n >= 2) OVER (PARTITION BY video_id, chunk, i0, i1) AS crowd FROM sper),
    sch AS (SELECT c.video_id, chunk, i0, i1, max(shot_dist) AS change FROM ins c JOIN fr ON c.video_id = fr.video_id AND frame > i0 AND frame < i1 GROUP BY c.video_id, chunk, i0, i1),
    sspan AS (SELECT video_id, track, min(frame) AS first, max(frame) AS last FROM det GROUP BY video_id, track),
    smet AS (SELECT c.*, m.track, i1 - i0 - n AS missing, crowd - CASE WHEN n >= 2 THEN 1 ELSE 0 END AS others, w_min AS width_min, w_med AS width_median, floor((m.yaw + 0.0000001::DOUBLE) * 10 + 0.5::DOUBLE) / 10 AS yaw, floor((m.pitch + 0.0000001::DOUBLE) * 10 + 0.5::DOUBLE) / 10 AS pitch,
        floor((m.roll + 0.0000001::DOUBLE) * 10 + 0.5::DOUBLE) / 10 AS roll, m.sharp AS sharp_median, floor(coalesce(change, 0) * 1000 + 0.5::DOUBLE) / 1000 AS change, coalesce(change > 0.97::DOUBLE, false) AS has_cut, first, last
        FROM ins c LEFT JOIN (SELECT * FROM srank WHERE k = 1) m USING (video_id, chunk, i0, i1) LEFT JOIN sch USING (video_id, chunk, i0, i1) LEFT JOIN sspan s ON s.video_id = c.video_id AND s.track = m.track),
    sfin AS (SELECT video_id, chunk, i0, i1, {A._REASON.replace("missing > 27", "missing > floor((i1 - i0) * " + str(A.SENTENCE_MISSING) + "::DOUBLE + 0.000000001::DOUBLE)")} AS reason, track, missing,
            CASE WHEN track IS NOT NULL THEN others END AS others, width_min, width_median, yaw, pitch, roll, sharp_median, CASE WHEN track IS NOT NULL THEN change END AS change FROM smet
        UNION ALL SELECT video_id, chunk, i0, i1, early, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM early WHERE early IS NOT NULL)"""
_M = "track, missing, others, width_min, width_median, yaw, pitch, roll, sharp_median, change"
_WFIN = f"""wfin AS (SELECT video_id, chunk, label, i0, CASE WHEN over THEN 'per_video_cap' ELSE face END AS reason, {', '.join(f'CASE WHEN NOT over AND track IS NOT NULL THEN {m} END AS {m}' for m in _M.split(', '))} FROM cp
        UNION ALL SELECT video_id, chunk, label, i0, 'video_edge', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM cand WHERE i0 < 0 OR i1 > n_frames)"""

SQL = {
    "sentence_clip_rows": f"""
        WITH {_WINDOWS} SELECT video_id, chunk, i0 AS frame_start, i1 - 1 AS frame_end, i1 - i0 AS n_frames, i0 / 25::DOUBLE AS clip_start, i1 / 25::DOUBLE AS clip_end, n_words,
            CAST(floor((i1 - i0) * 0.05::DOUBLE + 0.000000001::DOUBLE) AS INTEGER) AS max_missing FROM sw""",
    "sentence_words": f"""
        WITH {A.WORDS}, {_WINDOWS}, k AS (SELECT DISTINCT video_id, chunk, i0, i1 FROM sw)
        SELECT video_id, chunk, idx, word, label, i0, CAST(floor((s - i0 / 25::DOUBLE) * 1000 + 0.5::DOUBLE) AS BIGINT) AS start_ms, CAST(floor((e - i0 / 25::DOUBLE) * 1000 + 0.5::DOUBLE) AS BIGINT) AS end_ms,
            greatest(0, CAST(ceil(s * 25 - 0.000001::DOUBLE) AS INTEGER) - i0) AS start_frame, least(i1 - i0 - 1, CAST(floor(e * 25 + 0.000001::DOUBLE) AS INTEGER) - i0) AS end_frame, score
        FROM words JOIN k USING (video_id, chunk) WHERE s IS NOT NULL AND e IS NOT NULL""",
    "sentence_gate": f"WITH {A._DET}, {_GATED} SELECT video_id, chunk, i0, i1, reason, {_M} FROM sfin",
    "reject_rows": f"""
        WITH {A._CAND}, {A._METRICS}, {A._CAP}, {_WFIN}, {_GATED}
        SELECT 'words' AS kind, video_id, chunk, label, i0 AS frame_start, reason, {_M} FROM wfin WHERE reason <> 'ok'
        UNION ALL SELECT 'sentences', video_id, chunk, NULL, i0, reason, {_M} FROM sfin WHERE reason <> 'ok'""",
    "reject_counts": f"""
        WITH {A._CAND}, {A._METRICS}, {A._CAP}, {_GATED}
        SELECT kind, reason, count(*) AS n FROM (SELECT 'words' AS kind, reason FROM fin UNION ALL SELECT 'sentences', reason FROM sfin) GROUP BY kind, reason""",
}
