"""Queries of the face gate.

The data folder has no detections, so they are derived from the recorded clips:
one detection at each clip's middle frame, widths and yaw in tenths so that both
engines round alike; pitch and frame changes are arithmetic on the frame number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timeline import word_window
from ..operators import gate as G
from ..operators.series import cut_segments, frame_spans, swept
from ..operators.tracker import track_boxes
from ..params import Gate
from ..session import cut
from ..sources import table
from .transcripts import USABLE, WORDS, usable_words

#: Chosen so that every reason occurs on the derived detections.
GATE = Gate(max_change=0.95, max_missing=27, min_other=2, min_face=1300.0, max_yaw=150.0, max_pitch=40.0)
CUT = 0.97
SENTENCE_MISSING = 0.99  # the derived detections are sparse; the command's own share is 0.05


def detections(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "word_clip").where("frame_start is not null and face.track is not null and video_id is not null")
    tenth = lambda x: F.floor(F.col(x) * 10 + 0.5).cast("double")
    det = c.select("video_id", (F.col("frame_start") + 14).alias("frame"), F.col("face.track").alias("track"), tenth("face.face_width_median").alias("width"), tenth("face.yaw_abs").alias("yaw")).distinct()
    turn = lambda a, b, m: ((F.col("frame") * a + F.col("track") * b) % m).cast("double")
    det = det.withColumns({"pitch": turn(7, 3, 50), "roll": turn(3, 1, 40), "sharp": turn(11, 5, 90)})
    w = Window.partitionBy("video_id", "frame").orderBy("track", F.col("width").asc_nulls_first(), F.col("yaw").asc_nulls_first())
    return det.withColumn("ord", (F.row_number().over(w) - 1).cast("int"))


def frames(spark: SparkSession, d: str) -> DataFrame:
    return frames_of(detections(spark, d))


def frames_of(det: DataFrame) -> DataFrame:
    """Frames with a detection, and their distance to the frame before."""
    return det.select("video_id", "frame").distinct().withColumn("shot_dist", ((F.col("frame") * 13 + 7) % 100).cast("double") / 100)


def candidates(spark: SparkSession, d: str) -> DataFrame:
    """Windows of usable words of videos with faces."""
    n = table(spark, d, "word_clip").where("frame_end is not null").groupBy("video_id").agg((F.max("frame_end") + 1).alias("n_frames"))
    w = usable_words(spark, d).join(n, "video_id")
    return w.select("video_id", "chunk", "idx", "label", word_window(F.col("s"), F.col("e")).alias("i0"), "n_frames").distinct().withColumn("i1", F.col("i0") + 29).select("video_id", "chunk", "idx", "label", "i0", "i1", "n_frames")


_DET = """d0 AS (SELECT DISTINCT video_id, frame_start + 14 AS frame, face.track AS track, floor(face.face_width_median * 10 + 0.5::DOUBLE) AS width, floor(face.yaw_abs * 10 + 0.5::DOUBLE) AS yaw
        FROM word_clip WHERE frame_start IS NOT NULL AND face.track IS NOT NULL AND video_id IS NOT NULL),
    det AS (SELECT *, CAST((frame * 7 + track * 3) % 50 AS DOUBLE) AS pitch, CAST((frame * 3 + track) % 40 AS DOUBLE) AS roll, CAST((frame * 11 + track * 5) % 90 AS DOUBLE) AS sharp, row_number() OVER (PARTITION BY video_id, frame ORDER BY track, width NULLS FIRST, yaw NULLS FIRST) - 1 AS ord FROM d0),
    fr AS (SELECT DISTINCT video_id, frame, CAST((frame * 13 + 7) % 100 AS DOUBLE) / 100 AS shot_dist FROM det)"""
_CAND = f"""{WORDS}, {_DET}, nf AS (SELECT video_id, max(frame_end) + 1 AS n_frames FROM word_clip WHERE frame_end IS NOT NULL GROUP BY video_id),
    cand AS (SELECT DISTINCT video_id, chunk, idx, label, CAST(round_even((s + e) / 2 * 25, 0) AS INTEGER) - 14 AS i0, CAST(round_even((s + e) / 2 * 25, 0) AS INTEGER) + 15 AS i1, n_frames
        FROM words JOIN nf USING (video_id) WHERE {USABLE})"""
_METRICS = """inside AS (SELECT * FROM cand WHERE i0 >= 0 AND i1 <= n_frames),
    per AS (SELECT c.video_id, chunk, idx, label, i0, i1, track, count(*) AS n, min(frame * 1000 + ord) AS seen, min(width) AS w_min, median(width) AS w_med, max(abs(yaw)) AS yaw, max(abs(pitch)) AS pitch, max(abs(roll)) AS roll, median(sharp) AS sharp
        FROM inside c JOIN det t ON c.video_id = t.video_id AND frame >= i0 AND frame < i1 GROUP BY c.video_id, chunk, idx, label, i0, i1, track),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY video_id, chunk, idx, label, i0 ORDER BY n DESC, seen) AS k, count(*) FILTER (WHERE n >= 2) OVER (PARTITION BY video_id, chunk, idx, label, i0) AS crowd FROM per),
    main AS (SELECT *, crowd - CASE WHEN n >= 2 THEN 1 ELSE 0 END AS others FROM ranked WHERE k = 1),
    ch AS (SELECT c.video_id, chunk, idx, label, i0, max(shot_dist) AS change, bool_or(shot_dist > 0.97::DOUBLE) AS has_cut FROM inside c JOIN fr ON c.video_id = fr.video_id AND frame > i0 AND frame < i1
        GROUP BY c.video_id, chunk, idx, label, i0),
    span AS (SELECT video_id, track, min(frame) AS first, max(frame) AS last FROM det GROUP BY video_id, track),
    met AS (SELECT c.*, m.track, i1 - i0 - n AS missing, others, w_min AS width_min, w_med AS width_median, m.yaw, m.pitch, m.roll, m.sharp AS sharp_median, floor(coalesce(change, 0) * 1000 + 0.5::DOUBLE) / 1000 AS change, coalesce(has_cut, false) AS has_cut, first, last
        FROM inside c LEFT JOIN (SELECT * EXCLUDE (i1) FROM main) m USING (video_id, chunk, idx, label, i0) LEFT JOIN ch USING (video_id, chunk, idx, label, i0) LEFT JOIN span s ON s.video_id = c.video_id AND s.track = m.track)"""
_REASON = """CASE WHEN track IS NULL THEN 'no_face' WHEN has_cut THEN 'shot_cut' WHEN first > i0 OR last < i1 - 1 THEN 'track_break' WHEN change > 0.95::DOUBLE THEN 'unstable_frames'
    WHEN missing > 27 THEN 'face_missing' WHEN others > 0 THEN 'multiple_faces' WHEN width_min < 1300 THEN 'small_face' WHEN yaw > 150 THEN 'yaw' WHEN pitch > 40 THEN 'pitch' ELSE 'ok' END"""
_CAP = f"""rs AS (SELECT *, {_REASON} AS face FROM met),
    cp AS (SELECT *, coalesce(sum(CASE WHEN face = 'ok' THEN 1 ELSE 0 END) OVER (PARTITION BY video_id, label ORDER BY chunk, idx, i0 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) >= 5 AS over FROM rs),
    fin AS (SELECT video_id, chunk, idx, label, i0, CASE WHEN over THEN 'per_video_cap' ELSE face END AS reason FROM cp
            UNION ALL SELECT video_id, chunk, idx, label, i0, 'video_edge' FROM cand WHERE i0 < 0 OR i1 > n_frames)"""


def _stored(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Windows and detections as written tables, as each is read more than once, and the frames of the latter."""
    det = cut(detections(spark, d))
    return cut(candidates(spark, d)), det, frames_of(det)


def track_spans(spark: SparkSession, d: str) -> DataFrame:
    return G.track_spans(detections(spark, d))


def face_frames(spark: SparkSession, d: str) -> DataFrame:
    return detections(spark, d).groupBy("video_id").agg(F.countDistinct("frame").alias("frames_with_face"), F.count(F.lit(1)).alias("n_detections"))


def window_metrics(spark: SparkSession, d: str) -> DataFrame:
    c, det, fr = _stored(spark, d)
    m = G.window_metrics(c.where("i0 >= 0 and i1 <= n_frames"), ["chunk", "idx", "label"], det, fr, GATE, CUT)
    return m.select("video_id", "chunk", "idx", "label", "i0", "track", "missing", "others", "width_min", "width_median", "yaw", "pitch", "roll", "sharp_median", "change", "has_cut", "first", "last")


def main_track(spark: SparkSession, d: str) -> DataFrame:
    return window_metrics(spark, d).where("track is not null").select("video_id", "chunk", "idx", "label", "i0", "track", "others")


def face_gate(spark: SparkSession, d: str) -> DataFrame:
    c, det, fr = _stored(spark, d)
    m = G.window_metrics(c.where("i0 >= 0 and i1 <= n_frames"), ["chunk", "idx", "label"], det, fr, GATE, CUT)
    return m.select("video_id", "chunk", "idx", "label", "i0", G.face_reason(GATE).alias("reason"))


def per_video_cap(spark: SparkSession, d: str) -> DataFrame:
    out = G.word_reasons(*_stored(spark, d), GATE, CUT)
    return out.select("video_id", "chunk", "idx", "label", "i0", "reason")


def clip_funnel(spark: SparkSession, d: str) -> DataFrame:
    """Candidates by reason: video edge, cap, face gate, ok."""
    return per_video_cap(spark, d).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def funnel_summary(spark: SparkSession, d: str) -> DataFrame:
    r = per_video_cap(spark, d)
    return r.agg(F.countDistinct("video_id").alias("videos"), F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("reason") == "ok").alias("written"), F.count_if(F.col("reason") != "ok").alias("rejected"))


def split_at_cuts(spark: SparkSession, d: str) -> DataFrame:
    return cut_segments(frames(spark, d), "video_id", "frame", F.col("shot_dist") > CUT).groupBy("video_id", "segment").agg(F.min("frame").alias("first"), F.max("frame").alias("last"))


def shot_cuts(spark: SparkSession, d: str) -> DataFrame:
    return frames(spark, d).where(F.col("shot_dist") > CUT).select("video_id", "frame")


def speech_mask(spark: SparkSession, d: str) -> DataFrame:
    """Frames with speech of each video, to the end of its last unit: a transcript ends with its video."""
    u = table(spark, d, "asr").select("video_id", F.explode("units").alias("u")).select("video_id", F.col("u.start").alias("s"), F.col("u.end").alias("e")).where("s is not null and e is not null")
    spans = frame_spans(u, "video_id", F.col("s"), F.col("e"), 25)
    return swept(spans, "video_id", "a", "b").groupBy("video_id").agg(F.sum("new").alias("n_frames"), F.min("a").alias("first"), (F.max("b") - 1).alias("last"))


def clips_on_frames(spark: SparkSession, d: str) -> DataFrame:
    """How many clips are open on each frame, by one sweep over starts and ends."""
    c = table(spark, d, "word_clip").where("frame_start is not null and frame_end >= frame_start").select("video_id", "frame_start", "frame_end", "word").distinct()
    ends = c.select("video_id", F.col("frame_start").alias("frame"), F.lit(1).alias("x")).unionAll(c.select("video_id", (F.col("frame_end") + 1).alias("frame"), F.lit(-1).alias("x")))
    steps = ends.groupBy("video_id", "frame").agg(F.sum("x").alias("x"))
    w = Window.partitionBy("video_id").orderBy("frame").rowsBetween(Window.unboundedPreceding, 0)
    return steps.select("video_id", "frame", F.sum("x").over(w).alias("n_open"))


def iou_tracks(spark: SparkSession, d: str) -> DataFrame:
    """Tracks of boxes derived from the detections; sequential, so no SQL."""
    det = cut(detections(spark, d))
    b = det.withColumn("x0", F.col("pitch") * 4)
    b = b.select("video_id", "frame", "ord", "x0", F.lit(0.0).alias("y0"), (F.col("x0") + F.coalesce("width", F.lit(0.0)) / 10).alias("x1"), (F.coalesce("width", F.lit(0.0)) / 10).alias("y1"))
    # every frame has its distance, with a face or without
    all_frames = det.groupBy("video_id").agg(F.max("frame").alias("last")).select("video_id", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("frame"))
    cuts = all_frames.where(((F.col("frame") * 13 + 7) % 100).cast("double") / 100 > CUT)
    return track_boxes(b, cuts)


QUERIES = {
    f.__name__: f
    for f in (
        track_spans, face_frames, window_metrics, main_track, face_gate, per_video_cap, clip_funnel, funnel_summary, split_at_cuts, shot_cuts, speech_mask, clips_on_frames, iou_tracks,
    )
}

SQL = {
    "track_spans": f"WITH {_DET} SELECT video_id, track, min(frame) AS first, max(frame) AS last, count(*) AS n FROM det GROUP BY video_id, track",
    "face_frames": f"WITH {_DET} SELECT video_id, count(DISTINCT frame) AS frames_with_face, count(*) AS n_detections FROM det GROUP BY video_id",
    "window_metrics": f"WITH {_CAND}, {_METRICS} SELECT video_id, chunk, idx, label, i0, track, missing, others, width_min, width_median, yaw, pitch, roll, sharp_median, change, has_cut, first, last FROM met",
    "main_track": f"WITH {_CAND}, {_METRICS} SELECT video_id, chunk, idx, label, i0, track, others FROM met WHERE track IS NOT NULL",
    "face_gate": f"WITH {_CAND}, {_METRICS} SELECT video_id, chunk, idx, label, i0, {_REASON} AS reason FROM met",
    "per_video_cap": f"WITH {_CAND}, {_METRICS}, {_CAP} SELECT * FROM fin",
    "clip_funnel": f"WITH {_CAND}, {_METRICS}, {_CAP} SELECT reason, count(*) AS n FROM fin GROUP BY reason",
    "funnel_summary": f"""WITH {_CAND}, {_METRICS}, {_CAP} SELECT count(DISTINCT video_id) AS videos, count(*) AS candidates, count(*) FILTER (WHERE reason = 'ok') AS written,
        count(*) FILTER (WHERE reason <> 'ok') AS rejected FROM fin""",
    "split_at_cuts": f"""
        WITH {_DET}, s AS (SELECT video_id, frame, sum(CASE WHEN shot_dist > 0.97::DOUBLE THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY frame ROWS UNBOUNDED PRECEDING) AS segment FROM fr)
        SELECT video_id, CAST(segment AS BIGINT) AS segment, min(frame) AS first, max(frame) AS last FROM s GROUP BY video_id, segment""",
    "shot_cuts": f"WITH {_DET} SELECT video_id, frame FROM fr WHERE shot_dist > 0.97::DOUBLE",
    "speech_mask": """
        WITH u AS (SELECT video_id, unnest(units) AS u FROM asr), b AS (SELECT DISTINCT video_id, CAST(floor(u.start * 25) AS INTEGER) AS a, CAST(ceil(u."end" * 25) AS INTEGER) AS b FROM u),
        f AS (SELECT DISTINCT video_id, unnest(range(a, b)) AS frame FROM b WHERE b > a)
        SELECT video_id, count(*) AS n_frames, min(frame) AS first, max(frame) AS last FROM f GROUP BY video_id""",
    "clips_on_frames": """
        WITH c AS (SELECT DISTINCT video_id, frame_start, frame_end, word FROM word_clip WHERE frame_start IS NOT NULL AND frame_end >= frame_start),
        s AS (SELECT video_id, frame, sum(x) AS x FROM (SELECT video_id, frame_start AS frame, 1 AS x FROM c UNION ALL SELECT video_id, frame_end + 1, -1 FROM c) GROUP BY video_id, frame)
        SELECT video_id, frame, CAST(sum(x) OVER (PARTITION BY video_id ORDER BY frame ROWS UNBOUNDED PRECEDING) AS BIGINT) AS n_open FROM s""",
}
