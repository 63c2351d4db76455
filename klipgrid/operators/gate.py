"""The face gate: windows joined to detections, ordered reasons, the cap per video.

The range join is an equi-join on (video, frame bucket): a window meets the few
buckets it touches, so its cost follows the detections in reach and not the
length of the video.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeline import half_up
from ..params import Gate

BUCKET = 32


def _in_reach(windows: DataFrame, points: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Rows of ``points`` with ``lo <= frame < hi``, joined to their windows."""
    first, last = F.floor(lo / BUCKET), F.floor((hi - 1) / BUCKET)
    w = windows.where(hi > lo).withColumn("_b", F.explode(F.sequence(first, last)))
    p = points.withColumn("_b", F.floor(F.col("frame") / BUCKET))
    return w.join(p, ["video_id", "_b"]).where((F.col("frame") >= lo) & (F.col("frame") < hi)).drop("_b")


def track_spans(det: DataFrame) -> DataFrame:
    """(video_id, track, first, last, n) over the whole video."""
    return det.groupBy("video_id", "track").agg(F.min("frame").alias("first"), F.max("frame").alias("last"), F.count(F.lit(1)).alias("n"))


_MEASURES = ("width", "yaw", "pitch", "roll", "sharp")


def window_metrics(windows: DataFrame, key: list[str], det: DataFrame, frames: DataFrame, p: Gate = Gate(), cut: float = 0.35) -> DataFrame:
    """Metrics of the main face of each window [i0, i1); null track without a face.

    ``windows`` has video_id, ``key``, i0, i1 (one row per key) and any other
    columns; ``det`` has video_id, frame, ord, track, width, yaw, pitch, roll,
    sharp; ``frames`` has video_id, frame, shot_dist.  The main face is the track
    with most detections, the first seen of equals.  An empty window has no face.

    Detections and frames are one stream of points, so there is one range join and
    one grouping; windows run along as points of their own, so none gets lost.
    """
    keys = ["video_id", *key, "i0", "i1"]
    extra = [c for c in windows.columns if c not in keys]
    i0, i1 = F.col("i0"), F.col("i1")
    seen = det.where("track is not null")
    spans = track_spans(seen).select("video_id", "track", "first", "last")
    faces = seen.join(spans, ["video_id", "track"]).select("video_id", "frame", "ord", "track", *_MEASURES, "first", "last")
    points = faces.unionByName(frames.select("video_id", "frame", "shot_dist"), allowMissingColumns=True)
    rows = _in_reach(windows.select(*keys), points, i0, i1).unionByName(windows, allowMissingColumns=True)
    pose = (lambda c: F.max(F.abs(c))) if p.pose == "max" else (lambda c: F.percentile(F.abs(c), F.lit(0.95)))
    per = rows.groupBy(*keys, "track").agg(
        F.count("track").alias("n"), F.min(F.struct("frame", "ord")).alias("seen"),
        F.min("width").alias("w_min"), F.percentile("width", F.lit(0.5)).alias("w_med"), *[pose(F.col(c)).alias(c) for c in ("yaw", "pitch", "roll")],
        F.percentile("sharp", F.lit(0.5)).alias("sharp"), F.max("first").alias("first"), F.max("last").alias("last"),
        F.max(F.when(F.col("frame") > i0, F.col("shot_dist"))).alias("change"), *[F.max(c).alias(c) for c in extra],
    )
    # the smallest of (-n, first seen) is the main face; groups without a track have no place in the order
    face, place = F.struct("track", "n", "w_min", "w_med", "yaw", "pitch", "roll", "sharp", "first", "last"), F.struct((-F.col("n")).alias("m"), "seen")
    out = per.groupBy(*keys).agg(
        F.min_by(face, F.when(F.col("track").isNotNull(), place)).alias("f"), F.count_if(F.col("track").isNotNull() & (F.col("n") >= p.min_other)).alias("crowd"),
        F.max("change").alias("change"), *[F.max(c).alias(c) for c in extra],
    )
    # a percentile between two values may miss the half by its last bit
    tenth = lambda c: half_up(F.col(f"f.{c}") + 1e-7, 1)
    return out.select(
        *windows.columns, F.col("f.track").alias("track"), (i1 - i0 - F.col("f.n")).cast("int").alias("missing"),
        (F.col("crowd") - (F.col("f.n") >= p.min_other).cast("int")).alias("others"), tenth("w_min").alias("width_min"), tenth("w_med").alias("width_median"),
        tenth("yaw").alias("yaw"), tenth("pitch").alias("pitch"), tenth("roll").alias("roll"), tenth("sharp").alias("sharp_median"),
        half_up(F.coalesce("change", F.lit(0.0)), 3).alias("change"), F.coalesce(F.col("change") > cut, F.lit(False)).alias("has_cut"), F.col("f.first").alias("first"), F.col("f.last").alias("last"),
    )


METRICS = ["track", "missing", "others", "width_min", "width_median", "yaw", "pitch", "roll", "sharp_median", "change"]


def face_reason(p: Gate = Gate(), max_missing: Column | None = None) -> Column:
    """First test that a window fails, in fixed order, over ``window_metrics``; thresholds meet rounded numbers.

    ``max_missing`` takes the place of the parameter where it depends on the window.
    """
    c, most = F.col, F.lit(p.max_missing) if max_missing is None else max_missing
    return (
        F.when(c("track").isNull(), "no_face").when(c("has_cut"), "shot_cut")
        .when((c("first") > c("i0")) | (c("last") < c("i1") - 1), "track_break").when(c("change") > p.max_change, "unstable_frames")
        .when(c("missing") > most, "face_missing").when((c("others") > 0) & F.lit(not p.allow_others), "multiple_faces")
        .when(c("width_min") < p.min_face, "small_face").when(c("yaw") > p.max_yaw, "yaw").when(c("pitch") > p.max_pitch, "pitch").otherwise("ok")
    )


def capped(rows: DataFrame, by: list[str], order: list[str], accepted: Column, cap: int) -> DataFrame:
    """``rows`` with ``over_cap``: whether ``cap`` accepted rows come before in ``order``.

    Only accepted rows use up the cap, so a sequential loop that stops accepting
    gives the same answer.
    """
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("over_cap", F.coalesce(F.sum(accepted.cast("int")).over(w), F.lit(0)) >= cap)


def word_reasons(windows: DataFrame, det: DataFrame, frames: DataFrame, p: Gate, cut: float) -> DataFrame:
    """``windows`` (video_id, chunk, idx, label, i0, i1, n_frames) with ``reason`` and ``metrics``.

    A window beyond the video is 'video_edge' and meets no other test; then come
    the cap ('per_video_cap') and the face gate.  Metrics are null where no face
    was looked at.
    """
    edge = (F.col("i0") < 0) | (F.col("i1") > F.col("n_frames"))
    key = ["chunk", "idx", "label"]
    inside = window_metrics(windows.where(~edge), key, det, frames, p, cut).withColumn("face", face_reason(p))
    seen = capped(inside, ["video_id", "label"], ["chunk", "idx", "i0"], F.col("face") == "ok", p.cap)
    gated = seen.withColumn("reason", F.when(F.col("over_cap"), "per_video_cap").otherwise(F.col("face")))
    gated = gated.withColumn("metrics", F.when(~F.col("over_cap") & F.col("track").isNotNull(), F.struct(*METRICS)))
    return gated.select(*windows.columns, "reason", "metrics").unionByName(windows.where(edge).withColumn("reason", F.lit("video_edge")), allowMissingColumns=True)


def sentence_reasons(windows: DataFrame, det: DataFrame, frames: DataFrame, p: Gate, cut: float, least: float = -1.0, shortest: float = 1.0, longest: float = 20.0, missing: float = 0.05, fps: int = 25) -> DataFrame:
    """``windows`` (video_id, chunk, n_words, score, i0, i1) with ``reason`` and ``metrics``.

    In order: no words, no score or a low one ('low_align_score'), length, a start
    before the video ('video_edge'), the face gate with the pose's 95th percentile.
    The share of frames without the face may reach ``missing``, rounded down.
    """
    n = F.col("i1") - F.col("i0")
    bad = (F.col("n_words") == 0) | F.col("score").isNull() | (F.col("score") < least)
    early = F.when(bad, "low_align_score").when(~F.coalesce((n / fps).between(shortest, longest), F.lit(False)), "length").when(F.col("i0") < 0, "video_edge")
    rows = windows.withColumn("early", early)
    # 1e-9: 0.05 is no binary fraction, a product that is whole must stay whole
    most = F.floor(n * F.lit(missing) + 1e-9)
    gate = replace(p, pose="p95")
    inside = window_metrics(rows.where("early is null"), ["chunk"], det, frames, gate, cut).withColumn("reason", face_reason(gate, most))
    inside = inside.withColumn("metrics", F.when(F.col("track").isNotNull(), F.struct(*METRICS)))
    out = inside.select(*windows.columns, "reason", "metrics")
    return out.unionByName(rows.where("early is not null").withColumn("reason", F.col("early")).drop("early"), allowMissingColumns=True)
