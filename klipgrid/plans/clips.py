"""Queries of clip geometry and timing.

Landmarks aren't in the data folder: the 64 numbers of an embedding stand for 32
points (x, y), 29 embeddings in a row of one label for the frames of a clip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as Y
from ..functions import timeline as L
from ..operators.series import filled_gaps, shot_distances
from ..sources import table
from .transcripts import USABLE, WORDS, usable_words


def _micro(c: Column) -> Column:
    return F.floor(c * 1_000_000 + 0.5).cast("long")


def frame_grid(spark: SparkSession, d: str) -> DataFrame:
    w = usable_words(spark, d)
    i0 = L.word_window(F.col("s"), F.col("e"))
    a, b = L.word_frames(F.col("s"), F.col("e"), i0)
    return w.select("video_id", "chunk", "idx", "word", "s", i0.alias("i0"), a.alias("start_frame"), b.alias("end_frame"))


def word_clip_rows(spark: SparkSession, d: str) -> DataFrame:
    g = usable_words(spark, d).withColumn("i0", L.word_window(F.col("s"), F.col("e"))).where("i0 >= 0")
    a, b = L.word_frames(F.col("s"), F.col("e"), F.col("i0"))
    return g.select(
        F.col("label").alias("word"), F.col("word").alias("surface"), "video_id", F.lit(25).alias("fps"), F.lit(29).alias("n_frames"), F.lit(256).alias("size"),
        F.col("i0").alias("frame_start"), (F.col("i0") + 28).alias("frame_end"), L.time_of(F.col("i0")).alias("clip_start"), L.time_of(F.col("i0") + 29).alias("clip_end"),
        F.col("s").alias("word_start"), F.col("e").alias("word_end"), _micro(F.col("e") - F.col("s")).alias("duration_us"), a.alias("start_frame"), b.alias("end_frame"),
        F.col("score").alias("align_score"), "chunk", F.col("idx").alias("index"), F.col("source").alias("transcript_source"),
    )


def audio_index(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "word_clip").where("frame_start is not null").select("video_id", "frame_start", "n_frames").distinct()
    a, n = L.audio_slice(F.col("frame_start"), F.col("n_frames"))
    return c.select("video_id", "frame_start", a.alias("first_sample"), n.alias("n_samples"))


def shot_distance(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: F.abs(x.cast("double"))).alias("hist"))
    return shot_distances(e, "label", "vec_id", "hist").select("vec_id", "label", _micro(F.col("shot_dist")).alias("shot_dist_e6"))


def _points(spark: SparkSession, d: str) -> DataFrame:
    """(vec_id, label, clip, pts): 32 points of 1000 x 1000 pixels."""
    e = table(spark, d, "embeddings")
    at = lambda i: F.element_at("embedding", i).cast("double") * 1000 + 500
    pts = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.struct(at(i * 2 + 1).alias("x"), at(i * 2 + 2).alias("y")))
    return e.select("vec_id", "label", F.floor(F.col("vec_id") / 29).alias("clip"), pts.alias("pts"))


def landmark_boxes(spark: SparkSession, d: str) -> DataFrame:
    b = _points(spark, d).select("vec_id", Y.landmark_box(F.col("pts")).alias("b"))
    return b.select("vec_id", *[_micro(F.col(f"b.{c}")).alias(c) for c in ("x0", "y0", "x1", "y1")])


def iou_pairs(spark: SparkSession, d: str) -> DataFrame:
    """IoU of each box with the one before it of its label."""
    b = _points(spark, d).select("vec_id", "label", Y.landmark_box(F.col("pts")).alias("b"))
    b = b.withColumn("p", F.lag("b").over(Window.partitionBy("label").orderBy("vec_id"))).where("p is not null")
    c = lambda s, n: F.col(f"{s}.{n}")
    return b.select("vec_id", _micro(Y.iou(*[c(s, n) for s in ("p", "b") for n in ("x0", "y0", "x1", "y1")])).alias("iou_e6"))


def _crops(spark: SparkSession, d: str) -> DataFrame:
    p = _points(spark, d).withColumn("b", Y.landmark_box(F.col("pts")))
    p = p.withColumn("size", F.greatest(F.col("b.x1") - F.col("b.x0"), F.col("b.y1") - F.col("b.y0"))).withColumn("nose", F.element_at("pts", Y.NOSE_TIP + 1))
    g = p.groupBy("label", "clip").agg(F.array_sort(F.collect_list(F.struct("vec_id", "nose", "size", "pts"))).alias("f"))
    g = g.withColumns({"cx": Y.smoothed(F.transform("f", lambda x: x.nose.x), 5), "cy": Y.smoothed(F.transform("f", lambda x: x.nose.y), 5), "side": Y.crop_side(F.transform("f", lambda x: x["size"]))})
    z = g.select("side", F.explode(F.arrays_zip("f", "cx", "cy")).alias("z"))
    return z.select(F.col("z.f.vec_id").alias("vec_id"), F.col("z.cx").alias("cx"), F.col("z.cy").alias("cy"), "side", F.col("z.f.pts").alias("pts"))


def crop_boxes(spark: SparkSession, d: str) -> DataFrame:
    return _crops(spark, d).select("vec_id", *[F.floor(F.col(c) * 1000 + 0.5).cast("long").alias(c) for c in ("cx", "cy", "side")])


def pad_fraction(spark: SparkSession, d: str) -> DataFrame:
    x0, y0, s = Y.int_box(F.col("cx"), F.col("cy"), F.col("side"))
    b = _crops(spark, d).select("vec_id", x0.alias("x0"), y0.alias("y0"), s.alias("s"))
    return b.select("vec_id", "x0", "y0", "s", _micro(Y.pad_fraction(F.col("x0"), F.col("y0"), F.col("s"), F.lit(1000), F.lit(1000))).alias("pad_e6"))


def clip_landmarks(spark: SparkSession, d: str) -> DataFrame:
    x0, y0, s = Y.int_box(F.col("cx"), F.col("cy"), F.col("side"))
    b = _crops(spark, d).select("vec_id", x0.alias("x0"), y0.alias("y0"), s.alias("s"), F.posexplode("pts").alias("point", "p"))
    e3 = lambda c: F.floor(c * 1000 + 0.5).cast("long")
    return b.select("vec_id", "point", e3(Y.to_clip(F.col("p.x"), F.col("x0"), F.col("s"), 256)).alias("x_e3"), e3(Y.to_clip(F.col("p.y"), F.col("y0"), F.col("s"), 256)).alias("y_e3"))


def head_angles(spark: SparkSession, d: str) -> DataFrame:
    """Euler angles (hundredths of a degree) of the first nine numbers of an embedding, read as a matrix."""
    p, y, r = Y.euler_angles(F.slice("embedding", 1, 9))
    e2 = lambda c: F.floor(c * 100 + 0.5).cast("long")
    return table(spark, d, "embeddings").select("vec_id", e2(p).alias("pitch_e2"), e2(y).alias("yaw_e2"), e2(r).alias("roll_e2"))


def gap_interpolate(spark: SparkSession, d: str) -> DataFrame:
    """Start frames of sentences; null ones filled along the chunks of the video."""
    s = table(spark, d, "sentence_clip").groupBy("video_id", "chunk").agg(F.min("frame_start").cast("double").alias("v"))
    f = filled_gaps(s, ["video_id"], "chunk", "v")
    return f.select("video_id", "chunk", F.col("v").isNull().alias("interpolated"), F.floor(F.col("filled") * 1000 + 0.5).cast("long").alias("filled_e3"))


QUERIES = {
    f.__name__: f
    for f in (
        frame_grid, word_clip_rows, audio_index, shot_distance, landmark_boxes, iou_pairs, crop_boxes, pad_fraction, clip_landmarks, head_angles, gap_interpolate,
    )
}

_GRID = f"""{WORDS}, g AS (SELECT *, CAST(round_even((s + e) / 2 * 25, 0) AS INTEGER) - 14 AS i0 FROM words WHERE {USABLE}),
    ab AS (SELECT *, CAST(ceil(s * 25 - 0.000001::DOUBLE) AS INTEGER) - i0 AS a, CAST(floor(e * 25 + 0.000001::DOUBLE) AS INTEGER) - i0 AS b FROM g),
    fb AS (SELECT *, greatest(0, least(28, CASE WHEN b < a THEN 14 ELSE a END)) AS start_frame, greatest(0, least(28, CASE WHEN b < a THEN 14 ELSE b END)) AS end_frame FROM ab)"""
_PTS = """pt AS (SELECT vec_id, label, vec_id // 29 AS clip, list_transform(range(0, 32), lambda i: embedding[i * 2 + 1]::DOUBLE * 1000 + 500) AS px, list_transform(range(0, 32), lambda i: embedding[i * 2 + 2]::DOUBLE * 1000 + 500) AS py FROM embeddings),
    bx AS (SELECT *, list_min(px) AS x0, list_min(py) AS y0, list_max(px) AS x1, list_max(py) AS y1 FROM pt)"""
_CROP = f"""{_PTS}, fr AS (SELECT *, row_number() OVER (PARTITION BY label, clip ORDER BY vec_id) AS k, count(*) OVER (PARTITION BY label, clip) AS n FROM bx),
    gl AS (SELECT label, clip, list(px[2] ORDER BY vec_id) AS nx, list(py[2] ORDER BY vec_id) AS ny, median(greatest(x1 - x0, y1 - y0)) * 1.6::DOUBLE AS side FROM fr GROUP BY label, clip),
    cr AS (SELECT vec_id, px, py, side,
        CASE WHEN n > 1 THEN list_reduce(list_transform([-2, -1, 0, 1, 2], lambda j: nx[greatest(1, least(n, k + j))]), lambda a, b: a + b) / 5 ELSE px[2] END AS cx,
        CASE WHEN n > 1 THEN list_reduce(list_transform([-2, -1, 0, 1, 2], lambda j: ny[greatest(1, least(n, k + j))]), lambda a, b: a + b) / 5 ELSE py[2] END AS cy
        FROM fr JOIN gl USING (label, clip)),
    ib AS (SELECT *, CAST(round_even(cx - side / 2, 0) AS INTEGER) AS bx0, CAST(round_even(cy - side / 2, 0) AS INTEGER) AS by0, CAST(round_even(side, 0) AS INTEGER) AS bs FROM cr)"""

SQL = {
    "frame_grid": f"WITH {_GRID} SELECT video_id, chunk, idx, word, s, i0, start_frame, end_frame FROM fb",
    "word_clip_rows": f"""
        WITH {_GRID} SELECT label AS word, word AS surface, video_id, 25 AS fps, 29 AS n_frames, 256 AS size, i0 AS frame_start, i0 + 28 AS frame_end, i0 / 25::DOUBLE AS clip_start, (i0 + 29) / 25::DOUBLE AS clip_end,
            s AS word_start, e AS word_end, CAST(floor((e - s) * 1000000 + 0.5::DOUBLE) AS BIGINT) AS duration_us, start_frame, end_frame, score AS align_score, chunk, idx AS index, source AS transcript_source
        FROM fb WHERE i0 >= 0""",
    "audio_index": """
        SELECT DISTINCT video_id, frame_start, CAST(round_even(frame_start / 25::DOUBLE * 16000, 0) AS BIGINT) AS first_sample, n_frames * 640 AS n_samples FROM word_clip WHERE frame_start IS NOT NULL""",
    "shot_distance": """
        WITH h AS (SELECT vec_id, label, list_transform(embedding, lambda x: abs(x::DOUBLE)) AS h FROM embeddings),
        p AS (SELECT *, lag(h) OVER (PARTITION BY label ORDER BY vec_id) AS q FROM h),
        r AS (SELECT vec_id, label, q, list_reduce(list_transform(range(1, 65), lambda i: sqrt(h[i] * q[i])), lambda a, b: a + b) AS c,
              sqrt(list_reduce(h, lambda a, b: a + b) * list_reduce(q, lambda a, b: a + b)) AS m FROM p)
        SELECT vec_id, label, CAST(floor(CASE WHEN q IS NULL THEN 0 ELSE sqrt(greatest(0.0::DOUBLE, 1 - CASE WHEN m > 0 THEN c / m ELSE 1 END)) END * 1000000 + 0.5::DOUBLE) AS BIGINT) AS shot_dist_e6 FROM r""",
    "landmark_boxes": f"WITH {_PTS} SELECT vec_id, {', '.join(f'CAST(floor({c} * 1000000 + 0.5::DOUBLE) AS BIGINT) AS {c}' for c in ('x0', 'y0', 'x1', 'y1'))} FROM bx",
    "iou_pairs": f"""
        WITH {_PTS}, l AS (SELECT *, lag(x0) OVER w AS ax0, lag(y0) OVER w AS ay0, lag(x1) OVER w AS ax1, lag(y1) OVER w AS ay1 FROM bx WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
        i AS (SELECT vec_id, greatest(0.0::DOUBLE, least(ax1, x1) - greatest(ax0, x0)) * greatest(0.0::DOUBLE, least(ay1, y1) - greatest(ay0, y0)) AS m, (ax1 - ax0) * (ay1 - ay0) AS a, (x1 - x0) * (y1 - y0) AS b FROM l WHERE ax0 IS NOT NULL)
        SELECT vec_id, CAST(floor(CASE WHEN a + b - m > 0 THEN m / (a + b - m) ELSE 0 END * 1000000 + 0.5::DOUBLE) AS BIGINT) AS iou_e6 FROM i""",
    "crop_boxes": f"WITH {_CROP} SELECT vec_id, {', '.join(f'CAST(floor({c} * 1000 + 0.5::DOUBLE) AS BIGINT) AS {c}' for c in ('cx', 'cy', 'side'))} FROM cr",
    "pad_fraction": f"""
        WITH {_CROP} SELECT vec_id, bx0 AS x0, by0 AS y0, bs AS s, CAST(floor((1 - CAST((bs - greatest(0, -bx0) - greatest(0, bx0 + bs - 1000)) * (bs - greatest(0, -by0) - greatest(0, by0 + bs - 1000)) AS DOUBLE)
            / (bs * bs)) * 1000000 + 0.5::DOUBLE) AS BIGINT) AS pad_e6 FROM ib""",
    "clip_landmarks": f"""
        WITH {_CROP} SELECT vec_id, CAST(i AS INTEGER) AS point, CAST(floor((px[i + 1] - bx0) * (256::DOUBLE / bs) * 1000 + 0.5::DOUBLE) AS BIGINT) AS x_e3, CAST(floor((py[i + 1] - by0) * (256::DOUBLE / bs) * 1000 + 0.5::DOUBLE) AS BIGINT) AS y_e3
        FROM ib, range(32) AS r(i)""",
    "head_angles": """
        WITH m AS (SELECT vec_id, list_transform(embedding[1:9], lambda x: x::DOUBLE) AS m FROM embeddings),
        s AS (SELECT *, sqrt(m[1] * m[1] + m[4] * m[4] + m[7] * m[7]) AS a, sqrt(m[2] * m[2] + m[5] * m[5] + m[8] * m[8]) AS b, sqrt(m[3] * m[3] + m[6] * m[6] + m[9] * m[9]) AS c FROM m)
        SELECT vec_id, CAST(floor(degrees(atan2(m[8] / b, m[9] / c)) * 100 + 0.5::DOUBLE) AS BIGINT) AS pitch_e2,
            CAST(floor(degrees(atan2(-m[7] / a, sqrt(m[8] / b * (m[8] / b) + m[9] / c * (m[9] / c)))) * 100 + 0.5::DOUBLE) AS BIGINT) AS yaw_e2,
            CAST(floor(degrees(atan2(m[4] / a, m[1] / a)) * 100 + 0.5::DOUBLE) AS BIGINT) AS roll_e2 FROM s""",
    "gap_interpolate": """
        WITH s AS (SELECT video_id, chunk, CAST(min(frame_start) AS DOUBLE) AS v FROM sentence_clip GROUP BY video_id, chunk),
        f AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN chunk END IGNORE NULLS) OVER p AS a, last_value(v IGNORE NULLS) OVER p AS va,
              first_value(CASE WHEN v IS NOT NULL THEN chunk END IGNORE NULLS) OVER q AS b, first_value(v IGNORE NULLS) OVER q AS vb FROM s
              WINDOW p AS (PARTITION BY video_id ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), q AS (PARTITION BY video_id ORDER BY chunk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        w AS (SELECT *, (chunk - a) / CAST(b - a AS DOUBLE) AS w FROM f)
        SELECT video_id, chunk, v IS NULL AS interpolated, CAST(floor((CASE WHEN v IS NOT NULL THEN v WHEN a IS NULL THEN vb WHEN b IS NULL THEN va ELSE (1 - w) * va + w * vb END) * 1000 + 0.5::DOUBLE) AS BIGINT) AS filled_e3 FROM w""",
}
