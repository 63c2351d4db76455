"""Tables of faces and clips, documents of one video each, and landed JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from .text_files import _exists

#: Tables of the faces stage and of rendered clips, with their record types.
TABLES = {"detection": schemas.DETECTION, "landmark": schemas.LANDMARKS, "frame": schemas.FRAME, "video": schemas.VIDEO, "clip_frame": schemas.CLIP_FRAME, "word_clip": schemas.WORD_CLIP, "sentence_clip": schemas.SENTENCE_CLIP}


def _shaped(df: DataFrame, schema: str) -> DataFrame:
    """The columns of ``schema``, in order and cast; columns it doesn't name are left out, missing ones are null."""
    want = df.sparkSession.createDataFrame([], schema).schema
    return df.select(*[(F.col(f"`{f.name}`").cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in want])


def write_corpus_table(df: DataFrame, folder: str, name: str, overwrite: bool = False) -> None:
    """Add the videos of ``df`` that ``folder/name`` doesn't have yet, or write the table anew.

    Rows of one video lie together, sorted by frame where there is one, so that a
    reader of a few videos skips the rest by the files' statistics.
    """
    rows, path = _shaped(df, TABLES[name]), f"{folder.rstrip('/')}/{name}"
    spark = df.sparkSession
    if not overwrite and _exists(spark, path):
        rows = rows.join(spark.read.schema(TABLES[name]).parquet(path).select("video_id").distinct(), "video_id", "left_anti")
    order = [c for c in ("video_id", "frame", "chunk") if c in rows.columns]
    # by range of all of them: a long video fills several files
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite" if overwrite else "append").option("compression", "zstd").parquet(path)


def read_corpus_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name``; a missing one is empty."""
    path = f"{folder.rstrip('/')}/{name}"
    return spark.read.schema(TABLES[name]).parquet(path) if _exists(spark, path) else spark.createDataFrame([], TABLES[name])


def face_summary(detection: DataFrame, frame: DataFrame, cut: float = 0.35) -> DataFrame:
    """(video_id, n_frames, n_detections, frames_with_face, cuts, n_tracks): what the faces stage reports of a video."""
    d = detection.groupBy("video_id").agg(F.count(F.lit(1)).alias("n_detections"), F.countDistinct("frame").alias("frames_with_face"), F.countDistinct("track").alias("n_tracks"))
    f = frame.groupBy("video_id").agg((F.max("frame") + 1).alias("n_frames"), F.count_if(F.col("shot_dist") > cut).alias("n_cuts"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return f.join(d, "video_id", "left").select("video_id", "n_frames", zero("n_detections"), zero("frames_with_face"), "n_cuts", zero("n_tracks"))


def write_per_video(df: DataFrame, path: str) -> None:
    """One folder of JSON per video_id; only the videos of ``df`` are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", "false").partitionBy("video_id").json(path)


def read_in_path_order(spark: SparkSession, glob: str, schema: str) -> DataFrame:
    """JSON documents of all files that match, with ``path`` and their ``nth`` place in the order of paths.

    No file is an empty table.  Places come from a range sort, not from one task.
    """
    from ..operators.ranking import with_position

    if not _exists(spark, glob):
        return spark.createDataFrame([], f"{schema}, path STRING, nth BIGINT")
    rows = spark.read.schema(schema).json(glob).select("*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_at"))
    return with_position(rows, F.col("path"), F.col("_at"), name="nth").drop("_at")


def with_info(rows: DataFrame, info: DataFrame, key: str, fields: dict[str, str | None]) -> DataFrame:
    """``rows`` with the ``fields`` of the landed info document of each, and their defaults where it is absent or empty.

    Of several documents for one key the smallest values are taken.
    """
    picked = info.groupBy(F.col("id").alias("_info")).agg(*[F.min(F.nullif(F.col(f), F.lit(""))).alias(f) for f in fields])
    out = rows.join(picked, F.col(key) == F.col("_info"), "left").drop("_info")
    return out.withColumns({f: F.coalesce(F.col(f), F.lit(d)) for f, d in fields.items() if d is not None})
