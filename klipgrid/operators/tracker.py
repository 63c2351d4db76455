"""Greedy IoU tracker over boxes and shot cuts.

No track outlives a shot cut or a hole of more than ``max_gap`` frames without
any box, so a video falls into stretches that know nothing of each other.  The
stretches, not the videos, are the units of work: a long video is as many units
as it has cuts and holes.  Only the numbers of the tracks run on through the
video; they are added afterwards as a prefix sum over the stretches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..params import Tracking
from ..session import cut
from .ranking import running_sum

_BOX = ["x0", "y0", "x1", "y1"]


def overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Intersection over union of each box of ``a`` with each of ``b``; 0 where the union is empty."""
    corner = np.minimum(a[:, None, 2:], b[None, :, 2:]) - np.maximum(a[:, None, :2], b[None, :, :2])
    both = np.prod(np.maximum(corner, 0.0), axis=2)
    area = lambda x: np.prod(x[:, 2:] - x[:, :2], axis=1)
    union = area(a)[:, None] + area(b)[None, :] - both
    return np.divide(both, union, out=np.zeros_like(both), where=union > 0)


def matched(score: np.ndarray, least: float) -> np.ndarray:
    """For each column its row, or -1: the best pairs first, of equals the highest row, then column."""
    to = np.full(score.shape[1], -1)
    left = np.where(score >= least, score, -np.inf)
    while left.size:
        at = left.size - 1 - int(np.argmax(left.ravel()[::-1]))
        row, col = divmod(at, left.shape[1])
        if left[row, col] == -np.inf:
            break
        to[col] = row
        left[row, :] = left[:, col] = -np.inf
    return to


class Stretch:
    """Tracks of one stretch, numbered from 0; its frames come in order."""

    def __init__(self, p: Tracking) -> None:
        self.p, self.n = p, 0
        self.track, self.last, self.box = np.zeros(0, int), np.zeros(0, int), np.zeros((0, 4))

    def add(self, frame: int, boxes: np.ndarray) -> np.ndarray:
        """Track of each box of a frame."""
        live = frame - self.last <= self.p.max_gap + 1
        self.track, self.last, self.box = self.track[live], self.last[live], self.box[live]
        row = matched(overlaps(self.box, boxes), self.p.min_iou)
        met, fresh = row >= 0, np.flatnonzero(row < 0)
        self.last[row[met]], self.box[row[met]] = frame, boxes[met]
        out = np.empty(len(boxes), int)
        out[met], out[fresh] = self.track[row[met]], self.n + np.arange(len(fresh))
        self.n += len(fresh)
        # new numbers are the highest, so rows stay in the order of their tracks
        self.track, self.last = np.r_[self.track, out[fresh]], np.r_[self.last, np.full(len(fresh), frame)]
        self.box = np.concatenate([self.box, boxes[fresh]])
        return out


def track_boxes(boxes: DataFrame, cuts: DataFrame, p: Tracking = Tracking()) -> DataFrame:
    """(video_id, frame, ord, track) for boxes with video_id, frame, ord, x0..y1.

    ``cuts`` (video_id, frame) names the frames that begin a shot, with or without
    a face on them: all tracks end before a cut.  Tracks count from 0 in each
    video in the order in which they begin.  Boxes of a null video form a video of
    their own; a null corner overlaps nothing.  Repeated cuts count once; an empty
    table gives no rows.
    """
    kind = dict(boxes.dtypes)["video_id"]
    at = boxes.select("video_id", F.col("frame").cast("int").alias("frame")).distinct()
    # number of cuts up to each frame, and of holes before it
    marks = at.withColumn("_cut", F.lit(0)).unionByName(cuts.select("video_id", F.col("frame").cast("int").alias("frame"), F.lit(1).alias("_cut")).distinct())
    shots = running_sum(marks, ["video_id"], [F.col("frame"), F.col("_cut").desc()], "_cut", "_shot").where("_cut = 0").select("video_id", "frame", "_shot")
    # a frame without any box on the frames that a track could have been seen on begins anew
    near = at.select("video_id", F.explode(F.sequence(F.col("frame") + 1, F.col("frame") + p.max_gap + 1)).alias("frame")).distinct()
    near = near.select(F.col("video_id").alias("_nv"), F.col("frame").alias("_nf"), F.lit(0).alias("_near"))
    held = shots.join(near, F.col("video_id").eqNullSafe(F.col("_nv")) & (F.col("frame") == F.col("_nf")), "left").withColumn("_hole", F.coalesce("_near", F.lit(1)))
    parts = running_sum(held.select("video_id", "frame", "_shot", "_hole"), ["video_id"], [F.col("frame")], "_hole", "_part_no")
    parts = parts.select(F.col("video_id").alias("_v"), F.col("frame").alias("_f"), (F.col("_shot") + F.col("_part_no")).cast("long").alias("stretch"))
    rows = boxes.select("video_id", F.col("frame").cast("int").alias("frame"), F.col("ord").cast("int").alias("ord"), *[F.col(c).cast("double").alias(c) for c in _BOX])
    rows = rows.join(parts, F.col("video_id").eqNullSafe(F.col("_v")) & (F.col("frame") == F.col("_f"))).drop("_v", "_f")
    rows = rows.repartition("video_id", "stretch").sortWithinPartitions("video_id", "stretch", "frame", "ord")
    schema = T.StructType.fromDDL(f"video_id {kind}, stretch long, frame int, ord int, local long")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # rows of the last frame seen: it may go on in the next batch
        unit, tracks = None, None

        def work(pdf: pd.DataFrame) -> pd.DataFrame:
            nonlocal unit, tracks
            video, part, frame = pdf["video_id"].tolist(), pdf["stretch"].to_numpy(), pdf["frame"].to_numpy()
            box = pdf[_BOX].to_numpy(float)
            local = np.zeros(len(pdf), dtype=np.int64)
            new = np.r_[True, (frame[1:] != frame[:-1]) | (part[1:] != part[:-1]) | np.array([a != b for a, b in zip(video[1:], video[:-1], strict=True)], bool)]
            starts = np.flatnonzero(new)
            for a, b in zip(starts, np.r_[starts[1:], len(pdf)], strict=True):
                if unit != (video[a], part[a]):
                    unit, tracks = (video[a], part[a]), Stretch(p)
                local[a:b] = tracks.add(int(frame[a]), box[a:b])
            return pdf[["video_id", "stretch", "frame", "ord"]].assign(local=local)

        for pdf in batches:
            if held is not None:
                pdf = pd.concat([held, pdf], ignore_index=True)
            if not len(pdf):
                continue
            end = pdf.iloc[-1]
            last = (pdf["frame"] == end["frame"]) & (pdf["stretch"] == end["stretch"]) & ((pdf["video_id"] == end["video_id"]) | (pdf["video_id"].isna() & pd.isna(end["video_id"])))
            held = pdf[last]
            if not last.all():
                yield work(pdf[~last].reset_index(drop=True))
        if held is not None and len(held):
            yield work(held.reset_index(drop=True))

    local = cut(rows.mapInPandas(run, schema))
    sizes = local.groupBy("video_id", "stretch").agg((F.max("local") + 1).alias("_n"))
    first = running_sum(sizes, ["video_id"], [F.col("stretch")], "_n", "_upto")
    first = first.select(F.col("video_id").alias("_v"), F.col("stretch").alias("_s"), (F.col("_upto") - F.col("_n")).alias("_first"))
    out = local.join(first, F.col("video_id").eqNullSafe(F.col("_v")) & (F.col("stretch") == F.col("_s")))
    return out.select("video_id", "frame", "ord", (F.col("local") + F.col("_first")).cast("int").alias("track"))
