"""Stages around plug-ins, tables of faces and clips, and picks for screening."""

from __future__ import annotations

import json
import math
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from klipgrid import pipelines as P
from klipgrid.functions import geometry as Y
from klipgrid.operators import ingest
from klipgrid.sources import corpus_tables as C


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the workers don't know this module


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def hear(parts):
    for p in parts:
        out = []
        for v in p["video_id"]:
            out += [(v, None, None, "no sound")] if v == "bad" else [(v, 0.0, 6.0, None), (v, 6.5, 9.0, None), (v, 30.0, 30.4, None), (v, 40.0, 42.0, None)]
        yield pd.DataFrame(out, columns=["video_id", "start", "end", "error"])


def recognise(parts):
    for p in parts:
        t = [(v, c, None, "crash") if s == 40.0 else (v, c, f" said {s:g}-{e:g} ", None) for v, c, s, e in zip(p["video_id"], p["chunk"], p["start"], p["end"])]
        yield pd.DataFrame(t, columns=["video_id", "chunk", "text", "error"])


def test_transcription_merges_speech_and_takes_subtitles_as_they_are(spark):
    videos = spark.createDataFrame([("a",), ("bad",), ("sub",)], "video_id string")
    subs = spark.createDataFrame([("sub", 5.0, 5.1, "two"), ("sub", 0.0, 90.0, "one"), ("other", 0.0, 1.0, "x")], "video_id string, start double, end double, text string")
    units, errors = P.transcribe(videos, hear, recognise, subs)
    assert rows(units.select("video_id", "chunk", "start", "end", "text", "source")) == [("a", 0, 0.0, 9.0, "said 0-9", "asr"), ("sub", 0, 0.0, 90.0, "one", "subs"), ("sub", 1, 5.0, 5.1, "two", "subs")]
    assert rows(errors) == [("a", "crash"), ("bad", "no sound")]
    units, errors = P.transcribe(videos.where("false"), hear, recognise)
    assert units.count() == errors.count() == 0


def aligner(parts):
    for p in parts:
        out = []
        for v, c, t in zip(p["video_id"], p["chunk"], p["text"]):
            words = [{"word": w, "label": w, "start": 0.25 + i * 0.5, "end": 0.5 + i * 0.5, "score": s} for i, (w, s) in enumerate(zip(t.split(), (-0.5, -0.25)))]
            out.append((v, c, None, "fails") if t == "boom" else (v, c, [] if t == "..." else words, None))
        yield pd.DataFrame(out, columns=["video_id", "chunk", "words", "error"])


def test_alignment_brings_words_back_and_keeps_failures_apart(spark):
    units = spark.createDataFrame([("a", 0, 0.1, 2.0, "x y", "asr"), ("a", 1, 5.0, 6.0, "", "asr"), ("a", 2, 7.0, 8.0, "boom", "asr"), ("a", 3, 9.0, 10.0, "...", "asr"), ("a", 4, 3.0, 4.0, "z", None)], "video_id string, chunk int, start double, end double, text string, source string")
    out, errors = P.align(units, spark.createDataFrame([("a", 10.0)], "video_id string, total double"), aligner)
    got = {r["chunk"]: r for r in out.collect()}
    assert set(got) == {0, 3, 4} and rows(errors) == [("a", "fails")]
    assert [(w["word"], w["start"], w["end"]) for w in got[0]["words"]] == [("x", 0.25, 0.5), ("y", 0.75, 1.0)]
    assert [(w["start"], w["end"]) for w in got[4]["words"]] == [(3.0, 3.25)]
    assert (got[0]["score"], got[3]["score"], got[4]["score"]) == (-0.375, None, -0.5)


def test_screening_shares(spark):
    def faces(parts):
        for p in parts:
            f = [(v, i, o, 0.0, 0.0, w, 9.0, 0.0, y, 0.0, 1.0, None) for v in p["video_id"] if v == "a" for i, o, w, y in [(0, 0, 200.0, 0.0), (1, 0, 200.0, 50.0), (2, 0, 200.0, 0.0), (2, 1, 50.0, 0.0), (3, 0, 200.0, 0.0), (99, 0, 200.0, 0.0)]]
            yield pd.DataFrame(f, columns="video_id frame ord x0 y0 x1 y1 pitch yaw roll sharp error".split())

    def speech(parts):
        for p in parts:
            yield pd.DataFrame([(v, 0.0, 0.1, None) for v in p["video_id"] if v == "a"] + [(v, 0.05, 60.0, None) for v in p["video_id"] if v == "b"], columns=["video_id", "start", "end", "error"])

    videos = spark.createDataFrame([("a", 10, 1.0), ("b", 4, 1.0), ("c", 0, 1.0)], "video_id string, n_frames int, scale double")
    assert rows(P.screen(videos, faces, speech)) == [("a", 0.3, 0.1, 0.6, 0.2, 0.3, 0.1), ("b", 0.0, 0.0, 1.0, 0.0, 0.75, 0.0), ("c", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)]


def test_log_entries_are_clipped(spark):
    got = spark.createDataFrame([("error", "x" * 600)], "s string, e string").select(P.log_entry(F.col("s"), F.col("e")).alias("l"), P.log_entry(F.col("s"), F.col("e"), 300).alias("m")).collect()[0]
    assert len(got["l"]["error"]) == 500 and len(got["m"]["error"]) == 300


def test_picks_fall_back_and_drop_what_is_planned(spark):
    listing = [("many", f"m{i}", 400.0 if i != 3 else 10.0) for i in range(8)] + [("single", "s", None), ("short", "x", 10.0), ("short", "y", 20.0), ("again", "m0", 500.0), ("again", "z", 500.0), ("again", None, 500.0)]
    df = spark.createDataFrame(listing, "source string, id string, duration double")
    got = ingest.screen_picks(df, spark.createDataFrame([("m4",)], "id string"), F.col("duration").between(300, 10800), "source", [F.col("id")], 3)
    # m0, m4 (planned, not replaced) and m7 of seven; the single video without a duration; m0 once
    assert rows(got.select("source", "id")) == [("again", "m0"), ("again", "z"), ("many", "m7"), ("single", "s")]


@pytest.mark.parametrize(("pitch", "yaw", "roll"), [(0, 0, 0), (10, 20, 30), (-35, 60, -120), (5, 90, 0), (-170, -10, 3)])
def test_angles_of_a_rotation(spark, pitch, yaw, roll):
    p, y, r = map(math.radians, (pitch, yaw, roll))
    x = np.array([[1, 0, 0], [0, math.cos(p), -math.sin(p)], [0, math.sin(p), math.cos(p)]])
    m = np.array([[math.cos(y), 0, math.sin(y)], [0, 1, 0], [-math.sin(y), 0, math.cos(y)]])
    z = np.array([[math.cos(r), -math.sin(r), 0], [math.sin(r), math.cos(r), 0], [0, 0, 1]])
    rot = 2.5 * (z @ m @ x)
    four = np.eye(4)
    four[:3, :3] = rot
    for v in (rot, four):
        got = spark.createDataFrame([([float(a) for a in v.ravel()],)], "m array<double>").select(*Y.euler_angles(F.col("m"))).collect()[0]
        assert np.allclose(got, (pitch, yaw, roll), atol=1e-6)


def test_tables_of_faces_and_clips(spark, tmp_path):
    assert C.read_corpus_table(spark, str(tmp_path), "detection").count() == 0
    det = spark.createDataFrame([("a", i, 0, 1, 5.0) for i in range(3)] + [("b", 0, 0, 0, 6.0)], "video_id string, frame int, ord int, track int, yaw double").withColumn("extra", F.lit(1))
    C.write_corpus_table(det.where("video_id = 'a'"), str(tmp_path), "detection")
    C.write_corpus_table(det.withColumn("yaw", F.lit(9.0)), str(tmp_path), "detection")
    got = C.read_corpus_table(spark, str(tmp_path), "detection")
    assert rows(got.select("video_id", "frame", "yaw", "roll")) == [("a", 0, 5.0, None), ("a", 1, 5.0, None), ("a", 2, 5.0, None), ("b", 0, 9.0, None)]
    frames = spark.createDataFrame([("a", 0, 0.0), ("a", 9, 0.5), ("c", 4, 0.1)], "video_id string, frame int, shot_dist double")
    assert rows(C.face_summary(got, frames)) == [("a", 10, 3, 3, 1, 1), ("c", 5, 0, 0, 0, 0)]
    C.write_corpus_table(det.where("frame = 0"), str(tmp_path), "detection", overwrite=True)
    assert C.read_corpus_table(spark, str(tmp_path), "detection").count() == 2


def test_documents_of_a_video_and_their_order(spark, tmp_path):
    df = spark.createDataFrame([("a", [1, None]), ("b", None)], "video_id string, units array<int>")
    C.write_per_video(df, f"{tmp_path}/asr")
    C.write_per_video(df.where("video_id = 'b'").withColumn("units", F.array(F.lit(7))), f"{tmp_path}/asr")
    got = spark.read.schema("units array<int>, video_id string").json(f"{tmp_path}/asr")
    assert sorted((r["video_id"], r["units"]) for r in got.collect()) == [("a", [1, None]), ("b", [7])]
    for i in (3, 1, 2):
        (tmp_path / f"m{i}.json").write_text(json.dumps({"id": f"v{i}"}))
    assert rows(C.read_in_path_order(spark, f"file://{tmp_path}/m*.json", "id string").select("nth", "id")) == [(0, "v1"), (1, "v2"), (2, "v3")]
    assert C.read_in_path_order(spark, f"file://{tmp_path}/none*.json", "id string").count() == 0
    info = spark.createDataFrame([("a", "", "bn"), ("c", "x", "y")], "id string, license string, language string")
    got = C.with_info(spark.createDataFrame([("a",), ("b",)], "video_id string"), info, "video_id", {"license": "Standard", "language": None})
    assert rows(got.select("video_id", "license", "language")) == [("a", "Standard", "bn"), ("b", "Standard", None)]
