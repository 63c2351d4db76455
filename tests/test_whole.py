"""Queries do the whole job: no prefix, border or limit that the data do not have."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pyarrow.parquet as pq

from klipgrid.functions import text as X
from klipgrid.plans import faces, ingest, reports, transcripts

from conftest import DATA


def read(name):
    return pq.read_table(f"{DATA}/{name}.parquet").to_pylist()


def spoken():
    out = defaultdict(set)
    for r in read("asr"):
        for u in r["units"] or []:
            if u["start"] is not None and u["end"] is not None:
                out[r["video_id"]].update(range(math.floor(u["start"] * 25), math.ceil(u["end"] * 25)))
    return out


def test_frame_shares_take_every_frame_of_a_video(spark):
    speech, n, found = spoken(), Counter(), defaultdict(lambda: defaultdict(set))
    tenth = lambda x: None if x is None else math.floor(x * 10 + 0.5)
    for r in read("word_clip"):
        for x in (r["frame_end"], None if r["frame_start"] is None else r["frame_start"] + 14):
            n[r["video_id"]] = max(n[r["video_id"]], -1 if x is None else x)
        if r["frame_start"] is not None and r["face"] and r["face"]["track"] is not None:
            f, t = r["frame_start"] + 14, r["face"]["track"]
            found[r["video_id"]][f].add((t, tenth(r["face"]["face_width_median"]), tenth(r["face"]["yaw_abs"]), (f * 7 + t * 3) % 50))
    videos = {v for v in n if v is not None}
    for r in read("sentence_clip"):
        for x in (r["frame_end"], r["frame_start"]):
            n[r["video_id"]] = max(n[r["video_id"]], -1 if x is None else x)
    want = {}
    for v in videos:
        length = max(n[v], *speech[v], -1) + 1
        assert length > 500
        good = lambda x: None not in x and x[1] >= 1300 and x[2] <= 150 and x[3] <= 40
        one = {f for f, x in found[v].items() if len(x) == 1}
        valid = {f for f in one if good(next(iter(found[v][f])))}
        counts = (len(one), len(found[v]) - len(one), length - len(found[v]), len(valid), len(speech[v]), len(valid & speech[v]))
        want[v] = tuple(math.floor(c * 1000 / length + 0.5) for c in counts)
    got = {r["video_id"]: tuple(r[c] for c in ("one_face", "multi_face", "no_face", "valid_face", "speech", "usable")) for r in reports.frame_shares(spark, DATA).collect()}
    assert got == want


def test_speech_mask_goes_to_the_last_unit(spark):
    want = {v: (len(x), min(x), max(x)) for v, x in spoken().items() if x}
    assert max(x[2] for x in want.values()) > 3000
    assert {r["video_id"]: (r["n_frames"], r["first"], r["last"]) for r in faces.speech_mask(spark, DATA).collect()} == want


LOG = "seq long, id string, status string, error string, video string, t double"


def write_log(spark, folder, rows):
    spark.createDataFrame([(seq, f"v{seq}", status, None, None, t) for seq, status, t in rows], LOG).write.parquet(f"{folder}/download_log.parquet")
    return str(folder)


def test_rate_window_counts_over_midnight(spark, tmp_path):
    rnd = random.Random(3)
    # three midnights, bounds of the hour before them, and more than 150 in an hour across one
    times = [86_400.0 * k + x for k in (1, 2, 3) for x in (-3601, -3600, -3600, -1, 0, 0, 3599, 3600, 3601)] + [2 * 86_400 + rnd.uniform(-1800, 1800) for _ in range(200)]
    rows = [(i, rnd.choice(["ok", "ok", "ok", "error"]), t) for i, t in enumerate(times)]
    ok = [(i, math.floor(t)) for i, status, t in rows if status == "ok"]
    want = {i: sum(t - 3600 <= x <= t for _, x in ok) for i, t in ok}
    got = ingest.rate_window(spark, write_log(spark, tmp_path, rows)).collect()
    assert len(got) == len(ok) and {r["seq"]: r["in_window"] for r in got} == want
    assert {r["seq"] for r in got if r["must_wait"]} == {i for i, n in want.items() if n >= 150} != set()


def test_backoff_goes_on_over_every_hundredth_line(spark, tmp_path):
    rnd = random.Random(4)
    # random lines, then 350 without any success (over three borders), then random ones with a hole of 300 numbers
    rows = [(i, rnd.choice(["ok", "rate_limited", "error", None]), 0.0) for i in range(150)] + [(i, rnd.choice(["rate_limited", "error"]), 0.0) for i in range(150, 500)]
    rows += [(i, rnd.choice(["ok"] + ["rate_limited"] * 20), 0.0) for i in range(800, 1300)]
    want, hits = {}, 0
    for i, status, _ in rows:
        hits = 0 if status == "ok" else hits + (status == "rate_limited")
        if status == "rate_limited":
            want[i] = (hits, min(1800.0 * 2 ** (hits - 1), 14_400.0))
    got = ingest.backoff_sequence(spark, write_log(spark, tmp_path, rows)).collect()
    assert max(h for h, _ in want.values()) > 100
    assert len(got) == len(want) and {r["seq"]: (r["hits"], r["wait_s"]) for r in got} == want


def test_work_list_is_whole_by_default(spark, tmp_path):
    todo = [(f"v{i:03}", None if i % 3 == 0 else "ab"[i % 2]) for i in range(90)]
    spark.createDataFrame([(i, None, None, None, None, None, None, t) for i, t in [*todo, ("done", "a")]], "id string, url string, title string, channel string, channel_id string, duration double, source string, tag string").write.parquet(f"{tmp_path}/manifest.parquet")
    spark.createDataFrame([(1, "done", "ok", None, None, 0.0), (2, "v001", "error", None, None, 0.0)], LOG).write.parquet(f"{tmp_path}/download_log.parquet")
    got = lambda **x: [tuple(r) for r in ingest.work_list(spark, str(tmp_path), **x).collect()]
    assert got() == todo
    assert got(max_videos=20) == todo[:20]
    assert got(tag="b", max_videos=7) == [r for r in todo if r[1] == "b"][:7]


def test_vocabulary_needs_graphemes_videos_channels_and_length(spark, tmp_path):
    # word: videos, channels, seconds
    words = {"কলমদ": (20, 3, 0.3), "খলমদ": (19, 3, 0.3), "গলমদ": (20, 2, 0.3), "ঘলমদ": (20, 3, 0.24), "কীলী": (20, 3, 0.3)}
    align, seen = [], {}
    for word, (n, channels, length) in words.items():
        for i in range(n):
            video = f"{i % channels}-{i}"
            seen[video] = f"c{i % channels}"
            align.append((video, [("asr", [(word, 1.0, 1.0 + length, 0.0)])]))
    spark.createDataFrame(align, "video_id string, chunks array<struct<source:string,words:array<struct<word:string,start:double,end:double,score:double>>>>").write.parquet(f"{tmp_path}/align.parquet")
    # listed twice, once under no channel
    spark.createDataFrame([(v, c) for v, c in seen.items()] * 2 + [(v, None) for v in seen], "id string, channel_id string").write.parquet(f"{tmp_path}/manifest.parquet")
    got = [tuple(r) for r in transcripts.vocab_select(spark, str(tmp_path)).collect()]
    assert got == [("কলমদ", 20, 20, 600)]


def test_status_keeps_500_characters_of_a_message(spark, tmp_path):
    errors = [None, "short", "x" * 40, "y" * 600]
    spark.createDataFrame([(i, "v", "error", e, None, 0.0) for i, e in enumerate(errors)], LOG).write.parquet(f"{tmp_path}/download_log.parquet")
    got = {r["seq"]: r["message"] for r in ingest.status_classify(spark, str(tmp_path)).collect()}
    marks = [*X.RATE_LIMITED, *X.PERMANENT, "something else"]
    assert got == {i: f"{e or ''} / {marks[i % len(marks)]}"[:500] for i, e in enumerate(errors)}
    assert len(got[3]) == 500
