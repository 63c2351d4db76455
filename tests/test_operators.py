from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from klipgrid.operators import gate, ingest, intervals, series, skew, tracker
from klipgrid.operators.identity import distinct_rows
from klipgrid.operators.ranking import row_at_weight, running_sum, with_position


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_identical_rows_count_once_and_nulls_keep_their_place(spark):
    df = spark.createDataFrame([(None, "x", 1.0), ("x", None, 1.0), ("x", None, 1.0), (None, None, None), ("x", None, -0.0), ("x", None, 0.0)], "a string, _fp1 string, b double")
    assert distinct_rows(df, "a").count() == 4


def test_nested_columns_are_part_of_identity(spark):
    df = spark.createDataFrame([(1, (None, 2), [None, "a"]), (1, (2, None), [None, "a"]), (1, (2, None), ["a", None]), (1, None, None), (1, (None, None), None)], "k int, s struct<a:int,b:int>, l array<string>")
    assert distinct_rows(df, "k").count() == 5


def test_positions_are_dense(spark):
    df = spark.range(1000).withColumn("v", F.pmod(F.xxhash64("id"), F.lit(17)))
    got = {r["id"]: r["p"] for r in with_position(df, F.col("v"), F.col("id"), name="p").collect()}
    want = {r["id"]: i for i, r in enumerate(sorted(df.collect(), key=lambda r: (r["v"], r["id"])))}
    assert got == want
    assert with_position(df.where("id < 0"), F.col("v"), name="p").count() == 0


def test_row_at_weight_reads_the_exact_row(spark):
    rnd = random.Random(1)
    data = [(rnd.choice("aaaab"), i, rnd.randint(1, 5)) for i in range(500)]
    df = spark.createDataFrame(data, "k string, x int, w long")
    goal = spark.createDataFrame([("a", 100), ("b", 7), ("c", 1)], "k string, t long")
    got = {r["k"]: (r["x"], r["_reached"]) for r in row_at_weight(df, ["k"], [F.col("x").desc()], "w", goal, "t").collect()}
    for k, t in (("a", 100), ("b", 7)):
        run = 0
        for _, x, w in sorted((r for r in data if r[0] == k), key=lambda r: -r[1]):
            run += w
            if run >= t:
                assert got[k] == (x, run)
                break
    assert "c" not in got


@pytest.mark.parametrize("share", [1.0, 0.05])
def test_salted_count_is_exact(spark, share):
    rnd = random.Random(2)
    data = [("run", "hot", rnd.randint(0, 300)) for _ in range(2000)] + [("run", rnd.choice("abcdef"), rnd.randint(0, 9)) for _ in range(200)] + [(None, None, 1), (None, None, 1), (None, None, 2)]
    df = spark.createDataFrame(data, "run string, word string, _salt int")
    got = {(r["run"], r["word"]): r["n"] for r in skew.salted_distinct_count(df, ["run", "word"], heavy_share=share).collect()}
    assert got == Counter((a, b) for a, b, _ in set(data))
    assert skew.salted_distinct_count(df.where("false"), ["run", "word"]).count() == 0


def test_counts_that_differ(spark):
    clips = spark.createDataFrame([("r", "a", 1), ("r", "a", 2), ("r", "a", 2), ("r", "b", 1), ("r", "c", 1), ("r", "e", 1)], "run string, word string, x int")
    said = spark.createDataFrame([("r", "a", 2), ("r", "b", None), ("r", "d", 0), ("r", "e", 1), ("r", "e", 2)], "run string, word string, count long")
    assert rows(skew.counts_that_differ(clips, said, ["run", "word"], "count")) == [("r", "b"), ("r", "c"), ("r", "d"), ("r", "e")]
    assert rows(skew.counts_that_differ(clips.where("false"), said, ["run", "word"], "count")) == [("r", "a"), ("r", "b"), ("r", "d"), ("r", "e")]


def brute_periods(data):
    out = []
    for k in {r[0] for r in data if r[0] is not None}:
        frames = sorted({f for v, a, b in data if v == k and a is not None and b is not None for f in range(a, b + 1)})
        spans = []
        for f in frames:
            if spans and f == spans[-1][1] + 1:
                spans[-1][1] = f
            else:
                spans.append([f, f])
        out += [(k, "period", a, b) for a, b in spans]
        out += [(k, "gap", x[1] + 1, y[0] - 1) for x, y in zip(spans, spans[1:])]
    return sorted(out)


@pytest.mark.parametrize("block", [1 << 16, 16])
def test_periods_and_gaps(spark, monkeypatch, block):
    monkeypatch.setattr(intervals, "BLOCK", block)  # of 16: pieces that cross, fill and touch blocks
    rnd = random.Random(3)
    data = []
    for _ in range(600):
        a = rnd.randint(-40, 900)
        data.append((rnd.choice(["hot", "hot", "u", "v", None]), rnd.choice([a, a, a, None]), rnd.choice([a + rnd.randint(-3, 6), a, None])))
    data += data[:50] + [("one", 5, 5), ("bad", 9, 3), ("long", 3, 200), ("long", 202, 202), ("edge", 0, 15), ("edge", 16, 31), ("edge", 48, 63)]
    df = spark.createDataFrame(data, "video string, a int, b int").repartition(7).withColumn("key", F.lit(1))
    assert rows(intervals.periods_and_gaps(df, "video", "a", "b").select("key", "kind", "start", "end")) == brute_periods(data)
    assert intervals.periods_and_gaps(df.where("false"), "video", "a", "b").count() == 0


def test_blocks_split_in_the_worker_too():
    k, b, s, e = intervals._split_blocks(np.array([0]), np.array([intervals.BLOCK - 2]), np.array([2 * intervals.BLOCK + 1]))
    assert list(zip(b, s, e)) == [(0, intervals.BLOCK - 2, intervals.BLOCK - 1), (1, intervals.BLOCK, 2 * intervals.BLOCK - 1), (2, 2 * intervals.BLOCK, 2 * intervals.BLOCK + 1)]


def brute_merge(spans):
    out = []
    for s, e in sorted(spans):
        if out and e - out[-1][0] <= 20 and s - out[-1][1] < 1:
            out[-1][1] = e
        else:
            out.append([s, e])
    return [tuple(x) for x in out if x[1] - x[0] >= 1]


def test_merged_chunks(spark):
    rnd = random.Random(4)
    cases = [[(0.0, 5.0), (6.0, 7.0)], [(0.0, 10.0), (10.5, 20.0)], [(0.0, 10.0), (10.5, 20.1)], [(0.0, 1.0)], [(0.0, 0.9)], []]
    for _ in range(40):
        t, spans = 0.0, []
        for _ in range(rnd.randint(1, 25)):
            t += rnd.choice([0.1, 0.5, 1.0, 1.5])
            e = t + rnd.choice([0.3, 2.0, 7.0, 19.0])
            spans.append((t, e))
            t = e
        cases.append(spans)
    df = spark.createDataFrame(list(enumerate(cases)), "i int, s array<struct<s:double,e:double>>")
    for r in df.select("i", series.merged_chunks(F.col("s")).alias("m")).collect():
        assert [tuple(x) for x in r["m"]] == brute_merge(cases[r["i"]])


def test_gaps_fill_linearly_and_hold_at_the_ends(spark):
    df = spark.createDataFrame([("v", i, x) for i, x in enumerate([None, 1.0, None, None, 4.0, None])] + [("w", 0, None)], "v string, t int, x double")
    got = {(r["v"], r["t"]): r["filled"] for r in series.filled_gaps(df, ["v"], "t", "x").collect()}
    assert [round(got["v", i], 9) for i in range(6)] == [1, 1, 2, 3, 4, 4]
    assert got["w", 0] is None


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9])
def test_even_picks(spark, n):
    got = sorted(r["i"] for r in series.even_picks(spark.range(n).select(F.lit("c").alias("c"), F.col("id").alias("i")), "c", [F.col("i")], 3).collect())
    k = min(3, n)
    assert got == sorted({round(i * ((n - 1) / max(1, k - 1))) for i in range(k)})


def test_cap_counts_accepted_rows_only(spark):
    rnd = random.Random(5)
    data = [("v", rnd.choice("ab"), 0, i, rnd.random() < 0.5) for i in range(200)]
    df = spark.createDataFrame(data, "video string, label string, chunk int, idx int, ok boolean")
    got = {r["idx"]: r["over_cap"] for r in gate.capped(df, ["video", "label"], ["chunk", "idx"], F.col("ok"), 5).collect()}
    used = Counter()
    for _, label, _, i, ok in data:
        assert got[i] == (used[label] >= 5)
        used[label] += ok and used[label] < 5


FACES = [(i, 0, 1, 150.0, 10.0, 5.0) for i in range(5, 25)]
STILL = [(i, 0.01) for i in range(0, 40)]
CASES = [
    (FACES, STILL, "ok"),
    ([(30, 0, 1, 150.0, 0.0, 0.0)], STILL, "no_face"),
    (FACES, STILL + [(10, 0.9)], "ok"),
    (FACES, STILL + [(11, 0.9)], "shot_cut"),
    (FACES, STILL + [(19, 0.9)], "shot_cut"),
    (FACES, STILL + [(20, 0.9)], "ok"),
    ([r for r in FACES if r[0] > 10], STILL, "track_break"),
    (FACES, STILL + [(15, 0.3)], "unstable_frames"),
    ([r for r in FACES if r[0] not in (12, 13, 14)], STILL, "face_missing"),
    (FACES + [(i, 1, 2, 99.0, 0.0, 0.0) for i in (11, 12, 13)], STILL, "multiple_faces"),
    (FACES + [(i, 1, 2, 99.0, 0.0, 0.0) for i in (11, 12)], STILL, "ok"),
    ([(*r[:3], 99.9, *r[4:]) for r in FACES], STILL, "small_face"),
    ([(*r[:4], -30.04, 0.0) for r in FACES], STILL, "ok"),
    ([(*r[:4], -30.06, 0.0) for r in FACES], STILL, "yaw"),
    ([(*r[:4], 0.0, 41.0) for r in FACES], STILL, "pitch"),
    ([(*r[:3], 50.0, 90.0, 90.0) for r in FACES], STILL, "small_face"),
    # equals: the track seen first
    ([(i, i % 2, 7, 150.0, 0.0, 0.0) for i in range(10, 15)] + [(i, 1 - i % 2, 3, 150.0, 0.0, 0.0) for i in range(10, 15)], STILL, "track_break"),
]


def test_gate_reasons(spark):
    windows = spark.createDataFrame([(f"v{n}", 0, 0, "x", 10, 20) for n in range(len(CASES))], "video_id string, chunk int, idx int, label string, i0 int, i1 int")
    det = spark.createDataFrame([(f"v{n}", *r) for n, c in enumerate(CASES) for r in c[0]], "video_id string, frame int, ord int, track int, width double, yaw double, pitch double").withColumns({"roll": F.lit(0.0), "sharp": F.lit(1.0)})
    fr = spark.createDataFrame([(f"v{n}", *r) for n, c in enumerate(CASES) for r in c[1]], "video_id string, frame int, shot_dist double")
    m = gate.window_metrics(windows, ["chunk", "idx", "label"], det, fr).withColumn("reason", gate.face_reason())
    got = {r["video_id"]: (r["reason"], r["track"]) for r in m.collect()}
    assert [got[f"v{n}"][0] for n in range(len(CASES))] == [c[2] for c in CASES]
    assert got[f"v{len(CASES) - 1}"][1] == 7


def box(video, frame, ord_, x, y=0.0, size=20.0):
    return video, frame, ord_, float(x), float(y), float(x + size), float(y + size)


TRACKS = [
    # video, boxes (frame, ord, x), cuts, expected tracks
    ("expiry", [(0, 0, 0), (3, 0, 0), (7, 0, 0)], [], [0, 0, 1]),
    ("cut on a face", [(0, 0, 0), (1, 0, 0), (2, 0, 0)], [1], [0, 1, 1]),
    ("cut without a face", [(0, 0, 0), (2, 0, 0)], [1], [0, 1]),
    ("cut before all", [(5, 0, 0), (6, 0, 0)], [0, 0, 3], [0, 0]),
    ("apart", [(0, 0, 0), (1, 0, 15)], [], [0, 1]),
    ("best pair first", [(0, 0, 0), (0, 1, 8), (1, 0, 7), (1, 1, 1)], [], [0, 1, 1, 0]),
    ("equal tracks", [(0, 0, 0), (0, 1, 0), (1, 0, 0)], [], [0, 1, 1]),
    ("equal boxes", [(0, 0, 0), (1, 0, 0), (1, 1, 0)], [], [0, 1, 0]),
    ("new in box order", [(0, 0, 0), (1, 0, 100), (1, 1, 0), (1, 2, 200)], [], [0, 1, 0, 2]),
    ("numbers run on", [(0, 0, 0), (0, 1, 50), (10, 0, 0), (20, 0, 0), (20, 1, 50)], [20], [0, 1, 2, 3, 4]),
    ("a track is lost while another goes on", [(0, 0, 0), (0, 1, 50), *[(f, 0, 0) for f in range(1, 6)], (6, 0, 50)], [], [0, 1, 0, 0, 0, 0, 0, 2]),
]


def test_tracker(spark):
    kind = "video_id string, frame int, ord int, x0 double, y0 double, x1 double, y1 double"
    data = [box(v, *b) for v, boxes, _, _ in TRACKS for b in boxes] + [box(None, 0, 0, 0), box(None, 1, 0, 0)]
    cuts = spark.createDataFrame([(v, c) for v, _, cs, _ in TRACKS for c in cs], "video_id string, frame int")
    df = spark.createDataFrame(data, kind).withColumn("track", F.lit("clash"))
    got = {(r["video_id"], r["frame"], r["ord"]): r["track"] for r in tracker.track_boxes(df, cuts).collect()}
    for v, boxes, _, want in TRACKS:
        assert [got[v, f, o] for f, o, _ in boxes] == want, v
    assert got[None, 0, 0] == got[None, 1, 0] == 0 and len(got) == len(data)
    assert tracker.track_boxes(df.where("false"), cuts).count() == 0


def test_empty_boxes_overlap_nothing():
    a = np.array([[0.0, 0, 0, 0], [0, 0, 2, 2]])
    assert tracker.overlaps(a, a).tolist() == [[0, 0], [0, 1]]
    assert tracker.overlaps(a[1:], np.array([[1.0, 1, 3, 3], [2, 2, 3, 3]])).round(6).tolist() == [[round(1 / 7, 6), 0]]


def test_running_sums_cross_partitions(spark):
    rnd = random.Random(11)
    data = [(rnd.choice(["hot", "hot", "hot", "a", None]), i, rnd.choice([None, 1, 2])) for i in range(400)]
    got = {r["t"]: r["n"] for r in running_sum(spark.createDataFrame(data, "k string, t int, x int"), ["k"], [F.col("t")], "x", "n").collect()}
    sums = Counter()
    for k, t, x in data:
        sums[k] += x or 0
        assert got[t] == sums[k]


def test_sentence_reasons(spark):
    windows = spark.createDataFrame([("v", 0, 3, -0.5, 10, 60), ("v", 1, 0, -0.5, 10, 60), ("v", 2, 3, None, 10, 60), ("v", 3, 3, -1.5, 10, 60), ("v", 4, 3, 0.0, 10, 34), ("v", 5, 3, 0.0, -1, 60), ("v", 6, 3, 0.0, None, None), ("v", 7, 3, 0.0, 12, 62)], "video_id string, chunk int, n_words int, score double, i0 int, i1 int")
    # two frames of fifty are missing; one of a hundred looks away, which the percentile forgives
    det = spark.createDataFrame([("v", i, 0, 1, 150.0, 80.0 if i == 30 else 10.0, 5.0, 1.0, 9.0) for i in range(5, 90) if i not in (20, 21, 60)], "video_id string, frame int, ord int, track int, width double, yaw double, pitch double, roll double, sharp double")
    fr = spark.createDataFrame([("v", i, 0.01) for i in range(100)], "video_id string, frame int, shot_dist double")
    got = {r["chunk"]: r for r in gate.sentence_reasons(windows, det, fr, gate.Gate(), 0.35).collect()}
    assert [got[i]["reason"] for i in range(8)] == ["ok", "low_align_score", "low_align_score", "low_align_score", "length", "video_edge", "length", "face_missing"]
    assert got[0]["metrics"]["missing"] == 2 and got[0]["metrics"]["yaw"] == 10.0 and got[5]["metrics"] is None


def test_listings_of_any_depth_and_with_cycles(spark):
    chain = [(f"n{i}", f"n{i + 1}") for i in range(12)] + [("n3", "side"), ("n3", None), ("loop", "a"), ("a", "b"), ("b", "a"), ("b", "end")]
    edges = spark.createDataFrame(chain + chain[:3], "parent string, child string")
    roots = spark.createDataFrame([("n0",), ("n0",), ("loop",), ("alone",), (None,)], "root string")
    assert rows(ingest.flatten_listing(edges, roots)) == [("alone", "alone"), ("loop", "end"), ("n0", "n12"), ("n0", "side")]
    assert ingest.flatten_listing(edges, roots.where("false")).count() == 0


def test_hot_keys_meet_by_broadcast_and_others_by_hash(spark):
    data = [("hot", i) for i in range(900)] + [(f"k{i % 40}", i) for i in range(100)] + [(None, 1), ("none", 2)]
    many = spark.createDataFrame(data, "k string, x int")
    one = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(40)], ("else", 5)], "k string, y int")
    want = {"hot": 1, **{f"k{i}": i for i in range(40)}}
    got = rows(skew.join_unique(many, one, "k", heavy_share=0.3).select("k", "x", "y"))
    assert got == sorted((k, x, want[k]) for k, x in data if k in want)
    assert skew.join_unique(many, one, "k", "left", 0.3).count() == len(data)


def test_resume_rules_differ_when_an_error_follows(spark):
    work = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    log = spark.createDataFrame([("a", "ok", 1), ("a", "error", 2), ("b", "error", 1), ("b", "ok", 2), ("c", "unavailable", 1)], "id string, status string, seq int")
    assert rows(ingest.pending(work, log, "id")) == [("d",)]
    assert rows(ingest.pending_by_latest(work, log, "id", "seq")) == [("a",), ("d",)]


def test_sentence_word_frames_have_tolerance_and_clamps(spark):
    from klipgrid.functions.timeline import sentence_word_frames

    df = spark.createDataFrame([(0.56, 0.80, 10, 30), (0.0, 9.0, 10, 30), (1.001, 1.002, 10, 60)], "s double, e double, i0 int, i1 int")
    got = [tuple(r) for r in df.select(*sentence_word_frames(*[F.col(c) for c in df.columns])).collect()]
    assert got == [(4, 10), (0, 19), (16, 15)]


def test_eligibility_edges(spark):
    df = spark.createDataFrame([(1, None, None, None), (2, 59.9, None, "u"), (3, 60.0, "", "u"), (4, 10800.0, "was_live", "u"), (5, 10800.1, None, "u"), (6, 100.0, "is_live", "u"), (7, 100.0, None, "x/shorts/y"), (8, 300.0, None, "u")], "i int, d double, l string, u string")
    c = (F.col("d"), F.col("l"), F.col("u"))
    assert [r["i"] for r in df.where(ingest.eligible(*c)).collect()] == [1, 3, 4, 8]
    assert [r["i"] for r in df.where(ingest.screenable(*c)).collect()] == [8]
