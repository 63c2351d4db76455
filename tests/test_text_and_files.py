from __future__ import annotations

import io
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from klipgrid import schemas, streaming
from klipgrid.functions import geometry as Y
from klipgrid.functions import text as X
from klipgrid.functions import timeline as L
from klipgrid.plugins import SCORES, run_stage
from klipgrid.sources import reports
from klipgrid.sources import text_files as S


def one(spark, col, *values, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"c {kind}").select(col(F.col("c"))).collect()]


def test_label_forms(spark):
    given = ["বাংলাদেশ।", "ড়", "ো", "ে‍া", "abc", "১২", "", None]
    assert one(spark, X.bn_normalize, *given) == ["বাংলাদেশ", "ড়", "ো", "ো", "", "১২", "", None]
    assert one(spark, X.has_digits, "a1", "৩টা", "abc", None) == [True, True, False, None]


def test_status_order(spark):
    said = ["Sign in to confirm your age", "HTTP Error 429: x", "Private video", "boom", None]
    assert one(spark, X.status_of, *said) == ["rate_limited", "rate_limited", "unavailable", "error", "error"]


def test_golden_clip(spark):
    df = spark.createDataFrame([(1.06, 1.30)], "s double, e double")
    i0 = L.word_window(F.col("s"), F.col("e"))
    r = df.select(i0.alias("i0"), *L.word_frames(F.col("s"), F.col("e"), i0), L.time_of(i0), L.time_of(i0 + 29)).collect()[0]
    assert tuple(r) == (16, 11, 16, 0.64, 1.80)


def test_half_to_even_and_short_words(spark):
    df = spark.createDataFrame([(0.99, 1.01), (1.0, 1.04), (1.001, 1.002)], "s double, e double")
    i0 = L.word_window(F.col("s"), F.col("e"))
    got = [tuple(r) for r in df.select(i0, *L.word_frames(F.col("s"), F.col("e"), i0)).collect()]
    assert got[1][0] == round(25.5) - 14 and got[2][1:] == (14, 14)


def test_sections_and_waits(spark):
    assert one(spark, L.section_start, None, 0.0, 100.0, 400.0, 4000.0, kind="double") == [60.0, 60.0, 0.0, 100.0, 1000.0]
    assert one(spark, L.backoff, 1, 2, 4, 9, kind="int") == [1800.0, 3600.0, 14400.0, 14400.0]


@pytest.mark.parametrize("k", [1, 2, 5])
def test_smoothing_repeats_the_ends(spark, k):
    a = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0]
    for v in (a, a[:1], a[:3]):
        got = spark.createDataFrame([(v,)], "a array<double>").select(Y.smoothed(F.col("a"), k)).collect()[0][0]
        pad = np.pad(v, (k // 2, k - 1 - k // 2), mode="edge")
        want = np.convolve(pad, np.ones(k) / k, mode="valid") if k > 1 and len(v) > 1 else v
        assert np.allclose(got, want, atol=1e-9)


def test_boxes(spark):
    df = spark.createDataFrame([(0.0, 0.0, 2.0, 2.0, 1.0, 1.0, 3.0, 3.0), (0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)], "a double, b double, c double, d double, e double, f double, g double, h double")
    assert [round(r[0], 6) for r in df.select(Y.iou(*[F.col(x) for x in "abcdefgh"])).collect()] == [round(1 / 7, 6), 0.0]
    hist = spark.createDataFrame([([1.0, 3.0], [1.0, 3.0]), ([1.0, 0.0], [0.0, 1.0])], "a array<double>, b array<double>")
    assert [round(r[0], 6) for r in hist.select(Y.bhattacharyya(F.col("a"), F.col("b"))).collect()] == [0.0, 1.0]


def test_html_and_labels(spark):
    assert one(spark, X.html_escape, "<a & 'b' \"c\">", None) == ["&lt;a &amp; &#x27;b&#x27; &quot;c&quot;&gt;", None]
    assert one(spark, lambda c: X.label_part(c, 1), "a | b |c", "a", "", None) == ["b", "", "", ""]


VTT = """WEBVTT

00:00:01.000 --> 00:00:02.5
<c>one</c>
two

00:03.000 --> 00:04.000
lost

00:00:05.000 --> 00:00:06.000
dropped
00:00:07.000 --> 00:00:08.000
<i></i>

00:00:09.000 --> 00:00:10.000

00:00:11.000 --> 00:00:12.000
last"""


def test_vtt(spark):
    df = spark.createDataFrame([("f", VTT), ("g", ""), ("h", None)], "path string, content string")
    got = sorted((r["start"], r["end"], r["text"]) for r in S.parse_vtt(df).collect())
    assert got == [(1.0, 2.005, "one two"), (7.0, 8.0, ""), (11.0, 12.0, "last")]


def test_links(spark):
    df = spark.createDataFrame([("# c",), ("u1 # n | k",), ("u2",), ("  ",), ("u3#",)], "value string")
    assert sorted(tuple(r) for r in S.parse_links(df).collect()) == [("u1", "n | k"), ("u2", ""), ("u3", "")]


def test_json_lines(spark, tmp_path):
    assert S.read_jsonl(spark, f"{tmp_path}/none", schemas.DOWNLOAD_LOG).count() == 0
    df = spark.createDataFrame([("a", "ok", None, "আ", 1.5)], schemas.DOWNLOAD_LOG)
    S.write_jsonl(df, f"{tmp_path}/log")
    S.write_jsonl(df, f"{tmp_path}/log")
    assert S.read_jsonl(spark, f"{tmp_path}/log", schemas.DOWNLOAD_LOG).collect() == df.collect() * 2


def test_write_new_keeps_what_is_there(spark, tmp_path):
    p = f"{tmp_path}/t"
    S.write_new(spark.createDataFrame([(1, "a")], "k int, v string"), p, ["k"])
    S.write_new(spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), p, ["k"])
    assert sorted(tuple(r) for r in spark.read.parquet(p).collect()) == [(1, "a"), (2, "c")]


def test_wave_files(spark, tmp_path):
    b = io.BytesIO()
    with wave.open(b, "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(16000)
        w.writeframes(np.array([0, 16384, -32768], "<i2").tobytes())
    (tmp_path / "a.wav").write_bytes(b.getvalue())
    (tmp_path / "b.wav").write_bytes(b"no")
    got = {r["path"][-5:]: r for r in S.read_wave(spark, str(tmp_path)).collect()}
    assert got["a.wav"]["samples"] == [0.0, 0.5, -1.0] and got["b.wav"]["error"]
    assert sorted(r["id"] for r in S.catalog_files(spark, str(tmp_path)).collect()) == ["a", "b"]


def test_tsv_and_vocabulary(spark, tmp_path):
    S.write_tsv(spark.createDataFrame([("b", 2), ("a", 1)], "w string, n int").orderBy("w"), f"{tmp_path}/t")
    text = "".join(p.read_text() for p in (tmp_path / "t").glob("*.csv"))
    assert text == "w\tn\na\t1\nb\t2\n"
    (tmp_path / "v.txt").write_text("x\tn\n\n y \n")
    assert sorted(r[0] for r in S.read_vocabulary(spark, f"{tmp_path}/v.txt").collect()) == ["x", "y"]


def test_sentence_text(spark):
    df = spark.createDataFrame([("a b", -0.5, [("a", 0.1, 0.25, -0.1234), ("b", 1.0, 2.0, -1.0)])], "t string, s double, w array<struct<word:string,start:double,end:double,score:double>>")
    got = df.select(X.sentence_text(F.col("t"), F.col("s").cast("string"), F.col("w"))).collect()[0][0]
    assert got == "Text:  a b\nConf:  -0.5\n\nWORD START END SCORE\na 0.10 0.25 -0.123\nb 1.00 2.00 -1.000\n"


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("<b>", "v1", 7, -0.1), ("<b>", "v2", 9, -2.0), ("c", "v1", 1, None)], "word string, video_id string, frame_start int, align_score double")
    assert "<td>&lt;b&gt;</td><td>v1</td>" in reports.html_table(df, "t")
    page = reports.clip_browser(df, words=1)
    assert "<h2>&lt;b&gt; (2)</h2>" in page and "class='low'" in page and "<h2>c" not in page
    r = reports.run_summary(df.withColumn("reason", F.when(F.col("word") == "c", "ok").otherwise("yaw")), "words").collect()[0]
    assert (r["videos"], r["candidates"], r["written"], r["rejected"]) == (2, 3, 1, {"yaw": 2})
    S.replace_partitions(df, f"{tmp_path}/p", "video_id")
    S.replace_partitions(df.where("video_id = 'v2'").withColumn("frame_start", F.lit(5)), f"{tmp_path}/p", "video_id")
    assert sorted(x["frame_start"] for x in spark.read.parquet(f"{tmp_path}/p").collect()) == [1, 5, 7]


def test_streams(spark, tmp_path):
    row = {"id": "a", "url": "u", "duration": 100.0}
    spark.createDataFrame([(row["id"], row["url"], None, None, None, d, "s", None) for d in (100.0, 100.0, 1.0)], schemas.MANIFEST).write.json(f"{tmp_path}/in")
    q = streaming.manifest_stream(spark, f"{tmp_path}/in").writeStream.format("memory").queryName("m").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("m").count() == 1


def test_plugged_in_stage(spark):
    def score(parts):
        for p in parts:
            yield p.assign(score=1.0, error=None)

    assert run_stage(spark.createDataFrame([("v",)], "video_id string"), score, SCORES).collect()[0]["score"] == 1.0
