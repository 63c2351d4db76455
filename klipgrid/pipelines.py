"""The stages of the corpus around the plug-ins: transcription, alignment, screening.

Media and models come from outside (``plugins``); what happens between them is
here, as plans over tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions import text as X
from .functions.timeline import aligned_back, padded_window
from .operators.series import frame_spans, merged_chunks, swept
from .params import Screening
from .plugins import FACES, SPEECH, TEXTS, WORDS, Stage, run_stage


def transcribe(videos: DataFrame, speech: Stage, recognise: Stage, subtitles: DataFrame | None = None, longest: float = 20.0) -> tuple[DataFrame, DataFrame]:
    """Units (video_id, chunk, start, end, text, source) of ``videos``, and the errors (video_id, error).

    Voice activity is merged into chunks and each chunk recognised.  A video with
    ``subtitles`` (video_id, start, end, text) takes these as they are instead: no
    merging, no limit of length, no model.  A null text is an empty one.
    """
    todo = videos
    if subtitles is not None:
        subs = subtitles.join(videos.select("video_id"), "video_id", "left_semi")
        todo = videos.join(subs.select("video_id").distinct(), "video_id", "left_anti")
    heard = run_stage(todo, speech, SPEECH)
    spans = heard.where("error is null and start is not null").groupBy("video_id").agg(F.collect_list(F.struct(F.col("start").alias("s"), F.col("end").alias("e"))).alias("p"))
    chunks = spans.select("video_id", F.posexplode(merged_chunks(F.col("p"), longest)).alias("chunk", "c")).select("video_id", "chunk", F.col("c.s").alias("start"), F.col("c.e").alias("end"))
    said = run_stage(chunks, recognise, TEXTS)
    texts = said.where("error is null").select("video_id", "chunk", F.trim(F.coalesce("text", F.lit(""))).alias("text"))
    out = chunks.join(texts, ["video_id", "chunk"]).withColumn("source", F.lit("asr"))
    if subtitles is not None:
        own = subs.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "text"))).alias("u"))
        own = own.select("video_id", F.posexplode("u").alias("chunk", "u")).select("video_id", "chunk", "u.start", "u.end", "u.text", F.lit("subs").alias("source"))
        out = out.unionByName(own)
    errors = heard.where("error is not null").select("video_id", "error").unionByName(said.where("error is not null").select("video_id", "error"))
    return out, errors


def align(units: DataFrame, totals: DataFrame, aligner: Stage, pad: float = 0.25) -> tuple[DataFrame, DataFrame]:
    """Chunks (video_id, chunk, start, end, text, source, score, words) of ``units``, and the errors.

    Units without text drop out.  Each is aligned in a window padded by ``pad``
    within the recording (``totals``: video_id, total); word times come back from
    the window to the recording.  The score is the mean of the word scores, null
    without words.  A chunk that fails is an error and fails no other.
    """
    rows = units.where(F.coalesce("text", F.lit("")) != "").join(totals, "video_id")
    a, b = padded_window(F.col("start"), F.col("end"), F.col("total"), pad)
    done = run_stage(rows.select("video_id", "chunk", "text", a.alias("start"), b.alias("end")), aligner, WORDS)
    words = F.transform("words", lambda w: aligned_back(w, F.col("_from")))
    got = rows.withColumn("_from", a).join(done.where("error is null").select("video_id", "chunk", "words"), ["video_id", "chunk"]).withColumn("words", words)
    n = F.size("words")
    e4 = F.aggregate("words", F.lit(0).cast("long"), lambda s, w: s + F.floor(w.score * 10_000 + 0.5).cast("long"))
    score = F.when(n > 0, F.floor(e4 / n + 0.5) / 10_000)
    out = got.select("video_id", "chunk", "start", "end", "text", "source", score.alias("score"), "words")
    return out, done.where("error is not null").select("video_id", "error")


def screen(videos: DataFrame, faces: Stage, speech: Stage, p: Screening = Screening(), fps: int = 25) -> DataFrame:
    """Shares of each section (video_id, n_frames, scale): one, several and no face, valid, speech, usable.

    A frame is valid if its only face is large and turned little enough, usable if
    valid and spoken over; all shares are of the section's own frames, 0 without any.
    """
    found = run_stage(videos, faces, FACES).where("error is null").join(videos.select("video_id", "n_frames", "scale"), "video_id").where("frame < n_frames")
    good: Column = ((F.col("x1") - F.col("x0")) * F.col("scale") >= p.min_face) & (F.abs("yaw") <= p.max_yaw) & (F.abs("pitch") <= p.max_pitch)
    per = found.groupBy("video_id", "frame").agg(F.count(F.lit(1)).alias("faces"), F.count_if(good).alias("good"))
    said = run_stage(videos, speech, SPEECH).where("error is null and start is not null")
    spans = frame_spans(said, "video_id", F.col("start"), F.col("end"), fps).join(videos.select("video_id", "n_frames"), "video_id")
    spans = spans.select("video_id", "a", F.least("b", "n_frames").cast("int").alias("b")).where("b > a")
    both = per.select("video_id", F.col("frame").alias("a"), F.lit(None).cast("int").alias("b"), "faces", "good").unionByName(spans, allowMissingColumns=True)
    one, valid = F.col("faces") == 1, (F.col("faces") == 1) & (F.col("good") == 1)
    seen = swept(both, "video_id", "a", "b").groupBy("video_id").agg(
        F.count_if(one).alias("one"), F.count_if(F.col("faces") > 1).alias("multi"), F.count("faces").alias("any"), F.count_if(valid).alias("valid"), F.sum("new").alias("speech"), F.count_if(valid & F.col("inside")).alias("usable"),
    )
    share = lambda c: F.when(F.col("n_frames") > 0, F.floor(F.coalesce(c, F.lit(0)) / F.col("n_frames") * 1000 + 0.5) / 1000).otherwise(0.0)
    out = videos.join(seen, "video_id", "left")
    return out.select(
        "video_id", share(F.col("one")).alias("one_face"), share(F.col("multi")).alias("multi_face"), share(F.col("n_frames") - F.coalesce("any", F.lit(0))).alias("no_face"),
        share(F.col("valid")).alias("valid_face"), share(F.col("speech")).alias("speech"), share(F.col("usable")).alias("usable"),
    )


def log_entry(status: Column, error: Column, most: int = 500) -> Column:
    """A line of a log: the status, and the message up to ``most`` characters."""
    return F.struct(status.alias("status"), X.clipped(error, most).alias("error"))
