"""Queries of screening and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.geometry import scale_720
from ..operators.ranking import running_sum
from ..operators.identity import distinct_rows
from ..operators.series import frame_spans, swept
from ..sources import table
from .faces import _DET, CUT, detections, frames
from .transcripts import USABLE, WORDS, usable_words


def _lengths(spark: SparkSession, d: str) -> DataFrame:
    """(video_id, n): frames of every video with word clips.

    No table gives the length, so it is the furthest frame that a clip or a
    transcript reaches; bounds of a clip may be null or not fit together.
    """
    words = table(spark, d, "word_clip").select("video_id", F.greatest(F.col("frame_end"), F.col("frame_start") + 14).alias("last"), F.lit(True).alias("clip"))
    sentences = table(spark, d, "sentence_clip").select("video_id", F.greatest("frame_end", "frame_start").alias("last"), F.lit(False).alias("clip"))
    units = table(spark, d, "asr").select("video_id", (F.ceil(F.array_max(F.transform("units", lambda u: u.end)) * 25) - 1).cast("int").alias("last"), F.lit(False).alias("clip"))
    ends = words.unionAll(sentences).unionAll(units).where("video_id is not null")
    return ends.groupBy("video_id").agg(F.coalesce(F.max("last") + 1, F.lit(0)).alias("n"), F.bool_or("clip").alias("clip")).where("clip").drop("clip")


def frame_shares(spark: SparkSession, d: str) -> DataFrame:
    """Shares of all frames of a video in thousandths; a valid frame has one face, and a good one."""
    scale = scale_720(F.lit(1280), F.lit(720))
    ok = (F.col("width") * scale >= 1300) & (F.abs("yaw") <= 150) & (F.abs("pitch") <= 40)
    faces = detections(spark, d).groupBy("video_id", "frame").agg(F.count(F.lit(1)).alias("faces"), F.count_if(ok).alias("valid"))
    u = table(spark, d, "asr").select("video_id", F.explode("units").alias("u")).where("u.start is not null and u.end is not null")
    spans = frame_spans(u, "video_id", F.col("u.start"), F.col("u.end"), 25)
    # one sweep over frames with faces and spans of speech; frames with neither are counted by the length, not made
    both = faces.select("video_id", F.col("frame").alias("a"), F.lit(None).cast("int").alias("b"), "faces", "valid").unionByName(spans, allowMissingColumns=True)
    one = F.col("faces") == 1
    valid = one & (F.col("valid") == 1)
    seen = swept(both, "video_id", "a", "b").groupBy("video_id").agg(
        F.count_if(one).alias("one"), F.count_if(F.col("faces") > 1).alias("multi"), F.count("faces").alias("any"),
        F.count_if(valid).alias("valid"), F.sum("new").alias("speech"), F.count_if(valid & F.col("inside")).alias("usable"),
    )
    share = lambda c: F.when(F.col("n") > 0, F.floor(F.coalesce(c, F.lit(0)) * 1000 / F.col("n") + 0.5)).otherwise(0).cast("long")
    return _lengths(spark, d).join(seen, "video_id", "left").select(
        "video_id", share(F.col("one")).alias("one_face"), share(F.col("multi")).alias("multi_face"), share(F.col("n") - F.coalesce("any", F.lit(0))).alias("no_face"),
        share(F.col("valid")).alias("valid_face"), share(F.col("speech")).alias("speech"), share(F.col("usable")).alias("usable"),
    )


def section_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Cuts a minute and medians over the detections of a video, doubled to stay whole."""
    det, fr = detections(spark, d), frames(spark, d)
    cuts = fr.groupBy("video_id").agg(F.count_if(F.col("shot_dist") > CUT).alias("cuts"), (F.max("frame") + 1).alias("n"))
    per = F.floor(F.col("cuts") / F.greatest(F.col("n") / 1500, F.lit(1e-6)) * 1000 + 0.5).cast("long")
    med = lambda c: (F.percentile(c, F.lit(0.5)) * 2).cast("long")
    meds = det.groupBy("video_id").agg(med(F.col("width")).alias("width_median_x2"), med(F.abs("yaw")).alias("yaw_median_x2"))
    return cuts.join(meds, "video_id").select("video_id", per.alias("cuts_per_min_e3"), "width_median_x2", "yaw_median_x2")


def _sections(spark: SparkSession, d: str) -> DataFrame:
    """(video_id, the shares and medians of its section, licence, language tag)."""
    about = table(spark, d, "documents").where("video_id is not null").groupBy("video_id").agg(
        F.max(F.when(F.col("text").contains("Creative"), "Creative Commons")).alias("said"), F.min("lang").alias("language_tag")
    )
    rows = frame_shares(spark, d).join(section_metrics(spark, d), "video_id").join(about, "video_id", "left")
    return rows.withColumn("licence", X.licence(F.col("said"))).drop("said")


def section_rows(spark: SparkSession, d: str) -> DataFrame:
    """What screening knows of each video."""
    return _sections(spark, d)


_KEYS = ["usable", "valid_face", "one_face", "multi_face", "no_face", "speech", "cuts_per_min_e3", "width_median_x2"]


def channel_means(spark: SparkSession, d: str) -> DataFrame:
    """Means of eight metrics over the sections of each channel, its licences and language tags; '?' where none is known."""
    plan = table(spark, d, "manifest").where("id is not null").groupBy(F.col("id").alias("video_id")).agg(F.min("channel_id").alias("channel_id"))
    rows = _sections(spark, d).join(plan, "video_id", "left").withColumn("channel_id", F.coalesce("channel_id", F.lit("?")))
    mean = lambda c: F.floor(F.sum(c) / F.count(F.lit(1)) + 0.5).cast("long").alias(c)
    out = rows.groupBy("channel_id").agg(
        F.count(F.lit(1)).alias("n_videos"), F.count_if(F.col("licence").contains("Creative")).alias("cc_videos"),
        F.array_join(F.array_sort(F.collect_set(F.coalesce("language_tag", F.lit("None")))), ",").alias("language_tags"), *[mean(c) for c in _KEYS], F.min("video_id").alias("first_video"),
    )
    return out.orderBy(F.desc("usable"), "first_video")


def channel_report(spark: SparkSession, d: str) -> DataFrame:
    """Documents of each source: counts, mean length, language tags, licences."""
    m = table(spark, d, "documents")
    clean = m.select("source", "doc_id", "lang", X.licence(F.when(F.col("text").contains("Creative"), "Creative Commons")).alias("licence"), F.greatest(F.coalesce("n_chars", F.lit(0)), F.lit(0)).alias("n"))
    out = clean.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if(F.col("licence").contains("Creative")).alias("cc_docs"),
        F.array_join(F.array_sort(F.collect_set(F.coalesce("lang", F.lit("None")))), ",").alias("language_tags"),
        F.floor(F.sum("n") * 1000 / F.count(F.lit(1)) + 0.5).cast("long").alias("mean_chars_e3"), F.min("doc_id").alias("first_doc"),
    )
    return out.orderBy(F.desc("mean_chars_e3"), "first_doc")


def channel_members(spark: SparkSession, d: str) -> DataFrame:
    """Videos of each channel id as rows; a list in one cell would grow with the channel."""
    m = table(spark, d, "manifest").where("id is not null").select(F.coalesce("channel_id", F.lit("?")).alias("channel_id"), "id").distinct()
    return running_sum(m.withColumn("one", F.lit(1).cast("long")), ["channel_id"], [F.col("id")], "one", "nth").drop("one")


def viewer_words(spark: SparkSession, d: str) -> DataFrame:
    """The 40 words with most clips: the number the browse page shows."""
    return distinct_rows(table(spark, d, "word_clip"), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n_clips")).orderBy(F.desc("n_clips"), "word").limit(40)


def disjoint_split(spark: SparkSession, d: str) -> DataFrame:
    """Split by arithmetic on a group's key, so a group is never divided."""
    k = F.pmod(F.col("c_nationkey") * 7919 + 13, F.lit(10))
    return table(spark, d, "customer").select("c_custkey", "c_nationkey", F.when(k < 8, "train").when(k == 8, "valid").otherwise("test").alias("split"))


def source_caps(spark: SparkSession, d: str) -> DataFrame:
    """At most 20 words of each video, best aligned first."""
    w = usable_words(spark, d)
    n = F.row_number().over(Window.partitionBy("video_id").orderBy(F.desc("score"), "chunk", "idx", "s", "word"))
    return w.withColumn("nth", n.cast("long")).where("nth <= 20").select("video_id", "chunk", "idx", "word", "s", "nth")


def verify_sample(spark: SparkSession, d: str) -> DataFrame:
    """Two clips of each word for a listener, in order of id."""
    w = usable_words(spark, d)
    n = F.row_number().over(Window.partitionBy("label").orderBy("video_id", "chunk", "idx", "s", "word"))
    return w.withColumn("nth", n.cast("long")).where("nth <= 2").select("label", "video_id", "chunk", "idx", "s", "nth")


def id_subset(spark: SparkSession, d: str) -> DataFrame:
    """Rows of an explicit list of ids, in order, the first three."""
    return table(spark, d, "part").where(F.col("p_partkey").isin(3, 5, 7, 11, 13)).select("p_partkey", "p_name").orderBy("p_partkey").limit(3)


QUERIES = {
    f.__name__: f
    for f in (frame_shares, section_metrics, section_rows, channel_means, channel_report, channel_members, viewer_words, disjoint_split, source_caps, verify_sample, id_subset)
}

_SHARE = "CASE WHEN n > 0 THEN CAST(floor(({0}) * 1000 / n + 0.5::DOUBLE) AS BIGINT) ELSE 0 END"
_LENGTHS = """ends AS (SELECT video_id, greatest(frame_end, frame_start + 14) AS last, true AS clip FROM word_clip
        UNION ALL SELECT video_id, greatest(frame_end, frame_start), false FROM sentence_clip
        UNION ALL SELECT video_id, CAST(ceil(list_max(list_transform(units, lambda u: u."end")) * 25) - 1 AS INTEGER), false FROM asr),
    len AS (SELECT video_id, coalesce(max(last) + 1, 0) AS n FROM ends WHERE video_id IS NOT NULL GROUP BY video_id HAVING bool_or(clip))"""

SQL = {
    "frame_shares": f"""
        WITH {_DET}, {_LENGTHS},
        f AS (SELECT video_id, frame, count(*) AS faces, count(*) FILTER (WHERE width >= 1300 AND abs(yaw) <= 150 AND abs(pitch) <= 40) AS valid FROM det GROUP BY video_id, frame),
        u AS (SELECT video_id, unnest(units) AS u FROM asr),
        sp AS (SELECT DISTINCT video_id, unnest(range(CAST(floor(u.start * 25) AS INTEGER), CAST(ceil(u."end" * 25) AS INTEGER))) AS frame FROM u WHERE u.start IS NOT NULL AND u."end" IS NOT NULL),
        a AS (SELECT video_id, count(*) FILTER (WHERE faces = 1) AS one, count(*) FILTER (WHERE faces > 1) AS multi, count(*) AS seen, count(*) FILTER (WHERE faces = 1 AND valid = 1) AS good FROM f GROUP BY video_id),
        s AS (SELECT video_id, count(*) AS speech FROM sp GROUP BY video_id),
        b AS (SELECT video_id, count(*) AS usable FROM f JOIN sp USING (video_id, frame) WHERE faces = 1 AND valid = 1 GROUP BY video_id)
        SELECT video_id, {_SHARE.format("coalesce(one, 0)")} AS one_face, {_SHARE.format("coalesce(multi, 0)")} AS multi_face, {_SHARE.format("n - coalesce(seen, 0)")} AS no_face,
            {_SHARE.format("coalesce(good, 0)")} AS valid_face, {_SHARE.format("coalesce(speech, 0)")} AS speech, {_SHARE.format("coalesce(usable, 0)")} AS usable
        FROM len LEFT JOIN a USING (video_id) LEFT JOIN s USING (video_id) LEFT JOIN b USING (video_id)""",
    "section_metrics": f"""
        WITH {_DET}, c AS (SELECT video_id, count(*) FILTER (WHERE shot_dist > 0.97::DOUBLE) AS cuts, max(frame) + 1 AS n FROM fr GROUP BY video_id),
        m AS (SELECT video_id, CAST(median(width) * 2 AS BIGINT) AS width_median_x2, CAST(median(abs(yaw)) * 2 AS BIGINT) AS yaw_median_x2 FROM det GROUP BY video_id)
        SELECT video_id, CAST(floor(cuts / greatest(n / 1500::DOUBLE, 0.000001::DOUBLE) * 1000 + 0.5::DOUBLE) AS BIGINT) AS cuts_per_min_e3, width_median_x2, yaw_median_x2 FROM c JOIN m USING (video_id)""",
    "channel_report": """
        SELECT source, count(*) AS n_docs, count(*) FILTER (WHERE contains(text, 'Creative')) AS cc_docs, array_to_string(list_sort(list(DISTINCT coalesce(lang, 'None'))), ',') AS language_tags,
            CAST(floor(CAST(sum(greatest(coalesce(n_chars, 0), 0)) AS BIGINT) * 1000 / count(*) + 0.5::DOUBLE) AS BIGINT) AS mean_chars_e3, min(doc_id) AS first_doc FROM documents GROUP BY source""",
    "channel_members": """
        SELECT channel_id, id, row_number() OVER (PARTITION BY channel_id ORDER BY id) AS nth FROM (SELECT DISTINCT coalesce(channel_id, '?') AS channel_id, id FROM manifest WHERE id IS NOT NULL)""",
    "viewer_words": "SELECT word, count(*) AS n_clips FROM (SELECT DISTINCT * FROM word_clip) GROUP BY word ORDER BY n_clips DESC, word LIMIT 40",
    "disjoint_split": """
        SELECT c_custkey, c_nationkey, CASE WHEN (c_nationkey * 7919 + 13) % 10 < 8 THEN 'train' WHEN (c_nationkey * 7919 + 13) % 10 = 8 THEN 'valid' ELSE 'test' END AS split FROM customer""",
    "source_caps": f"""
        WITH {WORDS}, r AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY score DESC, chunk, idx, s, word) AS nth FROM words WHERE {USABLE})
        SELECT video_id, chunk, idx, word, s, nth FROM r WHERE nth <= 20""",
    "verify_sample": f"""
        WITH {WORDS}, r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY video_id, chunk, idx, s, word) AS nth FROM words WHERE {USABLE})
        SELECT label, video_id, chunk, idx, s, nth FROM r WHERE nth <= 2""",
    "id_subset": "SELECT p_partkey, p_name FROM part WHERE p_partkey IN (3, 5, 7, 11, 13) ORDER BY p_partkey LIMIT 3",
}

_SECTIONS = f"""fsh AS ({SQL["frame_shares"]}), smt AS ({SQL["section_metrics"]}),
    abt AS (SELECT video_id, max(CASE WHEN contains(text, 'Creative') THEN 'Creative Commons' END) AS said, min(lang) AS language_tag FROM documents WHERE video_id IS NOT NULL GROUP BY video_id),
    sec AS (SELECT fsh.*, smt.* EXCLUDE (video_id), language_tag, coalesce(said, 'Standard YouTube License') AS licence FROM fsh JOIN smt USING (video_id) LEFT JOIN abt USING (video_id))"""
SQL["section_rows"] = f"WITH {_SECTIONS} SELECT * FROM sec"
SQL["channel_means"] = f"""
        WITH {_SECTIONS}, pl AS (SELECT id AS video_id, min(channel_id) AS channel_id FROM manifest WHERE id IS NOT NULL GROUP BY id)
        SELECT coalesce(channel_id, '?') AS channel_id, count(*) AS n_videos, count(*) FILTER (WHERE contains(licence, 'Creative')) AS cc_videos,
            array_to_string(list_sort(list(DISTINCT coalesce(language_tag, 'None'))), ',') AS language_tags, {", ".join(f"CAST(floor(sum({c}) / count(*) + 0.5::DOUBLE) AS BIGINT) AS {c}" for c in _KEYS)}, min(video_id) AS first_video
        FROM sec LEFT JOIN pl USING (video_id) GROUP BY coalesce(channel_id, '?')"""
