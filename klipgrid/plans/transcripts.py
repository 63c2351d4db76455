"""Queries of transcripts: nested scans, label forms, word statistics, subtitles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.timeline import padded_window
from ..operators.series import merged_chunks
from ..params import Vocabulary, Words
from ..session import cut
from ..sources import table
from ..sources.text_files import parse_vtt, vocabulary_words


def _flat_words(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "align").select("video_id", F.posexplode("chunks").alias("chunk", "c"))
    w = c.select("video_id", "chunk", F.col("c.source").alias("source"), F.posexplode("c.words").alias("idx", "w"))
    return w.select("video_id", "chunk", "idx", "source", F.col("w.word").alias("word"), F.col("w.start").alias("s"), F.col("w.end").alias("e"), F.col("w.score").alias("score"))


def words(spark: SparkSession, d: str) -> DataFrame:
    """Flat words of all alignments, repeated deliveries once, with their label form."""
    return _flat_words(spark, d).distinct().withColumn("label", X.bn_normalize(F.col("word")))


def usable_words(spark: SparkSession, d: str, p: Words = Words()) -> DataFrame:
    """Words that pass the filter: time and score first, so the label form is made for the rest only."""
    w = _flat_words(spark, d).where((F.col("e") - F.col("s")).between(p.min_duration, p.max_duration) & (F.col("score") >= p.min_score))
    return w.distinct().withColumn("label", X.bn_normalize(F.col("word"))).where(F.length("label") >= p.min_chars)


WORDS = r"""w0 AS (SELECT video_id, unnest(chunks) AS c, generate_subscripts(chunks, 1) - 1 AS chunk FROM align),
    w1 AS (SELECT video_id, chunk, c.source AS source, unnest(c.words) AS w, generate_subscripts(c.words, 1) - 1 AS idx FROM w0),
    words AS (SELECT DISTINCT video_id, chunk, idx, source, w.word AS word, w.start AS s, w."end" AS e, w.score AS score,
        regexp_replace(regexp_replace(nfc_normalize(w.word), '[\x{200B}\x{200C}\x{200D}\x{FEFF}]', '', 'g'), '[^\x{0980}-\x{09FF}]', '', 'g') AS label FROM w1)"""
USABLE = "length(label) >= 2 AND e - s BETWEEN 0.12::DOUBLE AND 1.0::DOUBLE AND score >= -1.0::DOUBLE"


def word_counts(spark: SparkSession, d: str) -> DataFrame:
    w = usable_words(spark, d)
    first = F.min(F.struct("video_id", "chunk", "idx"))
    out = w.groupBy(F.col("label").alias("word")).agg(F.count(F.lit(1)).alias("count"), F.countDistinct("video_id").alias("n_videos"), first.alias("first"))
    return out.orderBy(F.desc("count"), "first").select("word", "count", "n_videos")


def word_totals(spark: SparkSession, d: str) -> DataFrame:
    return usable_words(spark, d).agg(F.count(F.lit(1)).alias("tokens"), F.countDistinct("label").alias("types"))


def top_words(spark: SparkSession, d: str) -> DataFrame:
    """The 40 most frequent words: the number shown by the statistics command."""
    w = usable_words(spark, d).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return w.orderBy(F.desc("n"), "label").limit(40)


def words_per_video(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "align").distinct()
    n = F.aggregate(F.coalesce("chunks", F.array()), F.lit(0).cast("long"), lambda s, c: s + F.greatest(F.size(F.coalesce(c.words, F.array())), F.lit(0)))
    return a.select("video_id", n.alias("n")).groupBy("video_id").agg(F.sum("n").alias("n_words"))


def label_normalize(spark: SparkSession, d: str) -> DataFrame:
    w = words(spark, d).select("word", "label").distinct()
    return w.select("word", "label", X.has_digits(F.col("word")).alias("digits"))


def _units(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "asr").select("video_id", F.posexplode("units").alias("unit_no", "u"))
    return u.select("video_id", "unit_no", F.col("u.start").alias("s"), F.col("u.end").alias("e"), F.col("u.text").alias("text"), F.col("u.source").alias("source")).distinct()


_UNITS = """u0 AS (SELECT video_id, unnest(units) AS u, generate_subscripts(units, 1) - 1 AS unit_no FROM asr),
    units AS (SELECT DISTINCT video_id, unit_no, u.start AS s, u."end" AS e, u.text AS text, u.source AS source FROM u0)"""


def aligner_tokens(spark: SparkSession, d: str) -> DataFrame:
    t = _units(spark, d).where("text is not null").select("video_id", "unit_no", "s", "text")
    t = t.withColumn("nfc", X.nfc(F.col("text")))
    toks = F.filter(F.split(F.trim("nfc"), r"[ \t\n\r\f]+"), lambda x: (X.bn_normalize(x, is_nfc=True) != "") & ~X.has_digits(x))
    return t.select("video_id", "unit_no", "s", F.size(toks).cast("long").alias("n_tokens"), F.array_join(toks, " ").alias("tokens"))


def text_units(spark: SparkSession, d: str) -> DataFrame:
    """Spans zipped with texts by position; empty texts drop out."""
    a = table(spark, d, "asr").select("video_id", F.transform("units", lambda u: F.struct(u.start.alias("s"), u.end.alias("e"))).alias("spans"), F.transform("units", lambda u: F.trim(u.text)).alias("texts"))
    z = a.select("video_id", F.explode(F.arrays_zip("spans", "texts")).alias("z"))
    return z.where("z.texts <> ''").select("video_id", F.col("z.spans.s").alias("s"), F.col("z.spans.e").alias("e"), F.col("z.texts").alias("text")).distinct()


def vad_merge(spark: SparkSession, d: str) -> DataFrame:
    spans = _units(spark, d).where("s is not null and e is not null").select("video_id", F.struct("s", "e").alias("p")).distinct()
    per = spans.groupBy("video_id").agg(F.collect_list("p").alias("spans"))
    return per.select("video_id", F.explode(merged_chunks(F.col("spans"))).alias("c")).select("video_id", F.col("c.s").alias("s"), F.col("c.e").alias("e"))


def vtt_cues(spark: SparkSession, d: str) -> DataFrame:
    """Subtitle files written from the transcripts and parsed back."""
    stamp = lambda t: F.concat_ws(":", *[F.lpad(F.floor(t / x).cast("long").cast("string") if x == 3600 else F.floor(F.pmod(t, F.lit(3600.0 if x == 60 else 60.0)) / x).cast("long").cast("string"), 2, "0") for x in (3600, 60, 1)])
    u = _units(spark, d).where("s is not null and e is not null and text is not null")
    cue = F.concat(stamp(F.col("s")), F.lit(".000 --> "), stamp(F.col("e")), F.lit(".500\n<c>"), F.col("text"), F.lit("</c>\n"))
    files = u.groupBy(F.col("video_id").alias("path")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("unit_no", "s", cue.alias("cue")))), lambda x: x.cue), "\n").alias("content"))
    return parse_vtt(files.select("path", F.concat(F.lit("WEBVTT\n\n"), F.col("content")).alias("content")))


def padded_windows(spark: SparkSession, d: str) -> DataFrame:
    u = _units(spark, d).where("s is not null and e is not null")
    total = u.groupBy("video_id").agg(F.max("e").alias("total"))
    a, b = padded_window(F.col("s"), F.col("e"), F.col("total"))
    return u.join(total, "video_id").select("video_id", "unit_no", "s", a.alias("from_s"), b.alias("to_s"))


def chunk_score(spark: SparkSession, d: str) -> DataFrame:
    """Mean of the word scores of a chunk in 1/10,000, from scores in whole 1/10,000."""
    w = words(spark, d).where("score is not null")
    e4 = F.floor(F.col("score") * 10_000 + 0.5).cast("long")
    return w.groupBy("video_id", "chunk").agg(F.count(F.lit(1)).alias("n_words"), F.floor(F.sum(e4) / F.count(F.lit(1)) + 0.5).cast("long").alias("score_e4"))


def vocab_filter(spark: SparkSession, d: str) -> DataFrame:
    w = words(spark, d)
    return w.join(vocabulary_words(table(spark, d, "vocab")).withColumnRenamed("word", "label"), "label", "left_semi").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def vocab_select(spark: SparkSession, d: str, p: Vocabulary = Vocabulary()) -> DataFrame:
    """Words fit for a closed vocabulary: median length, graphemes, spread over videos and channels; the commonest of them."""
    w = usable_words(spark, d).select("label", "video_id", F.floor((F.col("e") - F.col("s")) * 1000 + 0.5).alias("ms"))
    w = cut(w.where(F.regexp_count("label", F.lit(r"\X")) >= p.min_graphemes))
    g = w.groupBy("label").agg(F.percentile("ms", F.lit(0.5)).alias("ms"), F.countDistinct("video_id").alias("n_videos"), F.count(F.lit(1)).alias("n"))
    # a video may be listed under several channels, so its words are not joined with them
    of = table(spark, d, "manifest").where("id is not null and channel_id is not null").select(F.col("id").alias("video_id"), "channel_id").distinct()
    spread = w.select("label", "video_id").distinct().join(of, "video_id").groupBy("label").agg(F.countDistinct("channel_id").alias("n_channels"))
    ok = F.col("ms").between(p.min_ms, p.max_ms) & (F.col("n_videos") >= p.min_videos)
    out = g.where(ok).join(spread.where(F.col("n_channels") >= p.min_channels), "label")
    return out.orderBy(F.desc("n"), "label").limit(p.size).select("label", "n", "n_videos", (F.col("ms") * 2).cast("long").alias("double_ms"))


def low_confidence(spark: SparkSession, d: str) -> DataFrame:
    w = words(spark, d)
    return w.select("video_id", "chunk", "idx", "s", (F.col("score") < -1.0).alias("low"))


def html_escape(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.html_escape(F.col("text")).alias("html"))


def lrs_text(spark: SparkSession, d: str) -> DataFrame:
    w = words(spark, d).where("s is not null and e is not null and score is not null")
    ms = lambda c: F.floor(F.col(c) * 100 + 0.5).cast("long")
    line = F.concat_ws(" ", "word", ms("s").cast("string"), ms("e").cast("string"), F.floor(F.col("score") * 1000 + 0.5).cast("long").cast("string"))
    per = w.groupBy("video_id", "chunk").agg(F.array_sort(F.collect_list(F.struct("idx", "s", "word", line.alias("line")))).alias("l"))
    return per.select("video_id", "chunk", F.array_join(F.transform("l", lambda x: x.line), "\n").alias("lines"))


def top_n_per_word(spark: SparkSession, d: str) -> DataFrame:
    """Six clips of each word, best aligned first: the number the browse page shows."""
    c = table(spark, d, "word_clip").select("word", "video_id", "chunk", F.col("index").alias("idx"), "align_score", "run_id").distinct()
    w = Window.partitionBy("word").orderBy(F.col("align_score").desc_nulls_last(), "video_id", "chunk", "idx", "run_id")
    return c.withColumn("nth", F.row_number().over(w).cast("long")).where("nth <= 6")


QUERIES = {
    f.__name__: f
    for f in (
        word_counts, word_totals, top_words, words_per_video, label_normalize, aligner_tokens, text_units, vad_merge, vtt_cues, padded_windows, chunk_score,
        vocab_filter, vocab_select, low_confidence, html_escape, lrs_text, top_n_per_word,
    )
}

SQL = {
    "word_counts": f"WITH {WORDS} SELECT label AS word, count(*) AS count, count(DISTINCT video_id) AS n_videos FROM words WHERE {USABLE} GROUP BY label",
    "word_totals": f"WITH {WORDS} SELECT count(*) AS tokens, count(DISTINCT label) AS types FROM words WHERE {USABLE}",
    "top_words": f"WITH {WORDS} SELECT label, count(*) AS n FROM words WHERE {USABLE} GROUP BY label ORDER BY n DESC, label LIMIT 40",
    "words_per_video": """
        WITH a AS (SELECT DISTINCT * FROM align)
        SELECT video_id, CAST(coalesce(sum(list_sum(list_transform(chunks, lambda c: coalesce(len(c.words), 0)))), 0) AS BIGINT) AS n_words FROM a GROUP BY video_id""",
    "label_normalize": rf"WITH {WORDS} SELECT DISTINCT word, label, regexp_matches(word, '[\x{{09E6}}-\x{{09EF}}0-9]') AS digits FROM words",
    "aligner_tokens": rf"""
        WITH {_UNITS}, t AS (SELECT video_id, unit_no, s, list_filter(regexp_split_to_array(trim(nfc_normalize(text), ' '), '[ \t\n\r\f]+'),
            lambda x: regexp_replace(regexp_replace(x, '[\x{{200B}}\x{{200C}}\x{{200D}}\x{{FEFF}}]', '', 'g'), '[^\x{{0980}}-\x{{09FF}}]', '', 'g') <> '' AND NOT regexp_matches(x, '[\x{{09E6}}-\x{{09EF}}0-9]')) AS k
            FROM units WHERE text IS NOT NULL)
        SELECT video_id, unit_no, s, len(k) AS n_tokens, array_to_string(k, ' ') AS tokens FROM t""",
    "text_units": f"WITH {_UNITS} SELECT DISTINCT video_id, s, e, trim(text, ' ') AS text FROM units WHERE trim(text, ' ') <> ''",
    "vad_merge": f"""
        WITH RECURSIVE {_UNITS}, p AS (SELECT DISTINCT video_id, s, e FROM units WHERE s IS NOT NULL AND e IS NOT NULL),
        r AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY s, e) AS k FROM p),
        f AS (SELECT video_id, k, s AS cs, e AS ce, 1 AS c FROM r WHERE k = 1
              UNION ALL SELECT r.video_id, r.k, CASE WHEN r.e - cs <= 20 AND r.s - ce < 1.0 THEN cs ELSE r.s END, r.e, CASE WHEN r.e - cs <= 20 AND r.s - ce < 1.0 THEN c ELSE c + 1 END
              FROM f JOIN r ON r.video_id = f.video_id AND r.k = f.k + 1)
        SELECT video_id, min(cs) AS s, arg_max(ce, k) AS e FROM f GROUP BY video_id, c HAVING arg_max(ce, k) - min(cs) >= 1.0""",
    "vtt_cues": rf"""
        WITH {_UNITS}, q AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY unit_no, s, e, text) AS cue, regexp_split_to_array('<c>' || text || '</c>', '\r\n|\n|\r') AS l FROM units WHERE s IS NOT NULL AND e IS NOT NULL AND text IS NOT NULL),
        k AS (SELECT *, list_position(list_transform(l, lambda x: trim(x, ' ') = ''), true) AS blank FROM q)
        SELECT video_id AS path, cue, floor(s) AS start, floor(e) + 0.5::DOUBLE AS "end",
            array_to_string(list_transform(CASE WHEN blank > 0 THEN l[1 : blank - 1] ELSE l END, lambda x: trim(regexp_replace(x, '<[^>]+>', '', 'g'), ' ')), ' ') AS text FROM k""",
    "padded_windows": f"""
        WITH {_UNITS}, q AS (SELECT * FROM units WHERE s IS NOT NULL AND e IS NOT NULL), m AS (SELECT video_id, max(e) AS total FROM q GROUP BY video_id)
        SELECT video_id, unit_no, s, greatest(0.0::DOUBLE, s - 0.25::DOUBLE) AS from_s, least(total, e + 0.25::DOUBLE) AS to_s FROM q JOIN m USING (video_id)""",
    "chunk_score": f"""
        WITH {WORDS} SELECT video_id, chunk, count(*) AS n_words, CAST(floor(CAST(sum(CAST(floor(score * 10000 + 0.5::DOUBLE) AS BIGINT)) AS BIGINT) / count(*) + 0.5::DOUBLE) AS BIGINT) AS score_e4
        FROM words WHERE score IS NOT NULL GROUP BY video_id, chunk""",
    "vocab_filter": f"WITH {WORDS} SELECT label, count(*) AS n FROM words WHERE label IN (SELECT trim(split_part(line, chr(9), 1)) FROM vocab) AND label <> '' GROUP BY label",
    "vocab_select": rf"""
        WITH {WORDS}, k AS (SELECT * FROM words WHERE {USABLE} AND length(regexp_replace(label, '\pM', '', 'g')) + CASE WHEN regexp_matches(label, '^\pM') THEN 1 ELSE 0 END >= 3),
        g AS (SELECT label, median(floor((e - s) * 1000 + 0.5::DOUBLE)) AS ms, count(DISTINCT video_id) AS n_videos, count(*) AS n FROM k GROUP BY label),
        c AS (SELECT label, count(DISTINCT channel_id) AS n_channels FROM k JOIN manifest ON id = video_id GROUP BY label)
        SELECT label, n, n_videos, CAST(ms * 2 AS BIGINT) AS double_ms FROM g JOIN c USING (label) WHERE ms BETWEEN 250 AND 900 AND n_videos >= 20 AND n_channels >= 3 ORDER BY n DESC, label LIMIT 500""",
    "low_confidence": f"WITH {WORDS} SELECT video_id, chunk, idx, s, score < -1.0 AS low FROM words",
    "html_escape": """
        SELECT doc_id, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS html FROM documents""",
    "lrs_text": f"""
        WITH {WORDS}, l AS (SELECT video_id, chunk, idx, s, word, word || ' ' || CAST(floor(s * 100 + 0.5::DOUBLE) AS BIGINT) || ' ' || CAST(floor(e * 100 + 0.5::DOUBLE) AS BIGINT) || ' '
            || CAST(floor(score * 1000 + 0.5::DOUBLE) AS BIGINT) AS line FROM words WHERE s IS NOT NULL AND e IS NOT NULL AND score IS NOT NULL)
        SELECT video_id, chunk, string_agg(line, chr(10) ORDER BY idx, s, word, line) AS lines FROM l GROUP BY video_id, chunk""",
    "top_n_per_word": """
        WITH c AS (SELECT DISTINCT word, video_id, chunk, index AS idx, align_score, run_id FROM word_clip)
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY align_score DESC NULLS LAST, video_id, chunk, idx, run_id) AS nth FROM c) WHERE nth <= 6""",
}
