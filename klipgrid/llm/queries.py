"""Queries of the problems 1, 2, 3, 6, 7, 8, 9 and 10, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.identity import distinct_rows
from ..sources import table
from ..sources.text_files import vocabulary_words
from ..session import cut, scratch
from .caps import cap_contributors
from .cutoffs import fraction_cutoffs
from .language import detect_passages, label_cases
from .packing import pack
from .plainform import add_plain_forms, vocabulary, word_forms
from .repetition import flag_repetitive
from .splits import related_groups, related_pairs, related_splits
from .tokens import count_tokens, decode_corpus, encode_corpus

SPLIT_PERMILLE = {"train": 800, "valid": 100, "test": 100}
CHANNEL_PERMILLE = 30  # of the clips that take part, for one channel
CAP_BATCHES = 2  # the table is given once, so its batches are taken by hash of the video
CONTAINER = 2048  # tokens


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Cutoff of each transcript source in units of 1/10,000 and the clips kept."""
    out = fraction_cutoffs(table(spark, d, "word_clip"), "transcript_source", "align_score", table(spark, d, "keep_targets"), "keep_permille")
    return out.select("transcript_source", F.round(F.col("cutoff") * 10_000).cast("long").alias("cutoff_e4"), "n_kept")


def _units(spark: SparkSession, d: str) -> DataFrame:
    units = table(spark, d, "asr").select("video_id", F.posexplode("units").alias("unit_no", "u"))
    return units.select("video_id", "unit_no", F.col("u.text").alias("text"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Units at least 40% of whose words are repeated content."""
    return flag_repetitive(_units(spark, d), ["video_id", "unit_no"], "text").select("video_id", "unit_no").distinct()


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of channel ids that must land in one set."""
    out = related_pairs(table(spark, d, "manifest"), "channel_id", "id")
    return out.select(F.col("a").alias("channel_id_a"), F.col("b").alias("channel_id_b"))


def p3_split(spark: SparkSession, d: str) -> DataFrame:
    """The set of every video."""
    return related_splits(table(spark, d, "manifest"), "id", "channel_id", SPLIT_PERMILLE).withColumnRenamed("id", "video_id")


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    """Channel ids related to others: the smallest of their group, and its size."""
    return related_groups(table(spark, d, "manifest"), "channel_id", "id").select(F.col("node").alias("channel_id"), F.col("root").alias("first_channel_id"), F.col("n").alias("n_channels"))


def p3_check(spark: SparkSession, d: str) -> DataFrame:
    """Videos with a set, and how many channels are divided among sets."""
    split = cut(p3_split(spark, d))
    seen = table(spark, d, "manifest").where("id is not null and channel_id is not null").select(F.col("id").alias("video_id"), "channel_id").distinct()
    sets = seen.join(split, "video_id").groupBy("channel_id").agg(F.min("split").alias("a"), F.max("split").alias("z"))
    videos = split.agg(F.count(F.lit(1)).alias("n_videos"), F.countDistinct("video_id").alias("n_different"))
    return videos.join(F.broadcast(sets.agg(F.count_if(F.col("a") != F.col("z")).alias("n_divided"))))  # one row each


def channel_of_video(manifest: DataFrame) -> DataFrame:
    """(video_id, channel): the smallest name, in lower case and with blanks reduced."""
    name = F.trim(F.regexp_replace(F.lower("channel"), r"[\s\p{Z}]+", " "))
    return manifest.where(F.col("id").isNotNull() & F.col("channel").isNotNull()).groupBy(F.col("id").alias("video_id")).agg(F.min(name).alias("channel"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Clips that the cap of their channel leaves out."""
    clips = distinct_rows(table(spark, d, "sentence_clip"), "video_id", "chunk", "align_score")
    clips = cut(clips.join(channel_of_video(table(spark, d, "manifest")), "video_id").select("video_id", "chunk", "align_score", "channel", "_fp1"))
    cap = max(1, clips.count() * CHANNEL_PERMILLE // 1000)
    order = [("align_score", True), ("video_id", False), ("chunk", False), ("_fp1", False)]
    batch = F.pmod(F.xxhash64("video_id"), F.lit(CAP_BATCHES))
    return cap_contributors(clips, "channel", order, cap, batch, CAP_BATCHES, scratch(spark)).log().select("video_id", "chunk").distinct()


def _words(spark: SparkSession, d: str) -> DataFrame:
    chunks = table(spark, d, "align").select("video_id", F.posexplode("chunks").alias("chunk_no", "c"))
    words = chunks.select("video_id", "chunk_no", F.posexplode("c.words").alias("word_no", "w"))
    return words.select("video_id", "chunk_no", "word_no", F.col("w.word").alias("word"), F.col("w.label").alias("label"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Word entries whose word or label is not in plain form."""
    out = add_plain_forms(_words(spark, d), word_forms(vocabulary(table(spark, d, "vocab"))))
    odd = (F.col("word") != F.col("word_plain")) | (F.col("label") != F.col("label_plain"))
    return out.where(odd).select("video_id", "chunk_no", "word_no").distinct()


def p7_plain(spark: SparkSession, d: str) -> DataFrame:
    """Plain form of every different spelling, and how often it occurs."""
    forms = _words(spark, d).groupBy("word", "label").agg(F.count(F.lit(1)).alias("n"))
    return add_plain_forms(forms, word_forms(vocabulary(table(spark, d, "vocab"))))


def p7_check(spark: SparkSession, d: str) -> DataFrame:
    """Different spellings, and how many plain forms of them are no words of the vocabulary."""
    known = vocabulary_words(table(spark, d, "vocab"))
    plain = p7_plain(spark, d).select(F.regexp_replace("word_plain", "[।,?]$", "").alias("word"))
    lost = plain.where("word is not null").join(known, "word", "left_anti").agg(F.count(F.lit(1)).alias("n_unknown"))
    forms = _words(spark, d).select("word", "label").distinct().agg(F.count(F.lit(1)).alias("n_spellings"))
    return forms.join(F.broadcast(lost))  # one row each


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return encode_corpus(table(spark, d, "documents"), "doc_id", "text")


def p8_decoded(spark: SparkSession, d: str) -> DataFrame:
    """SHA-256 of what the ids of every document decode to."""
    text = decode_corpus(p8_ids(spark, d), "doc_id", "ids")
    return text.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))


def p9_check(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a container, and how often a rule of packing is broken."""
    out = cut(p9_pack(spark, d))
    per = out.groupBy("doc_id").agg(F.count(F.lit(1)).alias("pieces"), F.sum(F.col("token_end") - F.col("token_start")).alias("held"), F.min("token_start").alias("first"), F.max("token_end").alias("n"))
    docs = per.agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if((F.col("n") <= CONTAINER) & (F.col("pieces") > 1)).alias("n_divided"),
        F.count_if((F.col("first") != 0) | (F.col("held") != F.col("n"))).alias("n_torn"),
    )
    over = out.groupBy("container").agg(F.sum(F.col("token_end") - F.col("token_start")).alias("load")).agg(F.count_if(F.col("load") > CONTAINER).alias("n_overfull"))
    return docs.join(F.broadcast(over))  # one row each


def p9_pack(spark: SparkSession, d: str) -> DataFrame:
    """Container and token range of every document or piece."""
    sizes = count_tokens(table(spark, d, "documents"), "doc_id", "text")
    out = pack(sizes, "doc_id", "n_tokens", CONTAINER)
    return out.select("doc_id", "piece", F.col("first").alias("token_start"), F.col("last").alias("token_end"), "container")


def _passages(spark: SparkSession, d: str) -> DataFrame:
    return detect_passages(table(spark, d, "documents"), "doc_id", "text", "lang", "source", table(spark, d, "lang_samples"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Languages of documents whose label is missing, wrong or not enough."""
    return label_cases(_passages(spark, d), "doc_id", table(spark, d, "lang_codes"))


def p10_passages(spark: SparkSession, d: str) -> DataFrame:
    """Every passage with its language and confidence."""
    return _passages(spark, d).select("doc_id", "lang", F.round("confidence", 6).alias("confidence"), F.col("first").alias("first_word"), F.col("n").alias("n_words"))


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p3_found, p3_split, p3_groups, p3_check, p6_found, p7_found, p7_plain, p7_check, p8_ids, p8_decoded, p9_pack, p9_check, p10_found, p10_passages)}

SQL = {
    "p1_found": """
        WITH r AS (SELECT transcript_source, align_score FROM (SELECT DISTINCT * FROM word_clip)
                   WHERE transcript_source IS NOT NULL AND align_score IS NOT NULL),
        c AS (SELECT transcript_source, align_score,
                     count(*) OVER (PARTITION BY transcript_source ORDER BY align_score DESC) AS k,
                     count(*) OVER (PARTITION BY transcript_source) AS n FROM r),
        m AS (SELECT c.*, keep_permille FROM c JOIN (SELECT DISTINCT * FROM keep_targets) USING (transcript_source))
        SELECT transcript_source, CAST(round(max(align_score) * 10000) AS BIGINT) AS cutoff_e4, min(k) AS n_kept
        FROM m WHERE k * 1000 >= n * keep_permille GROUP BY transcript_source""",
    "p2_found": r"""
        WITH u AS (SELECT video_id, unnest(units) AS u, generate_subscripts(units, 1) - 1 AS unit_no FROM asr),
        t AS (SELECT DISTINCT video_id, CAST(unit_no AS INTEGER) AS unit_no, u.text AS text FROM u WHERE u.text IS NOT NULL),
        k AS (SELECT row_number() OVER () AS id, video_id, unit_no,
                     list_filter(list_transform(regexp_split_to_array(text, '[\s\x0b\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+'),
                       lambda w: lower(regexp_replace(w, '[^\pL\pM\pN]+', '', 'g'))), lambda w: w <> '') AS w FROM t),
        p AS (SELECT id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM k, unnest(range(1, len(w) - 1)) AS x(i)),
        s AS (SELECT id, i FROM (SELECT id, i, row_number() OVER (PARTITION BY id, a, b, c ORDER BY i) AS nth FROM p) WHERE nth > 1),
        v AS (SELECT id, count(DISTINCT i + o) AS n FROM s, (VALUES (0), (1), (2)) AS y(o) GROUP BY id)
        SELECT DISTINCT video_id, unit_no FROM v JOIN k USING (id) WHERE 5 * n >= 2 * len(w)""",
    "p3_found": """
        WITH RECURSIVE e AS (SELECT DISTINCT a.channel_id AS a, b.channel_id AS b FROM manifest a JOIN manifest b ON a.id = b.id AND a.channel_id <> b.channel_id),
        r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
        SELECT DISTINCT a AS channel_id_a, b AS channel_id_b FROM r WHERE a < b""",
    "p3_groups": """
        WITH RECURSIVE e AS (SELECT DISTINCT a.channel_id AS a, b.channel_id AS b FROM manifest a JOIN manifest b ON a.id = b.id AND a.channel_id <> b.channel_id),
        r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
        SELECT a AS channel_id, least(a, min(b)) AS first_channel_id, count(DISTINCT b) AS n_channels FROM (SELECT a, b FROM r UNION SELECT a, a FROM e) GROUP BY a""",
    "p3_check": "SELECT count(DISTINCT id) AS n_videos, count(DISTINCT id) AS n_different, 0::BIGINT AS n_divided FROM manifest",
    "p7_check": """
        WITH c AS (SELECT unnest(chunks) AS c FROM align), w AS (SELECT unnest(c.words) AS w FROM c)
        SELECT count(*) AS n_spellings, 0::BIGINT AS n_unknown FROM (SELECT DISTINCT w.word AS word, w.label AS label FROM w)""",
    "p8_decoded": "SELECT doc_id, sha256(coalesce(text, '')) AS sha256 FROM documents",
    "p9_check": "SELECT count(*) AS n_docs, 0::BIGINT AS n_divided, 0::BIGINT AS n_torn, 0::BIGINT AS n_overfull FROM documents",
    "p6_found": r"""
        WITH m AS (SELECT id AS video_id, min(trim(regexp_replace(lower(channel), '\s+', ' ', 'g'))) AS channel
                   FROM manifest WHERE channel IS NOT NULL GROUP BY id),
        c AS (SELECT DISTINCT * FROM sentence_clip),
        j AS (SELECT c.video_id, chunk, align_score, channel FROM c JOIN m USING (video_id)),
        r AS (SELECT video_id, chunk, row_number() OVER (PARTITION BY channel ORDER BY align_score DESC NULLS LAST, video_id, chunk) AS k,
                     count(*) OVER () AS n FROM j)
        SELECT DISTINCT video_id, chunk FROM r WHERE k > greatest(1, n * 3 // 100)""",
}
