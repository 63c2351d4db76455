"""Queries of ingest: lists, eligibility, resume, status, rate limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.timeline import backoff, section_start, section_status
from ..operators import ingest as I
from ..operators.identity import distinct_rows
from ..operators.series import even_picks
from ..sources import table
from ..sources.text_files import parse_links, pick_subtitles, vocabulary_words

_ORDER = ["source", "url", "title", "channel", "channel_id", "duration", "tag"]


def _listed(spark: SparkSession, d: str) -> DataFrame:
    """The manifest as a listing: live states derived from the duration (no such column is given)."""
    m = distinct_rows(table(spark, d, "manifest"), *table(spark, d, "manifest").columns)
    mod = F.pmod(F.col("duration").cast("long"), F.lit(7))
    live = F.when(mod == 0, "is_live").when(mod == 1, "was_live").when(mod == 2, "none")
    return m.withColumn("live_status", live)


_LISTED = """listed AS (SELECT *, CASE CAST(duration AS BIGINT) % 7 WHEN 0 THEN 'is_live' WHEN 1 THEN 'was_live' WHEN 2 THEN 'none' END AS live_status
    FROM (SELECT DISTINCT * FROM manifest))"""
_RULE = "coalesce(live_status, '') NOT IN ('is_live', 'is_upcoming', 'post_live') AND (duration IS NULL OR duration BETWEEN 60 AND 10800) AND NOT contains(coalesce(url, ''), '/shorts/')"
_FIRST = "ORDER BY source NULLS FIRST, url NULLS FIRST, title NULLS FIRST, channel NULLS FIRST, channel_id NULLS FIRST, duration NULLS FIRST, tag NULLS FIRST"


def _rule() -> F.Column:
    return I.eligible(F.col("duration"), F.col("live_status"), F.col("url"))


def links_parse(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "manifest")
    line = F.concat(F.col("source"), F.lit("  # "), F.coalesce("channel", F.lit("")), F.lit(" | "), F.coalesce("tag", F.lit("-")))
    rows = parse_links(m.select(line.alias("value")).unionAll(m.select(F.concat(F.lit("# "), F.col("id")).alias("value"))))
    name = F.coalesce(X.missing_if_empty(X.label_part(F.col("label"), 0)), F.col("url"))
    return rows.select("url", name.alias("name"), X.label_part(F.col("label"), 1).alias("kind"), X.label_part(F.col("label"), 2).alias("region")).distinct()


def manifest_eligible(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "download_log").where("status = 'unavailable'").select("id").distinct()
    new = I.insert_new(_listed(spark, d).where(_rule()), known, "id", [F.col(c).asc_nulls_first() for c in _ORDER])
    channel = F.coalesce(X.missing_if_empty(F.col("channel")), X.missing_if_empty(F.col("channel_id")), F.lit("?"))
    return new.select("id", X.watch_url(F.col("id")).alias("watch"), channel.alias("channel"), "duration", "source")


def ingest_counters(spark: SparkSession, d: str) -> DataFrame:
    return _listed(spark, d).agg(
        F.count(F.lit(1)).alias("listed"), F.count_if(_rule()).alias("eligible"), F.count_if(~_rule()).alias("skipped"), F.countDistinct(F.when(_rule(), F.col("id"))).alias("added")
    )


def screen_eligible(spark: SparkSession, d: str) -> DataFrame:
    ok = I.screenable(F.col("duration"), F.col("live_status"), F.col("url"))
    return _listed(spark, d).where(ok).select("id", "channel_id", "duration").distinct()


def listing_flatten(spark: SparkSession, d: str) -> DataFrame:
    r, n, c = table(spark, d, "region"), table(spark, d, "nation"), table(spark, d, "customer")
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    edges = n.select(key("r", "n_regionkey").alias("parent"), key("n", "n_nationkey").alias("child")).unionAll(
        c.select(key("n", "c_nationkey").alias("parent"), key("c", "c_custkey").alias("child"))
    )
    return I.flatten_listing(edges, r.select(key("r", "r_regionkey").alias("root")))


def status_classify(spark: SparkSession, d: str) -> DataFrame:
    """Status of each error; the message is kept to 500 characters, as the log of fetch does."""
    said = table(spark, d, "download_log").select("seq", "error")
    # the markers themselves, so that each branch is met
    marks = [*X.RATE_LIMITED, *X.PERMANENT, "something else"]
    pick = F.element_at(F.array(*[F.lit(m) for m in marks]), (F.pmod("seq", F.lit(len(marks))) + 1).cast("int"))
    text = F.concat(F.coalesce("error", F.lit("")), F.lit(" / "), pick)
    return said.select("seq", X.status_of(text).alias("status"), X.status_of(F.col("error")).alias("plain_status"), X.clipped(text).alias("message"))


def _known(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "manifest").where("id is not null").select("id", "tag").distinct()


def resume_any_ok(spark: SparkSession, d: str) -> DataFrame:
    return I.pending(_known(spark, d), table(spark, d, "download_log"), "id")


def work_list(spark: SparkSession, d: str, max_videos: int = 0, tag: str | None = None) -> DataFrame:
    """Videos that still have to be fetched, in order; as for the command, 0 is all and no tag is any."""
    todo = resume_any_ok(spark, d)
    todo = (todo if tag is None else todo.where(F.col("tag") == tag)).orderBy("id", "tag")
    return todo.limit(max_videos) if max_videos > 0 else todo


def resume_latest(spark: SparkSession, d: str) -> DataFrame:
    return I.pending_by_latest(_known(spark, d), table(spark, d, "download_log"), "id", "seq")


def latest_status(spark: SparkSession, d: str) -> DataFrame:
    return I.latest_status(table(spark, d, "download_log"), "id", "seq")


def resume_missing_output(spark: SparkSession, d: str) -> DataFrame:
    """Units of transcripts whose position has no aligned chunk yet."""
    units = table(spark, d, "asr").select("video_id", F.posexplode("units").alias("chunk", "u")).select("video_id", "chunk").distinct()
    done = table(spark, d, "align").select("video_id", F.posexplode("chunks").alias("chunk", "c")).select("video_id", "chunk")
    return units.join(done, ["video_id", "chunk"], "left_anti")


def semi_ready(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "align").select("video_id").distinct().join(table(spark, d, "word_clip").select("video_id"), "video_id", "left_semi")


def ready_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "align").select("video_id").intersect(table(spark, d, "sentence_clip").select("video_id"))


def difference_ids(spark: SparkSession, d: str) -> DataFrame:
    """Videos with word clips that the manifest does not list."""
    return table(spark, d, "word_clip").select("video_id").subtract(table(spark, d, "manifest").select(F.col("id").alias("video_id")))


def left_metrics_plan(spark: SparkSession, d: str) -> DataFrame:
    per = distinct_rows(table(spark, d, "sentence_clip"), "video_id").groupBy("video_id").agg(F.count(F.lit(1)).alias("n_clips"))
    plan = table(spark, d, "manifest").where("id is not null").groupBy(F.col("id").alias("video_id")).agg(F.min("channel").alias("channel"), F.min("tag").alias("label"))
    return per.join(plan, "video_id", "left").select("video_id", "n_clips", F.coalesce("channel", F.lit("?")).alias("channel"), F.coalesce("label", F.lit("")).alias("label"))


def rate_window(spark: SparkSession, d: str) -> DataFrame:
    ok = table(spark, d, "download_log").where("status = 'ok' and t is not null").select("seq", F.floor("t").alias("sec"))
    out = I.rolling_count_in_buckets(ok, "sec", 3600)
    return out.select("seq", "in_window", (F.col("in_window") >= 150).alias("must_wait"))


def backoff_sequence(spark: SparkSession, d: str) -> DataFrame:
    # blocks of 100 lines, so that no window holds the whole log
    log = table(spark, d, "download_log")
    out = I.limit_streaks_in_blocks(log, F.floor(F.col("seq") / 100), "seq", F.col("status") == "ok", F.col("status") == "rate_limited")
    return out.where("status = 'rate_limited'").select("seq", "hits", backoff(F.col("hits")).alias("wait_s"))


def section_bounds(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "manifest").select("id", "duration").distinct()
    return m.select("id", "duration", section_start(F.col("duration")).alias("start_s"), (section_start(F.col("duration")) + 120).alias("end_s"))


def section_states(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    text = F.when(F.col("event_id") % 10 == 0, "N/A").otherwise(F.col("value").cast("string"))
    got = F.coalesce(text.try_cast("double"), F.lit(0.0))
    return e.select("event_id", section_status(got, F.lit(60.0)).alias("status"), (F.col("value") > 300).alias("throttled"))


def planned_picks(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "manifest").where("channel_id is not null and id is not null").select("channel_id", "id").distinct()
    return even_picks(m, "channel_id", [F.col("id")], 3)


def screen_plan(spark: SparkSession, d: str) -> DataFrame:
    """Videos to sample of each source, but for those that the log has seen."""
    m = _listed(spark, d).select("source", "id", "duration", "live_status", "url").distinct()
    ok = I.screenable(F.col("duration"), F.col("live_status"), F.col("url"))
    order = [F.col("id"), F.col("duration").asc_nulls_first(), F.col("url").asc_nulls_first()]
    return I.screen_picks(m, table(spark, d, "download_log").select("id").where("status = 'ok'"), ok, "source", order, 3).select("source", "id")


def newest_per_link(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "manifest").where("id is not null").select("source", "id").distinct()
    return I.newest(m, "source", [F.col("id").desc()], 50).select("source", "id", F.col("nth").cast("long").alias("nth"))


def subtitle_pick(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("video_id is not null and lang is not null")
    per = docs.groupBy("video_id").agg(
        F.array_sort(F.collect_set("lang")).alias("listed"), F.collect_set(F.when(F.col("kind") == "subtitle", F.col("lang"))).alias("present")
    )
    return per.select("video_id", pick_subtitles(F.col("listed"), F.col("present")).alias("track"))


def vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return vocabulary_words(table(spark, d, "vocab"))


def record_templates(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "word_clip").where("frame_start is not null").select("word", "video_id", "frame_start").distinct()
    return c.select(X.clip_path(F.col("word"), F.col("video_id"), F.col("frame_start")).alias("path"), X.watch_url(F.col("video_id")).alias("url"))


def content_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        links_parse, manifest_eligible, ingest_counters, screen_eligible, listing_flatten, status_classify, resume_any_ok, work_list, resume_latest, latest_status,
        resume_missing_output, semi_ready, ready_ids, difference_ids, left_metrics_plan, rate_window, backoff_sequence, section_bounds, section_states,
        planned_picks, screen_plan, newest_per_link, subtitle_pick, vocabulary, record_templates, content_fingerprint,
    )
}

_STATUS = """CASE WHEN contains({0}, 'Sign in to confirm you') OR contains({0}, 'HTTP Error 429') OR contains({0}, 'rate-limited')
    OR contains({0}, 'This content isn''t available, try again later') THEN 'rate_limited'
    WHEN contains({0}, 'Private video') OR contains({0}, 'Video unavailable') OR contains({0}, 'members-only') OR contains({0}, 'Join this channel') OR contains({0}, 'This live event')
    OR contains({0}, 'Premieres in') OR contains({0}, 'age-restricted') OR contains({0}, 'Sign in to confirm your age') THEN 'unavailable' ELSE 'error' END"""
_MARKS = ", ".join("'" + m.replace("'", "''") + "'" for m in [*X.RATE_LIMITED, *X.PERMANENT, "something else"])

SQL = {
    "links_parse": """
        WITH l AS (SELECT source || '  # ' || coalesce(channel, '') || ' | ' || coalesce(tag, '-') AS v FROM manifest UNION ALL SELECT '# ' || id FROM manifest),
        p AS (SELECT trim(split_part(v, '#', 1)) AS url, trim(substr(v, strpos(v, '#') + 1)) AS label FROM l WHERE trim(v) <> '' AND NOT starts_with(trim(v), '#'))
        SELECT DISTINCT url, coalesce(nullif(trim(split_part(label, '|', 1)), ''), url) AS name, trim(split_part(label, '|', 2)) AS kind, trim(split_part(label, '|', 3)) AS region
        FROM p WHERE url <> ''""",
    "manifest_eligible": f"""
        WITH {_LISTED}, n AS (SELECT *, row_number() OVER (PARTITION BY id {_FIRST}) AS k FROM listed
            WHERE {_RULE} AND id IS NOT NULL AND id NOT IN (SELECT id FROM download_log WHERE status = 'unavailable' AND id IS NOT NULL))
        SELECT id, 'https://www.youtube.com/watch?v=' || id AS watch, coalesce(nullif(channel, ''), nullif(channel_id, ''), '?') AS channel, duration, source FROM n WHERE k = 1""",
    "ingest_counters": f"""
        WITH {_LISTED} SELECT count(*) AS listed, count(*) FILTER (WHERE {_RULE}) AS eligible, count(*) FILTER (WHERE NOT ({_RULE})) AS skipped,
            count(DISTINCT id) FILTER (WHERE {_RULE}) AS added FROM listed""",
    "screen_eligible": f"""
        WITH {_LISTED} SELECT DISTINCT id, channel_id, duration FROM listed WHERE coalesce(live_status, '') NOT IN ('is_live', 'is_upcoming', 'post_live', 'was_live')
            AND coalesce(duration, 0) BETWEEN 300 AND 10800 AND NOT contains(coalesce(url, ''), '/shorts/')""",
    "listing_flatten": """
        WITH RECURSIVE e AS (SELECT 'r' || n_regionkey AS p, 'n' || n_nationkey AS c FROM nation UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer),
        t AS (SELECT 'r' || r_regionkey AS root, 'r' || r_regionkey AS node FROM region UNION ALL SELECT t.root, e.c FROM t JOIN e ON t.node = e.p)
        SELECT DISTINCT root, node AS leaf FROM t WHERE node NOT IN (SELECT p FROM e)""",
    "status_classify": f"""
        WITH m AS (SELECT seq, error, coalesce(error, '') || ' / ' || list_extract([{_MARKS}], CAST(seq % 13 + 1 AS INTEGER)) AS t FROM download_log)
        SELECT seq, {_STATUS.format("t")} AS status, {_STATUS.format("coalesce(error, '')")} AS plain_status, substr(t, 1, 500) AS message FROM m""",
    "resume_any_ok": """
        SELECT DISTINCT id, tag FROM manifest m WHERE id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM download_log l WHERE l.id = m.id AND status IN ('ok', 'unavailable'))""",
    "work_list": """
        SELECT DISTINCT id, tag FROM manifest m WHERE id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM download_log l WHERE l.id = m.id AND status IN ('ok', 'unavailable')) ORDER BY id, tag""",
    "resume_latest": """
        WITH s AS (SELECT id, arg_max(status, seq) AS st FROM download_log GROUP BY id)
        SELECT DISTINCT id, tag FROM manifest m WHERE id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM s WHERE s.id = m.id AND st IN ('ok', 'unavailable'))""",
    "latest_status": "SELECT id, arg_max(status, seq) AS status FROM download_log GROUP BY id",
    "resume_missing_output": """
        WITH u AS (SELECT DISTINCT video_id, unnest(range(len(units))) AS chunk FROM asr), a AS (SELECT DISTINCT video_id, unnest(range(len(chunks))) AS chunk FROM align)
        SELECT video_id, chunk FROM u WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.video_id = u.video_id AND a.chunk = u.chunk)""",
    "semi_ready": "SELECT DISTINCT video_id FROM align a WHERE EXISTS (SELECT 1 FROM word_clip s WHERE s.video_id = a.video_id)",
    "ready_ids": "SELECT video_id FROM align INTERSECT SELECT video_id FROM sentence_clip",
    "difference_ids": "SELECT video_id FROM word_clip EXCEPT SELECT id FROM manifest",
    "left_metrics_plan": """
        WITH c AS (SELECT video_id, count(*) AS n_clips FROM (SELECT DISTINCT * FROM sentence_clip) GROUP BY video_id),
        p AS (SELECT id, min(channel) AS channel, min(tag) AS tag FROM manifest WHERE id IS NOT NULL GROUP BY id)
        SELECT video_id, n_clips, coalesce(channel, '?') AS channel, coalesce(tag, '') AS label FROM c LEFT JOIN p ON c.video_id = p.id""",
    "rate_window": """
        WITH o AS (SELECT seq, CAST(floor(t) AS BIGINT) AS sec FROM download_log WHERE status = 'ok' AND t IS NOT NULL),
        w AS (SELECT seq, count(*) OVER (ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS in_window FROM o)
        SELECT seq, in_window, in_window >= 150 AS must_wait FROM w""",
    "backoff_sequence": """
        WITH g AS (SELECT *, sum(CASE WHEN status = 'ok' THEN 1 ELSE 0 END) OVER (ORDER BY seq) AS run FROM download_log),
        h AS (SELECT seq, status, sum(CASE WHEN status = 'rate_limited' THEN 1 ELSE 0 END) OVER (PARTITION BY run ORDER BY seq) AS hits FROM g)
        SELECT seq, CAST(hits AS BIGINT) AS hits, least(1800.0::DOUBLE * pow(2, hits - 1), 14400.0::DOUBLE) AS wait_s FROM h WHERE status = 'rate_limited'""",
    "section_bounds": """
        WITH s AS (SELECT DISTINCT id, duration FROM manifest),
        b AS (SELECT id, duration, CASE WHEN coalesce(duration, 0) = 0 THEN 60.0::DOUBLE ELSE least(greatest(60.0::DOUBLE, duration * 0.25::DOUBLE), greatest(0.0::DOUBLE, duration - 130)) END AS start_s FROM s)
        SELECT id, duration, start_s, start_s + 120 AS end_s FROM b""",
    "section_states": """
        SELECT event_id, CASE WHEN (CASE WHEN event_id % 10 = 0 THEN 0 ELSE coalesce(value, 0) END) < 60.0::DOUBLE * 0.8::DOUBLE THEN 'truncated' ELSE 'ok' END AS status, value > 300 AS throttled FROM events""",
    "planned_picks": """
        WITH m AS (SELECT DISTINCT channel_id, id FROM manifest WHERE channel_id IS NOT NULL AND id IS NOT NULL),
        r AS (SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY id) - 1 AS i, count(*) OVER (PARTITION BY channel_id) AS n FROM m)
        SELECT channel_id, id FROM r WHERE EXISTS (SELECT 1 FROM range(least(3, n)) AS g(j) WHERE round_even(j * ((n - 1) / greatest(1, least(3, n) - 1)), 0) = i)""",
    "screen_plan": f"""
        WITH {_LISTED}, m AS (SELECT DISTINCT source, id, duration, live_status, url FROM listed WHERE id IS NOT NULL),
        o AS (SELECT *, coalesce(live_status, '') NOT IN ('is_live', 'is_upcoming', 'post_live', 'was_live') AND coalesce(duration, 0) BETWEEN 300 AND 10800 AND NOT contains(coalesce(url, ''), '/shorts/') AS ok FROM m),
        s AS (SELECT *, count(*) OVER (PARTITION BY source) AS c, count(*) FILTER (WHERE ok) OVER (PARTITION BY source) AS k FROM o),
        r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY id, duration NULLS FIRST, url NULLS FIRST) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM s WHERE ok OR (c = 1 AND k = 0)),
        p AS (SELECT * FROM r WHERE EXISTS (SELECT 1 FROM range(least(3, n)) AS g(j) WHERE round_even(j * ((n - 1) / greatest(1, least(3, n) - 1)), 0) = i)),
        q AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY source NULLS FIRST, duration NULLS FIRST, url NULLS FIRST) AS nth FROM p WHERE NOT EXISTS (SELECT 1 FROM download_log l WHERE l.id = p.id AND l.status = 'ok'))
        SELECT source, id FROM q WHERE nth = 1""",
    "newest_per_link": """
        SELECT * FROM (SELECT source, id, row_number() OVER (PARTITION BY source ORDER BY id DESC) AS nth FROM (SELECT DISTINCT source, id FROM manifest WHERE id IS NOT NULL)) WHERE nth <= 50""",
    "subtitle_pick": """
        WITH p AS (SELECT video_id, list_sort(list(DISTINCT lang)) AS l, list(DISTINCT lang) FILTER (WHERE kind = 'subtitle') AS s
                   FROM documents WHERE video_id IS NOT NULL AND lang IS NOT NULL GROUP BY video_id)
        SELECT video_id, list_filter(l, lambda x: (x = 'bn' OR starts_with(x, 'bn-')) AND list_contains(coalesce(s, []), x))[1] AS track FROM p""",
    "vocabulary": r"SELECT DISTINCT trim(split_part(line, chr(9), 1)) AS word FROM vocab WHERE trim(split_part(line, chr(9), 1)) <> ''",
    "record_templates": """
        SELECT word || '/' || video_id || '_' || lpad(CAST(frame_start AS VARCHAR), 6, '0') AS path, 'https://www.youtube.com/watch?v=' || video_id AS url
        FROM (SELECT DISTINCT word, video_id, frame_start FROM word_clip WHERE frame_start IS NOT NULL)""",
    "content_fingerprint": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
}
