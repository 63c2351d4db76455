"""Reports for people: small tables as HTML, and the browse page of clips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import html_escape

_PAGE = "<!doctype html><meta charset='utf-8'><title>{title}</title><h1>{title}</h1>\n{body}\n"


def _text(c: Column) -> Column:
    return html_escape(F.coalesce(c.cast("string"), F.lit("")))


def html_table(df: DataFrame, title: str) -> str:
    """All rows as a page, fetched partition by partition; cells are escaped by Spark.

    A page is for reading: larger results belong in a table.
    """
    cells = F.concat(*[F.concat(F.lit("<td>"), _text(F.col(c)), F.lit("</td>")) for c in df.columns])
    lines = [r[0] for r in df.select(F.concat(F.lit("<tr>"), cells, F.lit("</tr>"))).toLocalIterator()]
    head = "".join(f"<th>{c}</th>" for c in df.columns)
    return _PAGE.format(title=title, body="<table><tr>" + head + "</tr>\n" + "\n".join(lines) + "</table>")


def clip_browser(clips: DataFrame, words: int = 40, per_word: int = 6, low: float = -1.0) -> str:
    """Page of the commonest words with their best clips; low scores are marked.

    ``clips`` has word, video_id, frame_start, align_score.  At most
    ``words * per_word`` rows reach the driver.
    """
    count = clips.groupBy("word").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "word").limit(words)
    nth = F.row_number().over(Window.partitionBy("word").orderBy(F.col("align_score").desc_nulls_last(), "video_id", "frame_start"))
    top = clips.join(count, "word").withColumn("_k", nth).where(F.col("_k") <= per_word)
    path = F.concat_ws("/", _text(F.col("word")), F.concat_ws("_", _text(F.col("video_id")), F.lpad(F.col("frame_start").cast("string"), 6, "0")))
    kind = F.when(F.col("align_score") < low, "low").otherwise("ok")
    tag = F.concat(F.lit("<video class='"), kind, F.lit("' controls src='"), path, F.lit(".mp4'></video>"))
    body, last = [], None
    for r in top.select("_n", "word", "_k", _text(F.col("word")).alias("shown"), tag.alias("tag")).orderBy(F.desc("_n"), "word", "_k").collect():
        if r["word"] != last:
            body.append(f"<h2>{r['shown']} ({r['_n']})</h2>")
            last = r["word"]
        body.append(r["tag"])
    return _PAGE.format(title="Clips", body="\n".join(body))


def run_summary(rows: DataFrame, kind: str, reason: str = "reason") -> DataFrame:
    """One row: kind, videos, candidates, written, rejected by reason as a map."""
    by = rows.groupBy(reason).agg(F.count(F.lit(1)).alias("n"))
    counts = by.agg(
        F.sum("n").alias("candidates"), F.coalesce(F.sum(F.when(F.col(reason) == "ok", F.col("n"))), F.lit(0)).alias("written"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col(reason) != "ok", F.struct(reason, "n"))))).alias("rejected"),
    )
    return counts.join(rows.agg(F.countDistinct("video_id").alias("videos"))).select(F.lit(kind).alias("kind"), "videos", "candidates", "written", "rejected")
