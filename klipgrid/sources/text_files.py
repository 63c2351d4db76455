"""Line formats: JSON lines, link lists, subtitles, vocabularies, wave files."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import clock_seconds, is_language, strip_tags


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    hits = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return hits is not None and len(hits) > 0


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank lines are skipped, a missing file is an empty table."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    """JSON lines, one job per batch; null fields stay."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_tsv(df: DataFrame, path: str) -> None:
    """A small ordered report as one tab-separated file with a header."""
    df.coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", "true").csv(path)


def write_new(df: DataFrame, path: str, key: list[str], overwrite: bool = False) -> None:
    """Rows whose key is not in the table yet, or the whole table anew."""
    spark = df.sparkSession
    if overwrite or not _exists(spark, path):
        df.write.mode("overwrite").parquet(path)
    else:
        df.join(spark.read.parquet(path).select(*key), key, "left_anti").write.mode("append").parquet(path)


def replace_partitions(df: DataFrame, path: str, by: str) -> None:
    """Clean rewrite of only those partitions that ``df`` has rows for."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def parse_links(lines: DataFrame, line: str = "value") -> DataFrame:
    """(url, label): text before and after the first #; comment lines and blanks dropped."""
    text = F.trim(line)
    rows = lines.where((text != "") & ~text.startswith("#"))
    url = F.trim(F.substring_index(line, "#", 1))
    return rows.select(url.alias("url"), F.trim(F.regexp_extract(line, r"^[^#]*#(.*)$", 1)).alias("label")).where("url <> ''")


def parse_vtt(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(path, cue, start, end, text) of subtitle files, one file per row.

    Only HH:MM:SS.mmm stamps open a cue; a second stamp before a blank line drops
    the cue before it; the text ends at a blank line; tags are cut out.
    """
    body = F.concat(F.col(content), F.lit("\n\n"))
    lines = files.where(F.col(content).isNotNull()).select(path, F.posexplode(F.split(body, r"\r\n|\n|\r")).alias("no", "line"))
    stamp = r"(\d+:\d\d:\d\d\.\d+)\s+-->\s+(\d+:\d\d:\d\d\.\d+)"
    at = Window.partitionBy(path).orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    is_stamp, blank = F.col("line").rlike(stamp), F.trim("line") == ""
    lines = lines.withColumn("cue", F.sum(is_stamp.cast("int")).over(at)).where("cue > 0")
    inside = Window.partitionBy(path, "cue").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("ended", F.sum((blank & ~is_stamp).cast("int")).over(inside)).withColumn("stamp", is_stamp)
    parts = F.sort_array(F.collect_list(F.when((F.col("ended") == 0) & ~F.col("stamp"), F.struct("no", strip_tags(F.col("line")).alias("t")))))
    head = F.max(F.when(F.col("stamp"), F.col("line")))
    cues = lines.groupBy(path, "cue").agg(head.alias("head"), parts.alias("parts"), F.max("ended").alias("ended"))
    times = [clock_seconds(F.regexp_extract("head", stamp, i)) for i in (1, 2)]
    return cues.where((F.size("parts") > 0) & (F.col("ended") > 0)).select(
        path, "cue", times[0].alias("start"), times[1].alias("end"), F.array_join(F.col("parts.t"), " ").alias("text")
    )


def pick_subtitles(listed: Column, present: Column, code: str = "bn") -> Column:
    """First language of ``listed`` that is ``code`` or a form of it and whose file is there."""
    return F.try_element_at(F.filter(listed, lambda x: is_language(x, code) & F.array_contains(present, x)), F.lit(1))


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(word): first tab field of each line, trimmed, blanks dropped, each once."""
    return vocabulary_words(spark.read.text(path), "value")


def vocabulary_words(lines: DataFrame, line: str = "line") -> DataFrame:
    """(word) of vocabulary lines."""
    return lines.select(F.trim(F.substring_index(line, "\t", 1)).alias("word")).where("word <> ''").distinct()


def read_wave(spark: SparkSession, path: str, rate: int = 16_000) -> DataFrame:
    """(path, samples, error) of mono 16-bit wave files, samples / 32768; errors stay per file."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows = []
            for name, content in zip(p["path"], p["content"], strict=True):
                try:
                    with wave.open(io.BytesIO(content)) as w:
                        if w.getframerate() != rate or w.getsampwidth() != 2 or w.getnchannels() != 1:
                            raise ValueError(f"not {rate} Hz mono 16-bit")
                        rows.append((name, (np.frombuffer(w.readframes(w.getnframes()), "<i2") / 32768).astype(np.float32), None))
                except Exception as e:  # one bad file is a row, not a failed job
                    rows.append((name, None, repr(e)))
            yield pd.DataFrame(rows, columns=["path", "samples", "error"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, "path string, samples array<float>, error string")


def catalog_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, id): files of a folder by name, without reading them."""
    name = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    return spark.read.format("binaryFile").load(path).select("path", name.alias("id"))
