"""Text functions: label forms, subtitle markup, templates, status messages."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Messages that mean throttling, tested first, and permanent failures.
RATE_LIMITED = ("Sign in to confirm you", "HTTP Error 429", "rate-limited", "This content isn't available, try again later")
PERMANENT = (
    "Private video", "Video unavailable", "members-only", "Join this channel", "This live event", "Premieres in", "age-restricted", "Sign in to confirm your age",
)


def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


#: Unicode NFC; Spark has no such function, so one Arrow batch at a time.  Declared
#: nondeterministic only so that a filter on its result doesn't run it twice.
nfc = F.pandas_udf(_nfc, StringType()).asNondeterministic()


def bn_normalize(c: Column, is_nfc: bool = False) -> Column:
    """Label form: NFC, then no zero-width characters, then the Bengali block only.

    The order matters: a joiner between two parts of a vowel sign stops NFC from
    joining them, and stays out afterwards.
    """
    c = c if is_nfc else nfc(c)
    c = F.regexp_replace(c, r"[\x{200B}\x{200C}\x{200D}\x{FEFF}]", "")
    return F.regexp_replace(c, r"[^\x{0980}-\x{09FF}]", "")


def has_digits(c: Column) -> Column:
    """ASCII or Bengali digits in the raw word."""
    return c.rlike(r"[\x{09E6}-\x{09EF}0-9]")


def status_of(message: Column, limited: tuple[str, ...] = RATE_LIMITED, permanent: tuple[str, ...] = PERMANENT) -> Column:
    """Status of an error message: the first list with a marker in it wins."""
    m = F.coalesce(message, F.lit(""))
    hit = lambda marks: F.greatest(*[m.contains(x) for x in marks], F.lit(False))
    return F.when(hit(limited), "rate_limited").when(hit(permanent), "unavailable").otherwise("error")


def clipped(c: Column, most: int = 500) -> Column:
    """A message as a log keeps it: its first ``most`` characters (500 of a fetch, 300 of a section)."""
    return F.substring(c, 1, most)


def strip_tags(c: Column) -> Column:
    """Without <...> tags, trimmed."""
    return F.trim(F.regexp_replace(c, "<[^>]+>", ""))


def clock_seconds(c: Column) -> Column:
    """Seconds of HH:MM:SS.frac, where frac counts thousandths whatever its length."""
    part = lambda i: F.regexp_extract(c, r"(\d+):(\d\d):(\d\d)\.(\d+)", i)
    whole = part(1).try_cast("double") * 3600 + part(2).try_cast("double") * 60 + part(3).try_cast("double")
    return whole + part(4).try_cast("double") / 1000


def label_part(c: Column, i: int) -> Column:
    """Part ``i`` of 'a | b | c', trimmed; '' where there is none."""
    return F.trim(F.coalesce(F.try_element_at(F.split(F.coalesce(c, F.lit("")), r"\|"), F.lit(i + 1)), F.lit("")))


def missing_if_empty(c: Column) -> Column:
    """Null for the empty string."""
    return F.nullif(c, F.lit(""))


def licence(c: Column) -> Column:
    """The licence, or the site's standard one."""
    return F.coalesce(missing_if_empty(c), F.lit("Standard YouTube License"))


def is_language(c: Column, code: str) -> Column:
    """``code`` itself or one of its regional forms."""
    return (c == code) | c.startswith(f"{code}-")


def html_escape(c: Column) -> Column:
    """&, <, > and both quotes as entities."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def watch_url(c: Column) -> Column:
    """The page of a video id."""
    return F.concat(F.lit("https://www.youtube.com/watch?v="), c)


def clip_path(word: Column, video: Column, frame: Column) -> Column:
    """word/video_frame, the frame with six digits."""
    return F.concat(word, F.lit("/"), video, F.lit("_"), F.lpad(frame.cast("string"), 6, "0"))


def sentence_text(text: Column, score: Column, words: Column) -> Column:
    """Text file of a sentence: transcript, score, and one line per word."""
    lines = F.transform(words, lambda w: F.format_string("%s %.2f %.2f %.3f", w.word, w.start, w.end, w.score))
    return F.concat_ws("\n", F.concat(F.lit("Text:  "), text), F.concat(F.lit("Conf:  "), score), F.lit(""), F.lit("WORD START END SCORE"), F.array_join(lines, "\n"), F.lit(""))
