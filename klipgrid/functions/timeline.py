"""Seconds, frames and samples on the shared grid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import Fetch, Grid, Screening

GRID = Grid()


def half_up(c: Column, digits: int) -> Column:
    """Rounded half up by plain arithmetic, which every engine does alike."""
    return F.floor(c * 10**digits + 0.5) / 10**digits


def frame_of(t: Column, offset: Column | float = 0.0, grid: Grid = GRID) -> Column:
    """Frame number (with fraction) of a time in seconds."""
    return (t - offset) * grid.fps


def time_of(frame: Column, offset: Column | float = 0.0, grid: Grid = GRID) -> Column:
    """Time in seconds of a frame."""
    return frame / F.lit(grid.fps) + offset


def word_window(start: Column, end: Column, offset: Column | float = 0.0, grid: Grid = GRID) -> Column:
    """First frame of the window whose middle frame is the word's middle, half to even."""
    return (F.rint(frame_of((start + end) / 2, offset, grid)) - grid.middle).cast("int")


def word_frames(start: Column, end: Column, i0: Column, offset: Column | float = 0.0, grid: Grid = GRID) -> tuple[Column, Column]:
    """First and last frame of the word in its window.

    A word between two frames falls back to the middle frame; only then are both
    clamped to the window.
    """
    a = F.ceil(frame_of(start, offset, grid) - 1e-6).cast("int") - i0
    b = F.floor(frame_of(end, offset, grid) + 1e-6).cast("int") - i0
    empty = b < a
    a, b = F.when(empty, grid.middle).otherwise(a), F.when(empty, grid.middle).otherwise(b)
    clamp = lambda c: F.greatest(F.lit(0), F.least(F.lit(grid.frames - 1), c))
    return clamp(a), clamp(b)


def sentence_window(start: Column, end: Column, n_frames: Column, offset: Column | float = 0.0, grid: Grid = GRID) -> tuple[Column, Column]:
    """Half-open frame range of a sentence; no tolerance, and the start isn't clamped."""
    i0 = F.ceil(frame_of(start, offset, grid)).cast("int")
    return i0, F.least(n_frames, F.floor(frame_of(end, offset, grid)).cast("int") + 1)


def sentence_word_frames(start: Column, end: Column, i0: Column, i1: Column, offset: Column | float = 0.0, grid: Grid = GRID) -> tuple[Column, Column]:
    """First and last frame of a word in its sentence [i0, i1): with tolerance, each held at one end only.

    A word shorter than a frame has an end before its start; there is no fallback.
    """
    a = F.ceil(frame_of(start, offset, grid) - 1e-6).cast("int") - i0
    b = F.floor(frame_of(end, offset, grid) + 1e-6).cast("int") - i0
    return F.greatest(F.lit(0), a), F.least(i1 - i0 - 1, b)


def padded_window(start: Column, end: Column, total: Column, pad: float = 0.25) -> tuple[Column, Column]:
    """Span handed to the aligner: padded, within the recording."""
    return F.greatest(F.lit(0.0), start - pad), F.least(total, end + pad)


def aligned_back(word: Column, start: Column) -> Column:
    """A word's times from its window, which began at ``start``, back on the recording, to the millisecond."""
    at = lambda t: F.floor((t + start) * 1000 + 0.5) / 1000
    return F.struct(word.word.alias("word"), word.label.alias("label"), at(word.start).alias("start"), at(word.end).alias("end"), word.score.alias("score"))


def section_start(duration: Column, p: Screening = Screening()) -> Column:
    """Start of the section sampled from a video; an unknown or zero length starts at 60."""
    d = F.coalesce(duration, F.lit(0.0))
    known = F.least(F.greatest(F.lit(60.0), d * 0.25), F.greatest(F.lit(0.0), d - p.section - 10))
    return F.when(d == 0, F.lit(60.0)).otherwise(known)


def audio_slice(i0: Column, n: Column, offset: Column | float = 0.0, grid: Grid = GRID) -> tuple[Column, Column]:
    """First sample (half to even) and number of samples of a frame range."""
    return F.rint(time_of(i0, offset, grid) * grid.sample_rate).cast("long"), n * F.lit(grid.sample_rate // grid.fps)


def backoff(hits: Column, p: Fetch = Fetch()) -> Column:
    """Seconds to wait after so many limits in a row."""
    return F.least(F.lit(float(p.backoff)) * F.pow(F.lit(2.0), hits - 1), F.lit(float(p.longest_wait)))


def section_status(got: Column, wanted: Column, p: Screening = Screening()) -> Column:
    """'truncated' below the complete share of what was asked for; null counts as 0."""
    return F.when(F.coalesce(got, F.lit(0.0)) < wanted * p.complete, "truncated").otherwise("ok")
