"""Thresholds of every stage; the defaults are those of the pipeline's commands."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Listing:
    """Which listed videos enter the manifest."""

    min_duration: float = 60.0
    max_duration: float = 10_800.0
    live: tuple[str, ...] = ("is_live", "is_upcoming", "post_live")
    per_link: int = 50


@dataclass(frozen=True)
class Screening:
    """Which videos are sampled to judge a channel, and what counts as usable."""

    min_duration: float = 300.0
    max_duration: float = 10_800.0
    live: tuple[str, ...] = ("is_live", "is_upcoming", "post_live", "was_live")
    per_channel: int = 3
    section: float = 120.0
    complete: float = 0.8
    min_face: float = 100.0
    max_yaw: float = 30.0
    max_pitch: float = 40.0


@dataclass(frozen=True)
class Words:
    """Which aligned words are candidates."""

    min_score: float = -1.0
    min_duration: float = 0.12
    max_duration: float = 1.0
    min_chars: int = 2


@dataclass(frozen=True)
class Vocabulary:
    """Which words are fit for a closed vocabulary; videos stand for speakers."""

    min_ms: float = 250.0
    max_ms: float = 900.0
    min_graphemes: int = 3
    min_videos: int = 20
    min_channels: int = 3
    size: int = 500


@dataclass(frozen=True)
class Grid:
    """The frame grid all stages share, and the word window on it."""

    fps: int = 25
    frames: int = 29
    middle: int = 14
    sample_rate: int = 16_000


@dataclass(frozen=True)
class Gate:
    """The face gate of a clip."""

    max_change: float = 0.25
    max_missing: int = 2
    min_other: int = 3
    allow_others: bool = False
    min_face: float = 100.0
    max_yaw: float = 30.0
    max_pitch: float = 40.0
    cap: int = 5
    pose: str = "max"  # or "p95"


@dataclass(frozen=True)
class Tracking:
    """The box tracker and the shot detector."""

    min_iou: float = 0.3
    max_gap: int = 2
    cut: float = 0.35


@dataclass(frozen=True)
class Fetch:
    """Rate limits of fetching."""

    per_hour: int = 150
    backoff: int = 1800
    longest_wait: int = 14_400
    max_seconds: float = 300.0
