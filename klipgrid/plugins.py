"""What media tools and models must supply; the engine holds none of them.

Each is a function from an iterator of pandas frames to another (for
``mapInPandas``), given once per worker.  Results with an ``error`` column keep a
bad file from failing the job.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

SPEECH = "video_id string, start double, end double, error string"
TEXTS = "video_id string, chunk int, text string, error string"
WORDS = "video_id string, chunk int, words array<struct<word string, label string, start double, end double, score double>>, error string"
FACES = "video_id string, frame int, ord int, x0 float, y0 float, x1 float, y1 float, pitch float, yaw float, roll float, sharp float, error string"
SCORES = "video_id string, score double, error string"


class Stage(Protocol):
    """A model or decoder step."""

    def __call__(self, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]: ...


def run_stage(inputs: DataFrame, stage: Stage, schema: str) -> DataFrame:
    """Rows of ``stage`` over ``inputs``: voice activity, recognition, alignment, faces, speaker or language checks."""
    return inputs.mapInPandas(stage, schema)
