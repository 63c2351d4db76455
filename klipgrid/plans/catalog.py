"""All queries of the corpus operators, with their SQL."""

from __future__ import annotations

from . import clips, faces, ingest, reports, sentences, transcripts

_PARTS = (ingest, transcripts, faces, sentences, clips, reports)
QUERIES = {k: f for m in _PARTS for k, f in m.QUERIES.items()}
SQL = {k: q for m in _PARTS for k, q in m.SQL.items()}
clip_funnel = faces.clip_funnel
