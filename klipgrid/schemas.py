"""Record types of the corpus as schemas in DDL, which needs no session."""

from __future__ import annotations

_WORD = "STRUCT<word STRING, label STRING, start DOUBLE, end DOUBLE, score DOUBLE>"
_FACE = "STRUCT<track INT, missing_frames INT, face_width_median DOUBLE, yaw_abs DOUBLE>"

MANIFEST = "id STRING, url STRING, title STRING, channel STRING, channel_id STRING, duration DOUBLE, source STRING, tag STRING"
DOWNLOAD_LOG = "id STRING, status STRING, error STRING, video STRING, t DOUBLE"
ASR = "video_id STRING, asr_model STRING, units ARRAY<STRUCT<start DOUBLE, end DOUBLE, text STRING, source STRING>>"
ALIGN = (
    f"video_id STRING, asr_model STRING, chunks ARRAY<STRUCT<start DOUBLE, end DOUBLE, text STRING, source STRING, score DOUBLE, words ARRAY<{_WORD}>>>"
)
DETECTION = (
    "video_id STRING, frame INT, ord INT, track INT, x0 FLOAT, y0 FLOAT, x1 FLOAT, y1 FLOAT, pitch FLOAT, yaw FLOAT, roll FLOAT, sharp FLOAT"
)
LANDMARKS = "video_id STRING, frame INT, track INT, lmk ARRAY<STRUCT<x FLOAT, y FLOAT>>"
FRAME = "video_id STRING, frame INT, shot_dist FLOAT"
VIDEO = (
    "video_id STRING, fps INT, n_frames INT, width INT, height INT, offset DOUBLE, n_detections BIGINT, cuts ARRAY<INT>, frames_with_face BIGINT, "
    "tracks MAP<INT, STRUCT<first INT, last INT, n BIGINT>>, model_sha256 STRING, seconds DOUBLE"
)
WORD_CLIP = (
    "word STRING, surface STRING, video_id STRING, fps INT, n_frames INT, size INT, frame_start INT, frame_end INT, clip_start DOUBLE, clip_end DOUBLE, "
    f"word_start DOUBLE, word_end DOUBLE, duration DOUBLE, start_frame INT, end_frame INT, align_score DOUBLE, chunk INT, index INT, transcript_source STRING, face {_FACE}"
)
SENTENCE_CLIP = (
    "video_id STRING, chunk INT, text STRING, transcript_source STRING, fps INT, size INT, frame_start INT, frame_end INT, clip_start DOUBLE, clip_end DOUBLE, "
    "align_score DOUBLE, words ARRAY<STRUCT<word STRING, label STRING, start DOUBLE, end DOUBLE, start_frame INT, end_frame INT, score DOUBLE>>"
)
REJECT = "video_id STRING, word STRING, chunk INT, frame_start INT, word_start DOUBLE, reason STRING, metrics MAP<STRING, DOUBLE>"
SUMMARY = "kind STRING, videos BIGINT, candidates BIGINT, written BIGINT, rejected MAP<STRING, BIGINT>, args MAP<STRING, STRING>"
SCREEN_PLAN = "id STRING, channel STRING, label STRING, source STRING, title STRING, duration DOUBLE"
SCREEN_LOG = "id STRING, status STRING, error STRING, got_s DOUBLE, section STRING, took_s DOUBLE, t DOUBLE"
SECTION_METRICS = (
    "id STRING, seconds DOUBLE, height INT, width INT, one_face DOUBLE, multi_face DOUBLE, no_face DOUBLE, valid_face DOUBLE, speech DOUBLE, usable DOUBLE, "
    "cuts_per_min DOUBLE, face_width_median_720p DOUBLE, yaw_abs_median DOUBLE, license STRING, language_tag STRING, title STRING, channel_reported STRING, uploader_id STRING"
)
WORD_COUNTS = "word STRING, count BIGINT, n_videos BIGINT"
CLIP_FRAME = "video_id STRING, frame INT, landmarks ARRAY<STRUCT<x FLOAT, y FLOAT>>, crop_box STRUCT<cx FLOAT, cy FLOAT, side FLOAT>, interpolated BOOLEAN"
