"""Explicit schemas; no reader infers types from data."""

from __future__ import annotations

TURN = "struct<from:string,value:string>"
AVQA = (
    "video_id string, question_id string, type array<string>, video_path string, audio_path string, "
    "question string, answer string, label string"
)
AVE = "event string, vid string, start_time bigint, end_time bigint"
IMAGE_CAPTION = f"image string, conversations array<{TURN}>"
VIDEO_CAPTION = f"video string, conversations array<{TURN}>"
AUDIO_CAPTION = "audiocap_id string, youtube_id string, start_time double, caption string"
CHOICE = (
    "answer string, choice_a string, choice_b string, choice_c string, choice_d string, data_id string, question string"
)
CHOICE_FILE = f"questions array<struct<{CHOICE.replace(' string', ':string')}>>"
INSTRUCT = IMAGE_CAPTION
AV_PREDICTION = (
    "instruction string, output string, question_type array<string>, vid string, qid string, image_path string, "
    "video_path string, audio_path string, predict string"
)
IMAGE_PREDICTION = (
    "rank bigint, index bigint, subtask string, image_path string, question string, answer string, output array<string>"
)
SAMPLE = (
    "task string, sample_id string, vid string, qid string, subtask string, question_type array<string>, "
    f"image_path string, video_path string, audio_path string, conversation array<{TURN}>, question string, "
    "instruction string, output string"
)
# Cell texts that count as missing in the tab-separated benchmark.
NA_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]
