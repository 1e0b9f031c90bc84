"""Schemas of the tables that the operators read and write."""

from __future__ import annotations

from pyspark.sql.types import StructType

VIDEOS = StructType.fromDDL("video_id string, path string, fps double")
FRAMES = StructType.fromDDL("video_id string, frame_idx int, pixels binary")
SCORES = StructType.fromDDL("video_id string, frame_idx int, p_single float, p_many float")
SHOTS = StructType.fromDDL("video_id string, shot_id int, start_idx int, end_idx int")
FEATURES = StructType.fromDDL("video_id string, shot_id int, frame_idx int, embedding array<float>")
KEYFRAMES = StructType.fromDDL("video_id string, frame_no int, frame_name string, shot_id int, k_in_shot int, frame_idx int, t_sec double, time_stamp string")
ENRICHMENT = StructType.fromDDL("video_id string, frame_name string, tags array<string>, ocr string, caption string")
MESSAGES = StructType.fromDDL("conv_id bigint, turn bigint, role string, content_text string, parts array<struct<type:string,text:string,image_url:string>>")
REQUESTS = StructType.fromDDL("request_id string, start_ts timestamp, end_ts timestamp, model string, has_images boolean, success boolean, error_type string")
KEY_EVENTS = StructType.fromDDL("provider string, token string, ts timestamp, event string")
AUDIO_SEGMENTS = StructType.fromDDL("media_id string, seg_idx int, dur_ms bigint, size_bytes bigint, dbfs double")
OCR = StructType.fromDDL("channel_name string, main_news_text string, thumbnail_text string, time string")
