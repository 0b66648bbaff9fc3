"""Parameters with their fixed default values."""

from __future__ import annotations

from dataclasses import dataclass

#: File name endings of videos and of images.
VIDEO_SUFFIXES = (".avi", ".mp4", ".mkv", ".ts", ".mpg", ".mpeg", ".mov", ".flv", ".wmv", ".webm")
IMAGE_SUFFIXES = (".png", ".jpg", ".jpeg")
ZERO_TIME = "00:00:00"


@dataclass(frozen=True)
class Params:
    begin_time: str = ZERO_TIME
    end_time: str = ZERO_TIME
    scene_threshold: float = 0.20
    interlace_ratio: float = 0.25
    deinterlace_mode: str = "auto"
    # fixed values: the default filters
    deinterlace_filter: str = "bwdif=mode=send_frame:parity=auto"
    chroma_upsampling: bool = True
    chroma_filter: str = "scale=sws_flags=lanczos:in_color_matrix=bt709,format=yuv444p"
    hdr_tone_mapping: bool = False
    hdr_filter: str = "zscale=t=linear:npl=100,tonemap=tonemap=hable,zscale=p=bt709:t=bt709:m=bt709,format=bgr24"
    hdr_mode: str = "auto"
    attempt_content_fix: bool = True
    content_fix_threshold: float = 0.75
    aspect_tolerance: float = 0.05
    container_width: int = 1920
    crop_black: bool = True
    black_threshold: int = 15
    crop_white: bool = False
    white_threshold: int = 240
    white_mode: str = "reference"
    min_content_dimension: int = 300
    low_info_filter: bool = False
    variance_threshold: float = 100.0
    check_hr_variance: bool = False
    match_threshold: float = 0.65
    match_height: int = 540
    match_width: int = 955
    window_share: float = 0.06
    tracked_window: float = 5.0
    default_window: float = 10.0
    phash_threshold: int = 4
    align_scale: int = 2
    align_color_copy: bool = False
    align_timeout_hours: float = 12.0
    align_batch: int = 50
    show_warnings: bool = False
