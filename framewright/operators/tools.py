"""Command lines of the external probe and extractor, with their time limits, and the functions that run them."""

from __future__ import annotations

import os
import subprocess
from collections.abc import Callable

from ..params import ZERO_TIME, Params

#: Seconds that a tool may take.
DURATION_LIMIT, STREAMS_LIMIT, FIELDS_LIMIT, EXTRACT_LIMIT = 30, 10, 60, 7200
#: Seconds of a video that are looked at for interlacing.
FIELDS_SECONDS = 10


def duration_command(tool: str, path: str) -> list[str]:
    return [tool, "-v", "error", "-show_entries", "format=duration", "-of", "default=noprint_wrappers=1:nokey=1", path]


def streams_command(tool: str, path: str) -> list[str]:
    return [tool, "-v", "error", "-select_streams", "v:0", "-show_entries", "stream=color_transfer,color_primaries,side_data_list", "-of", "json", path]


def fields_command(tool: str, path: str, seconds: int = FIELDS_SECONDS) -> list[str]:
    return [tool, "-hide_banner", "-i", path, "-t", str(seconds), "-map", "0:v:0?", "-filter:v", "idet", "-an", "-sn", "-dn", "-threads", "1", "-nostats", "-f", "null", "-"]


def extract_command(tool: str, path: str, folder: str, chain: str, p: Params = Params()) -> list[str]:
    """A frame a chosen scene, at the highest quality, with a log of their times; a range of time only where one is set."""
    part = []
    if p.begin_time != ZERO_TIME or p.end_time != ZERO_TIME:
        part = ["-ss", p.begin_time, *(["-to", p.end_time] if p.end_time != ZERO_TIME else [])]
    return [tool, "-i", path, *part, "-vf", chain, "-vsync", "vfr", "-q:v", "2", f"{folder}/frame_%06d.png", "-hide_banner", "-loglevel", "info", "-nostats"]


def said(cmd: list[str], limit: float, must_end_well: bool = True) -> tuple[str, str] | None:
    """(standard output, error output) of a tool; None if it can't be run, takes longer than ``limit`` or fails."""
    try:
        got = subprocess.run(cmd, capture_output=True, text=True, errors="replace", timeout=limit)
    except (OSError, subprocess.TimeoutExpired):
        return None
    return None if must_end_well and got.returncode else (got.stdout, got.stderr)


def prober(probe_tool: str, extract_tool: str, p: Params = Params()) -> Callable[[str], tuple]:
    """For ``sources.media.probe``: asks only what the parameters need to know."""

    def run(path: str):
        duration = said(duration_command(probe_tool, path), DURATION_LIMIT)
        streams = said(streams_command(probe_tool, path), STREAMS_LIMIT) if p.hdr_tone_mapping and p.hdr_mode == "auto" else None
        fields = said(fields_command(extract_tool, path), FIELDS_LIMIT, False) if p.deinterlace_mode == "auto" else None
        return duration and duration[0], streams and streams[0], fields and fields[1]

    return run


def extractor(tool: str, folder_of: Callable[[str], str], p: Params = Params()) -> Callable[[str, str], tuple]:
    """For ``operators.extract.extracted``: frames go to ``folder_of(path)``, which is emptied first, so that a run can be repeated."""

    def run(path: str, chain: str):
        folder = folder_of(path)
        os.makedirs(folder, exist_ok=True)
        for name in os.listdir(folder):
            if name.startswith("frame_"):
                os.remove(os.path.join(folder, name))
        got = said(extract_command(tool, path, folder, chain, p), EXTRACT_LIMIT)
        if got is None:
            raise RuntimeError("the extractor failed")
        return [n for n in os.listdir(folder) if n.startswith("frame_") and n.endswith(".png")], got[1]

    return run
