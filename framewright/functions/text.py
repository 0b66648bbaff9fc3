"""Scalar rules on names, logs and probe output. All are column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import IMAGE_SUFFIXES, VIDEO_SUFFIXES, ZERO_TIME, Params


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_name(path) -> Column:
    return F.regexp_extract(col(path), r"([^/]*)$", 1)


def suffix(name) -> Column:
    """Lower-case ending with its dot, or ''."""
    return F.lower(F.regexp_extract(col(name), r"[^/.](\.[^./]+)$", 1))


def stem(name) -> Column:
    return F.regexp_replace(file_name(name), r"(?<=[^.])\.[^.]*$", "")


def stem_key(name) -> Column:
    return F.lower(stem(name))


def is_video(name) -> Column:
    return suffix(name).isin(*VIDEO_SUFFIXES)


def is_image(name) -> Column:
    return suffix(name).isin(*IMAGE_SUFFIXES)


def video_of(name) -> Column:
    """Video of a frame file's name, null for names of another form. Case counts."""
    found = F.regexp_extract(col(name), r"^(.*?)_frame_\d+\.png$", 1)
    return F.when(col(name).rlike(r"^(.*?)_frame_\d+\.png$"), found)


def frame_name(number) -> Column:
    return F.concat(F.lit("frame_"), F.lpad(col(number).cast("string"), 6, "0"), F.lit(".png"))


def matched_name(video, lr_frame) -> Column:
    """Name that both sides of a matched pair get."""
    return F.concat(col(video).cast("string"), F.lit("_"), stem(lr_frame), F.lit(".png"))


def duration(probe) -> Column:
    """Probe output -> seconds, null if it is no number."""
    return F.trim(col(probe)).try_cast("double")


HDR_SCHEMA = "streams array<struct<color_transfer:string,color_primaries:string,side_data_list:array<struct<side_data_type:string>>>>"


def is_hdr(probe_json) -> Column:
    """Whether the first stream has an HDR transfer, wide primaries or Dolby Vision data; false for unreadable probes."""
    # fixed values: the names that probes give
    s = F.get(F.from_json(col(probe_json), HDR_SCHEMA)["streams"], F.lit(0))
    return F.coalesce(
        F.coalesce(s["color_transfer"].isin("smpte2084", "arib-std-b67"), F.lit(False))
        | F.coalesce(s["color_primaries"] == "bt2020", F.lit(False))
        | F.coalesce(F.exists(s["side_data_list"], lambda d: F.coalesce(d["side_data_type"] == "Dolby Vision", F.lit(False))), F.lit(False)),
        F.lit(False),
    )


def interlace_counts(log) -> Column:
    """(tff, bff, progressive) from a field-order log's first such numbers, null where one is missing."""
    number = lambda name: F.regexp_extract(col(log), rf"{name}:\s*(\d+)", 1).try_cast("bigint")
    return F.struct(number("TFF").alias("tff"), number("BFF").alias("bff"), number("Progressive").alias("progressive"))


def is_interlaced(tff, bff, progressive, ratio: float = Params.interlace_ratio) -> Column:
    """Strictly more than ``ratio`` of the determined frames are interlaced; unknown or none: false."""
    fields = col(tff) + col(bff)
    return F.coalesce(F.try_divide(fields, fields + col(progressive)) > ratio, F.lit(False))


def pts_time(line) -> Column:
    """Last time on a log line, null if it has none (signs and exponents don't count)."""
    return F.regexp_extract(col(line), r"\[Parsed_showinfo.*pts_time:(\d+\.?\d*)", 1).try_cast("double")


def filter_chain(side, interlaced, hdr, scene_threshold, p: Params = Params(), mode=None, hdr_mode=None) -> Column:
    """Comma-joined filters in fixed order: deinterlace, chroma, tone map, scene select with its log."""
    side, mode = col(side), F.lit(p.deinterlace_mode) if mode is None else col(mode)
    hdr_mode = F.lit(p.hdr_mode) if hdr_mode is None else col(hdr_mode)
    # the three fixed modes don't ask whether a video is HDR
    deinterlace = (
        ((mode == "auto") & col(interlaced)) | (mode == "both") | ((mode == "lr") & (side == "LR")) | ((mode == "hr") & (side == "HR"))
    )
    tone = F.lit(p.hdr_tone_mapping) & (
        ((hdr_mode == "auto") & col(hdr)) | (hdr_mode == "both") | ((hdr_mode == "hr_only") & (side == "HR")) | ((hdr_mode == "lr_only") & (side == "LR"))
    )
    select = F.lit(f"select='gt(scene,{float(scene_threshold)!r})',showinfo")
    return F.concat_ws(
        ",", F.when(deinterlace, p.deinterlace_filter), F.when(F.lit(p.chroma_upsampling), p.chroma_filter), F.when(tone, p.hdr_filter), select
    )


def clock_seconds(clock) -> Column:
    parts = F.split(col(clock), ":")
    return parts[0].cast("double") * 3600 + parts[1].cast("double") * 60 + parts[2].cast("double")


def in_range(ts, p: Params = Params()) -> Column:
    """Time range; no bounds if both clocks are zero, no end if the end is zero."""
    if p.begin_time == ZERO_TIME and p.end_time == ZERO_TIME:
        return F.lit(True)
    ok = col(ts) >= clock_seconds(F.lit(p.begin_time))
    return ok if p.end_time == ZERO_TIME else ok & (col(ts) <= clock_seconds(F.lit(p.end_time)))


def is_image_line(line) -> Column:
    """A tool's progress line that names an image and no trouble."""
    return col(line).endswith(".png") & ~is_warning(line)


def is_warning(line) -> Column:
    return col(line).rlike("(?i)warning|futurewarning|error")


def is_shown(line, p: Params = Params()) -> Column:
    return F.lit(True) if p.show_warnings else ~is_warning(line)


def last_chars(text, n: int = 1000) -> Column:
    return F.right(col(text), F.lit(n))


def last_lines(text, n: int = 10) -> Column:
    lines = F.split(col(text), "\n")
    return F.array_join(F.slice(lines, F.greatest(F.size(lines) - n + 1, F.lit(1)), F.lit(n)), "\n")


def minutes(seconds) -> Column:
    return F.round(col(seconds) / 60, 1)


def hours(seconds) -> Column:
    return F.round(col(seconds) / 3600, 2)
