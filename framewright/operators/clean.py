"""Content fix, border crop and low-information rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col
from ..params import Params


def aspect_differs(w, h, w2, h2, p: Params = Params()) -> Column:
    """Whether two frames' aspect ratios are far enough apart to look for one inside the other."""
    return F.abs(F.try_divide(col(w), col(h)) - F.try_divide(col(w2), col(h2))) >= p.aspect_tolerance


def contest(hr_in_lr, lr_in_hr, p: Params = Params()) -> Column:
    """Which side to crop from the scores of both orders: the strictly higher one above the threshold, else none."""
    a, b, t = col(hr_in_lr), col(lr_in_hr), p.content_fix_threshold
    return F.when((a > b) & (a > t), "crop_hr").when((b > a) & (b > t), "crop_lr").otherwise("none")


def crop_applies(box, width, height, p: Params = Params()) -> Column:
    """A box is applied if it is large enough and not the whole frame; images are never dropped for it."""
    b = col(box)
    w, h = b["x_max"] - b["x_min"], b["y_max"] - b["y_min"]
    whole = (b["x_min"] == 0) & (b["y_min"] == 0) & (w == col(width)) & (h == col(height))
    return F.coalesce((w >= p.min_content_dimension) & (h >= p.min_content_dimension) & ~whole, F.lit(False))


def low_info(lr_var, hr_var, p: Params = Params()) -> Column:
    """Low variance of the LR frame, or, where asked, of its HR twin; an unreadable one is not low."""
    low = lambda v: F.coalesce(col(v) < p.variance_threshold, F.lit(False))
    return low(lr_var) | (F.lit(p.check_hr_variance) & low(hr_var))


def cascade(frames: DataFrame, flagged: DataFrame, keys: list[str]) -> DataFrame:
    """Both sides' frames without those whose key is flagged."""
    return frames.join(flagged.select(*keys).distinct(), keys, "left_anti")
