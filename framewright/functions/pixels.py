"""Pixel kernels in numpy, and vectorised functions over Spark's image rows.

Images are BGR bytes, as Spark's ``image`` source gives them. Resizing and grey conversion state their rounding; other
libraries may differ by one grey level.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from ..params import Params


def array_of(data: bytes, height: int, width: int, channels: int = 3) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(height, width, channels)


def gray(bgr: np.ndarray) -> np.ndarray:
    """Weights .299, .587 and .114 in 14-bit fixed point, rounded."""
    if bgr.ndim == 2 or bgr.shape[2] == 1:
        return bgr.reshape(bgr.shape[:2])
    b, g, r = (bgr[..., k].astype(np.int32) for k in range(3))
    return ((b * 1868 + g * 9617 + r * 4899 + 8192) >> 14).astype(np.uint8)


#: Resize weights by size, kept in each process; sizes are few.
_WEIGHTS: dict = {}


def _area(n: int, m: int) -> np.ndarray:
    """Weights (m, n) that average n samples into m cells by area."""
    if (n, m) in _WEIGHTS:
        return _WEIGHTS[n, m]
    edges = np.arange(m + 1) * (n / m)
    low, high = np.arange(n), np.arange(1, n + 1)
    if len(_WEIGHTS) > 64:
        _WEIGHTS.clear()
    _WEIGHTS[n, m] = out = np.maximum(0, np.minimum(edges[1:, None], high) - np.maximum(edges[:-1, None], low)) / (n / m)
    return out


def resize_area(image: np.ndarray, width: int, height: int) -> np.ndarray:
    """Area average of a grey image, aspect ignored, rounded to bytes."""
    h, w = image.shape
    return np.rint(_area(h, height) @ image.astype(float) @ _area(w, width).T).astype(np.uint8)


def mask_of(g: np.ndarray, p: Params = Params()) -> np.ndarray:
    """Content: brighter than black borders; for white borders by mode (see Params.white_mode).

    'reference' keeps pixels above the white threshold as content, 'intended' drops them.
    """
    out = np.ones(g.shape, bool)
    if p.crop_black:
        out &= g > p.black_threshold
    if p.crop_white:
        white = g > p.white_threshold
        out &= white if p.white_mode == "reference" else ~white
    return out


def box_of(mask: np.ndarray) -> tuple[int, int, int, int] | None:
    """(x_min, y_min, x_max, y_max) of the mask, ends exclusive."""
    ys, xs = np.flatnonzero(mask.any(1)), np.flatnonzero(mask.any(0))
    return (int(xs[0]), int(ys[0]), int(xs[-1]) + 1, int(ys[-1]) + 1) if len(ys) else None


def crop(image: np.ndarray, box: tuple[int, int, int, int]) -> np.ndarray:
    """Slice clipped to the image; an empty one changes nothing."""
    h, w = image.shape[:2]
    x0, y0, x1, y1 = max(0, box[0]), max(0, box[1]), min(w, box[2]), min(h, box[3])
    return image[y0:y1, x0:x1] if x1 > x0 and y1 > y0 else image


def auto_crop(bgr: np.ndarray, p: Params = Params()) -> np.ndarray:
    """Without borders; the image as it is where the content is too small or whole, or there is none."""
    h, w = bgr.shape[:2]
    box = box_of(mask_of(gray(bgr), p)) if p.crop_black or p.crop_white else None
    if not box:
        return bgr
    bw, bh = box[2] - box[0], box[3] - box[1]
    if bw < p.min_content_dimension or bh < p.min_content_dimension or (bw, bh) == (w, h):
        return bgr
    return crop(bgr, box)


def ncc(a: np.ndarray, b: np.ndarray) -> float:
    """Normalised correlation of two images of one size; a flat first one gives 1, a flat second one 0."""
    x, y = a.astype(float).ravel(), b.astype(float).ravel()
    x, y = x - x.mean(), y - y.mean()
    xx, yy = x @ x, y @ y
    return 1.0 if xx == 0 else 0.0 if yy == 0 else float(x @ y / np.sqrt(xx * yy))


def template(content: np.ndarray, container: np.ndarray, p: Params = Params()) -> tuple[float, tuple[int, int, int, int] | None]:
    """Best normalised correlation of ``content`` anywhere in ``container`` (grey), and where: (x, y, width, height).

    A container wider than ``container_width`` is scaled down first, the content alike; the place is scaled back. A
    content larger than the container scores 0. Correlations come from Fourier transforms, sums from integral images.
    """
    h, w = content.shape
    ch, cw = container.shape
    if h > ch or w > cw:
        return 0.0, None
    scale = 1.0
    if cw > p.container_width:
        scale = p.container_width / cw
        container = resize_area(container, p.container_width, max(1, int(ch * scale)))
        content = resize_area(content, max(1, int(w * scale)), max(1, int(h * scale)))
        if content.shape[0] > container.shape[0] or content.shape[1] > container.shape[1]:
            return 0.0, None
    t = content.astype(float)
    t -= t.mean()
    tt = (t * t).sum()
    th, tw = t.shape
    big = container.astype(float)
    if tt == 0:
        return 1.0, (0, 0, w, h)
    size = (big.shape[0] + th - 1, big.shape[1] + tw - 1)
    cross = np.fft.irfft2(np.fft.rfft2(big, size) * np.fft.rfft2(t[::-1, ::-1], size), size)[th - 1 : big.shape[0], tw - 1 : big.shape[1]]
    integral = lambda x: np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    window = lambda s: s[th:, tw:] - s[:-th, tw:] - s[th:, :-tw] + s[:-th, :-tw]
    n = th * tw
    spread = window(integral(big * big)) - window(integral(big)) ** 2 / n
    flat = spread <= 1e-6 * max(1.0, tt)
    score = np.where(flat, 0.0, cross / np.sqrt(np.where(flat, 1.0, spread) * tt))
    y, x = np.unravel_index(int(np.argmax(score)), score.shape)
    back = lambda v: int(v / scale)
    return float(np.clip(score[y, x], -1, 1)), (back(x), back(y), w, h)


def _dct(n: int) -> np.ndarray:
    k, x = np.arange(n)[:, None], np.arange(n)
    return 2 * np.cos(np.pi * k * (2 * x + 1) / (2 * n))


def _lanczos(n: int, m: int, a: int = 3) -> np.ndarray:
    """Weights (m, n) of a Lanczos resize, wider where it shrinks."""
    ratio = max(1.0, n / m)
    centre = (np.arange(m) + 0.5) * n / m
    x = (np.arange(n) + 0.5 - centre[:, None]) / ratio
    wts = np.where(np.abs(x) < a, np.sinc(x) * np.sinc(x / a), 0.0)
    return wts / wts.sum(1, keepdims=True)


def phash(g: np.ndarray) -> int:
    """64 bits, signed: the low 8 x 8 cosine coefficients of a 32 x 32 reduction above their median, row by row."""
    h, w = g.shape
    small = np.clip(np.rint(_lanczos(h, 32) @ g.astype(float) @ _lanczos(w, 32).T), 0, 255)
    low = (_dct(32) @ small @ _dct(32).T)[:8, :8].ravel()
    value = int("".join("1" if b else "0" for b in low > np.median(low)), 2)
    return value - (1 << 64) if value >= 1 << 63 else value


def _images(data, height, width, channels):
    for d, h, w, c in zip(data, height, width, channels):
        yield None if d is None or not h or not w or h < 0 else array_of(bytes(d), int(h), int(w), int(c))


@F.pandas_udf(DoubleType())
def gray_variance(data: pd.Series, height: pd.Series, width: pd.Series, channels: pd.Series) -> pd.Series:
    """Population variance of the grey image; null for an unreadable one."""
    return pd.Series([None if x is None else float(gray(x).astype(float).var()) for x in _images(data, height, width, channels)], dtype=float)


@F.pandas_udf(LongType())
def image_phash(data: pd.Series, height: pd.Series, width: pd.Series, channels: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else phash(gray(x)) for x in _images(data, height, width, channels)], dtype="Int64")


def match_pixels(width: int, height: int):
    """Function of image columns -> grey working pixels, reduced to one size, a byte each."""

    @F.pandas_udf("binary")
    def pixels(data: pd.Series, h: pd.Series, w: pd.Series, channels: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else resize_area(gray(x), width, height).tobytes() for x in _images(data, h, w, channels)], dtype=object)

    return pixels


def cropped_image(p: Params = Params()):
    """Function of image columns -> struct(data, height, width) without borders."""

    @F.pandas_udf("data binary, height int, width int")
    def cropped(data: pd.Series, h: pd.Series, w: pd.Series, channels: pd.Series) -> pd.DataFrame:
        rows = []
        for x in _images(data, h, w, channels):
            y = None if x is None else auto_crop(x, p)
            rows.append((None, None, None) if y is None else (np.ascontiguousarray(y).tobytes(), y.shape[0], y.shape[1]))
        return pd.DataFrame(rows, columns=["data", "height", "width"]).astype({"height": "Int32", "width": "Int32"})

    return cropped


def contest_scores(p: Params = Params()):
    """Function of both sides' image columns -> struct of both orders' scores and places."""

    @F.pandas_udf("hr_in_lr double, lr_in_hr double, hr_box array<int>, lr_box array<int>")
    def scores(ld: pd.Series, lh: pd.Series, lw: pd.Series, lc: pd.Series, hd: pd.Series, hh: pd.Series, hw: pd.Series, hc: pd.Series) -> pd.DataFrame:
        rows = []
        for a, b in zip(_images(ld, lh, lw, lc), _images(hd, hh, hw, hc)):
            if a is None or b is None:
                rows.append((None, None, None, None))
                continue
            ga, gb = gray(a), gray(b)
            (s1, box1), (s2, box2) = template(ga, gb, p), template(gb, ga, p)  # LR found in HR: crop HR there
            rows.append((s1, s2, list(box1) if box1 else None, list(box2) if box2 else None))
        return pd.DataFrame(rows, columns=["hr_in_lr", "lr_in_hr", "hr_box", "lr_box"])

    return scores
