"""Column expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def video_key(frame_id="frame_id") -> Column:
    """Group key of a frame: the text before the first '-' (whole id if none)."""
    return F.substring_index(_c(frame_id), "-", 1)


def frame_id_from_path(path="path", extension: str = "jpg") -> Column:
    """File stem of an image path."""
    return F.regexp_extract(_c(path), r"([^/]+)\." + re.escape(extension) + "$", 1)


def image_path(directory: str, frame_id="frame_id", extension: str = "jpg") -> Column:
    return F.concat(F.lit(directory.rstrip("/") + "/"), _c(frame_id), F.lit("." + extension))


def normalised_box(x1, y1, x2, y2, width: float, height: float) -> list[Column]:
    """Pixel corners -> centre/size normalised by the image size (no clipping)."""
    x1, y1, x2, y2 = _c(x1), _c(y1), _c(x2), _c(y2)
    return [
        ((x1 + x2) / F.lit(2.0) / F.lit(float(width))).alias("x_center"),
        ((y1 + y2) / F.lit(2.0) / F.lit(float(height))).alias("y_center"),
        ((x2 - x1) / F.lit(float(width))).alias("width"),
        ((y2 - y1) / F.lit(float(height))).alias("height"),
    ]


def in_band(col, low: float, high: float) -> Column:
    """Inclusive band test ``low <= col <= high``."""
    return _c(col).between(F.lit(float(low)), F.lit(float(high)))


def top_two_gap(scores) -> Column:
    """Highest minus second highest of an array of class scores, in one pass over it.

    Null and NaN scores are left out; an array of one score has nothing to be
    confused with, so its gap is the score; one without any score has no gap.
    """
    low = F.lit(float("-inf"))
    sound = F.filter(_c(scores), lambda x: x.isNotNull() & ~F.isnan(x))
    top = F.aggregate(
        sound, F.struct(low.alias("first"), low.alias("second")), lambda acc, x: F.struct(
            F.greatest(acc["first"], x).alias("first"),
            F.greatest(acc["second"], F.least(acc["first"], x)).alias("second")),
        lambda acc: F.struct(acc["first"].alias("first"), (acc["first"] - acc["second"]).alias("gap")))
    n = F.size(sound)
    return F.when(n == 1, top["first"]).when(n > 1, top["gap"])


def hash_order_key(seed: int, salt: str, key="frame_id") -> Column:
    """Repeatable pseudo-random order key: md5 of ``seed:salt:key``.

    Independent of row order and partitioning, so a shuffle done with it is the
    same on 1 or 1000 executors.
    """
    return F.md5(F.concat(F.lit(f"{seed}:{salt}:"), _c(key)))


def hash_rank(key) -> Column:
    """The first 12 hex digits of an order key as a number that never falls along the key."""
    return F.conv(F.substring(_c(key), 1, 12), 16, 10).cast("double")


def iou(a: dict, b: dict) -> Column:
    """IoU of two centre/size boxes given as dicts of columns (x, y, w, h)."""
    ix = F.greatest(F.lit(0.0),
                    F.least(a["x"] + a["w"] / 2.0, b["x"] + b["w"] / 2.0)
                    - F.greatest(a["x"] - a["w"] / 2.0, b["x"] - b["w"] / 2.0))
    iy = F.greatest(F.lit(0.0),
                    F.least(a["y"] + a["h"] / 2.0, b["y"] + b["h"] / 2.0)
                    - F.greatest(a["y"] - a["h"] / 2.0, b["y"] - b["h"] / 2.0))
    inter = ix * iy
    union = a["w"] * a["h"] + b["w"] * b["h"] - inter
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def class_name(class_id="class_id", name="class_name") -> Column:
    """Name with the ``class_<id>`` fallback for ids missing from the dimension."""
    return F.coalesce(_c(name), F.concat(F.lit("class_"), _c(class_id).cast("string")))


# A power of two: scaling by it changes no digit of a double.
UNIT = float(1 << 40)


def exact_sum(col) -> Column:
    """Order-independent sum of doubles: integers of 2**-40, summed exactly, back to double.

    A plain double sum depends on the order rows arrive in, which differs per
    run and per partitioning.  For values whose magnitude stays under 2**13.
    """
    return F.sum(F.round(_c(col) * F.lit(UNIT)).cast("decimal(38,0)")).cast("double") / F.lit(UNIT)
