"""Column functions over arrays of boxes: struct<label, cx, cy, w, h>, normalised, centre-origin.

All stay inside the JVM. Null arrays give null, null elements are dropped by
the filters, NaN coordinates fail every validity rule.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOX = "struct<label:string,cx:double,cy:double,w:double,h:double>"
PAD_VALUE = 114  # grey of padded borders (fixed value)


def box(label: Column, cx: Column, cy: Column, w: Column, h: Column) -> Column:
    return F.struct(label.alias("label"), cx.cast("double").alias("cx"), cy.cast("double").alias("cy"), w.cast("double").alias("w"), h.cast("double").alias("h"))


def from_corners(label: Column, x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> Column:
    """Pixel corners to a normalised box; an image side that is null or not positive gives null."""
    ok = (width > 0) & (height > 0)
    return F.when(ok, box(label, (x1 + x2) / 2 / width, (y1 + y2) / 2 / height, (x2 - x1) / width, (y2 - y1) / height))


def _is_valid(b: Column) -> Column:
    inside = lambda c: (c > -0.5) & (c < 1.5)
    side = lambda c: (c > 1e-4) & (c <= 1.5)
    return F.coalesce(b.isNotNull() & side(b["w"]) & side(b["h"]) & inside(b["cx"]) & inside(b["cy"]), F.lit(False))


def valid(boxes: Column) -> Column:
    """Boxes with sides in (1e-4, 1.5] and centres in (-0.5, 1.5)."""
    return F.filter(boxes, _is_valid)


def strictly_inside(boxes: Column) -> Column:
    """Boxes with centres in [0, 1] and sides in (0, 1] (the stricter rule of frame annotations)."""
    unit = lambda c: (c >= 0) & (c <= 1)
    return F.filter(boxes, lambda b: F.coalesce(unit(b["cx"]) & unit(b["cy"]) & (b["w"] > 0) & (b["w"] <= 1) & (b["h"] > 0) & (b["h"] <= 1), F.lit(False)))


def _corners(b: Column) -> tuple[Column, Column, Column, Column]:
    return b["cx"] - b["w"] / 2, b["cy"] - b["h"] / 2, b["cx"] + b["w"] / 2, b["cy"] + b["h"] / 2


def crop_window(width: Column, height: Column, out_w: int, out_h: int) -> tuple[Column, Column, Column, Column]:
    """Centred window of the target's aspect ratio in an image: width, height, left, top (sides rounded half to even)."""
    ratio = F.lit(out_w / out_h)
    wide = width / height > ratio
    crop_w = F.when(wide, F.bround(height * ratio).cast("long")).otherwise(width)
    crop_h = F.when(wide, height).otherwise(F.bround(width / ratio).cast("long"))
    return crop_w, crop_h, F.floor((width - crop_w) / 2), F.floor((height - crop_h) / 2)


def crop(boxes: Column, width: Column, height: Column, out_w: int, out_h: int, least_visible: float = 0.3) -> Column:
    """Boxes as seen through the centred crop; those outside, or showing less than ``least_visible`` of their area, go."""
    crop_w, crop_h, left, top = crop_window(width, height, out_w, out_h)

    def seen(b: Column) -> Column:
        x1, y1, x2, y2 = _corners(b)
        x1, x2, y1, y2 = x1 * width - left, x2 * width - left, y1 * height - top, y2 * height - top
        return F.struct(b["label"].alias("label"), F.greatest((x2 - x1) * (y2 - y1), F.lit(1e-9)).alias("area"), F.greatest(x1, F.lit(0.0)).alias("x1"), F.greatest(y1, F.lit(0.0)).alias("y1"), F.least(x2, crop_w.cast("double")).alias("x2"), F.least(y2, crop_h.cast("double")).alias("y2"))

    def stays(s: Column) -> Column:
        return (s["x2"] > s["x1"]) & (s["y2"] > s["y1"]) & ((s["x2"] - s["x1"]) * (s["y2"] - s["y1"]) / s["area"] >= least_visible)

    out = lambda s: box(s["label"], (s["x1"] + s["x2"]) / 2 / crop_w, (s["y1"] + s["y2"]) / 2 / crop_h, (s["x2"] - s["x1"]) / crop_w, (s["y2"] - s["y1"]) / crop_h)
    return F.transform(F.filter(F.transform(F.filter(boxes, lambda b: b.isNotNull()), seen), stays), out)


def pad(boxes: Column, width: Column, height: Column, out_w: int, out_h: int) -> Column:
    """Boxes in the image scaled to fit the target and centred in it; none goes."""
    scale = F.least(F.lit(out_w) / width, F.lit(out_h) / height)
    left = F.floor((F.lit(out_w) - F.bround(width * scale).cast("long")) / 2)
    top = F.floor((F.lit(out_h) - F.bround(height * scale).cast("long")) / 2)
    return F.transform(boxes, lambda b: box(b["label"], (b["cx"] * width * scale + left) / out_w, (b["cy"] * height * scale + top) / out_h, b["w"] * width * scale / out_w, b["h"] * height * scale / out_h))


def fit(boxes: Column, width: Column, height: Column, out_w: int, out_h: int, mode: str = "crop", least_visible: float = 0.3) -> Column:
    """``pad`` if the mode says so, else ``crop``."""
    return pad(boxes, width, height, out_w, out_h) if mode == "pad" else crop(boxes, width, height, out_w, out_h, least_visible)


def clamp(boxes: Column) -> Column:
    """Boxes cut to the unit square; those with a side under 1e-3 go."""

    def cut(b: Column) -> Column:
        x1, y1, x2, y2 = _corners(b)
        return F.struct(b["label"].alias("label"), F.greatest(x1, F.lit(0.0)).alias("x1"), F.greatest(y1, F.lit(0.0)).alias("y1"), F.least(x2, F.lit(1.0)).alias("x2"), F.least(y2, F.lit(1.0)).alias("y2"))

    big = lambda s: (s["x2"] - s["x1"] >= 1e-3) & (s["y2"] - s["y1"] >= 1e-3)
    out = lambda s: box(s["label"], (s["x1"] + s["x2"]) / 2, (s["y1"] + s["y2"]) / 2, s["x2"] - s["x1"], s["y2"] - s["y1"])
    return F.transform(F.filter(F.transform(F.filter(boxes, lambda b: b.isNotNull()), cut), big), out)


def label_line(cid: Column, b: Column) -> Column:
    """``class cx cy w h`` with six decimals."""
    return F.format_string("%d %.6f %.6f %.6f %.6f", cid, b["cx"], b["cy"], b["w"], b["h"])

