"""Rectangle algebra as column expressions.

Rectangles are structs ``x, y, w, h`` of integers with w, h > 0 and x, y >= 0; boxes are structs
``x1, y1, x2, y2`` of doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def rect(x: Column, y: Column, w: Column, h: Column) -> Column:
    as_int = lambda c, name: c.cast("int").alias(name)
    return F.struct(as_int(x, "x"), as_int(y, "y"), as_int(w, "w"), as_int(h, "h"))


def is_valid_rect(r: Column) -> Column:
    return (r["w"] > 0) & (r["h"] > 0) & (r["x"] >= 0) & (r["y"] >= 0)


def right(r: Column) -> Column:
    return r["x"] + r["w"]


def bottom(r: Column) -> Column:
    return r["y"] + r["h"]


def area(r: Column) -> Column:
    return r["w"].cast("long") * r["h"]


def overlap(a: Column, b: Column) -> Column:
    """Area common to two rectangles."""
    w = F.least(right(a), right(b)) - F.greatest(a["x"], b["x"])
    h = F.least(bottom(a), bottom(b)) - F.greatest(a["y"], b["y"])
    return F.greatest(w, F.lit(0)).cast("long") * F.greatest(h, F.lit(0))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of rectangles; 0 where the union is empty."""
    common = overlap(a, b)
    return F.coalesce(F.try_divide(common, area(a) + area(b) - common), F.lit(0.0))


def contains(outer: Column, inner: Column) -> Column:
    """Edges may touch."""
    return (
        (inner["x"] >= outer["x"])
        & (inner["y"] >= outer["y"])
        & (right(inner) <= right(outer))
        & (bottom(inner) <= bottom(outer))
    )


def box_width(b: Column) -> Column:
    return F.greatest(b["x2"] - b["x1"], F.lit(0.0))


def box_height(b: Column) -> Column:
    return F.greatest(b["y2"] - b["y1"], F.lit(0.0))


def box_area(b: Column) -> Column:
    return box_width(b) * box_height(b)


def box_iou(a: Column, b: Column) -> Column:
    w = F.greatest(F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]), F.lit(0.0))
    h = F.greatest(F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]), F.lit(0.0))
    union = box_area(a) + box_area(b) - w * h
    return F.when(union > 0, w * h / union).otherwise(F.lit(0.0))


def box_to_rect(b: Column, k: float = 1.0) -> Column:
    """A scaled box as a rectangle: halves to even, at least 1 wide and high."""
    whole = lambda c: F.bround(c).cast("int")
    return rect(
        whole(b["x1"] * k),
        whole(b["y1"] * k),
        F.greatest(whole(box_width(b) * k), F.lit(1)),
        F.greatest(whole(box_height(b) * k), F.lit(1)),
    )


def even(n: Column) -> Column:
    """The largest even number up to n."""
    return n - F.pmod(n, F.lit(2))


def pad_rect(r: Column, fraction: float, frame_w: Column, frame_h: Column) -> Column:
    """Widen each side by a fraction (rounded up), with an even origin and size inside the frame."""
    dx, dy = F.ceil(r["w"] * F.lit(fraction)).cast("int"), F.ceil(r["h"] * F.lit(fraction)).cast("int")
    x, y = F.greatest(even(r["x"] - dx), F.lit(0)), F.greatest(even(r["y"] - dy), F.lit(0))
    x2, y2 = F.least(frame_w, right(r) + dx), F.least(frame_h, bottom(r) + dy)
    return rect(x, y, F.greatest(even(x2 - x), F.lit(2)), F.greatest(even(y2 - y), F.lit(2)))


def scale_rect(r: Column, k: float, frame_w: Column, frame_h: Column) -> Column:
    """Scale outwards: origin down and far edge up, both even, clamped to the frame."""
    x, y = even(F.floor(r["x"] * F.lit(k)).cast("int")), even(F.floor(r["y"] * F.lit(k)).cast("int"))
    x2 = F.least(frame_w, F.ceil(right(r) * F.lit(k)).cast("int"))
    y2 = F.least(frame_h, F.ceil(bottom(r) * F.lit(k)).cast("int"))
    return rect(x, y, F.greatest(even(x2 - x), F.lit(2)), F.greatest(even(y2 - y), F.lit(2)))


def inset_rect(r: Column, frame_w: Column, frame_h: Column, margin: int = 2) -> Column:
    """Keep a margin to the frame's edges (for a patch filter); at least 1 wide and high."""
    x, y = F.greatest(r["x"], F.lit(margin)), F.greatest(r["y"], F.lit(margin))
    x2, y2 = F.least(right(r), frame_w - margin), F.least(bottom(r), frame_h - margin)
    return rect(x, y, F.greatest(x2 - x, F.lit(1)), F.greatest(y2 - y, F.lit(1)))


def panel_complement(panel: Column, edge: Column, frame_w: Column, frame_h: Column) -> Column:
    """What a side panel leaves of the frame; null without a panel."""
    left = rect(right(panel), F.lit(0), frame_w - right(panel), frame_h)
    other = rect(F.lit(0), F.lit(0), panel["x"], frame_h)
    return F.when(panel.isNotNull() & edge.isNotNull(), F.when(edge == "left", left).otherwise(other))


def ring(r: Column, frame_w: Column, frame_h: Column) -> Column:
    """The surrounding rectangle a quarter wider on each side (2 pixels at least), clipped."""
    dx = F.greatest(F.lit(2), F.floor(r["w"] * 0.25).cast("int"))
    dy = F.greatest(F.lit(2), F.floor(r["h"] * 0.25).cast("int"))
    x, y = F.greatest(F.lit(0), r["x"] - dx), F.greatest(F.lit(0), r["y"] - dy)
    x2, y2 = F.least(frame_w, right(r) + dx), F.least(frame_h, bottom(r) + dy)
    return rect(x, y, F.greatest(x2 - x, F.lit(1)), F.greatest(y2 - y, F.lit(1)))


def clamp01(v: Column) -> Column:
    return F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0)))
