"""Pixel statistics in long form.

Tables: ``grey(title_id, frame_idx, y, x, v)`` and ``pixel_stats(title_id, y, x, mean_grey,
temporal_var)``.  Sums are taken over whole numbers, so that they don't depend on their order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuegrid.functions.geometry import bottom, clamp01, right, ring


def luma(r: Column, g: Column, b: Column) -> Column:
    return 0.299 * r + 0.587 * g + 0.114 * b


def pixel_stats(grey: DataFrame) -> DataFrame:
    """Mean and sample variance of each pixel over the frames (0 for one frame)."""
    return grey.groupBy("title_id", "y", "x").agg(
        F.avg("v").alias("mean_grey"), F.coalesce(F.var_samp("v"), F.lit(0.0)).alias("temporal_var"), F.count("*").alias("frames")
    )


def frame_differences(grey: DataFrame) -> DataFrame:
    """Adds diff to the frame before, null on a title's first frame."""
    before = Window.partitionBy("title_id", "y", "x").orderBy("frame_idx")
    return grey.withColumn("diff", F.abs(F.col("v") - F.lag("v").over(before)))


def frame_motion(grey: DataFrame) -> DataFrame:
    return frame_differences(grey).groupBy("title_id", "frame_idx").agg(F.avg("diff").alias("motion"))


def box_motion(grey: DataFrame, boxes: DataFrame, upper: float = 0.6) -> DataFrame:
    """Mean difference in the upper part of each box of ``boxes(title_id, frame_idx, box_no, x1, y1, x2, y2)``."""
    columns = F.sequence(F.floor("x1").cast("int"), F.ceil("x2").cast("int") - 1)
    spread = boxes.select("title_id", "frame_idx", "box_no", "y1", "y2", F.explode_outer(F.when(F.ceil("x2") > F.floor("x1"), columns)).alias("x"))
    inside = (F.col("y") >= F.floor("y1")) & (F.col("y") < F.ceil(F.col("y1") + upper * (F.col("y2") - F.col("y1"))))
    hit = spread.join(frame_differences(grey).select("title_id", "frame_idx", "x", "y", "diff"), ["title_id", "frame_idx", "x"], "left")
    return hit.groupBy("title_id", "frame_idx", "box_no").agg(F.avg(F.when(inside, F.col("diff"))).alias("motion"))


def region_sums(stats: DataFrame) -> DataFrame:
    """(title_id, y, x, var_sum, grey_sum): sums over all pixels up to x and y, so that any region is four look-ups.

    A title's pixels fill an image from (0, 0).  Two running sums, along rows and then down columns.
    """
    row, column = Window.partitionBy("title_id", "y").orderBy("x"), Window.partitionBy("title_id", "x").orderBy("y")
    rows = stats.select("title_id", "y", "x", F.sum("temporal_var").over(row).alias("v"), F.sum("mean_grey").over(row).alias("g"))
    return rows.select("title_id", "y", "x", F.sum("v").over(column).alias("var_sum"), F.sum("g").over(column).alias("grey_sum"))


def band_stats(stats: DataFrame, bands: DataFrame) -> DataFrame:
    """Mean variance and grey over ``bands(title_id, band, x, y, w, h)``; nulls for an empty band.

    Each band looks up the four corners of :func:`region_sums`; what lies outside the image doesn't count.
    """
    size = stats.groupBy("title_id").agg((F.max("x") + 1).alias("fw"), (F.max("y") + 1).alias("fh"))
    clip = lambda v, most: F.least(F.greatest(v, F.lit(0)), F.coalesce(most, F.lit(0)))
    rows = bands.join(size, "title_id", "left").select(
        "title_id", "band", clip(F.col("x"), F.col("fw")).alias("x1"), clip(F.col("y"), F.col("fh")).alias("y1"),
        clip(F.col("x") + F.greatest("w", F.lit(0)), F.col("fw")).alias("x2"), clip(F.col("y") + F.greatest("h", F.lit(0)), F.col("fh")).alias("y2"),
    )
    corner = lambda x, y, sign: F.struct((F.col(x) - 1).alias("x"), (F.col(y) - 1).alias("y"), F.lit(sign).alias("sign"))
    corners = rows.select(
        "title_id", "band", ((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))).alias("area"),
        F.inline(F.array(corner("x2", "y2", 1), corner("x1", "y2", -1), corner("x2", "y1", -1), corner("x1", "y1", 1))),
    )
    total = lambda c: F.try_divide(F.coalesce(F.sum(F.col("sign") * F.col(c)), F.lit(0.0)), F.max("area"))
    found = corners.join(region_sums(stats), ["title_id", "x", "y"], "left")
    return found.groupBy("title_id", "band").agg(total("var_sum").alias("variance"), total("grey_sum").alias("grey"))


#: How far a window's edges may go.
ENDS = ("left", "right", "top", "under")


def _accepts(variance, grey, reference, max_var: float, max_step: float):
    """The rule of growth, of columns or of numbers alike."""
    return (variance <= max_var) & (grey - reference <= max_step) & (reference - grey <= max_step)


def accepts_band(variance: Column, grey: Column, reference: Column, max_var: float = 40.0, max_step: float = 6.0) -> Column:
    """Whether a band is still and goes on from what its edge took last (null: nothing yet); a band without pixels is not."""
    return F.coalesce(_accepts(variance, grey, F.coalesce(reference, grey), max_var, max_step), F.lit(False))


def grow_windows(
    rects: DataFrame, stats: DataFrame, band: int = 2, max_var: float = 40.0, max_step: float = 6.0, size: tuple[int, int] | None = None
) -> DataFrame:
    """``rects(title_id, x, y, w, h)`` grown over still, even background, edge by edge to a fixpoint.

    The frame's ``size`` (width, height) is that of the pixels found unless it is given; a title's pixels fill an image
    from (0, 0), and beyond them nothing is accepted.

    Edges are tried left, right, top, bottom with the extents of the moment; each remembers the
    grey it took last.  An edge stands at its first place or whole bands from it, so all that growth can ask for are
    :func:`region_sums` where these lines cross: one point in band x band pixels of the reach, and a window's alone are a task's group.
    """

    def grow(key: tuple, points: pd.DataFrame) -> pd.DataFrame:
        x, y, w, h, *ends = (int(points[c].iloc[0]) for c in ("x", "y", "w", "h", *ENDS))
        sums = {(px, py): (v, g) for px, py, v, g in points[["px", "py", "var_sum", "grey_sum"]].itertuples(index=False)}
        edges, last = [x, x + w, y, y + h], [None] * 4

        def means(x1: int, x2: int, y1: int, y2: int) -> tuple[float, float]:
            area, out = (x2 - x1) * (y2 - y1), [0.0, 0.0]
            if area <= 0:
                return np.inf, 0.0
            for px, py, sign in ((x2, y2, 1), (x1, y2, -1), (x2, y1, -1), (x1, y1, 1)):
                if px and py:
                    at = sums.get((px, py))
                    if at is None:  # beyond the pixels
                        return np.inf, 0.0
                    out = [o + sign * a for o, a in zip(out, at, strict=True)]
            return out[0] / area, out[1] / area

        moved = True
        while moved:
            moved = False
            for e in range(4):
                way = -1 if e % 2 == 0 else 1
                to = edges[e] + way * band
                if (to < ends[e]) if way < 0 else (to > ends[e]):
                    continue
                lo, hi = sorted((edges[e], to))
                variance, grey = means(lo, hi, edges[2], edges[3]) if e < 2 else means(edges[0], edges[1], lo, hi)
                if _accepts(variance, grey, grey if last[e] is None else last[e], max_var, max_step):
                    last[e], edges[e], moved = grey, to, True
        x0, y0 = edges[0] - edges[0] % 2, edges[2] - edges[2] % 2
        w0, h0 = edges[1] - x0, edges[3] - y0
        return pd.DataFrame([(key[0], x0, y0, max(2, w0 - w0 % 2), max(2, h0 - h0 % 2))], columns=["title_id", "x", "y", "w", "h"])

    found = rects.select("title_id", *(F.col(c).cast("int").alias(c) for c in "xywh"))
    if size:
        sized = found.withColumns({"fw": F.lit(size[0]), "fh": F.lit(size[1])})
    else:
        of = stats.groupBy("title_id").agg((F.max("x") + 1).alias("fw"), (F.max("y") + 1).alias("fh"))
        sized = found.join(of, "title_id", "left").na.fill(0, ["fw", "fh"])
    x, y, w, h, fw, fh = (F.col(c) for c in ("x", "y", "w", "h", "fw", "fh"))
    far_x = F.least(F.floor(w * 1.5), F.floor(F.greatest(F.lit(0.0), 0.6 * fw - w) / 2)).cast("int")
    far_y = F.floor(h * 1.5).cast("int")
    reach = (F.greatest(F.lit(0), x - far_x), F.least(fw, x + w + far_x), F.greatest(F.lit(0), y - far_y), F.least(fh, y + h + far_y))
    reached = sized.withColumns(dict(zip(ENDS, reach, strict=True)))

    def lines(start: Column, end: Column, least: Column, most: Column) -> Column:
        """The places of both edges: from each outward in whole bands."""
        back = F.when(least <= start, F.sequence(start, least, F.lit(-band))).otherwise(F.array(start))
        return F.array_union(back, F.when(most >= end, F.sequence(end, most, F.lit(band))).otherwise(F.array(end)))

    lined = reached.select("*", lines(y, y + h, F.col("top"), F.col("under")).alias("down"), F.explode(lines(x, x + w, F.col("left"), F.col("right"))).alias("px"))
    sums = region_sums(stats).select("title_id", (F.col("x") + 1).alias("px"), (F.col("y") + 1).alias("py"), "var_sum", "grey_sum")
    points = lined.join(sums, ["title_id", "px"], "left").where(F.col("py").isNull() | F.array_contains("down", F.col("py")))
    need = points.select("title_id", "x", "y", "w", "h", *ENDS, "px", "py", "var_sum", "grey_sum")
    return need.groupBy("title_id", "x", "y", "w", "h").applyInPandas(grow, "title_id long, x int, y int, w int, h int")


def classify_layout(rects: DataFrame, stats: DataFrame | None, frame_w: int, frame_h: int) -> DataFrame:
    """``rects(title_id, rect)`` to kind (side-panel or corner-inset), edge and panel.

    A rectangle within 2 % of the left or right edge may be part of a panel: it is if it is at least
    85 % high, or if the strip above and below it is still and even.
    """
    r, tolerance = F.col("rect"), round(0.02 * frame_w)
    edge = F.when(r["x"] <= tolerance, "left").when(right(r) >= frame_w - tolerance, "right")
    panel_x = F.when(F.col("edge") == "left", 0).otherwise(r["x"])
    panel_w = F.when(F.col("edge") == "left", right(r)).otherwise(frame_w - r["x"])
    rows = rects.select("title_id", "rect", edge.alias("edge"))
    rows = rows.withColumn("panel", F.struct(panel_x.alias("x"), F.lit(0).alias("y"), panel_w.alias("w"), F.lit(frame_h).alias("h")))
    if stats is not None:
        px = stats.select("title_id", "x", "y", "mean_grey", "temporal_var")
        p, outside = F.col("panel"), (F.col("y") < r["y"]) | (F.col("y") >= bottom(r))
        inside = (F.col("x") >= p["x"]) & (F.col("x") < right(p)) & outside
        strip = rows.where("edge is not null").join(px, "title_id").where(inside)
        means = strip.groupBy("title_id").agg(F.avg("temporal_var").alias("variance"), F.stddev_pop("mean_grey").alias("spread"))
        rows = rows.join(means, "title_id", "left")
    else:
        rows = rows.withColumns({"variance": F.lit(None).cast("double"), "spread": F.lit(None).cast("double")})
    free = frame_h - r["h"]
    even = (free >= 0.05 * frame_h) & (F.col("variance") <= 40.0) & (F.col("spread") <= 12.0)
    side = F.col("edge").isNotNull() & ((r["h"] >= 0.85 * frame_h) | F.coalesce(even, F.lit(False)))
    return rows.select(
        "title_id",
        F.when(side, "side-panel").otherwise("corner-inset").alias("kind"),
        F.when(side, F.col("edge")).alias("edge"),
        F.when(side, F.col("panel")).alias("panel"),
    )


def sobel_detail(stats: DataFrame) -> DataFrame:
    """Gradient magnitude of mean_grey by 3x3 Sobel over a whole image, borders reflected.

    The stencil is separable: differences and sums along rows, then along columns, each by the two neighbours
    of a window (at a border the inner one on both sides).
    """

    def sides(window: Window, c: str) -> tuple[Column, Column]:
        before, after = F.lag(c).over(window), F.lead(c).over(window)
        return F.coalesce(before, after, F.col(c)), F.coalesce(after, before, F.col(c))

    row, column = (Window.partitionBy("title_id", a).orderBy(b) for a, b in (("y", "x"), ("x", "y")))
    left, right_ = sides(row, "mean_grey")
    rows = stats.select("title_id", "x", "y", (right_ - left).alias("step"), (left + 2 * F.col("mean_grey") + right_).alias("soft"))
    above, below = sides(column, "step")
    soft_above, soft_below = sides(column, "soft")
    return rows.select("title_id", "x", "y", F.hypot(above + 2 * F.col("step") + below, soft_below - soft_above).alias("gradient"))


def measure_background(rects: DataFrame, stats: DataFrame, frame_w: int, frame_h: int) -> DataFrame:
    """``rects(title_id, rect)`` with detail (mean gradient), motion (mean variance) and difficulty of what surrounds each.

    The surroundings are the ring a quarter wider without the rectangle; the gradient is taken within the ring.
    A rectangle that fills its ring, and a title without pixels, has 0, 0 and 0.5.
    """
    ringed = rects.select("title_id", "rect", ring(F.col("rect"), F.lit(frame_w), F.lit(frame_h)).alias("ring"))
    px = stats.join(ringed, "title_id")
    within = lambda r: (F.col("x") >= r["x"]) & (F.col("x") < right(r)) & (F.col("y") >= r["y"]) & (F.col("y") < bottom(r))
    px = px.where(within(F.col("ring"))).withColumn("outside", ~within(F.col("rect")))
    px = px.join(sobel_detail(px.select("title_id", "x", "y", "mean_grey")), ["title_id", "x", "y"]).where("outside")
    means = px.groupBy("title_id").agg(F.avg("gradient").alias("detail"), F.avg("temporal_var").alias("motion"))
    rows = rects.join(means, "title_id", "left")
    return rows.withColumns(
        {
            "difficulty": difficulty(F.col("detail"), F.col("motion")),
            "detail": F.coalesce("detail", F.lit(0.0)),
            "motion": F.coalesce("motion", F.lit(0.0)),
        }
    )


def difficulty(detail: Column, motion: Column) -> Column:
    """0 (easy) to 1 (hard) to patch: 0.6 detail over 12 to 36 and 0.4 motion over 8 to 60."""
    share = lambda v, easy, hard: clamp01((v - easy) / (hard - easy))
    return F.coalesce(0.6 * share(detail, 12.0, 36.0) + 0.4 * share(motion, 8.0, 60.0), F.lit(0.5))


def verdict(ok: Column, layout: Column, confidence: Column, hard: Column) -> Column:
    return (
        F.when(~ok, "unusable")
        .when(layout == "side-panel", "excellent")
        .when(confidence < 0.7, "marginal")
        .when(hard < 0.35, "good")
        .when(hard < 0.65, "marginal")
        .otherwise("poor")
    )


VERDICTS = ["excellent", "good", "marginal", "poor", "unusable"]


def verdict_rank(v: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, VERDICTS)), v).cast("int")
