"""One pass over sampled frames: pixel statistics, motion of frames and motion in boxes together.

A frame is a row, its greys an array: ``frames(title_id, frame_idx, width, pixels)``.  What is measured is held as states
(n, mean, m2: how many values, their mean, the sum of squared deviations), which merge in any order, so everything comes
from one aggregate, and states of parts (other tasks, other days) can be merged later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuegrid.functions.text import let

KEYS = ["title_id", "kind", "frame_idx", "box_no", "y", "x"]


def state(values: Column) -> Column:
    """struct(n, mean, m2) of an array of numbers without nulls; mean is null for none."""
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, v: a + v)
    n = F.size(values).cast("long")
    return let(
        F.struct(values.alias("v"), F.try_divide(total(values), n).alias("mean")),
        lambda s: F.struct(
            F.size(s["v"]).cast("long").alias("n"), s["mean"].alias("mean"),
            total(F.transform(s["v"], lambda v: (v - s["mean"]) * (v - s["mean"]))).alias("m2"),
        ),
    )


def merge_states(states: DataFrame, keys: list[str]) -> DataFrame:
    """One state for each key: n, mean and m2 of all values behind the states."""
    n, s = F.sum("n"), F.sum(F.col("n") * F.col("mean"))
    squares = F.sum(F.col("m2") + F.col("n") * F.col("mean") * F.col("mean"))
    merged = states.groupBy(*keys).agg(n.alias("n"), s.alias("s"), squares.alias("q"))
    mean = F.try_divide(F.col("s"), F.col("n"))
    m2 = F.when(F.col("n") > 0, F.greatest(F.lit(0.0), F.col("q") - F.col("s") * mean))
    return merged.select(*keys, "n", mean.alias("mean"), m2.alias("m2"))


def variance(n: Column, m2: Column) -> Column:
    """Of a sample; 0 for a single value."""
    return F.coalesce(F.try_divide(m2, n - 1), F.lit(0.0))


def with_frame_before(frames: DataFrame) -> DataFrame:
    """Adds ``before``: the pixels of the title's frame before, null for its first.

    The window sees numbers only; pixels meet by a join on (title, frame), so no task gathers a title's images.
    """
    number = frames.select("title_id", "frame_idx").withColumn("last", F.lag("frame_idx").over(Window.partitionBy("title_id").orderBy("frame_idx")))
    earlier = frames.select(F.col("title_id").alias("of"), F.col("frame_idx").alias("at"), F.col("pixels").alias("before"))
    rows = frames.join(number, ["title_id", "frame_idx"])
    return rows.join(earlier, (rows["title_id"] == earlier["of"]) & (rows["last"] == earlier["at"]), "left").drop("of", "at", "last")


def box_pixels(values: Column, width: Column, box: Column, upper: float) -> Column:
    """The part of an image (an array by rows) that lies in the upper part of a box."""
    height = F.floor(F.size(values) / width).cast("int")
    clip = lambda v, most: F.least(F.greatest(v.cast("int"), F.lit(0)), most)
    x1, x2 = clip(F.floor(box["x1"]), width), clip(F.ceil(box["x2"]), width)
    y1, y2 = clip(F.floor(box["y1"]), height), clip(F.ceil(box["y1"] + upper * (box["y2"] - box["y1"])), height)
    rows = F.when(y2 > y1, F.sequence(y1, y2 - 1)).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.transform(rows, lambda y: F.slice(values, y * width + x1 + 1, F.greatest(x2 - x1, F.lit(0)))))


def analyse(frames: DataFrame, boxes: DataFrame, upper: float = 0.6) -> DataFrame:
    """(title_id, kind, frame_idx, box_no, y, x, n, mean, m2), in three kinds.

    ``pixel``: greys of each pixel over the title's frames; ``frame``: differences of each frame from the one before (no
    values for the first); ``box``: the same in the upper part of each of ``boxes(title_id, frame_idx, box_no, x1, y1,
    x2, y2)``, null mean where there are none.  Boxes in frames that aren't there are left out.
    """
    listed = boxes.groupBy("title_id", "frame_idx").agg(F.collect_list(F.struct("box_no", "x1", "y1", "x2", "y2")).alias("boxes"))
    rows = with_frame_before(frames).join(listed, ["title_id", "frame_idx"], "left")
    moved = F.zip_with("pixels", "before", lambda a, b: F.abs(a - b).cast("double"))
    rows = rows.withColumn("moved", F.when(F.col("before").isNotNull(), moved).otherwise(F.array().cast("array<double>")))
    no = F.lit(None)

    def item(kind: str, frame: Column, box: Column, y: Column, x: Column, s: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), frame.cast("long").alias("frame_idx"), box.cast("long").alias("box_no"), y.cast("int").alias("y"), x.cast("int").alias("x"),
            s["n"].alias("n"), s["mean"].alias("mean"), s["m2"].alias("m2"),
        )

    width, frame = F.col("width"), F.col("frame_idx")
    one = lambda v: F.struct(F.lit(1).cast("long").alias("n"), v.cast("double").alias("mean"), F.lit(0.0).alias("m2"))
    whole = F.array(item("frame", frame, no, no, no, state(F.col("moved"))))
    # no boxes means an empty moved part for the frame's first
    inside = lambda b: F.when(F.size("moved") > 0, box_pixels(F.col("moved"), width, b, upper)).otherwise(F.col("moved"))
    boxed = F.transform(F.coalesce("boxes", F.array()), lambda b: item("box", frame, b["box_no"], no, no, state(inside(b))))
    each = F.transform("pixels", lambda v, p: item("pixel", no, no, F.floor(p / width), p % width, one(v)))
    return merge_states(rows.select("title_id", F.inline(F.concat(whole, boxed, each))), KEYS)


def pixel_table(analysis: DataFrame) -> DataFrame:
    """The analysis as ``pixel_stats(title_id, y, x, mean_grey, temporal_var, frames)``."""
    rows = analysis.where("kind = 'pixel'")
    return rows.select("title_id", "y", "x", F.col("mean").alias("mean_grey"), variance(F.col("n"), F.col("m2")).alias("temporal_var"), F.col("n").alias("frames"))


def frame_table(analysis: DataFrame) -> DataFrame:
    """The analysis as ``frames(title_id, frame_idx, frame_motion)``."""
    return analysis.where("kind = 'frame'").select("title_id", "frame_idx", F.col("mean").alias("frame_motion"))


def with_box_motion(boxes: DataFrame, analysis: DataFrame) -> DataFrame:
    """``boxes`` with their motion."""
    motion = analysis.where("kind = 'box'").select("title_id", "frame_idx", "box_no", F.col("mean").alias("motion"))
    return boxes.join(motion, ["title_id", "frame_idx", "box_no"], "left")
