"""Scoring against ground truth, label upserts and text reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuegrid.functions.geometry import contains, iou
from cuegrid.operators.pixels import difficulty, verdict, verdict_rank

PASS_IOU = 0.85


def score_clips(truth: DataFrame, decisions: DataFrame, threshold: float = PASS_IOU) -> DataFrame:
    """``truth(clip, rect, face)`` against ``decisions(clip, found, confidence, error)``.

    A clip without a decision or with an error scores 0.  It passes if the IoU reaches the threshold
    and a given face lies inside what was found.
    """
    rows = truth.join(decisions, "clip", "left")
    usable = F.col("found").isNotNull() & F.col("error").isNull()
    value = F.when(usable, iou(F.col("rect"), F.col("found"))).otherwise(0.0)
    face = F.when(usable & F.col("face").isNotNull(), contains(F.col("found"), F.col("face")))
    out = rows.select("clip", value.alias("iou"), face.alias("face_contained"), "confidence", "error")
    return out.withColumn("passed", (F.col("iou") >= threshold) & F.coalesce("face_contained", F.lit(True)))


def summary(scores: DataFrame) -> DataFrame:
    """clips, passed and mean_iou over all clips, failures included."""
    return scores.agg(F.count("*").alias("clips"), F.count_if("passed").alias("passed"), F.avg("iou").alias("mean_iou"))


def upsert(rows: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``rows`` with all rows of the changed keys replaced by the changes."""
    return rows.join(changes.select(key).distinct(), key, "left_anti").unionByName(changes)


def triage(clips: DataFrame) -> DataFrame:
    """``clips(clip, error, layout, confidence, detail, motion)`` with difficulty, verdict and rank.

    A failed clip is unusable; a side panel needs no patch, so its difficulty is 0.
    """
    ok = F.col("error").isNull()
    hard = F.when(F.col("layout") == "side-panel", 0.0).otherwise(difficulty(F.col("detail"), F.col("motion")))
    rows = clips.withColumn("difficulty", F.when(ok, hard))
    rows = rows.withColumn("verdict", verdict(ok, F.col("layout"), F.col("confidence"), F.col("difficulty")))
    return rows.withColumn("rank", verdict_rank(F.col("verdict")))


def useful(rows: DataFrame) -> DataFrame:
    """How many clips are excellent or good, of how many."""
    return rows.agg(F.count_if(F.col("verdict").isin("excellent", "good")).alias("useful"), F.count("*").alias("clips"))


def triage_line(width: int = 28) -> Column:
    """One line of a fixed-width table of :func:`triage`'s rows."""
    number = lambda c: F.coalesce(F.format_string("%.2f", F.col(c).cast("double")), F.lit("-"))
    return F.concat_ws(
        " ", F.rpad("clip", width, " "), F.rpad("verdict", 10, " "), F.lpad(number("difficulty"), 6, " "), F.lpad(number("confidence"), 6, " ")
    )


def source_skeleton(name: Column, hard: Column) -> Column:
    """A YAML entry for the source list: an id from the file's name and how easy the patch is."""
    stem = F.regexp_replace(F.regexp_extract(name, r"([^/]+?)(\.[^./]*)?$", 1), "[ _]", "-")
    ease = F.when(hard < 0.35, "easy").when(hard < 0.65, "medium").otherwise("hard")
    return F.concat(F.lit("- id: "), F.substring(F.lower(stem), 1, 60), F.lit("\n  title: \n  url: \n  publisher: \n  licence: \n  attribution: \n  notes: "), ease)
