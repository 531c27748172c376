"""Rows as they are written out, and lines of fixed-width tables.

Numbers are scaled, rounded (halves to even) and scaled back; what isn't known stays null in rows and is a dash in lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuegrid.functions.numbers import half_even

# The decimals of written numbers by their names in the engine and on the wire.
CLUSTER = {
    "persistence": ("persistence", 4), "centre_std": ("centreStdNorm", 5), "stability": ("stability", 4), "size_frac": ("sizeFrac", 4),
    "motion_ratio": ("motionRatio", 3), "motion_score": ("motionScore", 4), "score": ("score", 4),
}
TRIAGE = {
    "duration_s": ("durationS", 1), "confidence": ("confidence", 3), "size_frac": ("sizeFrac", 3), "detail": ("backgroundDetail", 1),
    "motion": ("backgroundMotion", 1), "difficulty": ("fillDifficulty", 3),
}
SCORE = {"iou": ("iou", 4), "confidence": ("confidence", 4), "seconds": ("seconds", 1)}


def _rounded(names: dict[str, tuple[str, int]]) -> list[Column]:
    return [half_even(c, digits).alias(name) for c, (name, digits) in names.items()]


def cluster_rows(features: DataFrame) -> DataFrame:
    """title_id and the written members of each cluster's features."""
    return features.select(
        "title_id", F.col("cluster_id").alias("clusterId"), F.col("n_boxes").alias("frames"), *_rounded(CLUSTER), "eligible", "reason",
        F.transform("mean_box", lambda v: half_even(v, 1)).alias("meanBox"),
    )


def triage_rows(clips: DataFrame) -> DataFrame:
    """The written members of each triaged clip, resolution as ``WxH``; zeros of failed clips' measures as they are."""
    size = F.when(F.col("width") > 0, F.concat_ws("x", "width", "height"))
    return clips.select("clip", "verdict", "layout", "edge", "rect", size.alias("resolution"), *_rounded(TRIAGE), "error")


def score_rows(scores: DataFrame) -> DataFrame:
    """The written members of each clip's score."""
    return scores.select("clip", "passed", F.col("face_contained").alias("faceContained"), "layout", *_rounded(SCORE), "error")


def activity_rows(track: DataFrame, interval_ms: int) -> DataFrame:
    """title_id, intervalMs, scale, length, p95, idleFraction of a normalised track (see activity.normalise)."""
    idle = F.avg(F.when(F.col("level") < 20, 1.0).otherwise(0.0))
    return track.groupBy("title_id").agg(
        F.lit(interval_ms).alias("intervalMs"), F.lit("title-p95").alias("scale"), F.count("*").alias("length"),
        half_even(F.max("top"), 3).alias("p95"), half_even(idle, 3).alias("idleFraction"),
    )


def generated_by(kind: str, model: Column) -> Column:
    """Who made a text: the recogniser (``speech``) or the rewriter (``rewrite``) of this model (fixed values)."""
    return F.concat(F.lit({"speech": "faster-whisper-", "rewrite": "amazon-bedrock:"}[kind]), model)


def left(text: Column, width: int) -> Column:
    """At the left of a field; longer texts stay whole."""
    return F.when(F.length(text) < width, F.rpad(text, width, " ")).otherwise(text)


def right(text: Column, width: int) -> Column:
    return F.when(F.length(text) < width, F.lpad(text, width, " ")).otherwise(text)


def fixed(value: Column, digits: int, width: int) -> Column:
    """A number with so many decimals at the right of a field; a dash for null."""
    text = half_even(value.cast("double"), digits).cast(f"decimal(38,{digits})").cast("string")
    return right(F.coalesce(text, F.lit("-")), width)


def _line(*parts: Column) -> Column:
    return F.concat(*(x for k, p in enumerate(parts) for x in ([F.lit(" ")] if k else []) + [p]))


CLUSTER_HEAD = f"{'':2}{'id':>3} {'frames':>6} {'persist':>7} {'stable':>6} {'size':>5} {'motion×':>7} {'score':>5}  reason"


def cluster_lines(ranked: DataFrame, chosen: DataFrame) -> DataFrame:
    """(title_id, rank, line) of ranked clusters; a star marks the one of ``chosen(title_id, cluster_id)``."""
    rows = ranked.join(chosen.select("title_id", F.col("cluster_id").alias("chosen")), "title_id", "left")
    c = F.col
    mark = F.when(c("cluster_id") == c("chosen"), "* ").otherwise("  ")
    motion = F.when(c("motion_ratio").isNull(), "   n/a").otherwise(fixed(c("motion_ratio"), 2, 7))
    line = _line(
        F.concat(mark, right(c("cluster_id").cast("string"), 3)), right(c("n_boxes").cast("string"), 6), fixed(c("persistence"), 2, 7), fixed(c("stability"), 2, 6),
        fixed(c("size_frac"), 2, 5), motion, F.concat(fixed(c("score"), 2, 5), F.lit("  "), c("reason")),
    )
    return rows.select("title_id", "rank", line.alias("line"))


TRIAGE_HEAD = f"{'clip':30} {'verdict':10} {'layout':13} {'fill':>5} {'conf':>5} {'size':>5} {'detail':>7} {'motion':>7} {'dur':>6}"


def triage_lines(clips: DataFrame) -> DataFrame:
    """(clip, place, line): the table's lines, best verdict and easiest fill first; a failed clip has its error."""
    c = F.col
    name = F.rpad(F.regexp_extract(c("clip").cast("string"), "([^/]*)$", 1), 30, " ")
    layout = F.concat(F.coalesce("layout", F.lit("")), F.coalesce(F.concat(F.lit("/"), c("edge")), F.lit("")))
    whole = _line(
        name, left(c("verdict"), 10), left(layout, 13), fixed(c("difficulty"), 2, 5), fixed(c("confidence"), 2, 5), fixed(c("size_frac"), 2, 5),
        fixed(c("detail"), 1, 7), fixed(c("motion"), 1, 7), F.concat(fixed(c("duration_s"), 0, 6), F.lit("s")),
    )
    failed = _line(name, left(F.lit("unusable"), 10), F.coalesce("error", F.lit("")))
    order = Window.orderBy("rank", F.coalesce("difficulty", F.lit(0.0)), "clip")
    return clips.select("clip", F.row_number().over(order).alias("place"), F.when(c("error").isNull(), whole).otherwise(failed).alias("line"))


SCORE_HEAD = f"{'clip':40} {'iou':>6} {'pass':>5} {'face':>5} {'conf':>5} {'layout':13} {'s':>6}"


def score_lines(scores: DataFrame) -> DataFrame:
    """(clip, line) of scored clips ``(clip, iou, passed, face_contained, confidence, layout, seconds, error)``."""
    c, name = F.col, F.col("clip").cast("string")
    short = F.when(F.length(name) <= 40, name).otherwise(F.concat(F.lit("…"), F.substring(name, -39, 39)))
    face = F.when(c("face_contained").isNull(), "-").when(c("face_contained"), "yes").otherwise("NO")
    line = _line(
        left(short, 40), fixed(c("iou"), 3, 6), right(F.when(c("passed"), "ok").otherwise("FAIL"), 5), right(face, 5), fixed(c("confidence"), 2, 5),
        left(F.coalesce("layout", F.lit("-")), 13), F.concat(fixed(c("seconds"), 1, 6), F.coalesce(F.concat(F.lit("  "), c("error")), F.lit(""))),
    )
    return scores.select("clip", line.alias("line"))
