"""From detections to a decision about the signer's window, and on to a manifest.

A decision has title_id, rect and panel (pixels of the video), rect_sample (of the sampled frames), kind,
edge, method, confidence and error; titles without a signer have only an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuegrid.functions import geometry as g
from cuegrid.operators import analysis, detections, manifests, pixels

MARGIN = 0.03


def decide(frames: DataFrame, boxes: DataFrame, stats: DataFrame, videos: DataFrame, frame_w: int, frame_h: int, grow: bool = True) -> DataFrame:
    """Decisions of ``videos(title_id, width, height)`` from detections in sampled frames of frame_w by frame_h.

    Tracks, their features, the choice of the signer, the constant rectangle, its growth over still
    background with a margin, the layout of the grown window, and everything scaled to the video.
    """
    tracks = detections.cluster_detections(boxes)
    features = detections.cluster_features(tracks, frames, frame_w, frame_h)
    chosen = detections.choose_signer(features, videos)
    own = tracks.join(chosen.where("cluster_id is not null").select("title_id", "cluster_id"), ["title_id", "cluster_id"])
    windows = detections.fixed_rect(own, frame_w, frame_h)
    if grow:
        grown = pixels.grow_windows(windows.select("title_id", "rect.*"), stats, size=(frame_w, frame_h))
        padded = g.pad_rect(g.rect(*(F.col(c) for c in "xywh")), MARGIN, F.lit(frame_w), F.lit(frame_h))
        windows = grown.select("title_id", padded.alias("rect"))
    layouts = pixels.classify_layout(windows, stats, frame_w, frame_h)
    rows = videos.join(chosen, "title_id").join(windows, "title_id", "left").join(layouts, "title_id", "left")
    k = F.col("width") / frame_w
    to_video = lambda c: F.when(F.col(c).isNotNull(), g.scale_rect(F.col(c), k, F.col("width"), F.col("height")))
    return rows.select(
        "title_id", to_video("rect").alias("rect"), F.col("rect").alias("rect_sample"), "kind", "edge", to_video("panel").alias("panel"),
        F.when(F.col("rect").isNotNull(), "detected-crop").alias("method"), "confidence", "error",
    )


def analyse_and_decide(frames: DataFrame, boxes: DataFrame, videos: DataFrame, frame_w: int, frame_h: int, grow: bool = True) -> DataFrame:
    """Decisions straight from sampled frames and the boxes found in them: one pass over the frames, then :func:`decide`.

    ``frames(title_id, frame_idx, width, pixels)``, ``boxes(title_id, frame_idx, box_no, x1, y1, x2, y2)``.
    """
    found = analysis.analyse(frames, boxes)
    return decide(analysis.frame_table(found), analysis.with_box_motion(boxes, found), analysis.pixel_table(found), videos, frame_w, frame_h, grow)


def publish(decisions: DataFrame, titles: DataFrame, language: str, label: str, track_url: Column, captions: DataFrame | None = None) -> DataFrame:
    """(title_id, json): the manifests of the titles that have a window.

    ``titles(title_id, id, title, durationMs, source, video)`` as :func:`manifests.build_manifests` takes them.
    """
    good = decisions.where("error is null and rect is not null")
    track = signed_track(F.lit(language), F.lit(label), track_url, F.lit("none"))
    tracks = good.select("title_id", F.lit(0).alias("nth"), track.alias("track"))
    return manifests.build_manifests(titles.join(good.select("title_id"), "title_id", "left_semi"), tracks, captions)


def manual_decisions(entries: DataFrame) -> DataFrame:
    """Decisions of ``entries(title_id, rect, layout, width, height)`` that people measured: certain, corner-inset unless said otherwise.

    A side panel is on the side that the rectangle is nearer to (left if as near), full height.
    """
    r, side = F.col("rect"), F.col("layout") == "side-panel"
    left = r["x"] <= F.col("width") - g.right(r)
    whole = lambda x, w: g.rect(x, F.lit(0), w, F.col("height"))
    panel = F.when(left, whole(F.lit(0), g.right(r))).otherwise(whole(r["x"], F.col("width") - r["x"]))
    return entries.select(
        "title_id", "rect", F.col("rect").alias("rect_sample"), F.coalesce("layout", F.lit("corner-inset")).alias("kind"),
        F.when(side, F.when(left, "left").otherwise("right")).alias("edge"), F.when(side, panel).alias("panel"),
        F.lit("manual-crop").alias("method"), F.lit(1.0).alias("confidence"), F.lit(None).cast("string").alias("error"),
    )


def main_picture(measured: Column, keep: Column, signer: Column, frame_w: Column, frame_h: Column) -> Column:
    """struct(rect, error): what remains the programme, a measured rectangle or else what the panel leaves.

    A measured rectangle must lie in the frame and clear of the signer.
    """
    frame = g.rect(F.lit(0), F.lit(0), frame_w, frame_h)
    error = F.when(~g.contains(frame, measured), "main rectangle outside the frame").when(g.iou(measured, signer) > 0, "main rectangle overlaps the signer")
    none = F.lit(None).cast("string")
    rect = F.when(measured.isNull(), keep).when(error.isNull(), measured)
    return F.struct(rect.alias("rect"), F.when(measured.isNotNull(), error).otherwise(none).alias("error"))


def crop_motion(grey: DataFrame, decisions: DataFrame, scale: float, upper: float = 0.6) -> DataFrame:
    """(title_id, frame_idx, motion) in the upper part of each title's window, scaled to the sampled frames."""
    r = F.col("rect")
    edges = {"x1": r["x"] * scale, "y1": r["y"] * scale, "x2": g.right(r) * scale, "y2": g.bottom(r) * scale}
    window = decisions.where("rect is not null").select("title_id", F.lit(0).cast("long").alias("box_no"), *(v.cast("double").alias(c) for c, v in edges.items()))
    boxes = grey.select("title_id", "frame_idx").distinct().join(window, "title_id")
    return pixels.box_motion(grey, boxes, upper).drop("box_no")


def signed_track(language: Column, label: Column, url: Column, fill: Column) -> Column:
    """The manifest's track of a decision (its columns) cut from the video."""
    extraction = F.struct(
        F.col("method").alias("method"), F.col("kind").alias("sourceLayout"), F.bround("confidence", 4).alias("confidence"), F.col("rect").alias("cropRect"), fill.alias("fillMethod")
    )
    size = lambda c: g.even(F.col("rect")[c]).alias("width" if c == "w" else "height")
    track = F.struct(url.alias("url"), size("w"), size("h"), F.lit("h264").alias("codec"), F.lit(0).alias("syncOffsetMs"))
    return F.struct(
        language.alias("language"), label.alias("languageLabel"), F.lit("human-interpreter").alias("provenance"), extraction.alias("extraction"), track.alias("track")
    )
