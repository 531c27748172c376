"""Person tracks from detections.

Tables: ``frames(title_id, frame_idx, frame_motion)`` and ``detections(title_id, frame_idx, box_no,
x1, y1, x2, y2, motion)``; null motion means "no measurement".
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuegrid.functions.geometry import box_area, clamp01, even, rect

CLUSTERED = (
    "title_id long, frame_idx long, box_no long, x1 double, y1 double, x2 double, y2 double, motion double, cluster_id int"
)


def sample_frames(frames: DataFrame, every: int, number: str = "frame_idx") -> DataFrame:
    """Every ``every``-th frame by its number, from 0."""
    if every < 1:
        raise ValueError("every must be at least 1")
    return frames.where(F.col(number) % every == 0)


class OpenClusters:
    """The open clusters of one title: their boxes in order of creation, in a buffer that doubles."""

    def __init__(self, boxes: np.ndarray | None = None) -> None:
        self.n = 0 if boxes is None else len(boxes)
        self.held = np.empty((max(64, self.n), 4))
        if self.n:
            self.held[: self.n] = boxes

    @classmethod
    def within(cls, held: np.ndarray, n: int) -> OpenClusters:
        """The first ``n`` boxes of a buffer, which is filled further."""
        made = cls.__new__(cls)
        made.held, made.n = held, n
        return made

    @property
    def boxes(self) -> np.ndarray:
        return self.held[: self.n]

    def take_one(self, own: np.ndarray, min_iou: float, smoothing: float) -> int:
        """:meth:`take` for a frame of one box, as most are: the same numbers, by columns."""
        best = -1
        if self.n:
            means = self.boxes
            x1, y1, x2, y2 = own.tolist()
            low_x, low_y, high_x, high_y = means.T
            size = (high_x - low_x).clip(0) * (high_y - low_y).clip(0)
            common = (np.minimum(high_x, x2) - np.maximum(low_x, x1)).clip(0)
            common *= (np.minimum(high_y, y2) - np.maximum(low_y, y1)).clip(0)
            wide, high = x2 - x1, y2 - y1
            union = (0.0 if wide < 0 else wide) * (0.0 if high < 0 else high) + size - common
            overlap = np.divide(common, union, out=np.zeros(self.n), where=union > 0)
            last = self.n - 1 - int(overlap[::-1].argmax())
            if overlap[last] >= min_iou:
                best = last
                means[best] += smoothing * (own - means[best])
        if best < 0:
            best = self.add(own)
        return best

    def add(self, box: np.ndarray) -> int:
        """The number of the new cluster that the box opens."""
        if self.n == len(self.held):
            self.held = np.concatenate([self.held, np.empty_like(self.held)])
        self.held[self.n] = box
        self.n += 1
        return self.n - 1

    def take(self, own: np.ndarray, min_iou: float, smoothing: float) -> np.ndarray:
        """The clusters that a frame's boxes (in the order of their numbers) go to, best overlap first; the rest open new ones."""
        means, found = self.boxes, np.full(len(own), -1, np.int32)
        if self.n:
            low = np.maximum(own[:, None, :2], means[None, :, :2])
            high = np.minimum(own[:, None, 2:], means[None, :, 2:])
            common = np.prod(np.maximum(high - low, 0), axis=2)
            size = lambda b: np.prod(np.maximum(b[:, 2:] - b[:, :2], 0), axis=1)
            union = size(own)[:, None] + size(means)[None, :] - common
            overlap = np.divide(common, union, out=np.zeros_like(common), where=union > 0)
            taken: set[int] = set()
            for _, b, c in sorted(((overlap[b, c], b, c) for b, c in np.argwhere(overlap >= min_iou)), reverse=True):
                if found[b] < 0 and c not in taken:
                    taken.add(c)
                    found[b] = c
                    means[c] += smoothing * (own[b] - means[c])
        for b in np.flatnonzero(found < 0):
            found[b] = self.add(own[b])
        return found


def track_rows(boxes: np.ndarray, edges: list[int], clusters: OpenClusters, min_iou: float, smoothing: float) -> np.ndarray:
    """The clusters that one title's boxes go to; frames begin at ``edges`` (the last one ends them)."""
    found = np.empty(len(boxes), np.int32)
    for at, to in zip(edges, edges[1:]):
        if to - at == 1:
            found[at] = clusters.take_one(boxes[at], min_iou, smoothing)
        else:
            found[at:to] = clusters.take(boxes[at:to], min_iou, smoothing)
    return found


def track_frames(pdf: pd.DataFrame, clusters: OpenClusters, min_iou: float, smoothing: float) -> pd.DataFrame:
    """One title's boxes, frame by frame in order, with the clusters they go to."""
    pdf = pdf.sort_values(["frame_idx", "box_no"], kind="stable").reset_index(drop=True)
    frame = pdf["frame_idx"].to_numpy()
    edges = np.flatnonzero(np.r_[True, frame[1:] != frame[:-1], True]).tolist() if len(pdf) else []
    return pdf.assign(cluster_id=track_rows(pdf[["x1", "y1", "x2", "y2"]].to_numpy(float), edges, clusters, min_iou, smoothing))


# Rows that are tracked at a time, tracks that are followed side by side, and the most boxes of their frames.
BLOCK, ABREAST, CROWD = 1 << 17, 512, 8


def track_abreast(boxes: np.ndarray, edges: np.ndarray, first: np.ndarray, count: np.ndarray, found: np.ndarray, min_iou: float, smoothing: float) -> None:
    """Fills ``found`` as :func:`track_rows` does it, for tracks side by side: a step takes the next frame of each.

    A track's frames are ``count`` from ``first`` on (places in ``edges``), the longest track comes first, so tracks that go on are
    the first ones.  Clusters fill their rows from the right: of equal overlaps the first is the last cluster's.
    Places without a cluster hold an empty box, which overlaps nothing.
    """
    n, held, areas = np.zeros(len(first), np.int64), np.zeros((4, len(first), 0)), np.zeros((len(first), 0))
    last = np.searchsorted(-count, -np.arange(count[0]), "left")
    for step, going in enumerate(last.tolist()):
        at = edges[first[:going] + step]
        sizes = edges[first[:going] + step + 1] - at
        most, crowd = int(n[:going].max()), int(sizes.max())
        room = held.shape[2]
        if most + crowd > room:
            more = 2 * (most + crowd) + 6 - room
            held, areas = np.pad(held[:, :going], ((0, 0), (0, 0), (more, 0))), np.pad(areas[:going], ((0, 0), (more, 0)))
            room += more
        own, used = boxes[:, at], room - max(most, 1)
        size = np.maximum(own[2] - own[0], 0) * np.maximum(own[3] - own[1], 0)
        low_x, low_y, high_x, high_y = held[:, :going, used:]
        x1, y1, x2, y2 = own[:, :, None]
        overlap, high = np.minimum(high_x, x2), np.minimum(high_y, y2)
        overlap -= np.maximum(low_x, x1)
        high -= np.maximum(low_y, y1)
        np.maximum(overlap, 0, out=overlap)
        np.maximum(high, 0, out=high)
        overlap *= high
        union = np.add(areas[:going, used:], size[:, None], out=high)
        union -= overlap
        with np.errstate(divide="ignore", invalid="ignore"):
            overlap /= union
        if not union.min() > 0:
            overlap[~(union > 0)] = 0
        rows, best = np.arange(going), overlap.argmax(axis=1)
        fits, place = overlap[rows, best] >= min_iou, best + used
        if crowd > 1:
            crowded = np.flatnonzero(sizes > 1)
            rows = np.flatnonzero(sizes == 1)
            at, own, fits, place = at[rows], own[:, rows], fits[rows], place[rows]
        place = np.where(fits, place, room - 1 - n[rows])
        means = held[:, rows, place]
        means = np.where(fits, means + smoothing * (own - means), own)
        held[:, rows, place] = means
        areas[rows, place] = np.maximum(means[2] - means[0], 0) * np.maximum(means[3] - means[1], 0)
        n[rows] += ~fits
        found[at] = room - 1 - place
        if crowd > 1:
            for k in crowded.tolist():
                clusters = OpenClusters.within(held[:, k, ::-1].T, int(n[k]))
                begin, end = edges[first[k] + step], edges[first[k] + step + 1]
                found[begin:end] = clusters.take(boxes[:, begin:end].T, min_iou, smoothing)
                n[k] = clusters.n
                areas[k] = np.maximum(held[2, k] - held[0, k], 0) * np.maximum(held[3, k] - held[1, k], 0)


def _changes(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Whether a whole number differs from that of the row before, and whether it is null."""
    column = table[name].combine_chunks()
    null, values = column.is_null().to_numpy(zero_copy_only=False), column.fill_null(0).to_numpy(zero_copy_only=False)
    return np.r_[True, (values[1:] != values[:-1]) | (null[1:] != null[:-1])], null


def track_sorted(batches: Iterable[pa.RecordBatch], keys: tuple[str, ...], min_iou: float, smoothing: float) -> Iterator[pa.RecordBatch]:
    """Tracks of boxes that come sorted by keys, frame_idx and box_no (nulls of these two last): a track a key, blocks of rows at a time.

    Adds ``own``, the number of a row's cluster within its track, and ``first_frame`` and ``first_box``, those of the box that opened it.
    A block ends with a track; a track of more rows than a block goes on frame by frame with its open clusters.
    """
    waiting: list[pa.RecordBatch] = []
    going: OpenClusters | None = None
    openers: pa.Table | None = None
    batches = iter(batches)
    more = True
    while more:
        batch = next(batches, None)
        more = batch is not None
        if more:
            waiting.append(batch)
        rows = sum(b.num_rows for b in waiting)
        if rows == 0 or (more and rows < BLOCK):
            continue
        table = pa.Table.from_batches(waiting)
        frame, no_frame = _changes(table, "frame_idx")
        track = np.logical_or.reduce([_changes(table, k)[0] for k in keys])
        starts, edges = np.flatnonzero(track), np.flatnonzero(track | frame | no_frame)
        cut, within = rows, False
        if more:
            within = len(starts) == 1
            cut = int(edges[-1] if within else starts[-1])
            if cut == 0:
                continue
        waiting = [b for b in table.slice(cut).to_batches() if b.num_rows]
        table, starts, edges = table.slice(0, cut), starts[starts < cut], np.r_[edges[edges < cut], cut]
        boxes = np.stack([table[c].to_numpy() for c in ("x1", "y1", "x2", "y2")])
        found = np.empty(cut, np.int32)
        first = np.searchsorted(edges, starts)
        count = np.diff(np.r_[first, len(edges) - 1])
        alone = np.maximum.reduceat(np.diff(edges), first) > CROWD
        known = 0 if going is None else going.n
        alone[0] |= within or going is not None
        for k in np.flatnonzero(alone).tolist():
            clusters = going if k == 0 and going is not None else OpenClusters()
            mine = edges[first[k] : first[k] + count[k] + 1]
            found[mine[0] : mine[-1]] = track_rows(boxes[:, mine[0] : mine[-1]].T, (mine - mine[0]).tolist(), clusters, min_iou, smoothing)
            if k == 0:
                going = clusters
        order = np.flatnonzero(~alone)
        order = order[np.argsort(-count[order], kind="stable")]
        for at in range(0, len(order), ABREAST):
            some = order[at : at + ABREAST]
            track_abreast(boxes, edges, first[some], count[some], found, min_iou, smoothing)
        # the row that opened each row's cluster, those of the track that goes on before the block's
        length = np.diff(np.r_[starts, cut])
        _, opened, which = np.unique(np.repeat(np.arange(len(starts)) << 32, length) + found, return_index=True, return_inverse=True)
        opener = opened[which] + known
        if known:
            opener[: length[0]] = np.where(found[: length[0]] < known, found[: length[0]], opener[: length[0]])
        pool = table.select(["frame_idx", "box_no"])
        pool = pool if openers is None else pa.concat_tables([openers, pool])
        firsts = pool.take(pa.array(opener))
        if within:
            fresh = opened[found[opened] >= known] + known
            openers = pool.take(pa.array(np.r_[np.arange(known), fresh]))
        else:
            going = openers = None
        made = table.append_column("own", pa.array(found)).append_column("first_frame", firsts["frame_idx"]).append_column("first_box", firsts["box_no"])
        yield from made.combine_chunks().to_batches()


def detection_rows(detections: DataFrame) -> DataFrame:
    columns = ["title_id", "frame_idx", "box_no", "x1", "y1", "x2", "y2", "motion"]
    kinds = {"title_id": "long", "frame_idx": "long", "box_no": "long"}
    return detections.select(*(F.col(c).cast(kinds.get(c, "double")).alias(c) for c in columns))


def _overlap_cuts(boxes: DataFrame, rounds: int) -> tuple[DataFrame, list[str]]:
    """The boxes with a column a cut, and the columns' names: parts are the same in all of them (see :func:`overlap_groups`)."""
    rows, cuts = boxes, []
    for low, high in [("x1", "x2"), ("y1", "y2")] * rounds:
        order = Window.partitionBy("title_id", *cuts).orderBy(F.col(low).asc_nulls_first())
        reached = F.max(high).over(order.rowsBetween(Window.unboundedPreceding, -1))
        rows = rows.withColumn("free", F.coalesce(F.col(low) >= reached, F.lit(False)).cast("long"))
        rows = rows.withColumn(f"cut_{len(cuts)}", F.sum("free").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        cuts.append(f"cut_{len(cuts)}")
    return rows.drop("free"), cuts


def overlap_groups(boxes: DataFrame, rounds: int = 1) -> DataFrame:
    """Adds ``part``: boxes of a title in different parts are apart, and so is all that lies between boxes of one part.

    Each round cuts a part where no box covers a place, from left to right and then from top to bottom (running
    ends over a window), so the parts' bounding boxes don't overlap.
    """
    rows, cuts = _overlap_cuts(boxes, rounds)
    return rows.withColumn("part", F.array(*cuts)).drop(*cuts)


def cluster_detections(detections: DataFrame, min_iou: float = 0.3, smoothing: float = 0.2) -> DataFrame:
    """Greedy tracking: adds cluster_id, in order of creation within a title.

    Frames in order; every box and open cluster with an IoU of at least ``min_iou`` (above 0) is a candidate,
    taken best first (ties: higher box, then higher cluster) if both are free; a cluster's box moves
    towards what it takes; boxes left over open clusters.

    A cluster's box stays within its boxes' bounds, so parts of the picture that no box joins (:func:`overlap_groups`) don't touch each
    other: each part of a title is a track of its own, sequential in itself, and clusters are numbered by their
    first boxes afterwards.  Tracks are sorted within Spark's partitions and followed side by side (:func:`track_sorted`), blocks of rows at a
    time.  cuegrid.streaming.tracking tracks titles that grow, with the open clusters as its only state.
    """
    rows, cuts = _overlap_cuts(detection_rows(detections), 1)
    keys, columns = ("title_id", *cuts), [c.split()[0] for c in CLUSTERED.split(", ")]
    tracks = rows.repartition(*keys).sortWithinPartitions(*keys, F.col("frame_idx").asc_nulls_last(), F.col("box_no").asc_nulls_last())
    names = rows.columns
    kinds = ", ".join([*(f"{c} {rows.schema[c].dataType.simpleString()}" for c in names), "own int, first_frame long, first_box long"])
    found = tracks.mapInArrow(lambda batches: track_sorted(batches, keys, min_iou, smoothing), kinds)
    opened = Window.partitionBy("title_id").orderBy(F.col("first_frame").asc_nulls_last(), F.col("first_box").asc_nulls_last(), *cuts, "own")
    return found.withColumn("cluster_id", F.dense_rank().over(opened) - 1).select(*columns)


def cluster_features(clustered: DataFrame, frames: DataFrame, frame_w: int, frame_h: int) -> DataFrame:
    """One row a cluster: persistence, stability, size and motion scores, eligibility and reasons."""
    sampled = frames.groupBy("title_id").agg(F.count("*").alias("n_frames"))
    seen = clustered.join(frames.select("title_id", "frame_idx", "frame_motion"), ["title_id", "frame_idx"], "left")
    cx, cy = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    width = F.greatest(F.col("x2") - F.col("x1"), F.lit(0.0))
    grouped = seen.groupBy("title_id", "cluster_id").agg(
        F.count("*").alias("n_boxes"),
        F.stddev_pop(cx).alias("sx"),
        F.stddev_pop(cy).alias("sy"),
        F.median(width).alias("w"),
        F.avg("motion").alias("box_motion"),
        F.avg("frame_motion").alias("all_motion"),
        F.array(*map(F.avg, ("x1", "y1", "x2", "y2"))).alias("mean_box"),
    )
    diagonal = float(np.hypot(frame_w, frame_h))
    f = grouped.join(sampled, "title_id").select(
        "title_id",
        "cluster_id",
        "n_boxes",
        "mean_box",
        F.coalesce(F.try_divide(F.col("n_boxes"), F.col("n_frames")), F.lit(0.0)).alias("persistence"),
        F.when(F.col("n_boxes") > 1, F.hypot("sx", "sy") / diagonal).otherwise(0.0).alias("centre_std"),
        (F.col("w") / frame_w if frame_w else F.lit(1.0)).alias("size_frac"),
        (F.col("box_motion") / F.greatest("all_motion", F.lit(1e-3))).alias("motion_ratio"),
    )
    f = f.withColumns(
        {
            "motion_ratio": F.when(F.col("motion_ratio").isNotNull(), F.col("motion_ratio")),
            "stability": clamp01(1 - (F.col("centre_std") - 0.01) / 0.05),
            "size_score": clamp01(1 - F.col("size_frac") / 0.45),
            "motion_score": F.coalesce(clamp01(F.col("motion_ratio") / 3), F.lit(0.0)),
        }
    )
    reasons = F.concat_ws(
        "; ",
        F.when(F.col("persistence") < 0.5, "too brief"),
        F.when(F.col("size_frac") > 0.45, "too large"),
    )
    return f.withColumns(
        {
            "score": 0.4 * F.col("motion_score") + 0.25 * F.col("persistence") + 0.25 * F.col("stability") + 0.1 * F.col("size_score"),
            "confidence": clamp01(0.4 * F.col("persistence") + 0.3 * F.col("stability") + 0.3 * F.col("motion_score")),
            "eligible": (F.col("persistence") >= 0.5) & (F.col("size_frac") <= 0.45),
            "reason": F.when(reasons == "", "ok").otherwise(reasons),
        }
    )


def rank_clusters(features: DataFrame) -> DataFrame:
    """Adds rank within the title: eligible first, then score, then order of creation."""
    order = Window.partitionBy("title_id").orderBy(F.desc("eligible"), F.desc("score"), F.asc("cluster_id"))
    return features.withColumn("rank", F.row_number().over(order))


def choose_signer(features: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """The best eligible cluster of each title; a title without one has an error instead.

    With ``titles(title_id)`` titles without any cluster have theirs too.
    """
    best = rank_clusters(features).where("rank = 1")
    chosen = best.select(
        "title_id",
        F.when(F.col("eligible"), F.col("cluster_id")).alias("cluster_id"),
        F.when(F.col("eligible"), F.col("confidence")).alias("confidence"),
        F.when(~F.col("eligible"), F.lit("no eligible person")).alias("error"),
    )
    if titles is None:
        return chosen
    rows = titles.select("title_id").distinct().join(chosen, "title_id", "left")
    return rows.withColumn("error", F.when(F.col("cluster_id").isNull(), F.coalesce("error", F.lit("no person"))))


def fixed_rect(boxes: DataFrame, frame_w: int, frame_h: int, low: float = 0.05, high: float = 0.95, pad: float = 0.08) -> DataFrame:
    """(title_id, rect): a constant rectangle about the boxes' 5th to 95th percentiles, padded, even."""
    edges = boxes.groupBy("title_id").agg(
        F.percentile("x1", F.lit(low)).alias("x1"),
        F.percentile("y1", F.lit(low)).alias("y1"),
        F.percentile("x2", F.lit(high)).alias("x2"),
        F.percentile("y2", F.lit(high)).alias("y2"),
    )

    def side(lo: str, hi: str, limit: int) -> tuple[Column, Column]:
        size = F.greatest(F.col(hi) - F.col(lo), F.lit(1.0))
        start = F.greatest(even(F.floor(F.col(lo) - size * pad).cast("int")), F.lit(0))
        end = F.least(F.lit(limit), F.ceil(F.col(hi) + size * pad).cast("int"))
        length = F.greatest(even(end - start), F.lit(2))
        length = F.when(start + length > limit, even(limit - start)).otherwise(length)
        return start, F.greatest(length, F.lit(2))

    (x, w), (y, h) = side("x1", "x2", frame_w), side("y1", "y2", frame_h)
    return edges.select("title_id", rect(x, y, w, h).alias("rect"))


def iou_candidates(detections: DataFrame, min_iou: float = 0.3) -> DataFrame:
    """Pairs of boxes of one frame that overlap enough: an equi-join on the frame with a residual."""
    a = detections.select("title_id", "frame_idx", F.col("box_no").alias("a"), F.struct("x1", "y1", "x2", "y2").alias("p"))
    b = detections.select("title_id", "frame_idx", F.col("box_no").alias("b"), F.struct("x1", "y1", "x2", "y2").alias("q"))
    from cuegrid.functions.geometry import box_iou

    pairs = a.join(b, ["title_id", "frame_idx"]).where("a < b")
    return pairs.withColumn("iou", box_iou(F.col("p"), F.col("q"))).where(F.col("iou") >= min_iou).drop("p", "q")


def decode_anchors(anchors: DataFrame, size: int) -> DataFrame:
    """Raw predictions ``anchors(title_id, frame_idx, anchor, p)`` to centres, sizes and a score.

    Anchors run row by row over the grids of stride 8, 16 and 32; p holds dx, dy, log w, log h,
    objectness and the person class first.
    """
    place = anchors
    first, stride, base = F.lit(0), None, None
    start = 0
    for step in (8, 16, 32):
        cells = (size // step) ** 2
        inside = (F.col("anchor") >= start) & (F.col("anchor") < start + cells)
        stride = F.when(inside, step) if stride is None else stride.when(inside, step)
        base = F.when(inside, start) if base is None else base.when(inside, start)
        start += cells
    del first
    place = place.withColumn("stride", stride).withColumn("cell", F.col("anchor") - base)
    side = F.lit(size) / F.col("stride")
    p = lambda i: F.element_at("p", i + 1).cast("double")
    return place.where("stride is not null").select(
        "title_id",
        "frame_idx",
        "anchor",
        ((p(0) + F.col("cell") % side) * F.col("stride")).alias("cx"),
        ((p(1) + F.floor(F.col("cell") / side)) * F.col("stride")).alias("cy"),
        (F.exp(p(2)) * F.col("stride")).alias("w"),
        (F.exp(p(3)) * F.col("stride")).alias("h"),
        (p(4) * p(5)).alias("score"),
    )


def boxes_of(decoded: DataFrame, ratio: float, frame_w: int, frame_h: int, min_score: float = 0.35) -> DataFrame:
    """Confident predictions as boxes of the frame: unscaled, clipped, and not tiny."""
    clip = lambda v, limit: F.least(F.greatest(v / ratio, F.lit(0.0)), F.lit(float(limit)))
    boxes = decoded.where(F.col("score") > min_score).select(
        "title_id",
        "frame_idx",
        F.col("anchor").alias("box_no"),
        clip(F.col("cx") - F.col("w") / 2, frame_w).alias("x1"),
        clip(F.col("cy") - F.col("h") / 2, frame_h).alias("y1"),
        clip(F.col("cx") + F.col("w") / 2, frame_w).alias("x2"),
        clip(F.col("cy") + F.col("h") / 2, frame_h).alias("y2"),
        "score",
    )
    return boxes.where("x2 - x1 >= 2 and y2 - y1 >= 2")


def suppress_overlaps(boxes: DataFrame, most: float = 0.45) -> DataFrame:
    """Greedy non-maximum suppression per frame, as a fold over the boxes by falling score.

    Areas count whole pixels (one more each way); ties go to the higher box number.
    """
    item = F.struct((-F.col("score")).alias("s"), (-F.col("box_no")).alias("b"), *(F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")))
    size = lambda v: (v["x2"] - v["x1"] + 1) * (v["y2"] - v["y1"] + 1)

    def clash(k: Column, x: Column) -> Column:
        w = F.greatest(F.least(k["x2"], x["x2"]) - F.greatest(k["x1"], x["x1"]) + 1, F.lit(0.0))
        h = F.greatest(F.least(k["y2"], x["y2"]) - F.greatest(k["y1"], x["y1"]) + 1, F.lit(0.0))
        return w * h / (size(k) + size(x) - w * h) > most

    grouped = boxes.groupBy("title_id", "frame_idx").agg(F.array_sort(F.collect_list(item)).alias("all"))
    none = F.slice(F.col("all"), 1, 0)
    kept = F.aggregate("all", none, lambda acc, x: F.when(F.exists(acc, lambda k: clash(k, x)), acc).otherwise(F.array_append(acc, x)))
    rows = grouped.select("title_id", "frame_idx", F.explode(kept).alias("k"))
    return rows.select("title_id", "frame_idx", (-F.col("k.b")).alias("box_no"), "k.x1", "k.y1", "k.x2", "k.y2", (-F.col("k.s")).alias("score"))


def largest_box(detections: DataFrame) -> DataFrame:
    """(title_id, frame_idx, box_no) of each frame's largest box; ties go to the lower number."""
    size = box_area(F.struct("x1", "y1", "x2", "y2"))
    return detections.groupBy("title_id", "frame_idx").agg(F.max_by("box_no", F.struct(size, -F.col("box_no"))).alias("box_no"))
