"""Person tracks from a stream of detections: the open clusters of a title are its state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cuegrid.operators.detections import CLUSTERED, OpenClusters, detection_rows, track_frames

_STATE = "last_frame long, boxes array<double>"
#: The state store that arbitrary state needs.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Tracker(StatefulProcessor):
    def __init__(self, min_iou: float, smoothing: float) -> None:
        self.min_iou, self.smoothing = min_iou, smoothing

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.tracks = handle.getValueState("tracks", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, flat = self.tracks.get() if self.tracks.exists() else (None, [])
        clusters = OpenClusters(np.array(flat, float).reshape(-1, 4))
        pdf = pd.concat(list(rows))
        late = pdf.frame_idx <= last if last is not None else pd.Series(False, index=pdf.index)
        made = track_frames(pdf[~late], clusters, self.min_iou, self.smoothing)
        if len(made):
            self.tracks.update((int(made.frame_idx.max()), clusters.boxes.ravel().tolist()))
        yield pd.concat([made, pdf[late].assign(cluster_id=-1)])

    def close(self) -> None:
        pass


def track_stream(detections: DataFrame, min_iou: float = 0.3, smoothing: float = 0.2) -> DataFrame:
    """A stream of detections with cluster_id, as :func:`cuegrid.operators.detections.cluster_detections` gives it.

    Each micro-batch brings whole frames of a title, later ones than before; what comes with or behind a frame that has
    been tracked already gets cluster -1 (it can't be put in order any more, and no row is lost).  The state of a title is
    its last frame and its clusters' boxes.  The session's state store must be :data:`PROVIDER`.
    """
    rows = detection_rows(detections).groupBy("title_id")
    return rows.transformWithStateInPandas(_Tracker(min_iou, smoothing), CLUSTERED, "append", "None")
