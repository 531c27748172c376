"""Quality classifier by co-training two views of a document (operator 9).

* View A, *text content*: hashed character trigrams and hashed words of the whole text, and a few
  shapes (how much of it repeats, how long its words and lines are) as classes.
* View B, *page metadata*: source, language and recorded length as classes (never the text).

Both views are naive Bayes models over counts, so that all they learn from documents are sums, which tasks
add up before anything is shuffled.  They start from labelled rows.  In every round both score every
other document of the table, and the pseudo-labels that a view is confident of (its calibrated
probability is ``CONFIDENT`` from either end) are counted for the other view.  Each view is calibrated on labelled rows kept
apart, and a last regression over the two calibrated log-odds (on the same kept rows) gives the score.

Labelled rows are a bounded sample (``most_labelled``, the smallest hashes of their ids, a quarter of
them kept apart); the other labelled rows count as unlabelled.  Unlabelled documents have no bound and no sample: each
round is one pass over the table without a shuffle of texts, and so is scoring.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuegrid.llm.common import Shingler, columns, fresh, small_batches, stash

#: Most labelled rows that fitting looks at (default of the parameter), rounds, and the least confidence of a pseudo-label.
MAX_LABELLED, ROUNDS, CONFIDENT = 8_000, 2, 0.99
#: Fewest labelled rows of a class to fit on, on either side of the split.
FEWEST = 3
#: Silent features that short texts' means are drawn to 0 by.
DRAWN = 20
#: Hashed classes of each kind of feature (sizes in bits).
TRIGRAM_BITS, WORD_BITS = 13, 13
SHAPES, SHAPE_CLASSES = ("chars", "word_length", "line_words", "repeated_words", "repeated_next", "repeated_lines"), 16
SOURCES, LANGS, LENGTHS = 64, 16, 24

#: Where each kind of feature begins in a view's table of counts.
CONTENT_PARTS = np.cumsum([0, 1 << TRIGRAM_BITS, 1 << WORD_BITS, len(SHAPES) * SHAPE_CLASSES])
METADATA_PARTS = np.cumsum([0, SOURCES, LANGS, LENGTHS])
METADATA = ("source_bucket", "lang_bucket", "length_bucket")

_TRIGRAM = np.uint32(0x9E3779B1)


def content_features(text: bytes | None, shingles: Shingler) -> np.ndarray:
    """Numbers of the text's features, with repeats; of null and empty texts the shapes alone."""
    raw = np.frombuffer(text or b"", np.uint8).astype(np.uint32)
    grams = raw[:-2] << np.uint32(16) | raw[1:-1] << np.uint32(8) | raw[2:] if len(raw) > 2 else raw[:0]
    grams = (grams * _TRIGRAM) >> np.uint32(32 - TRIGRAM_BITS)
    words = shingles(text)
    lines = [x for x in (text or b"").split(b"\n") if x.strip()]
    n, share = max(1, len(words)), lambda x, of: int(10 * x / max(1, of))
    shape = [
        len(raw).bit_length() // 2,
        len(raw) // n,
        (n // max(1, len(lines))).bit_length(),
        share(len(words) - len(np.unique(words)), n),
        share((words[1:] == words[:-1]).sum(), n),
        share(len(lines) - len(set(lines)), len(lines)),
    ]
    at = np.minimum(shape, SHAPE_CLASSES - 1) + np.arange(len(SHAPES)) * SHAPE_CLASSES
    hashed = CONTENT_PARTS[1] + (words >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    return np.concatenate([grams.astype(np.int64), hashed, CONTENT_PARTS[2] + at])


def _view_columns(docs: DataFrame, names: list[str]) -> list[Column]:
    """The metadata classes under the given names, whatever columns ``docs`` lacks."""
    has = lambda c, kind, other: F.coalesce(F.col(c).try_cast(kind), F.lit(other)) if c in docs.columns else F.lit(other)
    length = F.greatest(has("n_chars", "long", 0), F.lit(0))
    made = [
        F.pmod(F.xxhash64(has("source", "string", "")), F.lit(SOURCES)).cast("int"),
        F.pmod(F.xxhash64(has("lang", "string", "")), F.lit(LANGS)).cast("int"),
        F.least(F.floor(F.log2(length + 1)), F.lit(LENGTHS - 1)).cast("int"),
    ]
    return [column.alias(name) for column, name in zip(made, names, strict=True)]


def _viewed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the metadata classes."""
    own = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    return docs.select(*own, *_view_columns(docs, list(METADATA)))


def _features(batch: pa.RecordBatch, names: tuple[str, ...] | list[str] = METADATA) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(content, metadata) feature numbers of each row."""
    shingles = Shingler(1, True)
    meta = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names], 1) + METADATA_PARTS[:-1]
    for text, m in zip(batch.column("text").cast(pa.binary()).to_pylist(), meta, strict=True):
        yield content_features(text, shingles), m


@dataclass
class Counts:
    """Sums over documents by class (0 bad, 1 good): features of either view, and documents."""

    content: np.ndarray
    metadata: np.ndarray
    documents: np.ndarray  # by view and class

    @classmethod
    def none(cls) -> Counts:
        return cls(np.zeros((2, CONTENT_PARTS[-1])), np.zeros((2, METADATA_PARTS[-1])), np.zeros((2, 2)))

    def plus(self, other: Counts) -> Counts:
        return Counts(self.content + other.content, self.metadata + other.metadata, self.documents + other.documents)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.content.ravel(), self.metadata.ravel(), self.documents.ravel()])

    @classmethod
    def of(cls, flat: np.ndarray) -> Counts:
        a, b = 2 * CONTENT_PARTS[-1], 2 * METADATA_PARTS[-1]
        return cls(flat[:a].reshape(2, -1), flat[a : a + b].reshape(2, -1), flat[a + b :].reshape(2, 2))


def log_odds(counts: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Each feature's log-odds of good to bad, smoothed within its kind."""
    out = np.zeros(counts.shape[1])
    for lo, hi in zip(parts, parts[1:], strict=False):
        part = counts[:, lo:hi] + 0.5
        share = part / part.sum(1, keepdims=True)
        out[lo:hi] = np.log(share[1] / share[0])
    return out


@dataclass
class Logistic:
    """L2-regularised logistic regression on standardised columns, by Newton steps."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> Logistic:
        mean, scale = x.mean(0), x.std(0)
        scale = np.where(scale > 1e-9, scale, 1.0)
        z = np.c_[(x - mean) / scale, np.ones(len(x))]
        w = np.zeros(z.shape[1])
        ridge = np.diag([penalty] * (z.shape[1] - 1) + [1e-6])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z.T * np.maximum(p * (1 - p), 1e-6)) @ z + ridge, z.T @ (p - y) + ridge @ w)
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        return cls(mean, scale, w)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -20, 20) @ self.weights[:-1] + self.weights[-1]


def _p(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


@dataclass
class CoTrained:
    """Both views' tables, their calibrations and the combination; without them every document is good."""

    content: np.ndarray | None = None
    metadata: np.ndarray | None = None
    calibrate: tuple[Logistic, Logistic] | None = None
    combine: Logistic | None = None

    def evidence(self, features: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """A row a document: mean log-odds of trigrams and of words, and those of shapes; the metadata's.

        Means are drawn to 0 in short texts, as if ``DRAWN`` more features said nothing.
        """
        a, b = [], []
        for content, metadata in features:
            odds = self.content[content]
            grams, end = int(np.searchsorted(content >= CONTENT_PARTS[1], True)), len(content) - len(SHAPES)
            means = odds[:grams].sum() / (grams + DRAWN), odds[grams:end].sum() / (end - grams + DRAWN)
            a.append([*means, *odds[end:]])
            b.append(self.metadata[metadata])
        return np.array(a).reshape(-1, 2 + len(SHAPES)), np.array(b).reshape(-1, len(METADATA))

    def probability(self, features: Iterator[tuple[np.ndarray, np.ndarray]], rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probability of good quality: of the content view, the metadata view, and both."""
        if self.calibrate is None:
            return (np.ones(rows),) * 3
        a, b = (c.logit(x) for c, x in zip(self.calibrate, self.evidence(features), strict=True))
        return _p(a), _p(b), _p(self.combine.logit(np.c_[a, b]))


def _chosen(docs: DataFrame, labels: DataFrame, most_labelled: int) -> DataFrame:
    """(doc_id, y, kept) of the labelled sample; of contradicting labels the worse one counts."""
    good = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y"))
    good = good.where("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.min("y").alias("y"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    some = good.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64(F.lit(9), "doc_id"), "doc_id").limit(most_labelled)
    return stash(some.withColumn("kept", F.pmod(F.xxhash64(F.lit(10), "doc_id"), F.lit(4)) == 0))


def _count(rows: DataFrame, model: CoTrained | None) -> Counts:
    """Counts of rows with y; with a model, of its confident pseudo-labels, each for the other view."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Counts.none()
        for batch in small_batches(batches):
            features = list(_features(batch))
            if shared.value is None:
                by_a = by_b = batch.column("y").to_numpy(zero_copy_only=False)
            else:
                p = shared.value.probability(iter(features), batch.num_rows)[:2]
                by_b, by_a = (np.where(q >= CONFIDENT, 1.0, np.where(q <= 1 - CONFIDENT, 0.0, np.nan)) for q in p)
            # what content says counts for the metadata view, and the other way round
            for (content, metadata), ya, yb in zip(features, by_a, by_b, strict=True):
                if ya == ya:
                    made.content[int(ya)] += np.bincount(content, minlength=CONTENT_PARTS[-1])
                    made.documents[0, int(ya)] += 1
                if yb == yb:
                    made.metadata[int(yb), metadata] += 1
                    made.documents[1, int(yb)] += 1
        flat = made.flat()
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], ["at", "n"])

    got = rows.mapInArrow(count, "at long, n double").groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # a row a feature at most
    flat = np.zeros(len(Counts.none().flat()))
    flat[got["at"].to_numpy()] = got["n"].to_numpy()
    return Counts.of(flat)


def _calibrated(kept: DataFrame, counts: Counts) -> CoTrained:
    """The model of these counts, calibrated and combined on the kept rows (a bounded sample)."""
    model = CoTrained(log_odds(counts.content, CONTENT_PARTS), log_odds(counts.metadata, METADATA_PARTS))
    shared = kept.sparkSession.sparkContext.broadcast(model)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            a, b = shared.value.evidence(_features(batch))
            lists = [pa.array(list(x), pa.list_(pa.float64())) for x in (a, b)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), *lists], ["doc_id", "y", "a", "b"])

    rows: pd.DataFrame = kept.mapInArrow(weigh, "doc_id long, y double, a array<double>, b array<double>").toPandas()
    rows = rows.sort_values("doc_id", kind="stable").drop_duplicates("doc_id")
    y, (a, b) = rows.y.to_numpy(), (np.stack(rows[c].to_numpy()) for c in "ab")
    model.calibrate = Logistic.fit(a, y), Logistic.fit(b, y)
    both = np.c_[model.calibrate[0].logit(a), model.calibrate[1].logit(b)]
    model.combine = Logistic.fit(both, y)
    return model


def fit_cotraining(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, most_labelled: int = MAX_LABELLED) -> CoTrained:
    """Fit on the documents that ``labels(doc_id, quality)`` covers and on all others.

    Labels other than 0 and 1, null ids and ids without a document are ignored; repeated documents count
    each.  With fewer than ``FEWEST`` labelled rows of a class on either side of the split nothing is fitted, and
    the model takes every document for good.
    """
    chosen = _chosen(docs, labels, most_labelled)
    sides = {(r.kept, r.y): r.n for r in chosen.groupBy("kept", "y").agg(F.count("*").alias("n")).collect()}
    if min(sides.get((k, y), 0) for k in (False, True) for y in (0.0, 1.0)) < FEWEST:
        return CoTrained()
    rows = _viewed(docs)
    known = rows.join(F.broadcast(chosen), "doc_id")  # most_labelled rows at most
    others = rows.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_anti")
    kept = known.where("kept")
    own = _count(known.where("not kept"), None)
    model = _calibrated(kept, own)
    for _ in range(rounds):
        model = _calibrated(kept, own.plus(_count(others, model)))
    return model


def score_quality(docs: DataFrame, model: CoTrained, threshold: float = 0.5) -> DataFrame:
    """doc_id, p_content, p_metadata, p_quality and keep of every row; other columns go.

    Null and empty texts score as texts without content; a null doc_id stays null; missing or null
    metadata count as empty; repeated rows are answered each; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            a, b, both = shared.value.probability(_features(batch), batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(a), pa.array(b), pa.array(both), pa.array(both >= threshold)],
                ["doc_id", "p_content", "p_metadata", "p_quality", "keep"],
            )

    return _viewed(docs).mapInArrow(score, "doc_id long, p_content double, p_metadata double, p_quality double, keep boolean")


def quality_classifier(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Fit by co-training and score all documents; see :func:`score_quality`."""
    return score_quality(docs, fit_cotraining(docs, labels), threshold)


def keep_good(docs: DataFrame, model: CoTrained, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns, in one pass.

    Null and empty texts, null ids and null or missing metadata are scored as in :func:`score_quality`; rows
    that repeat are judged each, and alike; columns keep their names, whatever these are; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    hidden, width = fresh(docs, *METADATA), len(docs.columns)
    text_at = docs.columns.index("text")
    wide = docs.select(*columns(docs), *_view_columns(docs, hidden))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            seen = pa.RecordBatch.from_arrays([batch.column(text_at), *(batch.column(width + i) for i in range(len(METADATA)))], ["text", *METADATA])
            both = shared.value.probability(_features(seen), batch.num_rows)[2]
            yield batch.select(list(range(width))).filter(pa.array(both >= threshold))

    return wide.mapInArrow(keep, docs.schema)
