"""Benchmark decontamination by size-partitioned MinHash containment search (operator 10).

An item is found in a document when at least ``percent`` % of the item's distinct word shingles
are in the document's:

* Items are partitioned by size (number of distinct shingles ``m``, by powers of two).  An item may miss
  ``e = m - ceil(percent * m)`` shingles.  Its sketch is a bottom-k MinHash, its ``2 * e_max + 1`` smallest shingle hashes,
  where ``e_max`` is the most that an item of the partition may miss.
* In every partition a document's sketch is its hashes up to the partition's greatest sketch hash (a scaled
  MinHash), so short items keep their weight in long documents.  Banded MinHash of the documents would lose
  them there, where Jaccard similarity goes to 0.
* The share of an item's sketch in the document's estimates containment.  An item is a candidate if
  no more than ``e`` of its sketch is missing, which holds of every item that the document holds: the
  search loses none, and most others fall here.
* Candidates are verified by exact containment of all the item's shingles.

Items are a stated query set: they reach the tasks in blocks of bounded size, and every block is
run against all documents; documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuegrid.llm.common import Shingler, small_batches, texts

#: Characters of item texts in one block; bounds what is broadcast.
BLOCK_CHARS = 16_000_000


@dataclass
class Partition:
    """The sketches of the items of one range of sizes: hashes in order, and whose they are."""

    hashes: np.ndarray
    owners: np.ndarray
    least: np.ndarray  # a candidate's hits, by position in the block (0 for items of other partitions)

    def candidates(self, tokens: np.ndarray) -> np.ndarray:
        """Positions of the candidates among a document's distinct hashes, in order."""
        sketch = tokens[: np.searchsorted(tokens, self.hashes[-1], "right")]
        hits = np.bincount(_owners(self.hashes, self.owners, sketch), minlength=len(self.least))
        return np.flatnonzero((self.least > 0) & (hits >= self.least))


def _owners(keys: np.ndarray, owners: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Owners of the keys (in order) that are among distinct tokens, with repeats."""
    lo, hi = np.searchsorted(keys, tokens, "left"), np.searchsorted(keys, tokens, "right")
    hit = np.flatnonzero(hi > lo)
    return np.concatenate([owners[:0], *(owners[lo[k] : hi[k]] for k in hit)])


def _in_order(hashes: list[np.ndarray], owners: list[int]) -> tuple[np.ndarray, np.ndarray]:
    h = np.concatenate([np.empty(0, np.uint64), *hashes])
    o = np.repeat(np.array(owners, np.int64), [len(x) for x in hashes])
    order = np.argsort(h, kind="stable")
    return h[order], o[order]


class ItemIndex:
    """Partitions and full shingle sets of one block of items, which are known by their positions."""

    def __init__(self, items: list[tuple[int, str]], n: int, percent: int) -> None:
        shingles = Shingler(n, True)
        self.ids = [i for i, _ in items]
        self.sets = [shingles.distinct((text or "").encode()) for _, text in items]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.need = -(-percent * self.sizes // 100)
        missing = self.sizes - self.need
        classes = np.array([len(s).bit_length() for s in self.sets], np.int64)
        self.partitions = []
        for c in np.unique(classes[self.sizes > 0]):
            members = np.flatnonzero(classes == c)
            length = 2 * int(missing[members].max()) + 1
            sketches = [self.sets[i][:length] for i in members]
            least = np.zeros(len(items), np.int64)
            least[members] = np.array([len(s) for s in sketches]) - missing[members]
            self.partitions.append(Partition(*_in_order(sketches, list(members)), least))
        bits = 20
        self.shift = np.uint64(64 - bits)
        self.maybe = np.zeros(1 << bits, bool)  # spares most look-ups
        for p in self.partitions:
            self.maybe[(p.hashes >> self.shift).astype(np.int64)] = True

    def search(self, shingles: np.ndarray) -> list[tuple[int, int]]:
        """(position, shared shingles) of the items that the document of these shingles holds."""
        maybe = self.maybe[(shingles >> self.shift).astype(np.int64)]
        if not maybe.any():
            return []
        likely = np.unique(shingles[maybe])  # holds all hashes of any sketch
        found, tokens = [], None
        for p in self.partitions:
            for i in p.candidates(likely):
                tokens = np.unique(shingles) if tokens is None else tokens
                at = np.minimum(np.searchsorted(tokens, self.sets[i]), len(tokens) - 1)
                shared = int((tokens[at] == self.sets[i]).sum())
                if shared >= self.need[i]:
                    found.append((int(i), shared))
        return found


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    block, chars = [], 0
    for row in items.select("item_id", "text").where("item_id is not null and text is not null").toLocalIterator():
        block.append((row.item_id, row.text))
        chars += len(row.text)
        if chars >= BLOCK_CHARS:
            yield block
            block, chars = [], 0
    if block:
        yield block


def find_contamination(docs: DataFrame, items: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Pairs doc_id, item_id, n_item (the item's shingles), n_shared and containment.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are ignored.  Texts
    and items of fewer than ``n`` words have their whole word sequence as their only shingle;
    null, empty and blank ones have none and match nothing.  Rows with a null item_id are left
    out; a null doc_id is reported as such.  Repeated rows are answered each.  Empty tables give
    an empty result.
    """
    spark = docs.sparkSession
    schema = T.StructType.fromDDL("doc_id long, item_id long, n_item long, n_shared long, containment double")

    def search(index: ItemIndex) -> DataFrame:
        shared = spark.sparkContext.broadcast(index)

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shingles, block = Shingler(n, True), shared.value
            ids, sizes = np.array(block.ids, np.int64), block.sizes
            for batch in small_batches(batches):
                docs_, items_, counts = [], [], []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                    for position, count in block.search(shingles(text)):
                        docs_.append(doc_id)
                        items_.append(position)
                        counts.append(count)
                at = np.array(items_, np.int64)
                shares = np.array(counts, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs_, pa.int64()), pa.array(ids[at]), pa.array(sizes[at]), pa.array(shares), pa.array(shares / np.maximum(sizes[at], 1))],
                    schema.names,
                )

        return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(probe, schema)

    found = [search(ItemIndex(block, n, percent)) for block in _blocks(items)]
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], schema)
