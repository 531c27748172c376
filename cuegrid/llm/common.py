"""Helpers shared by the training-data operators.

Words are runs of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z.  ``bytes.lower`` and
``bytes.split`` follow exactly that definition on UTF-8, so tokenising never decodes.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MEMO_WORDS = 100_000
#: The folder of the open :func:`scratch` block of this thread or context.
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_S32 = np.uint64(32)

#: Most keys that a join may broadcast.
BROADCAST_KEYS = 1_000_000
#: Bits of a fixed-size membership bitmap (2 MB): a bound that does not grow with the data.
BITMAP_BITS = 24


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; without it only a local master gets a folder of its own."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; within :func:`scratch` in that block's folder, which is deleted at the end."""
    return f"{_SCRATCH.get() or checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what was written to scratch paths within: nothing used later may read from it.

    Each block has a folder of its own, known to its own thread (or task of an event loop) only, so that blocks that run
    at the same time don't meet.  What an inner block makes goes with the inner block.
    """
    folder = f"{_SCRATCH.get() or checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"
    token = _SCRATCH.set(folder)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def stash(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet into the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, "stash")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` has it (whatever its case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, names with dots included."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def with_row_keys(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a bigint column ``name``: a key of the row, the same in every job.

    The key is the row's file (hashed) and its place in the file, which don't depend on how tasks
    split the files.  The hash has all bits that the places leave free and is tried with other seeds until the
    files' hashes differ.  What isn't read from files is written first.
    """
    try:
        rows = docs.select("*", docs.metadataColumn("_metadata").alias(name))
    except AnalysisException:
        docs = stash(docs)
        rows = docs.select("*", docs.metadataColumn("_metadata").alias(name))
    meta = F.col(name)
    files = stash(rows.groupBy(meta["file_path"].alias("file")).agg(F.max(meta["row_index"]).alias("most")))
    count, most = files.agg(F.count("*"), F.coalesce(F.max("most"), F.lit(0))).first()
    bits = max(1, int(most).bit_length())
    for seed in range(64):
        place = lambda file, seed=seed: F.shiftrightunsigned(F.xxhash64(file, F.lit(seed)), bits + 1)
        if files.select(place(F.col("file"))).distinct().count() == count:
            return rows.withColumn(name, F.shiftleft(place(meta["file_path"]), bits).bitwiseOR(meta["row_index"]))
    raise ValueError("too many files of too many rows to number")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class _WordHashes(dict):
    """Word -> 64-bit hash, bounded: it starts afresh when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> _S32)) * _MUL
    x = (x ^ (x >> _S32)) * _MIX
    return x ^ (x >> _S32)


class Shingler:
    """Hashes of the word n-grams of a text, in order and with repeats.

    ``short_whole``: a text of fewer than n words gives its whole word sequence as one shingle
    (else it gives none).
    """

    def __init__(self, n: int, short_whole: bool) -> None:
        self.n, self.short_whole, self.memo = n, short_whole, _WordHashes()

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = words_of(text)
        if not words:
            return np.empty(0, np.uint64)
        w = np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words))
        n = self.n
        if len(w) < n:
            if not self.short_whole:
                return np.empty(0, np.uint64)
            n = len(w)
        out = np.full(len(w) - n + 1, n, np.uint64)
        for i in range(n):
            out = out * _MUL + w[i : len(w) - n + 1 + i]
            out ^= out >> _S32
        return mix(out)

    def distinct(self, text: bytes | None) -> np.ndarray:
        return np.unique(self(text))


def bitmap_from(df: DataFrame, hashed: str) -> np.ndarray:
    """A bitmap of ``2**BITMAP_BITS`` bits over the top bits of a 64-bit hash column.

    At most ``2**(BITMAP_BITS - 6)`` rows (2 MB) reach the driver, whatever the input's size.
    Members are always found; others may be found by chance, so callers must stay right then.
    """
    bit = F.shiftrightunsigned(F.col(hashed), 64 - BITMAP_BITS)
    rows = df.select(bit.alias("bit")).select(
        F.shiftrightunsigned("bit", 6).alias("word"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("bits")
    )
    return bitmap_of_words(rows)


def bitmap_of_words(rows: DataFrame) -> np.ndarray:
    """Columns word (index of 64 bits) and bits (bigint) -> the bitmap, one bit_or per word."""
    out = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    got = rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    if got.num_rows:
        out[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return out


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - BITMAP_BITS)
    return (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def words_for_bitmap(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, bits) of a bitmap holding these hashes, for :func:`bitmap_of_words`."""
    at = np.unique(hashes >> np.uint64(64 - BITMAP_BITS))
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    word, bits = at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63))
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    return word[first].astype(np.int64), np.bitwise_or.reduceat(bits, first).view(np.int64)


def small_batches(batches: Iterator, rows: int = 500, size: int = 16 << 20) -> Iterator:
    """The batches in slices of at most ``rows`` rows and ``size`` bytes of texts (or one longer text)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        lengths = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
                lengths += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(lengths), 0
        while at < batch.num_rows:
            fits = int(np.searchsorted(ends, size + (ends[at - 1] if at else 0), "right"))
            to = max(at + 1, min(at + rows, fits))
            yield batch.slice(at, to - at)
            at = to
        pa.default_memory_pool().release_unused()


def texts(batch, column: str = "text") -> list[bytes | None]:
    """A string column of an Arrow batch as UTF-8 bytes."""
    import pyarrow as pa

    return batch.column(column).cast(pa.binary()).to_pylist()


def drop_rows(docs: DataFrame, losers: DataFrame, column: str) -> DataFrame:
    """``docs`` without the rows whose key is in ``losers`` (one column, written already).

    Up to ``BROADCAST_KEYS`` keys (8 MB) are broadcast, so that the texts are not shuffled; beyond
    that the join shuffles both sides.  Either way the same rows stay.
    """
    small = losers.count() <= BROADCAST_KEYS
    return docs.join(F.broadcast(losers) if small else losers.hint("merge"), column, "left_anti")
