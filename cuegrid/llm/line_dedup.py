"""Line deduplication with keep bitmaps instead of texts (operator 11).

A line's key is the line without white space at its ends and with A-Z lower-cased; 128 bits of its hash stand for it.
Every occurrence is a row (hash, document, line number).  The rows are dealt into ranges of (hash, document, line), so
that a key of any number of occurrences spreads over as many ranges as it needs, and are sorted within each.  One pass
streams a range: a key is a run of rows, and a run is decided when it ends or when it has met enough documents.  Only a
range's first and last run can go on in another range; a summary of these (two rows a range) decides what is left.
What comes back is one compressed bitmap of kept lines a document; texts are met again only where they are wanted.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cuegrid.llm.common import columns, fresh, small_batches, stash, texts, with_row_keys

#: Occurrences in one range, about.
RANGE_ROWS = 4_000_000

_SORT = ["h1", "h2", "row", "pos"]
_OUT = "row long, pos int, h1 long, h2 long, kind string, n long, last long, part int"


def _occurrences(min_chars: int):
    """(row, text) -> for each text a header (pos: its lines, no hash), for each line with a key its hash and number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small_batches(batches):
            rows = part.column("row").to_numpy()
            sizes, held, places = [], [], []
            for text in texts(part):
                lines = (text or b"").lower().split(b"\n")
                keys = [x.strip(b" \t\n\v\f\r") for x in lines]
                if min_chars > 1:
                    at = [i for i, k in enumerate(keys) if len(k) >= min_chars and len(k.decode("utf-8", "replace")) >= min_chars]
                else:
                    at = [i for i, k in enumerate(keys) if k]
                sizes.append((len(lines), len(at)))
                held += [xxhash.xxh3_128_digest(keys[i]) for i in at]
                places.append(np.array(at, np.int32))
            counts = np.array(sizes, np.int64).reshape(-1, 2)
            digests = np.frombuffer(b"".join(held), "<i8").reshape(-1, 2)
            none = pa.nulls(len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([none, pa.array(np.ascontiguousarray(digests[:, 0]))]),
                    pa.concat_arrays([none, pa.array(np.ascontiguousarray(digests[:, 1]))]),
                    pa.array(np.r_[rows, np.repeat(rows, counts[:, 1])]),
                    pa.array(np.concatenate([counts[:, 0].astype(np.int32), *places])),
                ],
                _SORT,
            )

    return run


class _Run:
    """The run of one key so far: rows are held until it has met enough documents or has ended."""

    def __init__(self, key: tuple[int, int], first: bool) -> None:
        self.key, self.first, self.n, self.last, self.held, self.start = key, first, 0, None, [], None


def _stream(min_docs: int, keep_first: bool):
    """Sorted rows of one range -> rows to drop, rows still open, and summaries of the first and last run.

    A run holds at most the occurrences in ``min_docs - 1`` documents; beyond that its rows pass through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        now: _Run | None = None
        out: list[tuple] = []

        def emit(kind: str, key: tuple[int, int], rows: np.ndarray, pos: np.ndarray) -> None:
            if len(rows):
                out.append((kind, key, rows, pos, 0, 0))

        def passed(r: _Run, rows: np.ndarray, pos: np.ndarray) -> None:
            """Rows of a run that has met enough documents."""
            if keep_first and r.start == (rows[0], pos[0]):
                if r.first:
                    emit("open", r.key, rows[:1], pos[:1])
                rows, pos = rows[1:], pos[1:]
            emit("drop", r.key, rows, pos)

        def end(r: _Run, last: bool) -> None:
            if r.n < min_docs and (r.first or last):
                for rows, pos in r.held:
                    emit("open", r.key, rows, pos)
            if r.first or last:
                out.append(("edge", r.key, np.array([r.start[0]]), np.array([r.start[1]]), r.n, r.last))

        def more(r: _Run, rows: np.ndarray, pos: np.ndarray, docs: int) -> None:
            if r.start is None:
                r.start = (rows[0], pos[0])
            was, r.n = r.n, r.n + docs - int(r.last is not None and r.last == rows[0])
            r.last = int(rows[-1])
            if was >= min_docs:
                passed(r, rows, pos)
                return
            r.held.append((rows, pos))
            if r.n >= min_docs:
                for x in r.held:
                    passed(r, *x)
                r.held = []

        def flush() -> pa.RecordBatch:
            sizes = [len(x[2]) for x in out]
            each = lambda values, kind: pa.array(np.repeat(np.array(values, kind), sizes))
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([x[2] for x in out]).astype(np.int64)),
                    pa.array(np.concatenate([x[3] for x in out]).astype(np.int32)),
                    each([x[1][0] for x in out], np.int64),
                    each([x[1][1] for x in out], np.int64),
                    pa.array([x[0] for x, s in zip(out, sizes, strict=True) for _ in range(s)]),
                    each([x[4] for x in out], np.int64),
                    each([x[5] for x in out], np.int64),
                    pa.array(np.full(sum(sizes), part, np.int32)),
                ],
                ["row", "pos", "h1", "h2", "kind", "n", "last", "part"],
            )
            out.clear()
            return batch

        for batch in batches:
            if not batch.num_rows:
                continue
            h1, h2, rows, pos = (batch.column(c).to_numpy() for c in _SORT)
            starts = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
            new_doc = np.r_[True, rows[1:] != rows[:-1]]
            new_doc[starts] = True
            docs = np.add.reduceat(new_doc, starts, dtype=np.int64)
            ends = np.r_[starts[1:], batch.num_rows]
            # runs within the batch that meet too few documents need no look: they stay
            looked = np.flatnonzero(docs >= min_docs)
            for k in sorted({0, len(starts) - 1, *looked.tolist()}):
                key = (int(h1[starts[k]]), int(h2[starts[k]]))
                if now is None or now.key != key:
                    if now is not None:
                        end(now, False)
                    now = _Run(key, now is None)
                more(now, rows[starts[k] : ends[k]], pos[starts[k] : ends[k]], int(docs[k]))
            if out:
                yield flush()
        if now is not None:
            end(now, True)
        if out:
            yield flush()

    return run


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, dropped = batch.column("n_lines").to_pylist(), batch.column("dropped").to_pylist()
        keeps, counts = [], []
        for size, places in zip(sizes, dropped, strict=True):
            keep = np.ones(size, np.uint8)
            keep[places or []] = 0
            keeps.append(zlib.compress(np.packbits(keep).tobytes()))
            counts.append(len(places or []))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("n_lines"), pa.array(counts, pa.int64()), pa.array(keeps, pa.binary())],
            ["row", "n_lines", "n_dropped", "keep"],
        )


def line_bitmaps(rows: DataFrame, row: str, min_chars: int = 1, min_docs: int = 2, keep_first: bool = True) -> DataFrame:
    """row, n_lines, n_dropped and keep of every row of ``rows(row, text)``, where the column named ``row`` is a unique bigint.

    Keys of at least ``min_chars`` code points that stand in at least ``min_docs`` documents (rows) lose their lines:
    all of them, or with ``keep_first`` all but the first by row and line.  keep is a zlib-compressed bitmap, one bit a
    line, first line first (:func:`kept_lines` applies it).  A null or empty text is one empty line; empty keys are never dropped.
    """
    made = stash(
        rows.select(F.col(row).alias("row"), "text").mapInArrow(_occurrences(max(1, min_chars)), "h1 long, h2 long, row long, pos int")
    )
    found = made.where("h1 is not null")
    ranges = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + found.count() // RANGE_ROWS)
    sorted_ = found.repartitionByRange(ranges, *_SORT).sortWithinPartitions(*_SORT)
    seen = stash(sorted_.mapInArrow(_stream(min_docs, keep_first), _OUT))
    order = Window.partitionBy("h1", "h2").orderBy("part")
    again = F.lag("last").over(order) == F.col("row")
    edges = (  # at most two rows a range
        seen.where("kind = 'edge'")
        .select("h1", "h2", F.struct("part", "row", "pos").alias("start"), (F.col("n") - F.when(again, 1).otherwise(0)).alias("n"))
        .groupBy("h1", "h2")
        .agg(F.sum("n").alias("total"), F.min("start").alias("start"))
        .where(F.col("total") >= min_docs)
    )
    open_ = seen.where("kind = 'open'").select("h1", "h2", "row", "pos").join(F.broadcast(edges), ["h1", "h2"])
    if keep_first:
        open_ = open_.where((F.col("row") != F.col("start.row")) | (F.col("pos") != F.col("start.pos")))
    drops = seen.where("kind = 'drop'").select("row", "pos").union(open_.select("row", "pos"))
    by_row = drops.groupBy("row").agg(F.collect_list("pos").alias("dropped"))
    headers = made.where("h1 is null").select("row", F.col("pos").cast("long").alias("n_lines"))
    maps = headers.join(by_row, "row", "left").select("row", "n_lines", "dropped")
    return maps.mapInArrow(_bitmaps, "row long, n_lines long, n_dropped long, keep binary").withColumnRenamed("row", row)


def kept_lines(text: bytes | None, keep: bytes | None) -> bytes:
    """The text's kept lines, joined again; without a bitmap all of them."""
    if keep is None or not text:
        return text or b""
    lines = text.split(b"\n")
    return b"\n".join(compress(lines, np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines)).tolist()))


def drop_repeated_lines(docs: DataFrame, min_chars: int = 1, min_docs: int = 2, keep_first: bool = True) -> DataFrame:
    """``docs`` with the texts' kept lines (see :func:`line_bitmaps`); all rows and columns stay, null texts become empty.

    "First" is by file and place in the file.  Repeated rows are documents of their own.
    """
    key, keep, kept = fresh(docs, "row", "keep", "kept")
    rows = with_row_keys(docs, key)
    maps = line_bitmaps(rows, key, min_chars, min_docs, keep_first).where("n_dropped > 0").select(key, F.col("keep").alias(keep))
    applied = F.pandas_udf(lambda t, k: _applied(t, k), "string")  # noqa: PLW0108
    return rows.join(maps, key, "left").withColumn("text", applied("text", keep)).select(*columns(docs))


def _applied(text, keep):
    return text.combine(keep, lambda t, k: kept_lines(t.encode() if t else b"", k).decode())


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in small_batches(batches):
        held = zip(texts(part), part.column("keep").to_pylist(), strict=True)
        made = [hashlib.sha256(kept_lines(text, keep)).hexdigest() for text, keep in held]
        columns_ = [part.column(c) for c in ("doc_id", "n_lines", "n_dropped")]
        yield pa.RecordBatch.from_arrays([*columns_, pa.array(made, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept_sha256"])


def line_dedup_digests(docs: DataFrame, min_chars: int = 1, min_docs: int = 10) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256: what dropping all lines of frequent keys leaves of every row.

    Every row is a document, repeated rows and null ids included; a null or empty text is one empty
    line; an empty table gives an empty result; other columns are ignored.
    """
    rows = with_row_keys(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "row")
    maps = line_bitmaps(rows, "row", min_chars, min_docs, keep_first=False)
    maps = maps.select("row", "n_lines", "n_dropped", F.when(F.col("n_dropped") > 0, F.col("keep")).alias("keep"))
    both = rows.join(maps, "row").select("doc_id", "text", "n_lines", "n_dropped", "keep")
    return both.mapInArrow(_digests, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def oracle_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
    with t as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
    l as (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as pos from t),
    k as (select *, translate(trim(line, E' \t\n\x0b\x0c\r'), '{upper}', '{lower}') as key from l),
    h as (select key from k where key <> '' group by key having count(distinct doc_id) >= 10)
    select doc_id, count(*) as n_lines, count(h.key) as n_dropped,
      sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where h.key is null), '')) as kept_sha256
    from k left join h using (key) group by doc_id"""
