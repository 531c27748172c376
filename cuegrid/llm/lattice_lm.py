"""Language-model scores by subword lattice likelihood (operator 3).

The model is a unigram model over the pieces of a public vocabulary.  A word (with the space in
front of it) can be cut into pieces in many ways; its probability is the sum over all of them, by
the forward recursion in log space.  A text's probability is the product over its words, times the
probability of the end.  Characters that no piece covers are cut into bytes.

The vocabulary file's scores are ranks, not probabilities; they give the first weights by Zipf's
law, and ``ROUNDS`` rounds of expectation maximisation over the counts of all words of all training
texts fit the weights (the pieces themselves stay as they are).

Nothing else enters a score: words that training texts hold have no arcs of their own, so known and
unknown words are scored by the same lattice, and the probabilities of all texts are those of one
model of pieces.

Base scores need each word's count over the corpus.  Words whose share of all training tokens is at
least ``SHARE`` (no more than 1 / SHARE words, whatever the corpus) are broadcast with their counts;
a text's other words meet the word table in a join, whose keys are rare by choice.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuegrid.llm.common import small_batches, stash, texts
from cuegrid.llm.pieces import SPACE, PieceTransducer

#: Least share of the training tokens of a broadcast word, rounds of fitting.
SHARE, ROUNDS = 2e-6, 3
#: Words a task counts before it hands them on, and words of one vectorised lattice.
MOST_COUNTED, MOST_ROWS = 300_000, 4_000
_BASE = np.uint64(0x100000001B3)
_LN10 = math.log(10)
_MAYBE_BITS = 18
_MAYBE_SHIFT = np.uint64(64 - _MAYBE_BITS)


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 10 == 0 if doc_id is not None else False


class PieceLattice:
    """Piece weights and the vectorised forward (and backward) recursion over many words at once."""

    def __init__(self, pieces: list[str], ranks: np.ndarray, n_bytes: int) -> None:
        self.pieces = pieces
        self.longest = max(map(len, pieces))
        by_size: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            by_size.setdefault(len(p), []).append(i)
        self.tables = {}  # per length: sorted hashes and the pieces' numbers
        for size, members in by_size.items():
            codes = np.array([[ord(c) for c in pieces[i]] for i in members], np.uint64)
            hashes = self._hash(codes)[:, 0] if size == 1 else self._whole(codes)
            order = np.argsort(hashes)
            if len(np.unique(hashes)) != len(hashes):
                raise ValueError("two pieces have the same hash")
            maybe = np.zeros(1 << _MAYBE_BITS, bool)  # spares most searches
            maybe[(hashes >> _MAYBE_SHIFT).astype(np.int64)] = True
            self.tables[size] = hashes[order], np.array(members)[order], maybe
        self.n_bytes = n_bytes
        weight = 1.0 / (ranks + 2.0)
        total = weight.sum() * 1.02
        # the last two numbers: a fallback byte and the end of the text
        self.log_weight = np.log(np.r_[weight / total, 0.01 / 1.02 / n_bytes, 0.01 / 1.02])

    @classmethod
    def from_file(cls, path: str) -> PieceLattice:
        machine = PieceTransducer.from_file(path)
        pieces = list(machine.ids)
        ranks = np.array([machine.ids[p] for p in pieces], float)
        return cls(pieces, ranks - ranks.min(), len(machine.byte_ids))

    @staticmethod
    def _hash(codes: np.ndarray) -> np.ndarray:
        return (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)

    @classmethod
    def _whole(cls, codes: np.ndarray) -> np.ndarray:
        mixed, out = cls._hash(codes), np.zeros(len(codes), np.uint64)
        for j in range(codes.shape[1]):
            out = out * _BASE + mixed[:, j]
        return out

    def _arcs(self, codes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, piece numbers) of all arcs over words of one length."""
        mixed, n = self._hash(codes), codes.shape[1]
        for i in range(n):
            out = np.zeros(len(codes), np.uint64)
            for j in range(i, min(n, i + self.longest)):
                out = out * _BASE + mixed[:, j]
                table = self.tables.get(j - i + 1)
                if table is None:
                    continue
                rows = np.flatnonzero(table[2][(out >> _MAYBE_SHIFT).view(np.int64)])
                if not len(rows):
                    continue
                some = out[rows]
                at = np.minimum(np.searchsorted(table[0], some), len(table[0]) - 1)
                hit = table[0][at] == some
                if hit.any():
                    yield i, j + 1, rows[hit], table[1][at[hit]]

    def _fallback(self, codes: np.ndarray, i: int) -> np.ndarray:
        """UTF-8 bytes of the characters at i."""
        c = codes[:, i]
        return 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)

    def forward(self, words: list[str]) -> np.ndarray:
        """Natural-log marginal probability of each word (with its leading space sign)."""
        out = np.zeros(len(words))
        for members, codes in self._by_length(words):
            out[members] = self._forward(codes, None)
        return out

    def expect(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece (and of a byte) over the words, by their counts."""
        out = np.zeros(len(self.log_weight))
        for members, codes in self._by_length(words):
            self._forward(codes, (counts[members].astype(float), out))
        return out

    def _by_length(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            step = max(1, MOST_ROWS * 16 // max(16, int(size)))
            for k in range(0, len(at), step):
                part = at[k : k + step]
                raw = "".join([words[m] for m in part]).encode("utf-32-le", "surrogatepass")
                yield part, np.frombuffer(raw, np.uint32).astype(np.uint64).reshape(len(part), size)

    def _forward(self, codes: np.ndarray, gather: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
        rows, n = codes.shape
        alpha = np.full((n + 1, rows), -np.inf)
        alpha[0] = 0.0
        single = self.tables.get(1)
        kept: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = []
        byte = len(self.log_weight) - 2
        done = -1
        for i, j, at, piece in self._arcs(codes):
            while done < i:  # fallback arcs out of each position, once its alpha is complete
                done += 1
                self._bytes(codes, alpha, done, single, kept, byte)
            weight = self.log_weight[piece]
            alpha[j, at] = np.logaddexp(alpha[j, at], alpha[i, at] + weight)
            if gather is not None:
                kept.append((i, j, at, piece, weight))
        while done < n - 1:
            done += 1
            self._bytes(codes, alpha, done, single, kept, byte)
        if gather is not None:
            counts, out = gather
            beta = np.full((n + 1, rows), -np.inf)
            beta[n] = 0.0
            for i, j, at, _, weight in sorted(kept, key=lambda x: -x[0]):
                beta[i, at] = np.logaddexp(beta[i, at], beta[j, at] + weight)
            uses, shares = [], []
            for i, j, at, piece, weight in kept:
                share = np.exp(alpha[i, at] + weight + beta[j, at] - alpha[n, at]) * counts[at]
                if piece.ndim == 0:
                    out[byte] += (share * self._fallback(codes[at], i)).sum()
                else:
                    uses.append(piece)
                    shares.append(share)
            if uses:
                out += np.bincount(np.concatenate(uses), np.concatenate(shares), len(out))
        return alpha[n]

    def _bytes(self, codes: np.ndarray, alpha: np.ndarray, i: int, single: tuple, kept: list, byte: int) -> None:
        hashes = self._hash(codes[:, i])
        at = np.minimum(np.searchsorted(single[0], hashes), len(single[0]) - 1)
        rows = np.flatnonzero(single[0][at] != hashes)
        if len(rows):
            weight = self.log_weight[byte] * self._fallback(codes, i)[rows]
            alpha[i + 1, rows] = np.logaddexp(alpha[i + 1, rows], alpha[i, rows] + weight)
            kept.append((i, i + 1, rows, np.array(byte), weight))

    def refit(self, uses: np.ndarray) -> None:
        """New weights from expected uses; half a use is added to each, so that none is impossible."""
        uses = uses.copy()
        uses[-2] /= self.n_bytes  # a byte's share of all fallback bytes
        uses += 0.5
        total = uses.sum() + uses[-2] * (self.n_bytes - 1)
        self.log_weight = np.log(uses / total)


def _words(docs: DataFrame) -> DataFrame:
    """(word, n): n is the count in training texts, 0 for words of held-out texts only."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"]
            )

        for batch in small_batches(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                words = (text or b"").lower().split()
                if held_out(doc_id):
                    for word in words:
                        seen.setdefault(word, 0)
                else:
                    seen.update(words)
                if len(seen) >= MOST_COUNTED:
                    yield flush()
                    seen = Counter()
        if seen:
            yield flush()

    return docs.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _fit(words: DataFrame, lattice: PieceLattice, ends: int) -> None:
    spark = words.sparkSession
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(lattice)

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(len(shared.value.log_weight))
            for batch in batches:
                part = [SPACE + w for w in batch.column("word").to_pylist()]
                out += shared.value.expect(part, batch.column("n").to_numpy(zero_copy_only=False))
            at = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out[at])], ["piece", "uses"])

        # at most one row a piece and task to shuffle, one a piece to collect
        rows = words.where("n > 0").mapInArrow(expect, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses"))
        got = rows.toArrow()
        uses = np.zeros(len(lattice.log_weight))
        uses[got["piece"].to_numpy()] = got["uses"].to_numpy()
        uses[-1] = ends
        lattice.refit(uses)


def _scored(words: DataFrame, lattice: PieceLattice) -> DataFrame:
    shared = words.sparkSession.sparkContext.broadcast(lattice)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = shared.value.forward([SPACE + w for w in batch.column("word").to_pylist()]) / _LN10
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(logs)], ["word", "n", "log10"])

    return words.mapInArrow(score, "word string, n long, log10 double")


def score_texts(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score, one row per input row.

    Training texts are those whose crc32(doc_id as text) mod 10 isn't 0; a null doc_id trains and
    isn't held out.  Tokens are the words of ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, then
    one end.  A null, empty or blank text is its end alone.  base_score is the smoothed word-unigram
    score; score the lattice model's, both in log10.  Repeated rows train and are answered each; an
    empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    words = stash(_words(docs))
    trains = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 != 0, F.lit(True))
    ends = docs.where(trains).count()
    n = F.col("n")
    row = words.agg(F.coalesce(F.sum(n), F.lit(0)).alias("n"), F.count_if(n > 0).alias("v")).first()
    total, kinds = row.n + ends, row.v + (ends > 0)
    lattice = PieceLattice.from_file(model_path)
    _fit(words, lattice, ends)
    table = stash(_scored(words, lattice))
    often = table.where(F.col("n") >= max(1, math.ceil(SHARE * total))).toArrow()  # at most 1 / SHARE words
    common = {w.encode(): (n, s) for w, n, s in zip(*(often[c].to_pylist() for c in ("word", "n", "log10")), strict=True)}
    shared = spark.sparkContext.broadcast(common)
    below = total + 0.1 * (kinds + 1)
    end_base = math.log10((ends + 0.1) / below)
    end_score = lattice.log_weight[-1] / _LN10

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        base = {w: math.log10((n + 0.1) / below) for w, (n, _) in known.items()}
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                # a row's own line (word null), and a line for each of its rare words
                row, doc, word, count, n_known, b, s = [], [], [], [], [], [], []
                for r, doc_id, text in zip(*(part.column(c).to_pylist() for c in ("row", "doc_id")), texts(part), strict=True):
                    counts = Counter((text or b"").lower().split())
                    tokens, here, sum_b, sum_s = 1, 1 if ends else 0, end_base, end_score
                    for w, n in counts.items():
                        tokens += n
                        hit = known.get(w)
                        if hit is None:
                            row.append(r)
                            doc.append(None)
                            word.append(w)
                            count.append(n)
                            n_known.append(0)
                            b.append(0.0)
                            s.append(0.0)
                        else:
                            here += n
                            sum_b += n * base[w]
                            sum_s += n * hit[1]
                    row.append(r)
                    doc.append(doc_id)
                    word.append(None)
                    count.append(tokens)
                    n_known.append(here)
                    b.append(sum_b)
                    s.append(sum_s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row, pa.int64()), pa.array(doc, pa.int64()), pa.array(word, pa.binary()).cast(pa.string())]
                    + [pa.array(count, pa.int64()), pa.array(n_known, pa.int64()), pa.array(b), pa.array(s)],
                    ["row", "doc_id", "word", "count", "known", "base", "score"],
                )

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    lines = numbered.mapInArrow(
        split, "row long, doc_id long, word string, count long, known long, base double, score double"
    )
    return _summed(stash(lines), table, total, below)


def _summed(lines: DataFrame, table: DataFrame, total: int, below: float) -> DataFrame:
    """One row a document from its own line and those of its rare words."""
    own = lines.where("word is null").select("row", "doc_id", "count", "known", "base", "score")
    rare = (
        lines.where("word is not null")
        .select("row", "word", "count")
        .join(table, "word")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n") > 0, F.col("count")).otherwise(0)).alias("known_"),
            F.sum(F.col("count") * F.log10((F.col("n") + 0.1) / below)).alias("base_"),
            F.sum(F.col("count") * F.col("log10")).alias("score_"),
        )
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return own.join(rare, "row", "left").select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False)).alias("held_out"),
        F.col("count").alias("n_tokens"),
        (F.col("known") + zero("known_")).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + zero("base_")).alias("base_score"),
        (F.col("score") + zero("score_")).alias("score"),
    )
