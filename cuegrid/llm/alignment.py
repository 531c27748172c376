"""Cross-tokenizer alignment by a dictionary of token groups (operator 12).

Where tokens of both vocabularies end at the same byte a text falls into groups: a few ids of A beside a few ids of B over the
same bytes.  A group's ids say all about its links (the pairs of tokens that share a byte), so distinct groups are
interned in one dictionary, links are made once for each distinct group and weighed by its frequency (or by the
documents that hold it), and what follows for a group is joined back to the documents by the group's key, which is
its ids in bytes.

Neither vocabulary has a token that goes on from another character into a space or a line feed, so texts are
tokenised between these places, and what has been tokenised is remembered.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuegrid.llm.common import small_batches, stash

SPACE = "▁"
_MEMO_CHUNKS, _MEMO_CHARS, _KNOWN_GROUPS = 200_000, 64, 500_000
#: Set in an id of B within a group's key.
OF_B = 1 << 31
#: A key is hot if it holds more than this share of all rows: so at most 1 / HOT keys are.
HOT = 1 / 100_000


def byte_level_bytes(token: str) -> bytes:
    """The bytes that a token of a byte-level vocabulary stands for: printable Latin-1 for itself, others from U+0100 on."""
    return bytes(_BYTE_OF[c] for c in token)


_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_OF = {chr(b): b for b in _PRINTABLE} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class Aligner:
    """Tokenises texts by both vocabularies and cuts them into groups; made in each Python worker from the files' contents."""

    #: Never within a token of either vocabulary: the place before a space or line feed behind another character.
    _CHUNK = re.compile(r"\s*\S+(?:[^\S \n]\s*\S*)*|\s+")
    _OTHER = re.compile(r"[^\S \n]")

    def __init__(self, a_json: str, b_model: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        spec = json.loads(a_json)
        pre = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("A must be a byte-level vocabulary that splits words and changes nothing")
        self.a_bytes = {i: byte_level_bytes(t) if all(c in _BYTE_OF for c in t) else t.encode() for t, i in self.a.get_vocab().items()}
        self.b = b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in pieces):
            raise ValueError("a piece of B goes on into a space or line feed")
        self.lead = b.encode("\n")
        if b"".join(self.b_bytes[i] for i in self.lead) != b" \n" or b.encode("\n  x")[: len(self.lead)] != self.lead:
            raise ValueError("B must put a space in front and keep all spaces and line feeds")
        widest = max(self.a_bytes) + 1
        self.a_sizes = np.array([len(self.a_bytes.get(i, b"")) for i in range(widest)], np.int64)
        self.b_sizes = np.array([len(p) for p in self.b_bytes], np.int64)
        # an id as text and what follows it: in its list a comma, behind the list a bar (A) or semicolon (B)
        ids = [[f"{i}{end}" for i in range(n)] for n, ends in ((widest, ",|"), (len(pieces), ",;")) for end in ends]
        self.said = np.array([x for part in ids for x in part], object)
        self.said_from = np.cumsum([0, widest, widest, len(pieces)])
        self.forget()

    def forget(self) -> None:
        self.chunks: dict[str, tuple[bytes, str, int, int] | None] = {}
        self.older: dict[str, tuple[bytes, str, int, int] | None] = {}
        self.groups: dict[bytes, int] = {}
        self.keys: list[bytes] = []

    def split(self, text: str) -> list[str]:
        """The chunks of a text behind a space."""
        text = " " + text
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or "\0" in text or self._OTHER.search(text):
            return self._CHUNK.findall(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")[1:]  # each space and line feed begins a chunk

    def _learn(self, chunks: list[str]) -> dict[str, tuple[bytes, str, int, int] | None]:
        """Of each chunk: its groups' numbers (int32 bytes), their ids as text, and how many tokens; None if bytes are lost."""
        if not chunks:
            return {}
        a = [e.ids for e in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        lead = len(self.lead)
        b = [ids[lead:] for ids in self.b.encode(["\n" + c for c in chunks], num_threads=1)]
        data = [c.encode() for c in chunks]
        good = range(len(chunks))
        if not self._whole(a, b, data):
            good = [i for i in good if self._whole(a[i : i + 1], b[i : i + 1], data[i : i + 1])]
        made = dict.fromkeys(chunks)
        if good:
            made |= self._grouped([chunks[i] for i in good], [a[i] for i in good], [b[i] for i in good])
        return made

    def _whole(self, a: list[list[int]], b: list[list[int]], data: list[bytes]) -> bool:
        """Whether the tokens of all chunks, each on its own, give back the chunks' bytes."""
        for table, lists in ((self.a_bytes, a), (self.b_bytes, b)):
            parts = [b"".join([table[i] for i in ids]) for ids in lists]
            if parts != data:
                return False
        return True

    def _grouped(self, chunks: list[str], a: list[list[int]], b: list[list[int]]) -> dict[str, tuple[bytes, str, int, int]]:
        """Cut all chunks at once where tokens of both end at the same byte; a chunk's end is such a place."""
        n_a, n_b = (np.array([len(x) for x in lists]) for lists in (a, b))
        flat_a, flat_b = (np.fromiter(chain.from_iterable(lists), np.int64, n.sum()) for lists, n in ((a, n_a), (b, n_b)))
        ends_a, ends_b = np.cumsum(self.a_sizes[flat_a]), np.cumsum(self.b_sizes[flat_b])
        last_a, last_b = np.isin(ends_a, ends_b, assume_unique=True), np.isin(ends_b, ends_a, assume_unique=True)
        # all tokens by group, those of A first
        group = np.r_[np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b]
        order = np.argsort(group, kind="stable")
        codes = np.r_[flat_a, flat_b + OF_B].astype("<u4")[order].tobytes()
        words = self.said[np.r_[flat_a + self.said_from[last_a.astype(int)], flat_b + self.said_from[2 + last_b]][order]].tolist()
        sizes = np.bincount(group)
        at = np.r_[0, np.cumsum(sizes)]
        numbers = np.empty(len(sizes), np.int32)
        known, keys = self.groups, self.keys
        bounds = (at * 4).tolist()
        for g in range(len(sizes)):
            key = codes[bounds[g] : bounds[g + 1]]
            number = known.get(key)
            if number is None:
                number = known[key] = len(keys)
                keys.append(key)
            numbers[g] = number
        held = numbers.tobytes()
        # groups up to each chunk's end
        upto = np.r_[0, np.cumsum(last_a)[np.cumsum(n_a) - 1]]
        of_words, of_groups = at[upto].tolist(), (upto * 4).tolist()
        return {
            c: (held[of_groups[i] : of_groups[i + 1]], "".join(words[of_words[i] : of_words[i + 1]]), x, y)
            for i, (c, x, y) in enumerate(zip(chunks, n_a.tolist(), n_b.tolist(), strict=True))
        }

    def align(self, texts: list[str | None]) -> list[tuple | None]:
        """For each text n_a, n_b, n_groups, groups_sha256, its distinct groups' numbers and counts; None without tokens."""
        if len(self.keys) > _KNOWN_GROUPS:
            self.forget()
        if len(self.chunks) > _MEMO_CHUNKS:
            self.chunks, self.older = {}, self.chunks
        split = [self.split(t) if t else [] for t in texts]
        new = set().union(*split).difference(self.chunks)
        self.chunks.update({c: self.older[c] for c in new if c in self.older})
        new = [c for c in new if c not in self.older]
        self.chunks.update(self._learn(new))
        out = []
        for chunks in split:
            parts = list(map(self.chunks.__getitem__, chunks))
            if not parts or None in parts:
                out.append(None)
                continue
            held, said, n_a, n_b = zip(*parts, strict=True)
            numbers, counts = np.unique(np.frombuffer(b"".join(held), np.int32), return_counts=True)
            digest = hashlib.sha256("".join(said)[:-1].encode()).hexdigest()
            out.append((sum(n_a), sum(n_b), int(counts.sum()), digest, numbers, counts))
        for c in new:
            if len(c) > _MEMO_CHARS:
                del self.chunks[c]
        return out


_MADE: dict[str, Aligner] = {}


def _aligner(files: tuple[str, bytes]) -> Aligner:
    """The worker's own, kept between its tasks."""
    name = hashlib.sha256(files[0].encode() + files[1]).hexdigest()
    if name not in _MADE:
        _MADE.clear()
        _MADE[name] = Aligner(*files)
    return _MADE[name]


def ids_of(key: bytes) -> tuple[list[int], list[int]]:
    """The ids of A and of B of a group's key."""
    codes = np.frombuffer(key, "<u4")
    n = int(np.count_nonzero(codes < OF_B))
    return codes[:n].tolist(), (codes[n:] - np.uint32(OF_B)).tolist()


def read_vocabularies(a_path: str, b_path: str) -> tuple[str, bytes]:
    """The contents of the two vocabulary files, read on the driver (a few MB, whatever the data)."""
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return a.read(), b.read()


def token_groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups_sha256, groups (array of key and n, distinct in the row) of each row.

    Null and empty texts, and those whose tokens don't give back the text behind a space (as with U+2581), have none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabularies(a_path, b_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(shared.value)
        for part in small_batches(batches, size=4 << 20):
            made = [x or (0, 0, 0, "", np.empty(0, np.int32), np.empty(0, np.int64)) for x in aligner.align(part.column("text").to_pylist())]
            ends = pa.array(np.cumsum([0, *(len(x[4]) for x in made)]), pa.int32())
            numbers = np.concatenate([x[4] for x in made])
            distinct, place = np.unique(numbers, return_inverse=True)
            keys = pa.array([aligner.keys[i] for i in distinct.tolist()], pa.binary()).take(pa.array(place))
            counts = pa.array(np.concatenate([x[5] for x in made]).astype(np.int64))
            groups = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([keys, counts], ["key", "n"]))
            columns = [pa.array([x[i] for x in made], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), *columns, pa.array([x[3] for x in made], pa.string()), groups],
                ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "groups"],
            )

    schema = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, groups array<struct<key: binary, n: long>>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def expand_links(dictionary: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """dictionary(key, weight) -> (key, weight, a, b, m): m links of the group are between ids a and b."""
    shared = dictionary.sparkSession.sparkContext.broadcast(read_vocabularies(a_path, b_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(shared.value)
        for batch in small_batches(batches, rows=20_000):
            links, sizes = [], []
            for key in batch.column("key").to_pylist():
                a, b = ids_of(key)
                found: dict[tuple[int, int], int] = {}
                j, start, end_b = 0, 0, len(aligner.b_bytes[b[0]])
                for x in a:
                    end = start + len(aligner.a_bytes[x])
                    while True:
                        found[x, b[j]] = found.get((x, b[j]), 0) + 1
                        if end_b > end or j + 1 == len(b):
                            break
                        if end_b == end:
                            j += 1
                            end_b += len(aligner.b_bytes[b[j]])
                            break
                        j += 1
                        end_b += len(aligner.b_bytes[b[j]])
                    start = end
                links += [(*pair, m) for pair, m in found.items()]
                sizes.append(len(found))
            at = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
            flat = np.array(links, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(at), batch.column("weight").take(at), *(pa.array(np.ascontiguousarray(flat[:, i])) for i in range(3))],
                ["key", "weight", "a", "b", "m"],
            )

    return dictionary.select("key", "weight").mapInArrow(run, "key binary, weight long, a long, b long, m long")


def join_by_weight(left: DataFrame, right: DataFrame, on: list[str], weight: str) -> DataFrame:
    """``left`` joined with ``right`` (one row a key, written already), whose column ``weight`` says how many rows of ``left`` have the key.

    Keys of more than the share ``HOT`` of all rows are at most 1 / HOT, so these are broadcast; no other key
    is large enough to fill a task.  Every row is joined in one of the two ways.
    """
    total = right.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight) > total * HOT
    hot = F.broadcast(right.where(is_hot).drop(weight))
    rest = left.join(F.broadcast(right.where(is_hot).select(*on)), on, "left_anti")
    return left.join(hot, on).unionByName(rest.join(right.where(~is_hot).drop(weight).hint("merge"), on))


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, by: str = "frequency") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, pairs, dictionary): per row the groups and what its links say, linked id pairs with counts, distinct groups.

    pairs(a, b, count, best): how many links hold the ids, weighed by the groups' frequency (``by="frequency"``) or
    by the documents that hold the group (``by="documents"``); best: no pair of the same b has more.
    dictionary(key, frequency, documents, n_links, n_best, count_sum): of one occurrence of the group.
    rows(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): every row of ``docs``, null ids and repeated rows too.
    """
    made = stash(token_groups(docs, a_path, b_path).withColumn("row", F.monotonically_increasing_id()))
    held = made.select("row", F.inline("groups"))
    dictionary = stash(held.groupBy("key").agg(F.sum("n").alias("frequency"), F.count("*").alias("documents")))
    weight = F.col("frequency" if by == "frequency" else "documents")
    links = stash(expand_links(dictionary.select("key", weight.alias("weight")), a_path, b_path))
    counted = stash(links.groupBy("a", "b").agg(F.sum(F.col("m") * F.col("weight")).alias("count"), F.count("*").alias("groups")))
    most = counted.groupBy("b").agg(F.max("count").alias("most"))
    pairs = stash(counted.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"), "groups"))
    told = join_by_weight(links.select("key", "a", "b", "m"), pairs, ["a", "b"], "groups")
    summed = told.groupBy("key").agg(
        F.sum("m").alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("n_best"),
        F.sum(F.col("m") * F.col("count")).alias("count_sum"),
    )
    dictionary = stash(dictionary.join(summed, "key"))
    back = join_by_weight(held, dictionary.drop("frequency"), ["key"], "documents")
    each = lambda c: F.sum(F.col(c) * F.col("n")).alias(c)
    sums = back.groupBy("row").agg(each("n_links"), each("n_best"), each("count_sum"))
    rows = made.drop("groups").join(sums, "row", "left").na.fill(0, ["n_links", "n_best", "count_sum"])
    rows = rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return rows, pairs.drop("groups"), dictionary
