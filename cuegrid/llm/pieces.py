"""SentencePiece encoding and decoding by a weighted finite-state transducer (operator 8).

The model file is read on the driver and compiled once; its transducer (bounded by the
vocabulary) is broadcast.  Encoding a text composes three machines and takes the shortest path in
the tropical semiring:

* the *normaliser*: a space in front of a non-empty text, every space becomes U+2581;
* the *pieces*: a trie whose arcs read characters and whose final states write a piece id.  The
  state also holds the piece written last.  Following one piece by another weighs 0 if merging
  their joint string gives back just these two, else infinity.  For a merge (BPE) vocabulary a
  path of finite weight is the encoding, and there is exactly one, so a shortest path needs one
  state a position;
* *byte fallback*: a character that no piece covers writes its UTF-8 bytes' ids.

No piece goes on from another character into a space, and none holds a character that isn't a
piece itself, so the composition falls apart at these places and each part's path is memoised.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cuegrid.llm.common import small_batches

SPACE = "▁"
#: Chunks of one generation of the memo, pairs remembered, characters and ids worked on at a time.
_MEMO_CHUNKS, _MEMO_PAIRS, _BLOCK = 100_000, 500_000, 100_000
_INFINITE = float("inf")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol-buffer message; numbers of 32 or 64 bits stay bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if tag & 7 == 2 else 8 if tag & 7 == 1 else 4
        yield tag >> 3, data[at : at + size]
        at += size


class PieceTransducer:
    """The compiled machine of one model; picklable."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: dict[int, int], silent: set[int], unknown: int) -> None:
        self.unknown = unknown
        self.byte_ids = byte_ids
        self.out = [b"" if i in silent else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        for byte, i in byte_ids.items():
            self.out[i] = bytes([byte])
        self.out[unknown] = " ⁇ ".encode()
        special = silent | set(byte_ids.values()) | {unknown}
        self.ids = {p: i for i, p in enumerate(pieces) if i not in special}
        self.scores = scores
        self.trie: dict[str, list] = {}  # by character: the nodes that follow, and the piece that ends here or -1
        for piece, i in self.ids.items():
            below = self.trie
            for c in piece:
                node = below.setdefault(c, [{}, -1])
                below = node[0]
            node[1] = i
        self.pieces = pieces
        alone = {c for p in self.ids for c in p if c not in self.ids}
        if alone:
            raise ValueError(f"pieces hold characters that aren't pieces: {sorted(alone)[:5]}")
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece holds a space behind another character")
        self._pairs: dict[int, bool] = {}
        self._grown: dict[int, list] = {}  # at most one row a character of the pieces
        self._chunks = _Chunks(self)
        self._apart = re.compile("(?<=[^ ]) ")
        self._split = re.compile(r" *[^ \n]+| +|\n" if "\n" not in self.ids else r" *[^ ]+| +")

    def __reduce__(self):
        silent = {i for i, o in enumerate(self.out) if not o}
        return PieceTransducer, (self.pieces, self.scores, self.byte_ids, silent, self.unknown)

    @classmethod
    def from_file(cls, path: str) -> PieceTransducer:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = {n: v for n, v in _fields(model.serialized_model_proto()) if n in (2, 3)}
        trainer, rules = dict(_fields(spec[2])), dict(_fields(spec[3]))
        if trainer.get(3, 1) != 2 or not trainer.get(35) or trainer.get(24):
            raise ValueError("only merge (BPE) models with byte fallback and spaces in front of words")
        if rules.get(2) or not rules.get(3, 1) or rules.get(4, 1) or not rules.get(5, 1):
            raise ValueError("only the identity normaliser that adds a space in front and keeps all spaces")
        size = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(size)]
        if any(model.is_unused(i) for i in range(size)):
            raise ValueError("unused pieces aren't supported")
        byte_ids = {int(pieces[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        silent = {i for i in range(size) if model.is_control(i)}
        return cls(pieces, [model.get_score(i) for i in range(size)], byte_ids, silent, model.unk_id())

    def _grows(self, piece: int) -> list[tuple[float, str, str]]:
        """(score, first part, last part) after each merge of a piece's characters: best score first, leftmost among equals.

        The last row has no score; there is none at all for a piece that its characters don't merge to.
        """
        score = lambda x: self.scores[self.ids[x]] if x in self.ids else -_INFINITE
        parts = list(self.pieces[piece])
        links = [score(x + y) for x, y in zip(parts, parts[1:])]
        rows, ends = [], (parts[0], parts[-1])
        while links and (best := max(links)) > -_INFINITE:
            rows.append((best, *ends))
            k = links.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del links[k]
            if k:
                links[k - 1] = score(parts[k - 1] + parts[k])
            if k < len(links):
                links[k] = score(parts[k] + parts[k + 1])
            ends = (parts[0], parts[-1])
        self._grown[piece] = found = [] if links else [*rows, (-_INFINITE, *ends)]
        return found

    def _follows(self, last: int, piece: int) -> bool:
        """Whether ``piece`` may follow ``last``: the arc weighs 0, otherwise infinity.

        Merging their joint string does what merging either does, best score first, unless parts on both sides of the joint merge.
        """
        if len(self._pairs) >= _MEMO_PAIRS:
            self._pairs.clear()
        left, right = (self._grown.get(x) or self._grows(x) for x in (last, piece))
        may = bool(left and right)
        i = j = 0
        while may:
            (mine, _, before), (theirs, after, _) = left[i], right[j]
            joint = self.ids.get(before + after)
            if joint is not None and self.scores[joint] > mine and self.scores[joint] >= theirs:
                may = False
            elif mine == theirs == -_INFINITE:
                break
            elif mine >= theirs:
                i += 1
            else:
                j += 1
        self._pairs[last * len(self.pieces) + piece] = may
        return may

    def path(self, chunk: str) -> list[int]:
        """The shortest path over one normalised chunk, as ids.

        All weights are 0 or infinity, so the search goes depth first, longest pieces first.  A prefix has one path of
        finite weight, so a position from which no piece goes on is left for good.
        """
        size, n = len(chunk), len(self.pieces)
        trie, known, dead = self.trie, self._pairs, set()
        starts: list[int] = []
        wrote: list[int] = []  # the pieces (-1: bytes) and where they start
        i, last = 0, -1
        while i < size:
            node, ends, j = trie.get(chunk[i]), [], i
            if node is None and i + 1 not in dead:  # no piece holds it
                starts.append(i)
                wrote.append(-1)
                i, last = i + 1, -1
                continue
            while node is not None:
                j += 1
                below, piece = node
                if piece >= 0 and j not in dead:
                    ends.append((j, piece))
                if j == size:
                    break
                node = below.get(chunk[j])
            for j, piece in reversed(ends):
                may = last < 0 or known.get(last * n + piece)
                if may is None:
                    may = self._follows(last, piece)
                if may:
                    starts.append(i)
                    wrote.append(piece)
                    i, last = j, piece
                    break
            else:
                dead.add(i)
                i = starts.pop()
                wrote.pop()
                last = wrote[-1] if wrote else -1
        if -1 not in wrote:
            return wrote
        out: list[int] = []
        for start, piece in zip(starts, wrote, strict=True):
            out += [piece] if piece >= 0 else [self.byte_ids[b] for b in chunk[start].encode("utf-8", "replace")]
        return out

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text (int32)."""
        if not text:
            return np.empty(0, np.int32)
        spaced, at, out = " " + text.replace(SPACE, " "), 0, []
        while at < len(spaced):  # a long text's chunks take many times its size
            cut = self._apart.search(spaced, at + _BLOCK)
            to = cut.start() if cut else len(spaced)
            out.append(b"".join(map(self._chunks.__getitem__, self._split.findall(spaced, at, to))))
            at = to
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text of ids: bytes join across pieces, wrong UTF-8 is replaced, one leading space goes."""
        out, data = self.out, bytearray()
        for at in range(0, len(ids), _BLOCK):
            part = ids[at : at + _BLOCK]
            data += b"".join([out[i] for i in (part.tolist() if isinstance(part, np.ndarray) else part)])
        return data.decode("utf-8", "replace").removeprefix(" ")


class _Chunks(dict):
    """Ids of chunks; what wasn't asked for over a whole generation goes, so common chunks stay."""

    def __init__(self, owner: PieceTransducer) -> None:
        self.owner, self.before = owner, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.before.get(chunk)
        if ids is None:
            ids = array("i", self.owner.path(chunk.replace(" ", SPACE))).tobytes()
        if len(chunk) <= 64:
            if len(self) >= _MEMO_CHUNKS:
                self.before = dict(self)
                self.clear()
            self[chunk] = ids
        return ids


def encode_pieces(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_pieces, ids and round_trip of every whole text.

    round_trip says whether decoding the ids gives the text back; only texts that hold U+2581,
    which encodes as a space, can fail it.  Null and empty texts have no ids and round_trip true.
    Every input row is answered, in whatever order; a null doc_id stays null; an empty table gives
    an empty result; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(PieceTransducer.from_file(model_path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for part in small_batches(batches):
            sizes, held, same = [], [], []
            for text in part.column("text").to_pylist():
                ids = machine.encode(text or "")
                sizes.append(len(ids))
                held.append(ids)
                same.append(machine.decode(ids) == (text or ""))
            flat = np.concatenate([np.empty(0, np.int32), *held])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(flat, pa.int32())),
                    pa.array(same, pa.bool_()),
                ],
                ["doc_id", "n_pieces", "ids", "round_trip"],
            )

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, n_pieces long, ids array<int>, round_trip boolean")


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text of ``encoded(doc_id, ids)``; null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(PieceTransducer.from_file(model_path))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                made = [shared.value.decode(ids or []) for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(made, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")
