"""N-gram Jaccard self-join by token-combination prefixes (operator 4).

Tokens are the 64-bit hashes of a text's distinct word shingles.  Two sets link when
``100 * |A & B| >= percent * |A | B|``.  The join is exact, and its steps are:

1. *Frequent classes.*  Each task counts tokens over blocks of texts; a token seen several times
   in a block is of the frequent class.  The class is kept in a bitmap of fixed size (2 MB).  A
   token put there by chance only gets other keys, so the result doesn't depend on it.
2. *Keys.*  Tokens are ordered rare first, then by hash.  Of the prefix of ``s - ceil(t*s) + 1``
   tokens, each rare token is a key of its own.  If fewer tokens than that are rare, the prefix is
   extended into the frequent tokens, and every two of these that follow each other are a key.
   Linked sets differ in at most ``E = (1-t)/t * s`` tokens, so among ``E + 2`` shared frequent tokens some two have no
   differing token between them and follow each other in both sets; they lie within the first
   ``2E + 2`` frequent tokens of either.  A linked pair thus shares a rare key or a combination.
3. *Classes.*  Texts with equal sets are one class; only its smallest id carries keys.
4. *Verification.*  Every class has a parity sketch: each token flips one of at least 4E bits, so
   two sets differ in no fewer tokens than their sketches in bits; pairs with too many are out.
   The others are verified on the whole sets.  Under every key each class is compared with the
   key's first class only; a key's classes by size are cut before where sizes allow no link.  The links found are merged into components; then classes of one key
   that are still in different components are compared, in crowds by their differences from the crowd's common tokens, after the
   most central ones were.  Links inside one component can't change the components, so
   no link between components is lost.
5. *Links* (``similar_pairs``, only where asked for).  Linked classes are in one component, so each component is
   compared in full: its sets, by size, in blocks of bounded size, every two blocks in a task of their own, by counts
   of common tokens.  Copies with equal sets stay one class.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuegrid.llm.common import (
    Shingler,
    bitmap_from,
    bitmap_of_words,
    in_bitmap,
    mix,
    small_batches,
    stash,
    texts,
    words_for_bitmap,
)
from cuegrid.llm.components import connected_components

#: Tokens counted at once by a task, and the count there from which a token is frequent.
BLOCK_TOKENS, FREQUENT_IN_BLOCK = 2_000_000, 2
#: Below this many tokens a set keeps single keys for its frequent tokens too.
SMALL_SET = 32
#: Up to so many members, a hub's members are compared key by key (their sketches, within the join);
#: beyond, by their differences, which takes whole token sets.
FEW, USUAL = 1_000, 32
#: Further members of a hub that are compared with all others, and how many a hub must have left out for it.
STARS, OPEN = 3, 50
#: Differences of up to so many tokens go along with a pair's keys, so that it is decided where it is made.
CARRIED = 256
#: Tokens of a block whose links are counted at once, what a member adds to them, and the tokens of one matrix.
LINK_BLOCK, MEMBER_TOKENS, COLUMNS = 200_000, 200, 4096


def _frequent(docs: DataFrame, n: int) -> np.ndarray:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, held, size, seen = Shingler(n, True), [], 0, set()

        def flush() -> pa.RecordBatch:
            tokens = np.concatenate(held)
            tokens.sort()
            word, bits = words_for_bitmap(tokens[FREQUENT_IN_BLOCK - 1 :][tokens[FREQUENT_IN_BLOCK - 1 :] == tokens[: 1 - FREQUENT_IN_BLOCK]])
            return pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits)], ["word", "bits"])

        for batch in small_batches(batches):
            for text in texts(batch):
                tokens = shingles.distinct(text)
                key = hash(tokens.tobytes())
                if not len(tokens) or key in seen:
                    continue
                seen.add(key)
                held.append(tokens)
                size += len(tokens)
                if size >= BLOCK_TOKENS:
                    yield flush()
                    held, size, seen = [], 0, set()
        if held:
            yield flush()

    return bitmap_of_words(docs.select("text").mapInArrow(count, "word long, bits long"))


def _keys(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The index keys of a sorted token set."""
    size = len(tokens)
    prefix = size + (-percent * size) // 100 + 1
    often = in_bitmap(frequent, tokens)
    rare, common = tokens[~often], tokens[often]
    found = [rare[:prefix]]
    if len(rare) < prefix:
        errors = (100 - percent) * size // percent
        run = common[: 2 * errors + 2]
        found.append(mix(run[:-1] * np.uint64(3) + run[1:]))
    if size < SMALL_SET:
        found.append(common[: max(0, prefix - len(rare))])
    return np.unique(np.concatenate(found))


def _sketch(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Parity of the tokens at each of a power of two of bits, as 64-bit words."""
    errors = (100 - percent) * len(tokens) // percent
    bits = max(256, 1 << (4 * errors).bit_length())
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _differing_bits(x: Column, y: Column) -> Column:
    """Bits in which two sketches differ; the longer one (twice as long at most) is folded."""
    fold = lambda v, size: F.when(F.size(v) == size, v).otherwise(
        F.zip_with(F.slice(v, 1, size), F.slice(v, size + 1, size), lambda p, q: p.bitwiseXOR(q))
    )
    size = F.least(F.size(x), F.size(y))
    apart = F.zip_with(fold(x, size), fold(y, size), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(apart, F.lit(0), lambda a, b: a + b)


def _keyed(docs: DataFrame, n: int, percent: int, frequent: np.ndarray) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(n, True)
        for batch in small_batches(batches):
            sizes, signs, keys, sketches = [], [], [], []
            for text in texts(batch):
                tokens = shingles.distinct(text)
                sizes.append(len(tokens))
                signs.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None)
                keys.append(_keys(tokens, shared.value, percent).view(np.int64) if len(tokens) else np.empty(0, np.int64))
                sketches.append(_sketch(tokens, percent))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(signs, pa.binary()),
                    _lists(keys),
                    _lists(sketches),
                ],
                ["doc_id", "n_shingles", "sign", "keys", "sketch"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        key, "doc_id long, n_shingles long, sign binary, keys array<long>, sketch array<long>"
    )


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate([np.empty(0, np.int64), *rows])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), pa.array(flat, pa.int64()))


def _sets(docs: DataFrame, n: int, ids: DataFrame) -> DataFrame:
    """(id, tokens) of the documents in ``ids``, and of a few others that pass the bitmap by chance."""
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap_from(ids.select(F.xxhash64("id").alias("h")), "h"))
    hashed = docs.select("doc_id", "text", F.xxhash64(F.col("doc_id").cast("long")).alias("h"))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(n, True)
        for batch in small_batches(batches):
            hashes = batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64)
            kept = batch.filter(pa.array(in_bitmap(wanted.value, hashes)))
            for at in range(0, kept.num_rows, 500):
                part = kept.slice(at, 500)
                tokens = [shingles.distinct(x).view(np.int64) for x in texts(part)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), _lists(tokens)], ["id", "tokens"])

    out = hashed.mapInArrow(collect, "id long, tokens array<long>")
    return out.join(ids, "id", "left_semi").dropDuplicates(["id"])


def _possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs (a, b) that sizes and sketches don't rule out, written."""
    side = lambda c: classes.select(F.col("id").alias(c), F.col("size").alias(f"s{c}"), F.col("sketch").alias(f"k{c}"))
    near = _near("sa", "sb", "ka", "kb", percent)
    return stash(pairs.distinct().join(side("a"), "a").join(side("b"), "b").where(near).select("a", "b"))


def _near(size_x: str, size_y: str, sketch_x: str, sketch_y: str, percent: int) -> Column:
    """Whether sizes and sketches allow a link."""
    smaller = F.least(size_x, size_y)
    fits = smaller * 100 >= F.greatest(size_x, size_y) * percent
    most = F.floor(smaller * (100 - percent) / percent)
    return F.when(fits, _differing_bits(F.col(sketch_x), F.col(sketch_y)) <= most).otherwise(F.lit(False))


def _linked(size_x: str, size_y: str, tokens_x: str, tokens_y: str, percent: int) -> Column:
    """Whether sets, held by their differences from one set, link; true where either isn't known."""
    total, common = F.col(size_x) + F.col(size_y), F.size(F.array_intersect(tokens_x, tokens_y))
    apart = F.size(tokens_x) + F.size(tokens_y) - 2 * common
    unknown = F.col(tokens_x).isNull() | F.col(tokens_y).isNull()
    return unknown | (apart * (100 + percent) <= total * (100 - percent))


def _verified(docs: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole token sets are similar enough."""
    sets = _sets(docs, n, pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    left = sets.select(F.col("id").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("id").alias("b"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb")).cast("long")
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", both.alias("n"), (F.size("ta") + F.size("tb")).cast("long").alias("m"))
        .where(F.col("n") * 100 >= (F.col("m") - F.col("n")) * percent)
        .select("a", "b")
    )


def ngram_jaccard_join(docs: DataFrame, n: int = 5, percent: int = 80, links: bool = False) -> DataFrame:
    """Similar documents, one row per input row: doc_id, n_shingles, component_id, class_id (and n_links).

    ``docs`` needs doc_id (any integer type) and text; other columns are ignored.  class_id is the
    smallest doc_id with the same shingle set, component_id the smallest reachable by links.
    Null, empty and blank texts have no shingles and keep their own id in both.  Texts of fewer
    than ``n`` words have their whole word sequence as their only shingle.  Rows that repeat are
    answered each; rows with a null doc_id keep null ids and link with nothing.  An empty table
    gives an empty result.  With ``links``, n_links is the number of other classes that the row's
    class links with: all links, also those inside a component.
    """
    if not 70 <= percent <= 100:
        raise ValueError("percent must be from 70 to 100: below that the combinations prove nothing")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = stash(_keyed(docs, n, percent, _frequent(docs, n)))
    classes = stash(
        keyed.where("sign is not null and doc_id is not null")
        .groupBy("sign")
        .agg(F.min("doc_id").alias("id"), *(F.first(c).alias(to) for c, to in (("n_shingles", "size"), ("keys", "keys"), ("sketch", "sketch"))))
    )
    shared = stash(_shared(classes.select("id", "size", F.explode("keys").alias("key")), percent))
    labels = connected_components(_edges(docs, classes.select("id", "size", "sketch"), shared, n, percent))
    member = classes.join(labels, "id", "left").select(
        "sign", F.col("id").alias("class_id"), F.coalesce("component", "id").alias("component_id")
    )
    own = F.col("doc_id")
    found = ["doc_id", "n_shingles", F.when(own.isNotNull(), F.coalesce("component_id", own)).alias("component_id"),
             F.when(own.isNotNull(), F.coalesce("class_id", own)).alias("class_id")]
    if links:
        ends = similar_pairs(docs, labels, n, percent, True).groupBy(F.col("id").alias("class_id")).agg(F.sum("n").alias("n_links"))
        member = member.join(stash(ends), "class_id", "left")
        found.append(F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return keyed.join(member, "sign", "left").select(*found)


def _shared(postings: DataFrame, percent: int) -> DataFrame:
    """(key, id, hub, n): the members of every key that more than one class has, its first one and their number.

    A key's members by size are cut wherever the next one is too large for a link with the one before it, and so with any
    before it; each run is a key of its own.  A token that texts of many sizes share by chance thus joins few of them.
    """
    first = postings.groupBy("key").agg(F.min("id").alias("one"), F.max("id").alias("other")).where("one < other")
    by_size = Window.partitionBy("key").orderBy("size", "id")
    apart = F.coalesce(F.lag("size").over(by_size) * 100 < F.col("size") * percent, F.lit(False)).cast("int")
    rows = postings.join(first.select("key"), "key").withColumn("apart", apart)
    rows = rows.withColumn("run", F.sum("apart").over(by_size.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("key", "run")
    rows = rows.withColumns({"hub": F.min("id").over(run), "n": F.count("*").over(run)}).where("n > 1")
    return rows.select(F.struct("key", "run").alias("key"), "id", "hub", "n")


def similar_pairs(docs: DataFrame, labels: DataFrame, n: int, percent: int, counted: bool = False) -> DataFrame:
    """Every link (a, b), a < b, between the classes of ``labels(id, component)``, once.

    ``counted``: instead (id, n), the links of a class in two blocks, so that no row a link is made.
    A component's sets are put in blocks by size; blocks whose sizes allow no link don't meet.
    """
    sets = stash(_sets(docs, n, labels.select("id")).join(labels, "id"))
    rows = sets.select("component", "id", F.size("tokens").cast("long").alias("size"))
    upto = F.sum(F.col("size") + MEMBER_TOKENS).over(Window.partitionBy("component").orderBy("size", "id"))
    rows = stash(rows.withColumn("block", F.floor(upto / LINK_BLOCK)))
    blocks = rows.groupBy("component", "block").agg(F.min("size").alias("lo"), F.max("size").alias("hi"))
    x, y = blocks.alias("x"), blocks.alias("y")
    meet = (
        (F.col("x.component") == F.col("y.component"))
        & (F.col("x.block") <= F.col("y.block"))
        & (F.col("x.hi") * 100 >= F.col("y.lo") * percent)
    )
    meeting = stash(x.join(y, meet).select("x.component", F.col("x.block").alias("one"), F.col("y.block").alias("two")))
    sides = F.array_distinct(F.array("one", "two"))
    sent = rows.join(meeting.withColumn("block", F.explode(sides)), ["component", "block"]).join(sets.select("id", "tokens"), "id")

    def link(key: tuple, group: pa.Table) -> pa.Table:
        ids = group["id"].to_numpy()
        tokens = group["tokens"].combine_chunks()
        sizes = tokens.value_lengths().to_numpy()
        first = group["block"].to_numpy() == key[1].as_py()
        second = first if key[1] == key[2] else ~first
        _, code, times = np.unique(tokens.flatten().to_numpy(), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(ids)), sizes)[times[code] > 1]
        kept = times > 1  # others are common to no two
        code = (np.cumsum(kept) - 1)[code[times[code] > 1]]
        order = np.argsort(code, kind="stable")
        row, code, total = row[order], code[order], int(kept.sum())
        common = np.zeros((int(first.sum()), int(second.sum())), np.float64)
        for at in range(0, total, COLUMNS):
            lo, hi = np.searchsorted(code, [at, at + COLUMNS])
            held = np.zeros((len(ids), min(COLUMNS, total - at)), np.float32)
            held[row[lo:hi], code[lo:hi] - at] = 1
            common += held[first] @ held[second].T
        either = sizes[first][:, None].astype(np.int64) + sizes[second][None, :] - common
        linked = common * 100 >= either * percent
        if first is second:
            linked = np.triu(linked, 1)
        if counted:
            ends = np.concatenate([ids[first], ids[second]])
            return pa.table({"id": ends, "n": np.concatenate([linked.sum(1), linked.sum(0)]).astype(np.int64)})
        i, j = np.nonzero(linked)
        a, b = ids[first][i], ids[second][j]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return sent.groupBy("component", "one", "two").applyInArrow(link, "id long, n long" if counted else "a long, b long")


def _edges(docs: DataFrame, classes: DataFrame, shared: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) that connect all linked classes of ``shared(key, id, hub, n)``.

    A key of two members is done with its hub's comparison, and one whose other members are in one component with theirs.
    The rounds of further stars take a hub's members, which are fewer than its keys' rows, and end when one links nothing.
    """
    rows = shared.where("id <> hub")
    found = stash(_verified(docs, _possible(rows.select(F.col("hub").alias("a"), F.col("id").alias("b")), classes, percent), n, percent))
    labels, moved = connected_components(found), False
    placed = stash(_unsettled(rows.where("n > 2"), labels))
    members = stash(placed.select("hub", "id", "part").distinct())
    for _ in range(STARS):
        more = _possible(_further_stars(members, labels), classes, percent)
        new = more if more.isEmpty() else stash(_verified(docs, more, n, percent))
        if new.isEmpty():  # a further round would compare the same pairs
            break
        found, moved = found.union(new), True
        labels = connected_components(found)
        members = stash(members.drop("part").join(labels, "id", "left").select("hub", "id", F.coalesce("component", "id").alias("part")))
    if moved:
        placed = stash(_unsettled(placed, labels))
        members = placed.select("hub", "id", "part").distinct()
    crowds = stash(_crowds(members, min(FEW, OPEN)))
    differing = None if crowds.isEmpty() else _differences(docs, crowds, n, percent)
    if differing is not None:
        stars, labels = _central_stars(differing, found, labels, percent)
        found = found.union(stars)
        placed = stash(_unsettled(placed, labels))
        members = placed.select("hub", "id", "part").distinct()
    open_ = stash(_open_hubs(members))
    few = placed.join(open_.where(F.col("n") <= FEW).select("hub"), "hub")
    if differing is None:
        rest = _pairs_of_keys(few.withColumn("tokens", F.lit(None).cast("array<bigint>")), classes, percent)
    else:
        carried = differing.select("hub", "id", F.when(F.size("tokens") <= CARRIED, F.col("tokens")).alias("tokens"))
        rest = _pairs_of_keys(few.join(carried, ["hub", "id"], "left"), classes, percent)
        many = members.join(open_.where(F.col("n") > FEW).select("hub"), "hub").join(carried, ["hub", "id"])
        rest = rest.union(_pairs_of_differences(many.join(differing.select("hub", "id", "first"), ["hub", "id"]), classes, percent))
    rest = _possible(rest, classes, percent)
    return found if rest.isEmpty() else found.union(_verified(docs, rest, n, percent))


def _open_hubs(members: DataFrame) -> DataFrame:
    """(hub, n): the hubs of ``members(hub, id, part)`` in several components; the hub has been compared with all."""
    parts = members.groupBy("hub").agg(F.count("*").alias("n"), F.min("part").alias("lo"), F.max("part").alias("hi"))
    return parts.where("lo < hi").select("hub", "n")


def _crowds(members: DataFrame, least: int) -> DataFrame:
    """The members of open hubs with over ``least`` of them."""
    return members.join(_open_hubs(members).where(F.col("n") > least).select("hub"), "hub")


def _unsettled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, id, hub, part): ``rows(key, id, hub)`` with their components, of keys whose members are in several."""
    of_key = Window.partitionBy("key")
    placed = rows.join(labels, "id", "left").select("key", "id", "hub", F.coalesce("component", "id").alias("part"))
    placed = placed.withColumns({"lo": F.min("part").over(of_key), "hi": F.max("part").over(of_key)})
    return placed.where("lo < hi").drop("lo", "hi")


def _further_stars(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a, b) of a hub's first member that the hub's component has left out with the members of other components.

    A hub may be far from the middle of its copies.  Of hubs with over ``OPEN`` members left out another member is
    compared with all, so that few components are left whose members are compared pair by pair.
    """
    own = labels.select(F.col("id").alias("hub"), F.col("component").alias("own"))
    out = members.join(own, "hub", "left").where(F.col("part") != F.coalesce("own", "hub"))
    centre = stash(
        out.groupBy("hub").agg(F.count("*").alias("left"), F.min(F.struct("id", "part")).alias("c")).where(F.col("left") > OPEN).select("hub", "c")
    )
    return members.join(centre, "hub").where(F.col("part") != F.col("c.part")).select(F.col("c.id").alias("a"), F.col("id").alias("b"))


def _pairs_of_keys(placed: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of ``placed(key, id, hub, part, tokens)`` under one key in different components, for hubs of few members.

    A pair is made at a key only if the keys before it (in order) differ: that holds for the
    pair's first shared key, and spares most of its repeats.
    """
    split = placed.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi")
    before = F.lag("key").over(Window.partitionBy("id").orderBy("key"))
    left = placed.join(split.select("key"), "key").join(classes, "id").withColumn("before", before)
    left = stash(left)
    x, y = left.alias("x"), left.alias("y")
    apart = (
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.id") < F.col("y.id"))
        & (F.col("x.part") != F.col("y.part"))
        & (F.col("x.before").isNull() | ~F.col("x.before").eqNullSafe(F.col("y.before")))
        & _near("x.size", "y.size", "x.sketch", "y.sketch", percent)
        & _linked("x.size", "y.size", "x.tokens", "y.tokens", percent)
    )
    return x.join(y, apart).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def _differences(docs: DataFrame, members: DataFrame, n: int, percent: int) -> DataFrame:
    """(hub, id, size, tokens, excess, first) of ``members(hub, id, part)``, written.

    Sets are held by their differences D from what most of the hub's members hold (tokens), which keeps
    distances: |A ^ B| = |D(A) ^ D(B)|.  A link is |A ^ B| <= c * (|A| + |B|), c = (1-t)/(1+t); excess is |D| - c * size,
    scaled.  Two linked members whose differences share a token: before the first one
    (in any common order) come only tokens in which the two differ, E at most, so it is among the
    first E + 1 of either.  The order puts last what more than one in USUAL of the members have.
    """
    ids = members.select("id").union(members.select("hub")).distinct()
    sets = stash(_sets(docs, n, ids))
    rows = members.join(sets, "id").join(sets.select(F.col("id").alias("hub"), F.col("tokens").alias("base")), "hub")
    differing = F.concat(F.array_except("tokens", "base"), F.array_except("base", "tokens"))
    rows = stash(rows.select("hub", "id", F.size("tokens").alias("size"), differing.alias("tokens")))
    counted = rows.select("hub", F.explode("tokens").alias("token")).groupBy("hub", "token").agg(F.count("*").alias("c"))
    counted = counted.where("c > 1").join(members.groupBy("hub").agg(F.count("*").alias("total")), "hub")
    # at most 2 and USUAL times a member's differences
    most = F.col("c") * 2 > F.col("total")
    usual = F.least("c", F.col("total") - F.col("c")) * USUAL > F.col("total")
    shifts = counted.where(most | usual).groupBy("hub").agg(
        F.collect_list(F.when(most, F.col("token"))).alias("most"), F.collect_list(F.when(usual, F.col("token"))).alias("usual")
    )
    rows = rows.join(shifts, "hub", "left")
    none = F.array().cast("array<bigint>")
    most, usual = F.coalesce("most", none), F.coalesce("usual", none)
    rows = rows.withColumn("tokens", F.array_sort(F.concat(F.array_except("tokens", most), F.array_except(most, "tokens"))))
    ordered = F.concat(F.array_except("tokens", usual), F.array_intersect("tokens", usual))
    reach = F.floor(F.col("size") * (100 - percent) / percent).cast("int") + 1
    excess = F.size("tokens") * (100 + percent) - F.col("size") * (100 - percent)
    return stash(rows.select("hub", "id", "size", "tokens", excess.alias("excess"), F.slice(ordered, F.lit(1), reach).alias("first")))


def _central_stars(rows: DataFrame, found: DataFrame, labels: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) of hubs' most central members, and the components of these and ``found``.

    Two linked members whose differences have nothing in common are both linked to the member of
    the least excess, so that one is compared with all.  Most copies link to one text in their middle but few to each other; where it
    is found no pairs are left.  Further rounds take the most central member of the components that had none yet, while
    over ``OPEN`` members are in such and a round links something.
    """
    new, centres = None, None
    for _ in range(1 + STARS):
        placed = rows.join(labels, "id", "left").withColumn("part", F.coalesce("component", "id")).drop("component", "first")
        left = placed
        if centres is not None:
            done = centres.join(placed.select("hub", "id", "part"), ["hub", "id"]).select("hub", "part").distinct()
            left = placed.join(done, ["hub", "part"], "left_anti")
        picked = left.groupBy("hub").agg(F.count("*").alias("n"), F.min(F.struct("excess", "id", "part")).alias("r"))
        if centres is not None:
            picked = picked.where(F.col("n") > OPEN)
        picked = stash(picked.select("hub", F.col("r.id").alias("id"), F.col("r.part").alias("own")))
        if picked.isEmpty():
            break
        centres = picked.select("hub", "id") if centres is None else centres.union(picked.select("hub", "id"))
        middle = stash(picked.join(rows, ["hub", "id"]).select("hub", F.col("id").alias("a"), "own", F.col("size").alias("sa"), F.col("tokens").alias("ta")))
        both = placed.join(middle, "hub").where("part <> own")
        links = stash(both.where(_linked("size", "sa", "tokens", "ta", percent)).select("a", F.col("id").alias("b")).distinct())
        if links.isEmpty():
            break
        new = links if new is None else new.union(links)
        labels = connected_components(found.union(new))
    return (found.limit(0) if new is None else new), labels


def _pairs_of_differences(rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of ``rows(hub, id, part, tokens, first)`` in different components whose differences share a token.

    For hubs of many members, whose most central one has been compared with all.
    """
    rows = rows.select("hub", "id", "part", "tokens", F.explode("first").alias("token"))
    split = rows.groupBy("hub", "token").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi")
    left = stash(rows.join(split.select("hub", "token"), ["hub", "token"]).join(classes, "id"))
    x, y = left.alias("x"), left.alias("y")
    apart = (
        (F.col("x.hub") == F.col("y.hub"))
        & (F.col("x.token") == F.col("y.token"))
        & (F.col("x.id") < F.col("y.id"))
        & (F.col("x.part") != F.col("y.part"))
        & _near("x.size", "y.size", "x.sketch", "y.sketch", percent)
        & _linked("x.size", "y.size", "x.tokens", "y.tokens", percent)
    )
    return x.join(y, apart).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
