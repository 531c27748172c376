"""Document fingerprints by a homomorphic multiset hash (operator 7), in DataFrame functions only.

A text is the multiset of its paragraphs (lines).  Each paragraph is hashed into a wide vector and
a text's fingerprint is the sum of its paragraphs' vectors, component by component:

* ``WIDE`` components modulo 2**32, all of them random for every paragraph: equal multisets, in
  whatever order, have equal sums, and others do not but by chance;
* ``NARROW`` signed counters: every sentence of the paragraph adds 1 or -1 (by its hash) to one of them.  Sums of
  texts with common sentences point the same way, so likeness can be read off.  Two counters share a
  number modulo 2**64, which adds up like the others; they are told apart while each is below 2**31 either way.  Equal sentences
  all add to one counter, and a text (at most 2**31 bytes) has fewer than 2**30 sentences, so no text's counter wraps.

Sums can be updated by adding an inserted paragraph's vector or subtracting a deleted one's.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDE, NARROW = 16, 64
PACKED = 2  # counters in one number
MASK32 = (1 << 32) - 1
#: Rows in one range of ids (each the business of one task), most ranges, and ranges in a bundle.
RANGE_ROWS, MOST_RANGES, BUNDLE = 1_000, 65_536, 256


def paragraph_sums(text: Column) -> Column:
    """array<bigint>: WIDE sums modulo 2**32, then NARROW / PACKED packed ones modulo 2**64."""
    hashes = F.transform(F.split(text, "\n", -1), lambda p: F.xxhash64(p))
    units = F.filter(F.split(text, r"(?<=[.!?])[\x20\t\r]+|\n", -1), lambda u: u != "")

    def placed(h: Column) -> Column:
        """The sentence's number and what it adds to it."""
        counter = F.shiftrightunsigned(h, 1).bitwiseAND(NARROW - 1).cast("int")
        one = F.try_element_at(F.lit(np.array([1 << 32 * i for i in range(PACKED)], np.int64)), counter % PACKED + 1)
        return F.struct(
            F.floor(counter / PACKED).cast("int").alias("at"), F.when(h.bitwiseAND(1) == 0, one).otherwise(-one).alias("by")
        )

    places = F.transform(F.transform(units, lambda u: F.xxhash64(u)), placed)

    def sums(v: Column) -> Column:
        total = lambda value: lambda i: F.aggregate(v["hashes" if value is wide else "places"], F.lit(0).cast("long"), lambda a, x: value(a, x, i))
        wide = lambda a, h, i: (a + F.xxhash64(h, i).bitwiseAND(MASK32)).bitwiseAND(MASK32)
        narrow = lambda a, p, i: F.when(p["at"] == i, _plus(a, p["by"])).otherwise(a)
        return F.concat(
            F.transform(F.sequence(F.lit(1), F.lit(WIDE)), total(wide)),
            F.transform(F.sequence(F.lit(0), F.lit(NARROW // PACKED - 1)), total(narrow)),
        )

    # bound in a one-element array, so that texts are split and hashed once and not once a component
    return F.element_at(F.transform(F.array(F.struct(hashes.alias("hashes"), places.alias("places"))), sums), 1)


def _plus(x: Column, y: Column) -> Column:
    """x + y modulo 2**64 (ANSI arithmetic has no overflow): bits without carries, and the carries of 32 and 32 bits."""
    low = x.bitwiseAND(MASK32) + y.bitwiseAND(MASK32)
    high = F.shiftrightunsigned(x, 32) + F.shiftrightunsigned(y, 32) + F.shiftrightunsigned(low, 32)
    return F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(MASK32))


def add(x: Column, y: Column, sign: int = 1) -> Column:
    """The sums of two texts together (or, with sign -1, of the first without the second's paragraphs)."""
    less = lambda v: v if sign > 0 else _plus(F.bitwise_not(v), F.lit(1).cast("long"))
    wide = F.zip_with(F.slice(x, 1, WIDE), F.slice(y, 1, WIDE), lambda a, b: (a + b * sign).bitwiseAND(MASK32))
    narrow = F.zip_with(F.slice(x, WIDE + 1, NARROW), F.slice(y, WIDE + 1, NARROW), lambda a, b: _plus(a, less(b)))
    return F.concat(wide, narrow)


def as_string(sums: Column) -> Column:
    """Hexadecimal digits: 8 for each wide component, then 16 for each packed one."""
    digits = lambda size: lambda v: F.lpad(F.lower(F.hex(v)), size, "0")
    return F.concat(
        F.array_join(F.transform(F.slice(sums, 1, WIDE), digits(8)), ""),
        F.array_join(F.transform(F.slice(sums, WIDE + 1, NARROW), digits(16)), ""),
    )


def counters(sums: Column) -> Column:
    """array<bigint>: the NARROW signed counters of the packed sums."""
    start = F.transform(F.slice(sums, WIDE + 1, NARROW), lambda v: F.struct(v.alias("rest"), F.array().cast("array<bigint>").alias("out")))
    low = lambda s: s["rest"].bitwiseAND(MASK32)
    for _ in range(PACKED):
        start = F.transform(
            F.transform(start, lambda s: F.struct(s["rest"], s["out"], F.when(low(s) > MASK32 // 2, low(s) - MASK32 - 1).otherwise(low(s)).alias("c"))),
            # the rest has what this counter borrowed given back
            lambda s: F.struct(F.shiftright(F.shiftright(s["rest"], 31) + F.when(s["c"] < 0, F.lit(1)).otherwise(F.lit(0)), 1).alias("rest"), F.array_append(s["out"], s["c"]).alias("out")),
        )
    return F.flatten(F.transform(start, lambda s: s["out"]))


def likeness(x: Column, y: Column) -> Column:
    """0 to 1: an estimate of the sentences in common over those of either; 1 for equal sums only.

    The product of two signed sums is that of the sentences' counts but for chance, whose share
    falls with NARROW and not with the length of the texts.
    """
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda a, v: a + v)

    def near(v: Column) -> Column:
        common = dot(v["x"], v["y"])
        either = dot(v["x"], v["x"]) + dot(v["y"], v["y"]) - common
        return F.coalesce(F.try_divide(common, either), F.lit(0.0))

    both = F.struct(counters(x).alias("x"), counters(y).alias("y"))
    near_ = F.element_at(F.transform(F.array(both), near), 1)
    return F.when(x == y, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(0.999), near_)))


def with_next(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` with next_text: the text of the next row by (doc_id, text), the last row's the first's.

    Ids are dealt into ranges by approximate quantiles, which are ids of the table.  A range's
    first rows (those of its bounding id) are also given to the range before it, so that each range
    is complete in itself and no window spans the table.
    """
    ranges = min(MOST_RANGES, 1 + docs.count() // RANGE_ROWS)
    bounds = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(ranges)], max(10_000, 4 * ranges)).alias("b")).first().b
    bounds = sorted(set(bounds or []))
    if len(bounds) > 1:
        # a row's place among the bounds: that of its bundle of them, then the place within
        bundles = [bounds[i : i + BUNDLE] for i in range(0, len(bounds), BUNDLE)]
        up_to = lambda table, key: F.size(F.filter(table, lambda b: b <= key))
        heads = F.lit(np.array([b[0] for b in bundles], np.int64))
        bundle = F.array(*(F.lit(np.array(b, np.int64)) for b in bundles))
        at = F.greatest(up_to(heads, F.col("doc_id")), F.lit(1))
        own_bundle = F.element_at(bundle, at)
        place = (at - 1) * BUNDLE + up_to(own_bundle, F.col("doc_id"))
        is_bound = F.array_contains(own_bundle, F.col("doc_id"))
        place = F.when(F.col("doc_id").isNull(), 1).otherwise(F.greatest(place, F.lit(1)))
        lowest = docs.agg(F.min("doc_id").alias("m"), F.count_if(F.col("doc_id").isNull()).alias("n")).first()
        is_first = F.col("doc_id").isNull() if lowest.n else F.col("doc_id") == lowest.m
        before = F.when(is_first, len(bounds)).when(is_bound, place - 1)
        last = len(bounds)
    else:
        place, is_first, before, last = F.lit(1), F.lit(True), F.lit(1), 1
    own = F.struct(place.alias("part"), F.lit(False).alias("guest"), F.lit(False).alias("wrapped"))
    guest = F.struct(before.alias("part"), F.lit(True).alias("guest"), (is_first & (before == last)).alias("wrapped"))
    copies = F.filter(F.array(own, guest), lambda x: x["part"].isNotNull() & (x["part"] > 0))
    dealt = docs.select("doc_id", "text", F.explode(copies).alias("x"))
    order = Window.partitionBy("x.part").orderBy("x.wrapped", F.col("doc_id").asc_nulls_first(), "x.guest", "text")
    return dealt.withColumn("next_text", F.lead("text").over(order)).where("not x.guest").drop("x")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or
    all) of the next document's, in ascending doc_id; the last document's next is the first.
    A null text counts as empty, an empty text as one empty paragraph.  Rows of one doc_id follow each
    other by text, null ids come first; a table's only row is its own next; an empty table gives
    an empty result; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = F.length("text")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - F.floor(n / 2).cast("int")), F.substring(F.col("next_text"), F.lit(1), F.floor(n / 2).cast("int")))
    rows = with_next(rows).select("doc_id", n.cast("long").alias("n_chars"), "text", "next_text", edited.alias("edited"))
    sums = rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        paragraph_sums(F.col("text")).alias("a"),
        paragraph_sums(F.col("edited")).alias("b"),
        paragraph_sums(F.col("next_text")).alias("c"),
    )
    return sums.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_string(F.col("a")).alias("fingerprint"),
        as_string(F.col("b")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"),
        likeness(F.col("a"), F.col("c")).alias("near_next"),
    )
