"""Positions of regular-expression matches as column expressions.

A span is a struct ``(start, rank, end, kind, hit)``: code points, end exclusive; rank is the
kind's place in its operator's list, so that spans sort by start, then by kind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,rank:int,end:int,kind:string,hit:string>"
PLACED = SPAN[:-1] + ",left:string,right:string>"

_W, _P = r"\x20\x09-\x0D", r".,;:!?()\[\]<>\"'"
#: The last word before an entity and the first one after it, past punctuation that touches the entity.
_LEFT = rf"(?<![^{_W}])([^{_W}]++)[{_W}]*+[(\[<\"']{{0,3}}+\z"
_RIGHT = rf"^[{_P}]*+[{_W}]*+([^{_W}]++)"


def no_spans(placed: bool = False) -> Column:
    return F.array().cast(f"array<{PLACED if placed else SPAN}>")


def find_spans(
    text: Column,
    pattern: str,
    kind: str,
    rank: int,
    keep: Callable[[Column], Column] | None = None,
    guard: Column | None = None,
    placed: bool = False,
) -> Column:
    """All leftmost non-overlapping matches, in order; ``keep`` says of a hit whether it counts.

    ``pattern`` must not match the empty string.  The matches and the gaps between them (``split``
    searches the same way) give the positions by a running sum.  Texts without a match pay one
    search; ``guard`` is a cheaper condition that holds for all texts with a match.  ``placed``
    adds the whole words to the left and right, looked for as far as the matches on either side reach (both included).
    """
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    around = []

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        span = F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), x["hit"].alias("hit"),
            *(x[c] for c in around),
        )
        wanted = F.lit(True) if keep is None else keep(x["hit"])
        return F.when(x["hit"].isNull(), acc).otherwise(
            F.struct(end.alias("at"), F.when(wanted, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))
        )

    pairs = F.zip_with(gaps, hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    if placed:
        around = ["left", "right"]
        before = F.zip_with(F.concat(F.array(F.lit("")), hits), gaps, lambda h, g: F.concat(h, g))
        after = F.zip_with(F.slice(gaps, F.lit(2), F.size(gaps)), F.slice(hits, F.lit(2), F.size(gaps)), lambda g, h: F.concat(g, F.coalesce(h, F.lit(""))))
        sides = F.zip_with(before, after, lambda b, a: F.struct(F.regexp_extract(b, _LEFT, 1).alias("left"), F.regexp_extract(a, _RIGHT, 1).alias("right")))
        pairs = F.zip_with(pairs, sides, lambda p, s: F.struct(p["gap"].alias("gap"), p["hit"].alias("hit"), s["left"].alias("left"), s["right"].alias("right")))
    start = F.struct(F.lit(0).alias("at"), no_spans(placed).alias("out"))
    found = F.aggregate(pairs, start, step, lambda acc: acc["out"])
    has = text.rlike(pattern) if guard is None else guard & text.rlike(pattern)
    return F.when(has, found).otherwise(no_spans(placed))


def in_order(*spans: Column) -> Column:
    """The spans of several kinds by start, then rank."""
    return F.array_sort(F.concat(*spans))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def apart_from(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others."""
    return F.filter(spans, lambda s: ~F.exists(others, lambda o: (s["start"] < o["end"]) & (o["start"] < s["end"])))


def replaced(text: Column, spans: Column, by: str) -> Column:
    """``text`` with each span, given in order, replaced; what overlaps is replaced once."""

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(by))).otherwise(acc["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
