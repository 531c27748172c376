"""URL filters by a Bloom filter cascade (operator 1), in DataFrame functions only.

The cascade answers membership in a list of host keys exactly, for every key of the corpus's
universe (all hosts of all pages and their parent domains).  Level 1 holds the listed keys; level
2 the keys of the universe that level 1 takes for listed though they aren't; level 3 the listed
keys that level 2 takes for those; and so on until a level errs on nothing.  A key is looked up
level by level until one doesn't hold it: listed if that took an odd number of levels held.  A look-up is
a column expression over literals, so pages are neither joined nor shuffled.

Level 1 errs on about as many keys as are listed (its error rate is the list's share of the universe), and every
later level on half of its keys.  All levels together so take about ``len(list) * (5 + 1.44 *
log2(universe / list))`` bits, whatever the universe holds: 2 MB for a million listed keys among a
billion, and that is also all that the driver sees.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuegrid.llm.common import stash

#: Least and most hashes of a level; a level of h hashes errs on one key in 2 ** h.
HASHES = (1, 40)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), upper, upper.lower())


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def parents(host: Column) -> Column:
    """The host and all its parent domains: a.b.c, b.c, c."""
    parts = F.split(host, r"\.", -1)
    tails = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(tails)


@dataclass
class Level:
    """One Bloom filter: its number, hashes a key, and bits in 64-bit words."""

    number: int
    hashes: int
    words: np.ndarray

    def holds(self, key: Column) -> Column:
        words, bits = F.lit(self.words), len(self.words) * 64
        found = F.lit(True)
        for at in _places(key, self.number, self.hashes, bits):  # the first bit that is off ends the search
            word = F.element_at(words, (F.shiftright(at, 6) + 1).cast("int"))
            found = found & (F.getbit(word, (at.bitwiseAND(63)).cast("int")) == 1)
        return found


def _places(key: Column, number: int, hashes: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(number), F.lit(j)), F.lit(bits).cast("long")) for j in range(hashes)]


def _level(keys: DataFrame, number: int, count: int, others: int) -> Level:
    """The filter of a table of ``count`` distinct keys that is to err on about as many of ``others``."""
    hashes = min(HASHES[1], max(HASHES[0], math.ceil(math.log2(max(1.0, others / count)))))
    size = max(1, math.ceil(count * hashes / math.log(2) / 64))
    at = keys.select(F.explode(F.array(*_places(F.col("key"), number, hashes, size * 64))).alias("at"))
    rows = (
        at.select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()  # at most ``size`` rows
    )
    words = np.zeros(size, np.int64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return Level(number, hashes, words)


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    def lists(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        verdict = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            verdict = F.when(level.holds(key), verdict).otherwise(F.lit(level.number % 2 == 0))
        return verdict


def build_cascade(universe: DataFrame, listed: DataFrame) -> Cascade:
    """The cascade of ``listed(key)`` that is exact over ``universe(key)`` and the list itself."""
    inside = stash(listed.select("key").where("key is not null").distinct())
    outside = universe.select("key").where("key is not null").distinct().join(inside, "key", "left_anti")
    outside = stash(outside)
    cascade, held, other, number = Cascade(), inside, outside, 1
    count, others = held.count(), other.count()
    while count:
        level = _level(held, number, count, others)
        cascade.levels.append(level)
        wrong = stash(other.where(level.holds(F.col("key"))))
        held, other, number = wrong, held, number + 1
        count, others = wrong.count(), count
    return cascade


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, action) of the longest of ``rules`` (action, host, path) that fits; nulls if none does."""
    rule = action = F.lit(None).cast("string")
    for act, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # the longest ends outermost
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        action = F.when(fits, act).otherwise(action)
    return rule, action


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """page_id, host, path, rule, verdict and listed_key for every row of ``pages(page_id, url)``.

    The verdict is the longest fitting rule's, else block if the host or a parent domain is in
    ``listed(key)``, else allow.  A null url or one without ``://`` has an empty host and path,
    fits no rule and is allowed.  Null page ids, repeated rows and other columns are as they are; an
    empty list blocks nothing; an empty table gives an empty result.
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    universe = rows.select("host").distinct().select(F.explode(parents(F.col("host"))).alias("key"))
    cascade = build_cascade(stash(universe), listed)
    judged = rows.withColumn("hits", F.filter(parents(F.col("host")), cascade.lists))
    rule, action = matching_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.size("hits") > 0, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(action, own).alias("verdict"), F.get("hits", F.lit(0)).alias("listed_key")
    )
