"""Personal data by bootstrapped contextual extraction (operator 6), in DataFrame functions only.

Base rules find e-mail addresses, IP addresses, payment-card and phone numbers.  They are the seeds
of a bootstrap.  A lexical pattern is the word in front of an entity, alone or together with the
word behind it.  Instances are the entities and all identifier-like tokens: whole tokens, without
brackets and punctuation around them, that hold a digit or a sign within (``@ _ / \\ # ~ = +``, or ``. : [ (``
between others).  A token of letters alone is no candidate.  Rounds on the graph of patterns and instances:

* a pattern lives for a kind once ``MIN_SEEDS`` distinct instances of the kind stand at it: seeds and
  whatever rounds before have found;
* its confidence is the share of those among all its instances, and it must reach ``MIN_PATTERN``;
* an instance's score is 1 minus the product of the doubts of the words in front of it (of a word's
  patterns the most confident counts); from ``MIN_SCORE`` on it is found, and counts as the seeds do.

So found instances induce new patterns at their other places, and these find others.  What counts
only grows, so the rounds end, when one finds nothing more.  Found instances are entities of the kind
``context``.  Edges are aggregated before any join, so common contexts meet as counts, and texts are
read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuegrid.llm.common import stash
from cuegrid.llm.spans import apart_from, as_text, find_spans, in_order, no_spans, of_kind

KINDS = ("email", "ip", "card", "phone")
W = r"\x20\x09-\x0D"  # what separates words

# A match can begin at a run's first character or where the match before it ended; from within a
# run that failed at its first character it fails as well.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: Over a text in which single separators between digits have become JOINT.
CARD = "[0-9][0-9\u0001]*[0-9]"
JOINT, OTHER = "\u0001", "\u0002"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
P = r".,;:!?()\[\]<>\"'"  # what may stand around a token
SIGNED = rf"(?=[^{W}]*?(?:[0-9@_/\\#~=+]|[^{W}{P}][.:\[(][^{W}{P}]))"
#: A token that looks like an identifier, without the punctuation around it.
CANDIDATE = rf"(?<=(?:^|[{W}])[(\[<\"']{{0,3}}+)(?=[^{W}{P}]){SIGNED}[^{W}]*[^{W}{P}](?=[{P}]*+(?:[{W}]|\z))"

MIN_SEEDS, MIN_PATTERN, MIN_SCORE, DIGITS = 5, 0.4, 0.6, 9


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def small_parts(hit: Column) -> Column:
    value = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    return F.forall(F.split(hit, r"\."), lambda p: (F.length(value(p)) <= 3) & (value(p).try_cast("int") <= 255))


def luhn(hit: Column) -> Column:
    """14 to 19 digits whose Luhn sum ends in 0."""
    digits = _digits(hit)

    def term(c: Column, i: Column) -> Column:
        twice = c.cast("int") * (1 + i % 2)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.transform(F.split(F.reverse(digits), ""), term), F.lit(0), lambda a, b: a + b)
    return F.when(F.length(digits).between(14, 19), total % 10 == 0).otherwise(F.lit(False))


def base_spans(text: Column) -> Column:
    joined = F.regexp_replace(F.translate(text, JOINT, OTHER), r"(?<=[0-9])[\x20-](?=[0-9])", JOINT)
    many = text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}")
    return in_order(
        find_spans(text, EMAIL, "email", 0, guard=F.contains(text, F.lit("@")), placed=True),
        find_spans(text, IP, "ip", 1, small_parts, placed=True),
        F.when(many, find_spans(joined, CARD, "card", 2, luhn, placed=True)).otherwise(no_spans(True)),
        find_spans(text, PHONE, "phone", 3, lambda h: F.length(_digits(h)).between(10, 15), F.contains(text, F.lit("+")), True),
    )


def discover(occurrences: DataFrame) -> DataFrame:
    """(value, kind, score) of the unseen instances found; of several kinds the likeliest.

    ``occurrences(value, kind, left, right)``: one row an entity or candidate; kind is null for
    candidates.  Rows without a word in front (null or empty) are in no pattern; a null right counts as none.
    """
    both = F.array(F.concat(F.lit("l:"), "left"), F.concat(F.lit("b:"), "left", F.lit(" "), F.coalesce("right", F.lit(""))))
    edges = stash(
        occurrences.where("left <> '' and value <> ''")
        .select("value", "kind", "left", F.explode(both).alias("pattern"))
        .groupBy("left", "pattern", "value")
        .agg(F.collect_set("kind").alias("kinds"))
    )
    total = edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_SEEDS)
    edges = stash(edges.join(total, "pattern"))  # a pattern of fewer instances never lives
    seeds = edges.select("value", F.explode("kinds").alias("kind")).distinct()
    values = edges.where(F.size("kinds") == 0).select("left", "pattern", "value")
    found, number = stash(seeds.select("value", "kind", F.lit(1.0).alias("score")).limit(0)), 0
    while True:
        positive = seeds.unionAll(found.select("value", "kind")).distinct()
        patterns = (
            edges.select("left", "pattern", "value", "n")
            .join(positive, "value")
            .groupBy("left", "pattern", "n", "kind")
            .agg(F.count("*").alias("hits"))
            .where((F.col("hits") >= MIN_SEEDS) & (F.col("hits") >= MIN_PATTERN * F.col("n")))
            .select("pattern", "kind", (F.col("hits") / F.col("n")).alias("trust"))
        )
        words = values.join(patterns, "pattern").groupBy("value", "kind", "left").agg(F.max("trust").alias("trust"))
        doubt = F.sum(F.log(F.greatest(1 - F.col("trust"), F.lit(1e-6))))
        scored = words.groupBy("value", "kind").agg(F.round(1 - F.exp(doubt), DIGITS).alias("score"))
        found = stash(scored.where(F.col("score") >= MIN_SCORE))
        before, number = number, found.count()
        if number == before:
            break
    return found.groupBy("value").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"), F.max("score").alias("score"))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_context, one row per input row.

    The four base counts are those of the base rules; ``context`` counts what the method adds.
    A null text counts as empty; an empty text has no spans (empty string, and the hash of it); a
    null doc_id stays null; repeated rows are answered each, and count once in the graph; an empty
    table gives an empty result; other columns are ignored.  Method spans that overlap a base span are
    left out.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("base", base_spans(F.col("text")))
    more = apart_from(find_spans(F.col("text"), CANDIDATE, "context", 4, placed=True), F.col("base"))
    rows = rows.withColumn("more", more)
    rows = stash(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "base", "more"))
    one = lambda c, kind: rows.select(F.explode(c).alias("x")).select(
        F.lower("x.hit").alias("value"), kind.alias("kind"), F.lower("x.left").alias("left"), F.lower("x.right").alias("right")
    )
    seen = one("base", F.col("x.kind")).unionAll(one("more", F.lit(None).cast("string")))
    found = stash(discover(seen))
    found_in = (
        rows.select("row", F.explode("more").alias("span"))
        .withColumn("value", F.lower("span.hit"))
        .join(found.select("value"), "value")
        .groupBy("row")
        .agg(F.collect_list("span").alias("extra"))
    )
    joined = rows.select("row", "doc_id", "base").join(found_in, "row", "left")
    extra = F.coalesce("extra", no_spans(True))
    every = in_order(F.col("base"), extra)
    return joined.select(
        "doc_id",
        *(of_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS),
        F.sha2(as_text(F.col("base")), 256).alias("base_sha256"),
        as_text(every).alias("spans"),
        F.size(extra).cast("long").alias("n_context"),
    )
