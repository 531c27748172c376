"""Source divergence audit: how the use of terms differs between sources of a language (operator 13).

For a pair of sources all that the divergence needs of a term is its two counts.  So each pair's joint histogram is
tallied: how many terms have these two counts.  Terms that both sources have give the histogram's inner cells; the cells
where a count is zero are implied: a source's own histogram less the inner cells' row or column, and the kept terms less
all others.  The divergence of a cell is worked out once and multiplied by the cell's terms.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuegrid.llm.common import BROADCAST_KEYS, small_batches, stash, texts

#: Entries that a task counts before it hands them on.
HELD_TERMS = 200_000
SCALE = 1_000_000_000

#: Bytes of a term stay (A-Z as a-z), all others part terms: letters and whatever isn't ASCII.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) -> (lang, source, term, n, docs), summed over what a task has met."""
    seen: dict[tuple, tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in seen.items():
            size = len(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang], pa.string()).take(pa.array([0] * size, pa.int32())),
                    pa.array([source], pa.string()).take(pa.array([0] * size, pa.int32())),
                    pa.array(n.keys(), pa.binary()).cast(pa.string()),
                    pa.array(n.values(), pa.int64()),
                    pa.array([docs[t] for t in n], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )
        seen.clear()

    for part in small_batches(batches):
        langs, sources = part.column("lang").to_pylist(), part.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, texts(part), strict=True):
            words = text.translate(_TERM_BYTES).split() if text else []
            if not words:
                continue
            n, docs = seen[lang, source]
            held -= len(n)
            n.update(words)
            docs.update(set(words))
            held += len(n)
            if held >= HELD_TERMS:
                yield from flush()
                held = 0
    yield from flush()


def probability(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 * (n + 2) / (total + 2 * kept)), exact for all counts below 10^15."""
    share = F.lit(SCALE).cast("decimal(38,0)") * (n + 2).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", share, (total + kept * 2).cast("decimal(20,0)")).cast("long")


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); p and q are at most 10^9 + 1, so a square fits 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _sized(small: DataFrame) -> DataFrame:
    """``small`` (written already) for a join: broadcast up to ``BROADCAST_KEYS`` rows, merged beyond."""
    return F.broadcast(small) if small.count() <= BROADCAST_KEYS else small.hint("merge")


def audit_sources(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank of every (lang, source) group of ``docs(lang, source, text)``.

    part ``pair``: each other source of the lang, value the divergence summed over the lang's kept
    terms, all ranks.  part ``term``: kept terms of the group that it uses more than its lang does,
    the first ``top`` ranks.  A lang keeps the terms that stand in at least ``min_docs`` of its documents.
    Null lang, source and text are empty; groups without terms take part; a lang with one source has
    no pairs; repeated rows are documents of their own; an empty table gives an empty result; other columns are
    ignored.  Ranks break ties by item in UTF-8 order.
    """
    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    rows = docs.select(empty("lang"), empty("source"), empty("text"))
    counts = stash(
        rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    of_lang = of_lang.where(F.col("docs") >= min_docs).drop("docs")
    kept = stash(counts.drop("docs").join(of_lang, ["lang", "term"]))

    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_all"), F.count("*").alias("terms"))
    langs = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang")
    langs = langs.agg(F.sum("n").alias("lang_all"), F.count("*").alias("kept"))
    groups = stash(
        rows.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    )
    return _pairs(kept, groups).union(_terms(kept, groups, top))


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    a = groups.select("lang", F.col("source").alias("a"), F.col("n_all").alias("n_a"), F.col("terms").alias("terms_a"), "kept")
    b = groups.select("lang", F.col("source").alias("b"), F.col("n_all").alias("n_b"), F.col("terms").alias("terms_b"))
    pairs = stash(a.join(b, "lang").where("a < b"))  # as many as the result's
    cell = ["lang", "a", "b", "x", "y"]
    tally = lambda m: F.sum(m).alias("m")

    one = kept.select("lang", "term", F.col("source").alias("a"), F.col("n").alias("x"))
    other = kept.select("lang", "term", F.col("source").alias("b"), F.col("n").alias("y"))
    both = one.join(other, ["lang", "term"]).where("a < b").groupBy(*cell).agg(tally(F.lit(1).cast("long")))
    # a term that both have is none that one of them has alone
    put = lambda x, y, m: F.struct(x.alias("x"), y.alias("y"), m.alias("m"))
    zero, x, y, m = F.lit(0).cast("long"), F.col("x"), F.col("y"), F.col("m")
    inner = both.select("lang", "a", "b", F.inline(F.array(put(x, y, m), put(x, zero, -m), put(zero, y, -m), put(zero, zero, m))))

    own = stash(kept.groupBy("lang", "source", F.col("n").alias("x")).agg(tally(F.lit(1).cast("long"))))
    ends = _sized(pairs.select("lang", "a", "b"))
    rows_ = own.withColumnRenamed("source", "a").join(ends, ["lang", "a"]).select("lang", "a", "b", "x", zero.alias("y"), "m")
    columns_ = own.withColumnRenamed("source", "b").join(ends, ["lang", "b"]).select("lang", "a", "b", zero.alias("x"), F.col("x").alias("y"), "m")
    neither = pairs.select("lang", "a", "b", zero.alias("x"), zero.alias("y"), (F.col("kept") - F.col("terms_a") - F.col("terms_b")).alias("m"))

    cells = inner.union(rows_).union(columns_).union(neither).groupBy(*cell).agg(tally("m")).where("m > 0")
    p, q = probability(x, F.col("n_a"), F.col("kept")), probability(y, F.col("n_b"), F.col("kept"))
    known = cells.join(_sized(pairs), ["lang", "a", "b"]).select("lang", "a", "b", "m", p.alias("p"), q.alias("q"))
    summed = known.groupBy("lang", "a", "b").agg(F.sum(F.col("m") * divergence(F.col("p"), F.col("q"))).alias("value"))
    summed = pairs.select("lang", "a", "b").join(summed, ["lang", "a", "b"], "left").na.fill(0, ["value"])
    both_ways = F.inline(
        F.array(
            F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))
        )
    )
    listed = summed.select("lang", "value", both_ways).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return listed.withColumn("rank", F.row_number().over(_ranked()))


def _terms(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    p = probability(F.col("n"), F.col("n_all"), F.col("kept"))
    q = probability(F.col("lang_n"), F.col("lang_all"), F.col("kept"))
    known = kept.join(_sized(groups), ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
    more = known.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), "item", divergence(F.col("p"), F.col("q")).alias("value")
    )
    # the row number's limit reaches the map side, so a group's task gets a few rows from each
    return more.withColumn("rank", F.row_number().over(_ranked())).where(F.col("rank") <= top)


def _ranked():
    return Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")


def oracle_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    p = lambda n, total: f"(1 + 1000000000::hugeint * ({n} + 2) // ({total} + 2 * v))"
    f = lambda a, b: f"(({a} - {b}) * ({a} - {b})) // ({a} + {b})"
    return rf"""
    with d as (select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
        translate(coalesce(text, ''), '{upper}', '{lower}') as text from documents),
    w as (select doc_id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
    k as (select lang, term, count(*) as lang_n from w group by lang, term having count(distinct doc_id) >= 10),
    lv as (select lang, count(*) as v, sum(lang_n) as lang_all from k group by lang),
    c as (select w.lang, w.source, w.term, count(*) as n from w join k using (lang, term) group by all),
    g as (select distinct lang, source from d),
    t as (select g.lang, g.source, coalesce(sum(n), 0) as total from g left join c using (lang, source) group by all),
    dense as (select t.lang, t.source, k.term, coalesce(c.n, 0) as n, {p('coalesce(c.n, 0)', 't.total')} as p, {p('k.lang_n', 'lang_all')} as q
      from t join k using (lang) join lv using (lang) left join c using (lang, source, term)),
    pairs as (select a.lang, a.source, b.source as item from g a join g b on a.lang = b.lang and a.source <> b.source),
    sums as (select a.lang, a.source, b.source as item, sum({f('a.p', 'b.p')}) as value
      from dense a join dense b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
    parts as (select lang, source, 'pair' as part, item, coalesce(value, 0)::bigint as value from pairs left join sums using (lang, source, item)
      union all select lang, source, 'term', term, ({f('p', 'q')})::bigint from dense where n > 0 and p > q),
    r as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from parts)
    select * from r where part = 'pair' or rank <= 10"""
