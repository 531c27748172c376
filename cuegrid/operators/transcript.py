"""Transcript pages and recogniser results as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cuegrid.functions.text import clean_html, is_event, normal_word, stripped, tokens

RECOGNISED = (
    "struct<results:struct<items:array<struct<type:string,start_time:string,end_time:string,"
    "alternatives:array<struct<confidence:string,content:string>>>>>>"
)


def paragraphs(pages: DataFrame, opener: str = "", ends: tuple[str, ...] = ()) -> DataFrame:
    """``pages(page_id, html)`` to (page_id, pos, attributes, inner, text), scripts left out.

    With an ``opener`` (the start of an id) a page begins at its first such paragraph, and ends where
    one of ``ends`` comes after it.
    """
    body = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>", "")
    if opener:
        at = F.locate(f'<p id="{opener}', body)
        body = F.when(at > 0, F.substring(body, at, F.length(body))).otherwise(F.lit(""))
    for end in ends:
        body = F.regexp_replace(body, rf"(?s)(?<=.)\Q{end}\E.*", "")
    pattern = r"(?is)<p(\s[^>]*)?>(.*?)</p>"
    hits = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
    rows = pages.select("page_id", F.posexplode(hits).alias("pos", "hit"))
    inner = F.regexp_extract("hit", pattern, 2)
    return rows.select(
        "page_id",
        "pos",
        F.regexp_extract("hit", pattern, 1).alias("attributes"),
        inner.alias("inner"),
        stripped(F.regexp_replace(clean_html(inner), "^[: ]+", "")).alias("text"),
    )


# Fixed values of the report's pages.
OPENER = "orscontributions_"
FOOTERS = ("Back to Official Report", "©", "&copy;")
END_MARKERS = ("<!-- Previous/Next navigation -->", '<p class="h5">')


def contributions(pages: DataFrame, opener: str = OPENER, footers: tuple[str, ...] = FOOTERS, ends: tuple[str, ...] = END_MARKERS) -> DataFrame:
    """Speakers' contributions: page_id, ci, speaker, clock, paragraphs.

    A paragraph with an opener id opens one; ``H:MM`` alone is a clock for the next; class ``lead``
    is left out; an end marker ends the page, and so does a paragraph (not an opener) whose text has a footer; a
    contribution needs a speaker and a paragraph.  The speaker is what the opener has as strong (none, if that is empty), or else all of it.
    """
    rows = paragraphs(pages, opener, ends)
    opens = F.contains("attributes", F.lit(f'id="{opener}'))
    footer = F.lit(False)
    for f in footers:
        footer = footer | (~opens & F.contains("text", F.lit(f)))
    upto = Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("ended", F.max(footer.cast("int")).over(upto)).where("ended = 0").withColumn("opens", opens)
    rows = rows.withColumn("ci", F.sum(F.col("opens").cast("int")).over(upto))
    clock = F.when(~F.col("opens") & F.col("text").rlike(r"^\d{1,2}:\d{2}$"), F.col("text"))
    rows = rows.withColumn("clock", clock)
    element = r"(?is)<strong[^>]*>(.*?)</strong>"
    strong = F.when(F.col("inner").rlike(element), clean_html(F.regexp_extract("inner", element, 1)))
    before = Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    # a clock belongs to the next opener: the last clock since the opener before it
    rows = rows.withColumn("pending", F.last(F.when(F.col("opens"), "").otherwise(F.col("clock")), ignorenulls=True).over(before))
    body = ~F.col("opens") & F.col("clock").isNull() & (F.col("text") != "") & ~F.col("attributes").rlike(r'class="[^"]*\blead\b')
    found = rows.where("ci > 0").groupBy("page_id", "ci").agg(
        F.max(F.when(F.col("opens"), F.coalesce(strong, F.col("text")))).alias("speaker"),
        F.max(F.when(F.col("opens") & (F.col("pending") != ""), F.col("pending"))).alias("clock"),
        F.transform(F.array_sort(F.collect_list(F.when(body, F.struct("pos", "text")))), lambda x: x["text"]).alias("paragraphs"),
    )
    return found.where("speaker <> '' and size(paragraphs) > 0")


def report_words(contributions_: DataFrame) -> DataFrame:
    """(title_id, pos, text, ci, pi, is_event, norm, weight) of ``(title_id, ci, paragraphs)``."""
    rows = contributions_.select("title_id", "ci", F.posexplode("paragraphs").alias("pi", "paragraph"))
    rows = rows.select("title_id", "ci", "pi", F.posexplode(tokens(F.col("paragraph"))).alias("ti", "text"))
    order = Window.partitionBy("title_id").orderBy("ci", "pi", "ti")
    rows = rows.withColumn("pos", F.row_number().over(order) - 1).withColumn("is_event", is_event(F.col("text")))
    return rows.select(
        "title_id",
        "pos",
        "text",
        "ci",
        "pi",
        "is_event",
        F.when(~F.col("is_event"), normal_word(F.col("text"))).alias("norm"),
        F.when(F.col("is_event"), 12).otherwise(F.greatest(F.lit(1), F.length("text"))).alias("weight"),
    )


def word_counts(contributions_: DataFrame) -> DataFrame:
    from cuegrid.functions.text import words

    total = F.aggregate(F.transform("paragraphs", lambda p: F.size(words(p))), F.lit(0), lambda a, n: a + n)
    return contributions_.select("title_id", "ci", total.alias("words"))


def recognised_words(results: DataFrame) -> DataFrame:
    """``results(title_id, json)`` of a recogniser to (title_id, pos, text, start, end, probability).

    Punctuation goes to the word before it; in front of any word, and empty, it is dropped.
    """
    items = results.select("title_id", F.from_json("json", RECOGNISED).alias("r")).select("title_id", F.posexplode("r.results.items").alias("i", "x"))
    best = F.get(F.col("x.alternatives"), F.lit(0))
    items = items.select(
        "title_id", "i", (F.col("x.type") == "pronunciation").alias("spoken"), best["content"].alias("content"),
        F.col("x.start_time").try_cast("double").alias("start"), F.col("x.end_time").try_cast("double").alias("end"),
        F.coalesce(best["confidence"].try_cast("double"), F.lit(1.0)).alias("probability"),
    ).where("content <> ''")
    upto = Window.partitionBy("title_id").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    items = items.withColumn("pos", F.sum(F.col("spoken").cast("int")).over(upto)).where("pos > 0")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "content"))), lambda x: x["content"]), "")
    return items.groupBy("title_id", "pos").agg(
        text.alias("text"),
        F.max(F.when(F.col("spoken"), F.col("start"))).alias("start"),
        F.max(F.when(F.col("spoken"), F.col("end"))).alias("end"),
        F.max(F.when(F.col("spoken"), F.col("probability"))).alias("probability"),
    )


WORDS = "array<struct<text:string,start:double,end:double,probability:double>>"


def load_words(lists: DataFrame) -> DataFrame:
    """``lists(title_id, json)`` of saved words to (title_id, pos, text, start, end, probability); a missing probability is 1."""
    rows = lists.select("title_id", F.posexplode(F.from_json("json", WORDS)).alias("pos", "w"))
    return rows.select("title_id", "pos", "w.text", "w.start", "w.end", F.coalesce("w.probability", F.lit(1.0)).alias("probability"))


def save_words(words: DataFrame) -> DataFrame:
    """(title_id, json): the words of each title as one list, in order of pos."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "text", "start", "end", "probability")))
    return words.groupBy("title_id").agg(F.to_json(F.transform(ordered, lambda w: w.dropFields("pos"))).alias("json"))
