"""Subtitle files as tables of cues."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cuegrid.functions.text import flat, parse_timestamp, stripped, timing_line, word_budget

_CLOCK = r"((?:\d{1,3}:\d{2}|\d{1,2}):\d{2}[.,]\d{3})"
TIMING = rf"^\s*{_CLOCK}\s*-->\s*{_CLOCK}[ \t]*(.*?)\s*$"


def _blocks(files: DataFrame) -> DataFrame:
    """(title_id, pos, block, lines, at): the blocks between blank lines and the place of their timing line, from 1 (0: none)."""
    body = F.regexp_replace(F.regexp_replace(F.col("text"), "^\ufeff", ""), "\r\n?", "\n")
    rows = files.select("title_id", F.posexplode(F.split(body, "\n\n")).alias("pos", "block")).where(~F.col("block").rlike(r"(?U)^\s*$"))
    rows = rows.withColumn("lines", F.split("block", "\n"))
    at = F.array_position(F.transform("lines", lambda x: x.rlike(TIMING)), F.lit(True)).cast("int")
    return rows.withColumn("at", at)


def parse_vtt(files: DataFrame) -> DataFrame:
    """``files(title_id, text)`` to cues: title_id, index, start_s, end_s, text, identifier, settings.

    A block is a cue if one of its lines is a timing line: what is in front of it is the
    identifier, what follows is the text.  Cues count from 1 in order.
    """
    cues = _blocks(files).where("at > 0").withColumn("time", F.element_at("lines", F.col("at")))
    part = lambda i: F.regexp_extract("time", TIMING, i)
    order = Window.partitionBy("title_id").orderBy("pos")
    joined = lambda start, size: stripped(F.array_join(F.slice("lines", start, size), "\n"))
    head = joined(F.lit(1), F.col("at") - 1)
    return cues.select(
        "title_id",
        F.row_number().over(order).alias("index"),
        parse_timestamp(part(1)).alias("start_s"),
        parse_timestamp(part(2)).alias("end_s"),
        joined(F.col("at") + 1, F.size("lines")).alias("text"),
        F.when(head != "", head).alias("identifier"),
        part(3).alias("settings"),
    )


def vtt_preamble(files: DataFrame) -> DataFrame:
    """(title_id, blocks): notes, styles and regions of ``files(title_id, text)``, in order; files without any have none."""
    rows = _blocks(files).where("at = 0").withColumn("block", stripped(F.col("block"))).where("not startswith(block, 'WEBVTT')")
    ordered = F.array_sort(F.collect_list(F.struct("pos", "block")))
    return rows.groupBy("title_id").agg(F.transform(ordered, lambda x: x["block"]).alias("blocks"))


def build_vtt(cues: DataFrame, note: str | None = None, preamble: DataFrame | None = None) -> DataFrame:
    """(title_id, text): a WebVTT file of each title's cues, in order of index, after a note and the preamble's blocks."""
    block = F.concat(
        F.when(F.coalesce("identifier", F.lit("")) == "", "").otherwise(F.concat("identifier", F.lit("\n"))),
        timing_line(F.col("start_s"), F.col("end_s"), F.col("settings")),
        F.lit("\n"),
        F.col("text"),
        F.lit("\n"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("index", block.alias("block"))))
    files = cues.groupBy("title_id").agg(F.array_join(F.transform(ordered, lambda x: x["block"]), "\n").alias("body"))
    head = F.array(F.lit("WEBVTT"), *([F.lit(f"NOTE {note}")] if note else []))
    if preamble is not None:
        files = files.join(preamble.select("title_id", "blocks"), "title_id", "left")
        head = F.concat(head, F.coalesce("blocks", F.array().cast("array<string>")))
    return files.select("title_id", F.concat(F.array_join(F.transform(head, lambda x: F.concat(x, F.lit("\n\n"))), ""), "body").alias("text"))


def chunks(cues: DataFrame, size: int = 40) -> DataFrame:
    """Adds chunk (consecutive slices of a title's cues) and the line that asks for a rewrite."""
    line = F.concat(
        F.lit("["), F.col("index").cast("string"), F.lit("] (<="), word_budget(F.greatest(F.col("end_s") - F.col("start_s"), F.lit(0.0))).cast("string"),
        F.lit(" words) "), flat(F.col("text")),
    )
    return cues.withColumn("chunk", F.floor((F.col("index") - 1) / size).cast("int")).withColumn("line", line)


def parse_replies(replies: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """``replies(title_id, chunk, reply)`` to (title_id, chunk, index, text).

    ``[n]`` at a line's start opens cue n; other lines go on with it after a space.  A repeated marker
    overwrites, blank results are dropped.  With ``asked(title_id, chunk, index)`` the cues of other chunks,
    their further lines included, are dropped: a reply can't touch what it wasn't asked for.
    """
    lines = replies.select("title_id", "chunk", F.posexplode(F.split(F.regexp_replace("reply", "\r\n", "\n"), "\n")).alias("pos", "line"))
    marker = r"^\s*\[(\d+)\]\s?(.*)$"
    lines = lines.withColumn("index", F.regexp_extract("line", marker, 1).try_cast("int"))
    order = Window.partitionBy("title_id", "chunk").orderBy("pos")
    lines = lines.withColumn("group", F.count("index").over(order.rowsBetween(Window.unboundedPreceding, 0))).where("group > 0")
    own = stripped(F.when(F.col("index").isNotNull(), F.regexp_extract("line", marker, 2)).otherwise(F.col("line")))
    said = F.filter(F.transform(F.array_sort(F.collect_list(F.struct("pos", own.alias("t")))), lambda x: x["t"]), lambda t: t != "")
    texts = lines.groupBy("title_id", "chunk", "group").agg(F.max("index").alias("index"), F.array_join(said, " ").alias("text"))
    if asked is not None:
        texts = texts.join(asked.select("title_id", "chunk", "index"), ["title_id", "chunk", "index"], "left_semi")
    last = texts.groupBy("title_id", "chunk", "index").agg(F.max_by("text", "group").alias("text"))
    return last.where("text <> ''")


def missing(cues: DataFrame, parsed: DataFrame) -> DataFrame:
    """Cues that no reply covers: those to ask for again."""
    return cues.join(parsed.select("title_id", "index"), ["title_id", "index"], "left_anti")


def merge_rewrites(cues: DataFrame, parsed: DataFrame) -> DataFrame:
    """Cues with rewritten text where there is one; times, identifiers and settings never change."""
    new = parsed.groupBy("title_id", "index").agg(F.min("text").alias("new"))
    return cues.join(new, ["title_id", "index"], "left").withColumns(
        {"rewritten": F.col("new").isNotNull(), "text": F.coalesce("new", "text")}
    ).drop("new")


def rewrite_stats(merged: DataFrame) -> DataFrame:
    return merged.groupBy("title_id").agg(
        F.count("*").alias("cues"),
        F.count_if("rewritten").alias("rewritten"),
        F.try_divide(F.count_if("rewritten"), F.count("*")).alias("coverage"),
    )
