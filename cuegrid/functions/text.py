"""Text and subtitle functions as column expressions."""

from __future__ import annotations

import html.entities
import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = r"(?U)\s+"
SENTENCE_END = "[.!?][\"'”’)\\]]*$"
CLAUSE_END = "[,;:—–][\"'”’)\\]]*$"
LINE, LINES = 42, 2


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with the value worked out once however often ``then`` uses it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def words(text: Column) -> Column:
    """Tokens between white space of any kind."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def normal_word(word: Column) -> Column:
    """Lower case, a-z, 0-9 and inner apostrophes only."""
    plain = F.regexp_replace(F.lower(F.translate(word, "‘’", "''")), "[^a-z0-9']+", "")
    return F.regexp_replace(plain, "^'+|'+$", "")


def is_event(token: Column) -> Column:
    return token.rlike(r"^\[[^\]]*\]$")


def tokens(text: Column) -> Column:
    """Words, with every ``[...]`` a token of its own even inside a word or with spaces."""
    pieces = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"(\[[^\]]*\])", "\u0001$1\u0001"), "\u0001")
    return F.flatten(F.transform(pieces, lambda p: F.when(is_event(p), F.array(p)).otherwise(words(p))))


def break_line(text: Column) -> Column:
    """At most two lines: a text over 42 characters breaks at its most balanced space, and white space around the break goes."""
    n = F.length(text)
    half = F.floor((n - 1) / 2).cast("int")
    # of the spaces on either side of the middle only the nearest can be the best
    left = F.instr(F.reverse(F.substring(text, F.lit(1), half + 1)), " ")
    right = F.instr(F.substring(text, half + 2, n), " ")
    spaces = F.filter(F.array(F.when(left > 0, half + 1 - left), F.when(right > 0, half + right)), lambda i: i.isNotNull())
    options = F.transform(
        spaces,
        lambda i: F.struct(
            F.greatest(i, n - i - 1).alias("longest"), F.abs(i - F.floor(n / 2).cast("int")).alias("off"), i.alias("at")
        ),
    )
    best = F.array_min(options)
    upper = F.regexp_replace(F.substring(text, F.lit(1), best["at"]), SPACES + r"\z", "")
    broken = F.concat(upper, F.lit("\n"), F.regexp_replace(F.substring(text, best["at"] + 2, n), r"\A" + SPACES, ""))
    return F.when(n <= LINE, text).when(best.isNull(), text).otherwise(broken)


def fits(text: Column) -> Column:
    """Whether the broken text has at most two lines of at most 42 characters."""
    lines = F.split(break_line(text), "\n")
    return let(lines, lambda x: (F.size(x) <= LINES) & F.forall(x, lambda line: F.length(line) <= LINE))


def parse_timestamp(value: Column) -> Column:
    """Seconds of ``[hh:]mm:ss.mmm`` (a comma will do); null if it is something else."""
    parts = F.split(F.replace(F.trim(value), F.lit(","), F.lit(".")), ":")
    number = lambda i: F.try_element_at(parts, F.lit(i)).try_cast("double")
    three = number(1) * 3600 + number(2) * 60 + number(3)
    return F.when(F.size(parts) == 3, three).when(F.size(parts) == 2, number(1) * 60 + number(2))


def format_timestamp(seconds: Column) -> Column:
    """``hh:mm:ss.mmm``, halves to even; null for null and negative values."""
    ms = F.bround(seconds * 1000).cast("long")
    part = lambda by, of, size: F.lpad((F.floor(ms / by) % of).cast("long").cast("string"), size, "0")
    hours = F.floor(ms / 3_600_000).cast("long").cast("string")
    hours = F.when(F.length(hours) < 2, F.lpad(hours, 2, "0")).otherwise(hours)
    text = F.concat(hours, F.lit(":"), part(60_000, 60, 2), F.lit(":"), part(1000, 60, 2), F.lit("."), part(1, 1000, 3))
    return F.when(seconds >= 0, text)


def timing_line(start: Column, end: Column, settings: Column) -> Column:
    return F.concat(
        format_timestamp(start), F.lit(" --> "), format_timestamp(end), F.when(F.coalesce(settings, F.lit("")) == "", "").otherwise(F.concat(F.lit(" "), settings))
    )


def word_budget(duration_s: Column, per_second: float = 2.0, least: int = 3) -> Column:
    return F.greatest(F.lit(least), F.floor(duration_s * per_second).cast("int"))


def flat(text: Column) -> Column:
    """One line with single spaces."""
    return F.trim(F.regexp_replace(text, SPACES, " "))


def stripped(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def srt_to_vtt(srt: Column) -> Column:
    """Header, lines of digits only dropped, lines trimmed at the right, decimal commas of times as points."""
    text = F.regexp_replace(F.regexp_replace(srt, "^\ufeff", ""), "\r\n", "\n")
    lines = F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, SPACES + r"\z", ""))
    kept = F.filter(lines, lambda x: ~x.rlike(r"^\d+\z"))
    timed = F.transform(kept, lambda x: F.regexp_replace(x, r"(\d{2}:\d{2}:\d{2}),(\d{3})", "$1.$2"))
    return F.concat(F.regexp_replace(F.array_join(F.concat(F.array(F.lit("WEBVTT"), F.lit("")), timed), "\n"), SPACES + r"\z", ""), F.lit("\n"))


def as_vtt(path: Column, text: Column) -> Column:
    """A subtitle file as WebVTT: ``.srt`` converted, others as they are; null for what is neither."""
    plain = F.regexp_replace(text, "^\ufeff", "")
    return F.when(F.lower(path).rlike(r"\.srt$"), srt_to_vtt(plain)).when(plain.rlike(r"(?U)\A\s*WEBVTT"), plain)


_REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def _text_map(pairs: dict[str, str]) -> Column:
    """A literal map (folded into one constant by the optimizer)."""
    return F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")


def _numbered() -> dict[str, str]:
    """Numbers that don't stand for their own character: 0, carriage return, and 128 to 159 as Windows reads them; and those that stand for none."""
    windows = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}
    none = [*range(1, 9), 0xB, *range(0xE, 0x20), 0x7F, *range(0xFDD0, 0xFDF0), *(p << 16 | e for p in range(17) for e in (0xFFFE, 0xFFFF))]
    return {str(n): c for n, c in ({n: "" for n in none} | windows | {0: "\ufffd", 0xD: "\r"}).items()}


def unescape(text: Column) -> Column:
    """HTML character references as characters: all names, with or without the semicolon where HTML lets it go, and numbers.

    The table of names is that of the standard library.  Of a run that is no name the longest beginning that is one counts.
    """
    names = _text_map({k: v for k, v in html.entities.html5.items()})
    short = sorted((k for k in html.entities.html5 if not k.endswith(";")), key=len, reverse=True)
    numbered = _text_map(_numbered())

    def number(hit: Column) -> Column:
        digits = F.regexp_replace(F.regexp_replace(hit, "^#[xX]?0*|;$", ""), "^$", "0")
        base = F.when(hit.rlike("^#[xX]"), 16).otherwise(10)
        code = F.when(F.length(digits) <= 9, F.when(base == 16, F.conv(digits, 16, 10)).otherwise(digits).cast("long")).otherwise(1 << 40)
        utf32 = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        wrong = (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
        return let(code, lambda n: F.coalesce(F.try_element_at(numbered, n.cast("string")), F.when(wrong, "\ufffd").otherwise(utf32(F.when(wrong, 0).otherwise(n)))))

    def name(hit: Column) -> Column:
        head = F.regexp_extract(hit, f"^(?:{'|'.join(short)})", 0)
        by_head = F.concat(F.try_element_at(names, head), F.substring(hit, F.length(head) + 1, F.length(hit)))
        return F.coalesce(F.try_element_at(names, hit), F.when(head != "", by_head), F.concat(F.lit("&"), hit))

    hits, gaps = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(1)), F.split(text, _REFERENCE, -1)
    made = F.transform(hits, lambda h: F.when(F.startswith(h, F.lit("#")), number(h)).otherwise(name(h)))
    joined = F.array_join(F.zip_with(gaps, made, lambda g, h: F.concat(g, F.coalesce(h, F.lit("")))), "")
    return F.when(text.rlike(_REFERENCE), joined).otherwise(text)


def clean_html(fragment: Column) -> Column:
    """Tags dropped, character references as characters, no-break spaces as spaces, trimmed."""
    text = unescape(F.regexp_replace(fragment, "<[^>]+>", ""))
    return stripped(F.replace(text, F.lit("\u00a0"), F.lit(" ")))


def display_name(speaker: Column) -> Column:
    """Without a leading number and without what stands in brackets behind the name, trimmed."""
    name = stripped(F.regexp_replace(speaker, r"^\d+\.\s+", ""))
    at = F.locate(" (", name)
    return F.when(at > 1, stripped(F.substring(name, F.lit(1), at - 1))).otherwise(name)


def absolute_url(url: Column, base: str) -> Column:
    """``url`` under ``base`` unless it is empty or has a scheme."""
    return F.when((F.coalesce(url, F.lit("")) == "") | F.contains(url, F.lit("://")), url).otherwise(
        F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(url, "^/+", ""))
    )


def split_s3(url: Column) -> Column:
    """struct(bucket, key) of ``s3://bucket/key`` (the key may be empty); null for what is no such address or has no bucket."""
    parts = lambda i: F.regexp_extract(url, "(?s)^s3://([^/?#]+)/*([^?#]*)", i)
    return F.when(parts(1) != "", F.struct(parts(1).alias("bucket"), parts(2).alias("key")))


def duration_ms(seconds: Column) -> Column:
    """Whole milliseconds, halves to even."""
    return F.bround(seconds * 1000).cast("long")


def content_sha256(content: Column) -> Column:
    """The digest that stands beside a stored file: lower-case hexadecimal SHA-256 of its bytes (of a text, in UTF-8)."""
    return F.sha2(content, 256)
