"""Secret scans with a battery of randomness tests (operator 2), in DataFrame functions only.

Base rules find assignments, access keys and long hexadecimal strings.  The method adds strings
that no rule names.  Candidates are runs of 20 and more characters of ``[A-Za-z0-9+/_=-]``.  Each
gets an encoding from its characters (hexadecimal, base 32, 36, 62 or 64, letters of both cases, or letters) and, over that
alphabet,

* a chi-squared test of uniformity,
* a runs test of symbols above and below the alphabet's middle, and
* a lag-1 serial-correlation test.

A random string passes all three: Fisher's combination of their p-values must not be small.
Against it stands ordinary text, whose chi-squared is non-central with a parameter that grows with
the length; its excess a character is measured on the corpus's own letter-only runs, and carried
to other alphabets as the same chance of drawing one character twice; for hexadecimal digits the
ordinary string is a decimal number (ten of the sixteen symbols).  Evenness says
little of 20 to 40 characters, so there are two p-values: the chance that an ordinary string of the length comes
out as even, and the chance that it changes as often between letters and digits (``CHANGES`` a
character).  Fisher's rule combines them.  The Benjamini-Hochberg rule at ``FDR`` is applied in every
length band, over counts of p-values in tenths of a decade (bounded rows, no global sort).
Letter-only runs are the reference and are never declared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuegrid.llm.common import columns, fresh, stash
from cuegrid.llm.spans import apart_from, as_text, find_spans, in_order, of_kind, replaced

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # leftmost runs of 20 and more: shorter ones can't hold a longer one
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "random")

FDR, LEAST_FIT = 0.01, 0.01
#: Excess of chi-squared a character in ordinary text where the corpus has no reference runs.
USUAL_EXCESS = 0.7
#: Least excess a character taken for any alphabet.
LEAST_EXCESS = 0.3
#: Excess a character of a decimal number over the hexadecimal digits: 16 / 10 - 1.
HEX_EXCESS = 0.6
#: Changes between letters and digits a character in ordinary strings (two in a name such as "run2024b").
CHANGES = 0.075
BINS = 300

ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base52": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "letters": "abcdefghijklmnopqrstuvwxyz",
}


def base_spans(text: Column) -> Column:
    long_value = lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= 6
    return in_order(
        find_spans(text, ASSIGN, "assign", 0, long_value),
        find_spans(text, ACCESS, "access", 1, guard=F.contains(text, F.lit("AKIA"))),
        find_spans(text, HEX, "hex", 2),
    )


def normal_tail(z: Column) -> Column:
    """P(Z > z), by the rational approximation of Abramowitz and Stegun 26.2.17."""
    x = F.abs(z)
    t = F.lit(1.0) / (F.lit(1.0) + x * 0.2316419)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-x * x / 2) * 0.3989422804014327 * poly
    return F.least(F.lit(1.0), F.greatest(F.lit(1e-300), F.when(z >= 0, upper).otherwise(1 - upper)))


def bind(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with the value worked out once however often ``then`` uses it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _encoding(token: Column) -> Column:
    bare = F.regexp_replace(token, "[=_+/-]", "")
    return (
        F.when(token.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(bare.rlike("^([a-z]+|[A-Z]+|[A-Z][a-z]+|(?=.{1,39}$)[A-Za-z]*[a-z]{8}[A-Za-z]*)$"), "letters")
        .when(token.rlike("^[A-Z2-7]+=*$"), "base32")
        .when(bare.rlike("^([0-9a-z]+|[0-9A-Z]+)$"), "base36")
        .when(token.rlike("^[A-Za-z]+$"), "base52")
        .when(token.rlike("^[A-Za-z0-9]+$"), "base62")
        .otherwise("base64")
    )


def token_tests(token: Column) -> Column:
    """struct(encoding, size, chi2, free, fit, changes) of a token: fit is Fisher's combined p-value."""
    encoding = _encoding(token)
    plain = (
        F.when(encoding == "hex", F.lower(token))
        .when(encoding == "letters", F.lower(F.regexp_replace(token, "[^A-Za-z]", "")))
        .when(encoding == "base32", F.regexp_replace(token, "=", ""))
        .when(encoding == "base36", F.lower(F.regexp_replace(token, "[^0-9A-Za-z]", "")))
        .otherwise(F.translate(F.regexp_replace(token, "=+$", ""), "-_=", "+/"))
    )
    table = F.create_map(*[F.lit(x) for pair in ALPHABETS.items() for x in pair])
    def tests(x: Column) -> Column:
        text, alphabet = x["text"], x["alphabet"]
        n, kinds = F.length(text).cast("double"), F.length(alphabet).cast("double")
        symbols = F.split(alphabet, "")
        squares = F.aggregate(
            symbols, F.lit(0.0), lambda a, c: a + F.pow((n - F.length(F.replace(text, c))).cast("double"), F.lit(2.0))
        )
        codes = F.transform(F.split(text, ""), lambda c: (F.instr(alphabet, c) - 1).cast("double"))
        halves = F.array_join(F.transform(codes, lambda c: F.when(c < F.floor(kinds / 2), "a").otherwise("b")), "")
        low = n - F.length(F.replace(halves, F.lit("a")))
        runs = F.length(F.regexp_replace(halves, "a+|b+", "x"))
        changes = F.length(F.regexp_replace(F.regexp_replace(text, "[^A-Za-z0-9]", ""), "[A-Za-z]+|[0-9]+", "x")) - 1
        return F.struct(
            n.alias("n"), kinds.alias("kinds"), squares.alias("squares"), codes.alias("codes"), low.alias("low"), runs.alias("runs"),
            changes.cast("double").alias("changes"),
        )

    def judged(v: Column) -> Column:
        n, kinds, low = v["n"], v["kinds"], v["low"].cast("double")
        free = kinds - 1
        chi2 = v["squares"] * kinds / n - n
        z_chi = (F.pow(F.greatest(chi2, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - F.lit(2.0) / (9 * free))) / F.sqrt(F.lit(2.0) / (9 * free))
        high = n - low
        product = 2 * low * high
        spread = product * (product - n) / (n * n * (n - 1))
        z_runs = F.when(spread > 0, (v["runs"] - (product / n + 1)) / F.sqrt(spread)).otherwise(F.lit(9.0))
        mean = F.aggregate(v["codes"], F.lit(0.0), lambda a, c: a + c) / n
        around = F.aggregate(v["codes"], F.lit(0.0), lambda a, c: a + (c - mean) * (c - mean))
        beside = F.aggregate(
            F.zip_with(F.slice(v["codes"], F.lit(1), (n - 1).cast("int")), F.slice(v["codes"], F.lit(2), (n - 1).cast("int")), lambda p, q: (p - mean) * (q - mean)),
            F.lit(0.0),
            lambda a, c: a + c,
        )
        z_serial = F.when(around > 0, beside / around * F.sqrt(n)).otherwise(F.lit(9.0))
        tails = F.struct(z_chi.alias("chi"), z_runs.alias("runs"), z_serial.alias("serial"))
        fit = bind(bind(tails, logs), lambda half: F.exp(-half) * (1 + half + half * half / 2))
        return F.struct(encoding.alias("encoding"), n.alias("size"), chi2.alias("chi2"), free.alias("free"), fit.alias("fit"), v["changes"].alias("changes"))

    def logs(z: Column) -> Column:
        """Half of Fisher's statistic, which has 6 degrees of freedom."""
        two = lambda name: F.least(F.lit(1.0), 2 * normal_tail(F.abs(z[name])))
        return -(F.log(normal_tail(z["chi"])) + F.log(two("runs")) + F.log(two("serial")))

    start = F.struct(plain.alias("text"), F.element_at(table, encoding).alias("alphabet"))
    return F.when(F.length(plain) >= 16, bind(bind(start, tests), judged)).otherwise(
        F.struct(F.lit("letters").alias("encoding"), *(F.lit(x).alias(c) for c, x in (("size", 0.0), ("chi2", 0.0), ("free", 1.0), ("fit", 0.0), ("changes", 0.0))))
    )


def evenness_p(t: Column, excess: float) -> Column:
    """The chance that ordinary text of this length has as small a chi-squared (Abdel-Aty)."""
    rate = F.when(t["encoding"] == "hex", F.lit(HEX_EXCESS)).otherwise(F.greatest(F.lit(LEAST_EXCESS), (t["free"] + 1) * (excess + 1) / 26 - 1))
    shift = t["size"] * rate
    a = t["free"] + shift
    spread = F.lit(2.0) * (1 + shift / a) / (9 * a)
    z = (F.pow(F.greatest(t["chi2"], F.lit(0.0)) / a, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)
    return bind(-z, normal_tail)


def changes_p(t: Column) -> Column:
    """The chance of as many changes in an ordinary string: a Poisson tail by its first term (Stirling) and a geometric series."""
    mean, c = t["size"] * CHANGES, F.greatest(t["changes"], F.lit(0.0))
    tail = F.exp(c - mean - c * F.log(c / mean)) / F.sqrt(c * 6.283185307179586) / (1 - mean / (c + 1))
    return F.when(c > mean, F.least(F.lit(1.0), tail)).otherwise(F.lit(1.0))


def ordinary_p(t: Column, excess: float) -> Column:
    """The chance that an ordinary string of this length looks as random (Fisher's rule, 4 degrees of freedom)."""
    half = -(F.log(evenness_p(t, excess)) + F.log(F.greatest(changes_p(t), F.lit(1e-300))))
    return bind(half, lambda h: F.exp(-h) * (1 + h))


def _band(t: Column) -> Column:
    return F.when(t["size"] < 32, 0).when(t["size"] < 64, 1).when(t["size"] < 128, 2).otherwise(3)


def _bin(p: Column) -> Column:
    return F.least(F.floor(F.log10(p) * -10), F.lit(BINS)).cast("int")


def _tested(t: Column) -> Column:
    return (t["encoding"] != "letters") & (t["fit"] >= LEAST_FIT)


def calibrate(docs: DataFrame) -> tuple[float, dict[int, int]]:
    """The excess of ordinary text and each length band's least declared bin, over all documents."""
    found = find_spans(F.col("text"), CANDIDATE, "random", 3)
    hits = docs.select(F.explode(F.transform(found, lambda s: s["hit"])).alias("token"))
    tests = stash(hits.groupBy("token").agg(F.count("*").alias("n")).select("n", token_tests(F.col("token")).alias("t")))
    plain = tests.where("t.encoding = 'letters' and t.size > 0")
    row = plain.agg(F.avg((F.col("t.chi2") - F.col("t.free")) / F.col("t.size")).alias("excess")).first()
    excess = max(0.3, row.excess) if row.excess is not None else USUAL_EXCESS
    t = F.col("t")
    counted = (
        tests.where(t["encoding"] != "letters")
        .groupBy(_band(t).alias("band"), F.when(_tested(t), _bin(ordinary_p(t, excess))).otherwise(0).alias("bin"))
        .agg(F.count("*").alias("n"))
        .collect()  # at most 4 bands of BINS + 1 rows
    )
    least: dict[int, int] = {}
    for band in range(4):
        rows = sorted(((r.bin, r.n) for r in counted if r.band == band), reverse=True)
        total, above = sum(n for _, n in rows), 0
        for at, n in rows:
            above += n
            if at and 10 ** (-at / 10) <= FDR * above / total:
                least[band] = at
    return excess, least


def _spans(text: Column, excess: float, least: dict[int, int]) -> tuple[Column, Column]:
    base = base_spans(text)

    def declared(x: Column) -> Column:
        t, level = x["t"], F.lit(BINS + 1)
        for band, at in least.items():
            level = F.when(_band(t) == band, F.lit(at)).otherwise(level)
        return _tested(t) & (_bin(ordinary_p(t, excess)) >= level)

    found = find_spans(text, CANDIDATE, "random", 3)
    tested = F.transform(found, lambda s: F.struct(s.alias("s"), token_tests(s["hit"]).alias("t")))
    return base, F.transform(F.filter(tested, declared), lambda x: x["s"])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_random, one row per input row.

    spans are of the whole text, base ones and those of the method.  A null text counts as empty; an
    empty text has no spans (empty string, and the hash of it); a null doc_id stays null; repeated
    rows are answered each; an empty table gives an empty result; other columns are ignored.
    Method spans that overlap a base span are left out.  Distinct candidate strings count once in
    the false-discovery control.
    """
    docs = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    marked = mark_secrets(docs, "found")
    base = F.filter("found", lambda s: s["rank"] < 3)
    return marked.select(
        "doc_id",
        *(of_kind(F.col("found"), k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(as_text(base), 256).alias("base_sha256"),
        as_text(F.col("found")).alias("spans"),
        of_kind(F.col("found"), KINDS[3]).alias(f"n_{KINDS[3]}"),
    )


def mark_secrets(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a column ``name``, which they mustn't have: all spans of text in order.

    A null text has null spans, an empty one none; all other columns stay, whatever their names; an
    empty table gives an empty result.
    """
    base, more = _spans(F.col("text"), *calibrate(docs.select("text")))
    one, two = fresh(docs, "base", "more")
    wide = docs.select("*", base.alias(one), more.alias(two))
    return wide.select(*columns(docs), in_order(F.col(one), apart_from(F.col(two), F.col(one))).alias(name))


def redact_secrets(docs: DataFrame, by: str = "[secret]") -> DataFrame:
    """``docs`` with every secret of text replaced, and n_chars (if there) as it is then.

    Texts without secrets, null and empty ones included, and all other columns (whatever their
    names) stay as they are; rows that repeat are rewritten each; an empty table gives an empty
    result.
    """
    (found,) = fresh(docs, "found")
    marked = mark_secrets(docs, found)
    any_ = F.coalesce(F.size(found), F.lit(0)) > 0
    text = F.when(any_, replaced(F.col("text"), F.col(found), by)).otherwise(F.col("text"))
    out = []
    for column, name in zip(columns(docs), docs.columns, strict=True):
        if name == "text":
            column = text.alias("text")
        elif name == "n_chars":
            kind = docs.schema["n_chars"].dataType
            column = F.when(any_, F.length(text).cast(kind)).otherwise(F.col("n_chars")).alias("n_chars")
        out.append(column)
    return marked.select(*out)
