"""JSON texts laid out as the wire format wants them: members in order, two spaces a level, nulls left out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SHORT = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t", "\f": "\\f", "\b": "\\b"}


def quoted(text: Column) -> Column:
    """A JSON string; only quotes, backslashes and control characters are escaped.

    The escapes are one fold over a table, so that the expression of a text stays small: a document has many texts.
    """
    pairs = (_SHORT | {chr(i): f"\\u{i:04x}" for i in range(32) if chr(i) not in _SHORT}).items()
    table = F.array(*(F.struct(F.lit(char).alias("char"), F.lit(by).alias("by")) for char, by in pairs))
    special = text.rlike(r'[\x00-\x1f"\\]')
    made = F.when(special, F.aggregate(table, text, lambda t, x: F.replace(t, x["char"], x["by"]))).otherwise(text)
    return F.concat(F.lit('"'), made, F.lit('"'))


def decimal(value: Column, digits: int = 4) -> Column:
    """A number rounded (halves to even) to at most ``digits`` decimals and at least one."""
    text = F.bround(value, digits).cast(f"decimal(38,{digits})").cast("string")
    return F.regexp_replace(text, r"(\.\d+?)0+$", "$1")


def pretty_json(value: Column, kind: T.DataType, digits: int = 4, level: int = 0) -> Column:
    """The JSON text of a value of this type, null for null; null members of structs are left out, null items stay.

    Fractions are rounded to ``digits`` decimals.  Empty lists and objects are ``[]`` and ``{}``.
    """
    pad, end = "\n" + "  " * (level + 1), "\n" + "  " * level

    def framed(empty: Column, body: Column, opening: str, closing: str) -> Column:
        return F.when(empty, opening + closing).otherwise(F.concat(F.lit(opening + pad), body, F.lit(end + closing)))

    # a text is null only for a null value, so the values say whether a body is empty, and no text is made twice
    if isinstance(kind, T.StructType):
        members = [F.concat(F.lit(f'"{f.name}": '), pretty_json(value[f.name], f.dataType, digits, level + 1)) for f in kind.fields]
        empty = reduce(lambda x, y: x & y, (value[f.name].isNull() for f in kind.fields), F.lit(True))
        return F.when(value.isNotNull(), framed(empty, F.concat_ws("," + pad, *members), "{", "}"))
    if isinstance(kind, T.ArrayType):
        items = F.transform(value, lambda x: F.coalesce(pretty_json(x, kind.elementType, digits, level + 1), F.lit("null")))
        return F.when(value.isNotNull(), framed(F.size(value) == 0, F.array_join(items, "," + pad), "[", "]"))
    if isinstance(kind, T.StringType):
        return quoted(value)
    if isinstance(kind, T.DoubleType | T.FloatType | T.DecimalType):
        return decimal(value, digits)
    if isinstance(kind, T.IntegralType | T.BooleanType):
        return value.cast("string")
    raise ValueError(f"no JSON text of {kind.simpleString()}")


def json_document(value: Column, kind: T.DataType, digits: int = 4) -> Column:
    """:func:`pretty_json` with a line feed at the end, as files have it."""
    return F.concat(pretty_json(value, kind, digits), F.lit("\n"))
