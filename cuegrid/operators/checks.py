"""Checks of JSON documents against a declared shape, as one expression over a document (a variant).

The shape says which places a document may have, so the expression (SQL text) follows it: each object's members are taken apart
once, each item of a list is judged by a function of the item, and only what is wrong makes an issue.  No row is made for a node
and nothing is shuffled; the time of a document follows the number of its nodes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

ISSUE = "struct<at:array<string>,message:string,severity:string>"


@dataclass(frozen=True)
class Condition:
    """Of an object: if ``key`` is as ``when`` says, then ``target`` is as ``then`` says.

    when: ``equals`` (it is ``value``, or missing; what is no object counts as equal), ``has`` (it is there), ``true`` (it is true).
    then: ``needs`` (target is there), ``forbids`` (it is not; what is no object has it), ``true`` (it is true if it is there),
    ``forbids each`` (with the target ``list/member``: no item of the list has the member; what is no object has it).
    """

    when: str
    key: str
    value: str | None
    then: str
    target: str
    message: str


@dataclass(frozen=True)
class Shape:
    """What a place of a document holds."""

    kind: str
    least: float | None = None
    most: float | None = None
    among: list[str] | None = None
    form: str | None = None
    fields: dict[str, Shape] = field(default_factory=dict)
    needed: list[str] = field(default_factory=list)
    conditions: list[Condition] = field(default_factory=list)
    item: Shape | None = None


def text(least: int = 0, among: list[str] | None = None, like: str | None = None) -> Shape:
    """A text; length and form are asked of texts only, and what is no text is none of the known values."""
    return Shape("text", least=least or None, among=among, form=like)


def number(least: float | None = None, most: float | None = None, whole: bool = True) -> Shape:
    """A number; 5.0 is whole, and bounds are asked of numbers only."""
    return Shape("whole" if whole else "number", least=least, most=most)


def flag() -> Shape:
    return Shape("flag")


def listing(item: Shape, least: int = 0) -> Shape:
    return Shape("list", least=least or None, item=item)


def record(fields: dict[str, Shape], needed: list[str], conditions: list[Condition] | None = None) -> Shape:
    """An object with no other keys."""
    return Shape("object", fields=fields, needed=needed, conditions=conditions or [])


def none() -> Column:
    return F.array().cast(f"array<{ISSUE}>")


def issue(at: Column, message: str | Column, severity: str = "error") -> Column:
    return F.struct(at.alias("at"), (F.lit(message) if isinstance(message, str) else message).alias("message"), F.lit(severity).alias("severity"))


def issue_if(broken: Column, at: Column, message: str | Column, severity: str = "error") -> Column:
    return F.when(F.coalesce(broken, F.lit(False)), F.array(issue(at, message, severity))).otherwise(none())


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _issue(at: list[str], message: str) -> str:
    place = f"array({', '.join(at)})" if at else "cast(array() as array<string>)"
    return f"named_struct('at', {place}, 'message', {_text(message)}, 'severity', 'error')"


def _if(broken: str, at: list[str], message: str) -> str:
    return f"case when {broken} then {_issue(at, message)} end"


def _unless(right: str, *found: str) -> str:
    """Null if ``right`` holds, else the issues found; so right documents cost the tests only."""
    return f"case when {right} then null else filter(array({', '.join(found)}), x -> x is not null) end"


def _get(node: str, type_: str) -> str:
    return f"try_variant_get({node}, '$', '{type_}')"


class _Judge:
    """The SQL of a shape's issues: an array, or null for none; ``at`` holds the SQL of a place's keys."""

    def __init__(self) -> None:
        self.names = 0

    def _named(self, letter: str) -> str:
        self.names += 1
        return f"{letter}{self.names}_"

    def node(self, v: str, at: list[str], shape: Shape) -> str:
        if shape.kind == "flag":
            broken = f"schema_of_variant({v}) <> 'BOOLEAN'"
            return f"case when {broken} then array({_issue(at, 'true or false is wanted')}) end"
        of = {"text": self._of_text, "whole": self._of_number, "number": self._of_number, "list": self._of_list, "object": self._of_object}
        return of[shape.kind](v, at, shape)

    def _of_text(self, v: str, at: list[str], shape: Shape) -> str:
        is_text, said = f"schema_of_variant({v}) = 'STRING'", _get(v, "string")
        right, found = [is_text], [_if(f"not {is_text}", at, "a text is wanted")]
        if shape.least:
            right.append(f"length({said}) >= {shape.least}")
            found.append(_if(f"{is_text} and length({said}) < {shape.least}", at, "too short"))
        if shape.among is not None:
            among = f"{said} in ({', '.join(map(_text, shape.among))})"
            right.append(among)
            found.append(_if(f"not ({is_text} and {among})", at, "none of the known values"))
        if shape.form is not None:
            form = f"{said} rlike {_text(shape.form)}"
            right.append(form)
            found.append(_if(f"{is_text} and not {form}", at, "not of the form wanted"))
        return _unless(" and ".join(right), *found)

    def _of_number(self, v: str, at: list[str], shape: Shape) -> str:
        shown = lambda x: str(int(x)) if x == int(x) else str(float(x))
        kind, size, whole = f"schema_of_variant({v})", self._named("n"), shape.kind == "whole"
        numeric = f"({kind} in ('BIGINT', 'DOUBLE', 'FLOAT') or startswith({kind}, 'DECIMAL'))"
        right = [numeric, *([f"{size} = floor({size})"] if whole else [])]
        found = [_if(f"not coalesce({' and '.join(right)}, false)", at, "a whole number is wanted" if whole else "a number is wanted")]
        for bound, sign, within, words in ((shape.least, "<", ">=", "less than"), (shape.most, ">", "<=", "more than")):
            if bound is not None:
                right.append(f"{size} {within} {float(bound)!r}D")
                found.append(_if(f"{numeric} and {size} {sign} {float(bound)!r}D", at, f"{words} {shown(bound)}"))
        return f"element_at(transform(array({_get(v, 'double')}), {size} -> {_unless(' and '.join(right), *found)}), 1)"

    def _of_list(self, v: str, at: list[str], shape: Shape) -> str:
        items, x, i = self._named("l"), self._named("x"), self._named("i")
        each = self.node(x, [*at, f"cast({i} as string)"], shape.item)
        found = f"flatten(filter(transform({items}, ({x}, {i}) -> {each}), f -> f is not null))"
        few = f"when size({items}) < {int(shape.least)} then array({_issue(at, 'too few items')}) " if shape.least else ""
        found = f"case when {items} is null then array({_issue(at, 'a list is wanted')}) {few}else {found} end"
        return f"element_at(transform(array({_get(v, 'array<variant>')}), {items} -> {found}), 1)"

    def _of_object(self, v: str, at: list[str], shape: Shape) -> str:
        o = self._named("o")
        used = [k for c in shape.conditions for k in (c.key, c.target.split("/")[0])]
        struct = ", ".join(f"`{k}`: variant" for k in dict.fromkeys([*shape.fields, *used]))
        keys = f"map_keys({_get(v, 'map<string,variant>')})"
        known = ", ".join(map(_text, shape.fields))
        member = lambda k: f"{o}.`{k}`"
        missing = [f"{member(k)} is null" for k in shape.needed]
        own = _unless(
            f"{o} is not null and size({keys}) = " + " + ".join(f"int({member(k)} is not null)" for k in shape.fields) + "".join(f" and not {m}" for m in missing),
            _if(f"{o} is null", at, "an object is wanted"),
            _if(f"exists({keys}, k -> k not in ({known}))", at, "unknown keys"),
            *(_if(f"{o} is not null and {m}", at, f"{k} is missing") for k, m in zip(shape.needed, missing, strict=True)),
        )
        below = [f"case when {member(k)} is not null then {self.node(member(k), [*at, _text(k)], its)} end" for k, its in shape.fields.items()]
        found = ", ".join([own, *(self._of_condition(c, o, at) for c in shape.conditions), *below])
        found = f"flatten(filter(array({found}), f -> f is not null))"
        return f"element_at(transform(array({_get(v, f'struct<{struct}>')}), {o} -> {found}), 1)"

    def _of_condition(self, c: Condition, o: str, at: list[str]) -> str:
        member = lambda k: f"{o}.`{k}`"
        has = lambda k: f"({member(k)} is not null)"
        true = lambda k: f"coalesce(schema_of_variant({member(k)}) = 'BOOLEAN' and {_get(member(k), 'boolean')}, false)"
        if c.when == "equals":
            said = f"schema_of_variant({member(c.key)}) = 'STRING' and {_get(member(c.key), 'string')} = {_text(c.value)}"
            holds = f"(not {has(c.key)} or coalesce({said}, false))"
        else:
            holds = has(c.key) if c.when == "has" else true(c.key)
        if c.then == "forbids each":
            head, last = c.target.split("/")
            x, i = self._named("x"), self._named("i")
            item = _get(x, f"struct<`{last}`: variant>")
            bad = _if(f"{item} is null or {item}.`{last}` is not null", [*at, _text(head), f"cast({i} as string)"], c.message)
            items = f"transform({_get(member(head), 'array<variant>')}, ({x}, {i}) -> {bad})"
            return f"case when {holds} then filter({items}, f -> f is not null) end"
        if c.then == "true":
            wrong, at = f"{has(c.target)} and not {true(c.target)}", [*at, _text(c.target)]
        else:
            wrong = f"{o} is not null and not {has(c.target)}" if c.then == "needs" else f"({o} is null or {has(c.target)})"
        return f"case when {holds} and {wrong} then array({_issue(at, c.message)}) end"


def issues(v: str, shape: Shape) -> Column:
    """The issues (an array, in no order, or null for none) of a document, the column ``v`` (a variant)."""
    return F.expr(_Judge().node(v, [], shape))
