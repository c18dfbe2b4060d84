"""Tags and attributes of markup as column expressions, for pages whose nesting does not matter."""

from __future__ import annotations

from collections.abc import Callable
from html import unescape as reference_text
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A quote opens a value only after `=`. Possessive parts keep the match linear on broken markup.
# A loop takes a frame of the stack each time round, and a finished atomic group gives its frames
# back, so three nested loops match more parts than a text can have, within a thread's stack.
_PART = r"""(?>[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)"""
_ATTRIBUTES = rf"(?>(?>(?>{_PART}{{1,1000}}+){{1,1000}}+){{0,1000}}+)"
_ATTRIBUTE = r"""[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+"""
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&"
_REPLACEMENT = "\ufffd"


def tags_with(tag: str, attribute: str, html: Column) -> Column:
    """Attribute texts of every `tag` that mentions `attribute`, in document order.

    All tags are matched, so that none is found inside another's value; comments and the content
    of scripts and styles are passed over.
    """
    name = "".join(f"[{c.lower()}{c.upper()}]" for c in tag)
    pattern = (
        r"(?s)<(?:([sS](?:[cC][rR][iI][pP][tT]|[tT][yY][lL][eE]))(?=[\s/>])" + _ATTRIBUTES
        + r">.*?(?:</(?i:\1)(?=[\s/>])[^>]*>|\z)|!--(?:.*?-->|.*)"
        + rf"|{name}(?=[\s/>])({_ATTRIBUTES})>|[a-zA-Z]{_ATTRIBUTES}>)")
    found = F.regexp_extract_all(html, F.lit(pattern), F.lit(2))
    return F.filter(found, lambda text: F.exists(
        given_attributes(text), lambda given: is_named(given, attribute)))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once, however often `use` names it."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))


def given_attributes(text: Column) -> Column:
    """The attributes of a tag's attribute text, each as it is written there."""
    return F.regexp_extract_all(text, F.lit(_ATTRIBUTE), F.lit(0))


def is_named(given: Column, name: str) -> Column:
    """Whether an attribute has this name (lower case)."""
    return F.lower(F.left(given, F.lit(len(name)))).eqNullSafe(F.lit(name)) & F.substr(
        given, F.lit(len(name) + 1), F.lit(1)).isin("", "=", " ", "\t", "\n", "\r", "\f", "\x0b")


def first_named(given: Column, name: str) -> Column:
    """The first attribute of this name among `given`, as written; null if there is none."""
    return F.get(F.filter(given, lambda one: is_named(one, name)), F.lit(0))


_BLANKS = " \t\n\r\f\x0b"


def written_value(first: Column) -> Column:
    """What stands behind the equals sign of an attribute as written; null if there is none."""
    at = F.locate("=", first)
    return F.when(at > 0, F.ltrim(F.substr(first, at + 1), F.lit(_BLANKS)))


def unquoted(written: Column) -> Column:
    return F.when(F.left(written, F.lit(1)).isin('"', "'"), F.substr(
        written, F.lit(2), F.length(written) - 2)).otherwise(written)


def attribute_value(given: Column, name: str) -> Column:
    """Value of the first attribute of this name among `given`; null if it is empty or absent."""
    written = bound(first_named(given, name), written_value)
    decoded = bound(bound(written, unquoted), unescape)
    return bound(decoded, lambda value: F.nullif(value, F.lit("")))


def attributes_of(text: Column, *names: str) -> list[Column]:
    """Values of attributes in a tag's attribute text, each the first of its name."""
    given = given_attributes(text)
    return [attribute_value(given, name) for name in names]


def with_attributes(rows: DataFrame, text: str, names: dict[str, str]) -> DataFrame:
    """`rows` with a column for each attribute of the column `text`, which is left out.

    Step by step, so that generated code works each value out once.
    """
    rows = rows.withColumn(text, given_attributes(F.col(text)))
    rows = rows.withColumns({c: first_named(F.col(text), n) for c, n in names.items()}).drop(text)
    for step in (written_value, unquoted, unescape, lambda value: F.nullif(value, F.lit(""))):
        rows = rows.withColumns({c: step(F.col(c)) for c in names})
    return rows


def _looked_up(pairs: dict[str, str]) -> Callable[[Column], Column]:
    """Value of a key among `pairs`, null if it is not one.

    The pairs are one text that is searched: a map would be an expression, or a large literal that
    every rule of the optimizer goes over, wherever it is used.
    """
    pairs = "".join(f"\x01{key}\x02{value}" for key, value in pairs.items()) + "\x01"

    def of(key: Column) -> Column:
        marked = F.concat(F.lit("\x01"), key, F.lit("\x02"))
        return bound(F.instr(F.lit(pairs), marked), lambda at: F.when(at > 0, F.substring_index(
            F.substr(F.lit(pairs), at + F.length(key) + 2), "\x01", 1)))

    return of


def unescape(text: Column) -> Column:
    """Text with its character references decoded as the standard reader does.

    Names may lack their semicolon where HTML 5 lists them without one, also at the start of a
    longer word. Numbers that stand for no character are left out or replaced.
    """
    name_of = _looked_up(html5)
    open_names = {n: text for n, text in html5.items() if not n.endswith(";")}
    open_name_of = _looked_up(open_names)
    # numbers that mean another character, by the standard reader
    other_of = _looked_up({str(n): reference_text(f"&#{n};") for n in (0, 13, *range(128, 160))})

    def number(token: Column) -> Column:
        digits = F.regexp_extract(token, "^&#0*([0-9]{1,8});?$", 1)
        hexes = F.regexp_extract(token, "^&#[xX]0*([0-9a-fA-F]{1,7});?$", 1)
        zero = token.rlike("^&#[xX]?0+;?$")
        code = F.coalesce(F.nullif(digits, F.lit("")).cast("bigint"), F.conv(
            F.nullif(hexes, F.lit("")), 16, 10).cast("bigint"),
            F.when(zero, F.lit(0)).otherwise(F.lit(-1)).cast("bigint"))
        return bound(code, lambda c: F.coalesce(
            other_of(c.cast("string")),
            F.when((c < 0) | c.between(0xD800, 0xDFFF) | (c > 0x10FFFF), _REPLACEMENT)
            .when(c.between(1, 8) | (c == 11) | c.between(14, 31) | (c == 127)
                  | c.between(0xFDD0, 0xFDEF) | (c % 65536 >= 0xFFFE), F.lit(""))
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32"))))

    def named(token: Column) -> Column:
        name = F.substr(token, F.lit(2))
        return F.coalesce(
            name_of(name),
            *[F.concat(open_name_of(F.left(name, F.lit(n))), F.substr(name, F.lit(n + 1)))
              for n in range(max(map(len, open_names)), 1, -1)],
            token)

    def decoded(token: Column) -> Column:
        return (F.when(token.startswith("&#"), F.when(
            F.length(token) > 2, number(token)).otherwise(token))
            .when(token.startswith("&"), named(token)).otherwise(token))

    tokens = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(tokens, decoded), "")
                  ).otherwise(text)
