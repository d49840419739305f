"""The text nodes of HTML as column expressions: no Python runs on the rows.

1. One regular expression cuts a page into comments, CDATA, declarations, scripts and styles with their content, tags,
   and runs of text. A construct that never closes is text, as for a parser that reaches the end of the page in it.
2. Which text shows depends on the elements around it only where a page has an element that hides its text or keeps
   white space. Such a page folds its tokens through one state machine with the stack of open elements; others need
   no state and take time in proportion to their length.
3. Character references are decoded by a literal map of their names; those that may lack the semicolon by the longest
   name that they start with.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements whose own text is no page text, those that keep white space, and those without content.
RAW = ("script", "style")
HIDDEN = (*RAW, "template", "rt", "rp")
VERBATIM = ("pre", "textarea")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")

_NAME = r"[a-zA-Z][^\t\n\r\f />\x00]*"
_OPEN = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
_CDATA = r"<!\[CDATA\[[\s\S]*?\]\]>"
CONSTRUCTS = "|".join(
    [
        r"<!--[\s\S]*?--\s*>",
        _CDATA,
        r"<!(?!--)[^>]*>",
        r"<\?[^>]*>",
        *[rf"(?i:<{name}(?=[\s/>])){_OPEN}(?<!/>)(?i:[\s\S]*?(?:</{name}\s*>|\z))" for name in RAW],
        rf"<{_NAME}{_OPEN}",
        r"</[^>]*>",
    ]
)
# possessive loops: neither long runs nor many stray signs pile up calls
TOKENS = rf"{CONSTRUCTS}|(?:[^<]++|(?!{CONSTRUCTS})<)++"
_STATEFUL = "(?i)<(" + "|".join([*HIDDEN[len(RAW) :], *VERBATIM]) + r")(?=[\s/>])"
REFERENCES = r"&#[xX][0-9a-fA-F]+;?|&#[0-9]+;?|&[a-zA-Z][a-zA-Z0-9]*;?|[^&]+|&"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


@functools.cache
def _names() -> tuple[str, str]:
    """The named references as JSON, and those that may lack the semicolon as alternatives, longest first."""
    bare = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
    return json.dumps({name: html5[name] for name in sorted(html5)}), "|".join(bare)


def _character(reference: Column) -> Column:
    """The character of a numeric reference; what is none as the replacement character or as nothing."""
    digits = F.regexp_extract(reference, "^&#[xX]?0*([0-9a-fA-F]*);?$", 1)
    base = F.when(reference.rlike("^&#[xX]"), 16).otherwise(10)

    def of(code: Column) -> Column:
        # 0x80 to 0x9F mean the characters of Windows-1252, where it has one
        old = F.when(code.isin(0x81, 0x8D, 0x8F, 0x90, 0x9D), F.decode(F.unhex(F.concat(F.lit("C2"), F.hex(code))), "UTF-8")).otherwise(
            F.translate(F.decode(F.unhex(F.hex(code)), "ISO-8859-1"), "".join(map(chr, _CP1252)), "".join(_CP1252.values()))
        )
        control = code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF)
        return (
            F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit("\ufffd"))
            .when(code.between(0x80, 0x9F), old)
            .when(control | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE), F.lit(""))
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        )

    # numbers of more digits are no code points
    held = F.when(F.length(digits) > 7, F.lit(0x110000)).otherwise(F.call_function("conv", F.when(digits == "", "0").otherwise(digits), base, F.lit(10)).cast("int"))
    return _let(held.cast("long"), of)


_CP1252 = {code: bytes([code]).decode("cp1252") for code in range(0x80, 0xA0) if code not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def unescape(text: Column) -> Column:
    """Character references decoded."""
    names, bare = _names()
    table = F.from_json(F.lit(names), "map<string, string>")
    start = rf"^&({bare})"

    def decoded(piece: Column) -> Column:
        prefix = F.regexp_extract(piece, start, 1)
        named = F.coalesce(
            F.try_element_at(table, F.substr(piece, F.lit(2))),
            F.when(prefix != "", F.concat(F.try_element_at(table, prefix), F.substr(piece, F.length(prefix) + 2))),
            piece,
        )
        return F.when(~piece.startswith("&") | (piece == "&"), piece).when(piece.startswith("&#"), _character(piece)).otherwise(named)

    parts = F.regexp_extract_all(text, F.lit(REFERENCES), F.lit(0))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(parts, decoded), "")).otherwise(text)


def _is_text(token: Column) -> Column:
    return ~token.rlike(rf"^(?:{CONSTRUCTS})")


def _flags(tokens: Column) -> Column:
    """For each token h, v or s: its text is hidden, verbatim or shown, by the elements open around it."""

    def step(state: Column, token: Column) -> Column:
        name = F.lower(F.regexp_extract(token, rf"^</?\s*({_NAME})", 1))
        opens = token.rlike("^<[a-zA-Z]") & ~token.rlike("/>$") & ~name.isin(*VOID, *RAW)
        stack = state["stack"]
        # the last open element of this name, counted from the top
        depth = F.array_position(F.reverse(stack), name).cast("int")
        moved = (
            F.when(_is_text(token), stack)
            .when(token.startswith("</") & (depth > 0), F.slice(stack, F.lit(1), F.size(stack) - depth))
            .when(opens, F.array_append(stack, name))
            .otherwise(stack)
        )
        flag = (
            F.when(F.coalesce(F.try_element_at(stack, F.lit(-1)), F.lit("")).isin(*HIDDEN), "h")
            .when(F.exists(stack, lambda element: element.isin(*VERBATIM)), "v")
            .otherwise("s")
        )
        return F.struct(moved.alias("stack"), F.concat(state["flags"], flag).alias("flags"))

    empty = F.struct(F.array().cast("array<string>").alias("stack"), F.lit("").alias("flags"))
    return F.split(F.aggregate(tokens, empty, step)["flags"], "")


def text_nodes(html: Column) -> Column:
    """The text nodes that a browser would show, in document order."""

    def shown(text: Column, verbatim: Column) -> Column:
        blank = ~verbatim & ~text.rlike(r"[^ \n\t\f\r]") & (text != "")
        return F.when(blank, F.when(F.contains(text, F.lit("\n")), "\n").otherwise(" ")).otherwise(text)

    def node(token: Column, flag: Column | None) -> Column:
        verbatim = F.lit(False) if flag is None else flag == "v"
        text = _let(unescape(token), lambda held: shown(held, verbatim))
        own = F.when(_is_text(token), text if flag is None else F.when(flag != "h", text))
        data = F.regexp_extract(token, r"^<!\[CDATA\[([\s\S]*)\]\]>$", 1)
        # an empty text is no node, empty data is one
        return F.when(token.rlike(rf"^{_CDATA}$"), data).otherwise(F.nullif(own, F.lit("")))

    def of(tokens: Column) -> Column:
        plain = F.transform(tokens, lambda token: node(token, None))
        folded = _let(_flags(tokens), lambda flags: F.transform(tokens, lambda token, i: node(token, F.get(flags, i))))
        return F.array_compact(F.when(html.rlike(_STATEFUL), folded).otherwise(plain))

    return _let(F.regexp_extract_all(html, F.lit(TOKENS), F.lit(0)), of)


def visible_text_lines(html: str | Column) -> Column:
    """Text nodes joined by line breaks, references decoded, comments and scripts left out; NULL becomes the empty text."""
    html = F.col(html) if isinstance(html, str) else html
    joined = F.array_join(text_nodes(F.coalesce(html, F.lit(""))), "\n")
    return F.regexp_replace(joined, r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+\z", "")
