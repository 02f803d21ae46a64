"""Column functions on readable text."""

from __future__ import annotations

import sys
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def collapse(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), "^ | $", "")


def fold(text: Column) -> Column:
    """A key that takes upper and lower case for the same: full case folding, as str.casefold() has it."""
    single, several = foldings()
    wide = F.translate(text, "".join(single), "".join(single.values()))
    for letter, folded in several.items():
        wide = F.replace(wide, F.lit(letter), F.lit(folded))
    return F.when(text.rlike(r"^[\x00-\x7F]*\z"), F.lower(text)).when(text.rlike("[" + "".join(several) + "]"), wide).otherwise(F.translate(text, "".join(single), "".join(single.values())))


@cache
def foldings() -> tuple[dict[str, str], dict[str, str]]:
    """Letters that fold to one other letter, and those that fold to several; no folded text folds again."""
    changed = {c: f for c in map(chr, range(sys.maxunicode + 1)) if (f := c.casefold()) != c}
    return {c: f for c, f in changed.items() if len(f) == 1}, {c: f for c, f in changed.items() if len(f) > 1}


def ends_sentence(text: Column) -> Column:
    """Whether the last character besides closing quotes and brackets ends a sentence."""
    return text.rlike(r"""(?U)[.!?…][\s"'”’)\]}]*\z""")


def starts_lower(text: Column) -> Column:
    """Whether the first letter is in lower case."""
    return text.rlike(r"^[^\p{L}]*[\p{L}&&\p{IsLowercase}]")


def footnote_text(text: Column) -> Column:
    """A marker without the brackets around it and the points behind it."""
    strip = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")
    bare = F.regexp_replace(strip(text), r"^[()\[\]{}]+|[()\[\]{}]+\z", "")
    return strip(F.regexp_replace(bare, r"\.+\z", ""))


def footnote_label(text: Column) -> Column:
    """The label in a superscript: up to three digits, a letter, or marks. Null for anything else."""
    label = footnote_text(text)
    return F.when(label.rlike(r"^(\p{Nd}{1,3}|[A-Za-z]|[*†‡]+)\z"), label)


def without_page_number(text: Column, number: Column) -> Column:
    """A header or footer, its white space collapsed, without the printed page number at either end."""
    n = F.regexp_replace(number.cast("string"), r"(?U)^\s+|\s+\z", "")
    quoted = F.concat(F.lit("\\Q"), F.replace(n, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    front = collapse(F.regexp_replace(text, F.concat(F.lit("(?U)^"), quoted, F.lit("(\\s+|\\z)")), F.lit("")))
    both = collapse(F.regexp_replace(front, F.concat(F.lit("(?U)(\\s+|^)"), quoted, F.lit("\\z")), F.lit("")))
    return F.when(F.coalesce(n, F.lit("")) == "", text).otherwise(both)


def escape_markup(text: Column) -> Column:
    out = text
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def without_markup_stars(text: Column) -> Column:
    """One balanced pair of ** __ * or _ around the whole taken off, at most twice."""
    once = lambda t: F.regexp_replace(t, r"(?s)^(\*\*|__|\*|_)(.+)\1\z", "$2")
    return once(once(text))


def padded(number: Column, width: int = 4) -> Column:
    """At least so many digits; longer numbers are not cut."""
    return F.format_string(f"%0{width}d", number.cast("long"))


def block_id(page_id: Column, index: Column) -> Column:
    """1-based from a 0-based index."""
    return F.concat(page_id, F.lit(":block:"), padded(index + 1))


def span_id(block: Column, index: Column) -> Column:
    return F.concat(block, F.lit(":span:"), padded(index + 1))


def node_id(block: Column, kind: str) -> Column:
    """The id of the node that starts with a block."""
    return F.concat(block, F.lit(f":node:{kind}"))


def verse_line_id(block: Column, number: Column) -> Column:
    """1-based."""
    return F.concat(block, F.lit(":node:verse-line:"), padded(number))


def relationship_id(source: Column, kind: Column, target: Column) -> Column:
    return F.concat(source, F.lit(":relationship:"), F.replace(kind, F.lit("_"), F.lit("-")), F.lit(":"), target)
