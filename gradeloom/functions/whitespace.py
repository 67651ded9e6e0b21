"""Unicode-aware whitespace and line handling as Column expressions.

``trim`` and ``\\s`` know only ASCII blanks; answers and questions also carry
full-width and no-break spaces, so every blank test in the package uses the
character set below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The characters that count as line ends and as whitespace.
LINE_ENDS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
INLINE_BLANKS = (
    "\t \x1f\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)
BLANKS = LINE_ENDS + INLINE_BLANKS

# The same sets as regular-expression character classes. The rare wide blanks stand
# behind one range test, so that ordinary letters are ruled out in two steps.
_WIDE_BLANK = r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
BLANK_CLASS = rf"[\t-\r\x1c-\x20\x85\xa0{_WIDE_BLANK}]"
_LINE_END = r"[\n-\r\x1c-\x1e\x85\u2028\u2029]"
_NOT_LINE_END = r"[^\n-\r\x1c-\x1e\x85\u2028\u2029]"


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: ColumnOrName) -> Column:
    """Remove whitespace from both ends."""
    return F.btrim(as_column(text), F.lit(BLANKS))


def left_strip(text: ColumnOrName) -> Column:
    """Remove whitespace from the start."""
    return F.ltrim(as_column(text), F.lit(BLANKS))


def right_strip(text: ColumnOrName) -> Column:
    """Remove whitespace from the end."""
    return F.rtrim(as_column(text), F.lit(BLANKS))


def is_blank(text: ColumnOrName) -> Column:
    """True for null, empty and whitespace-only text."""
    return F.coalesce(strip(text), F.lit("")) == ""


def first_line(stripped: ColumnOrName) -> Column:
    """First line of text whose start has already been stripped."""
    head = F.substring_index(as_column(stripped), "\n", 1)
    return right_strip(F.regexp_extract(head, rf"\A{_NOT_LINE_END}*+", 0))


def last_line(stripped: ColumnOrName) -> Column:
    """Last line of text whose end has already been stripped."""
    tail = F.substring_index(as_column(stripped), "\n", -1)
    return left_strip(F.regexp_extract(tail, rf"(?s)\A(?:.*{_LINE_END})?({_NOT_LINE_END}*)\z", 1))


def clean_lines(text: ColumnOrName) -> Column:
    """The stripped, non-blank lines as an array."""
    lines = F.transform(F.split(as_column(text), _LINE_END), strip)
    return F.filter(lines, lambda line: line != "")


def word_count(text: ColumnOrName) -> Column:
    """Number of whitespace-separated words."""
    return F.size(F.array_remove(F.split(as_column(text), f"{BLANK_CLASS}+"), ""))
