"""Text expressions with the semantics tabular cleaning scripts expect."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartframes.columns import Name, col

# fixed values: the characters that count as blanks when a line is wrapped
BLANKS = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)


def replace_first(text: Name, pattern: str, value: str) -> Column:
    """Replace the first regex match only; ``value`` is taken as it is."""
    return F.array_join(F.split(col(text), f"(?:{pattern})", 2), value)


def replace_literal(text: Name, literal: str, value: str) -> Column:
    """Replace the first occurrence of a plain string."""
    return replace_first(text, re.escape(literal), value)


def replace_all(text: Name, literal: str, value: str) -> Column:
    """Replace every occurrence of a plain string."""
    return F.replace(col(text), F.lit(literal), F.lit(value))


def slice_text(text: Name, offset: int, length: int | None = None) -> Column:
    """Substring from a zero-based offset; a negative offset counts from the end."""
    text = col(text)
    if offset >= 0:
        start = F.lit(offset + 1)
    else:
        start = F.greatest(F.char_length(text) + offset + 1, F.lit(1))
    size = F.char_length(text) if length is None else F.lit(length)
    if offset < 0 and length is not None:
        # an offset before the start uses up part of the length
        size = F.greatest(size + F.least(F.char_length(text) + offset, F.lit(0)), F.lit(0))
    return F.substr(text, start, size)


def split_get(text: Name, separator: str, index: int = 0) -> Column:
    """Piece of a text split at a plain separator; null when there is no such piece."""
    return F.get(F.split(col(text), re.escape(separator)), F.lit(index))


def title_case(text: Name) -> Column:
    """Upper-case each letter that follows neither a letter nor a digit, lower-case the others."""
    pieces = F.regexp_extract_all(F.lower(col(text)), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), 1)
    raised = F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2))))
    return F.array_join(raised, "")


def zero_pad(text: Name, length: int) -> Column:
    """Zeros on the left up to ``length``, after a sign if there is one; longer text is kept."""
    text = col(text).cast("string")
    sign = F.regexp_extract(text, "^[+-]?", 0)
    digits = F.substr(text, F.char_length(sign) + 1)
    missing = F.greatest(F.lit(length) - F.char_length(text), F.lit(0))
    return F.concat(sign, F.repeat(F.lit("0"), missing), digits)


def pad_end(text: Name, length: int, fill: str = " ") -> Column:
    """Fill characters on the right up to ``length``; longer text is kept."""
    text = col(text).cast("string")
    missing = F.greatest(F.lit(length) - F.char_length(text), F.lit(0))
    return F.concat(text, F.repeat(F.lit(fill), missing))


def wrap_text(text: Name, width: int, mark: str = "<br>") -> Column:
    """Turn the first blank after at least ``width`` characters of each line into ``mark``."""
    quoted = mark.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(col(text), f"(?s)(.{{{width},}}?){BLANKS}", f"$1{quoted}")


def bold_label(head: Name, *tail: Name, separator: str = "<br>") -> Column:
    """``<b>head</b>`` followed by the other texts; null when any of them is null."""
    parts = [F.lit("<b>"), col(head).cast("string"), F.lit("</b>")]
    for text in tail:
        parts += [F.lit(separator), col(text).cast("string")]
    return F.concat(*parts)
