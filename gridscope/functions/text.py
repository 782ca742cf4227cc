"""Text column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridscope.functions.columns import col

_BLANK_ENDS = r"^[\x00-\x20]+|[\x00-\x20]+$"


def is_empty(text) -> Column:
    return col(text).isNull() | (col(text) == "")


def _blank_if_empty(text, value: Column) -> Column:
    return F.when(is_empty(text), F.lit("")).otherwise(value)


def _trimmed(text) -> Column:
    return F.regexp_replace(col(text), _BLANK_ENDS, "")


def join_items(items, symbol: str) -> Column:
    """The non-blank items of a list joined by ``symbol``."""
    return F.array_join(F.filter(col(items), lambda item: _trimmed(item) != ""), symbol)


def equals_any(text, options, separator: str = ",") -> Column:
    """Whether the trimmed text is one of a separated list; blanks in the list do not count."""
    listed = F.split(strip_whitespace(options), separator)
    return F.coalesce(F.array_contains(listed, _trimmed(text)), F.lit(False))


def omit_after(text, size: int) -> Column:
    """Text cut to ``size`` characters and marked with dots."""
    return F.when(F.length(col(text)) > size, F.concat(F.left(col(text), F.lit(size)), F.lit("..."))) \
        .otherwise(col(text))


def cut_with_symbol(text, size: int, symbol: str) -> Column:
    """Like :func:`omit_after` with an own mark; text that is short enough gives ''."""
    return F.when(F.length(col(text)) > size, F.concat(F.left(col(text), F.lit(size)), F.lit(symbol))) \
        .otherwise(F.lit(""))


def mask_email(email) -> Column:
    """Stars in place of everything before the last @."""
    text = col(email)
    local = F.length(text) - F.instr(F.reverse(text), "@")
    masked = F.concat(F.repeat(F.lit("*"), local), F.substring(text, local + 1, F.length(text)))
    return F.when(text.contains("@") & (local > 0), masked).otherwise(text)


def repeat(text, times: int) -> Column:
    return F.repeat(col(text), times)


def drop_left(text, count: int) -> Column:
    return F.when(~is_empty(text) & (F.length(col(text)) >= count),
                  F.substring(col(text), F.lit(count + 1), F.length(col(text)))).otherwise(F.lit(""))


def drop_right(text, count: int) -> Column:
    return F.when(F.length(col(text)) > count, F.left(col(text), F.length(col(text)) - count)) \
        .otherwise(col(text))


def split_items(text, pattern: str) -> Column:
    return F.split(col(text), pattern)


def format_by_pattern(number, pattern: str) -> Column:
    return F.call_function("format_number", col(number), F.lit(pattern))


def left(text, count: int) -> Column:
    return _blank_if_empty(text, F.left(col(text), F.lit(count)))


def right(text, count: int) -> Column:
    return _blank_if_empty(text, F.right(col(text), F.lit(count)))


def strip_whitespace(text) -> Column:
    return F.regexp_replace(col(text), r"\s+", "")


def strip_punctuation(text) -> Column:
    return _blank_if_empty(text, F.regexp_replace(col(text), r"[\pP\p{Punct}]+", ""))


def count_of(text, part: str) -> Column:
    """Number of non-overlapping places where ``part`` stands in the text."""
    if not part:
        return F.lit(0)
    spared = F.length(col(text)) - F.length(F.replace(col(text), F.lit(part), F.lit("")))
    return F.coalesce((spared / len(part)).cast("int"), F.lit(0))


def _swap(text: Column, start: Column, length: int, new: str) -> Column:
    return F.concat(F.left(text, start - 1), F.lit(new),
                    F.substring(text, start + length, F.length(text)))


def replace_first(text, part: str, new: str) -> Column:
    text = col(text)
    start = F.instr(text, part)
    return F.when(start > 0, _swap(text, start, len(part), new)).otherwise(text)


def replace_last(text, part: str, new: str) -> Column:
    text = col(text)
    from_end = F.instr(F.reverse(text), part[::-1])
    start = F.length(text) - from_end - len(part) + 2
    return F.when(from_end > 0, _swap(text, start, len(part), new)).otherwise(text)


def remove_all(text, part: str) -> Column:
    return F.replace(col(text), F.lit(part), F.lit("")) if part else col(text)


def upper_first(text) -> Column:
    """First letter in upper case if it is a-z."""
    text = col(text)
    head, tail = F.left(text, F.lit(1)), F.substring(text, F.lit(2), F.length(text))
    return _blank_if_empty(text, F.when(head.between("a", "z"), F.concat(F.upper(head), tail)).otherwise(text))


def lower_first(text) -> Column:
    """First letter in lower case if it is A-Z."""
    text = col(text)
    head, tail = F.left(text, F.lit(1)), F.substring(text, F.lit(2), F.length(text))
    return _blank_if_empty(text, F.when(head.between("A", "Z"), F.concat(F.lower(head), tail)).otherwise(text))


def left_equal(a, b, count: int) -> Column:
    return left(a, count) == left(b, count)


def right_equal(a, b, count: int) -> Column:
    return right(a, count) == right(b, count)
