"""Text and type cleaning for landed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The white space characters stripped from text, and those of them that are ASCII.
ASCII_SPACE = " \t\n\x0b\x0c\r"
WHITESPACE = (
    ASCII_SPACE + "\x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trimmed(text: Column) -> Column:
    """Strip Unicode white space. Text of one byte per character can only hold the ASCII ones, and
    stripping by that short list costs half as much as by the whole."""
    is_ascii = F.length(text) == F.octet_length(text)
    return F.when(is_ascii, F.btrim(text, F.lit(ASCII_SPACE))).otherwise(
        F.btrim(text, F.lit(WHITESPACE))
    )


def blank_to_null(text: Column | str) -> Column:
    """Trim, and turn what is then empty into null."""
    return F.nullif(trimmed(_col(text)), F.lit(""))


def sentinel_to_null(text: Column | str, sentinel: str) -> Column:
    """``blank_to_null`` plus one exact-case spelling of "nothing"."""
    return F.nullif(blank_to_null(text), F.lit(sentinel))


def number_or_null(text: Column | str) -> Column:
    """Parse a double; text that is not a number becomes null instead of failing under ANSI."""
    return _col(text).try_cast("double")


def as_instant(value: Column | str, dtype: T.DataType) -> Column:
    """A landed timestamp as a zoneless timestamp, whatever type it landed with.

    Zoned timestamps are turned into their UTC wall clock, so results do not depend on the session
    time zone.
    """
    value = _col(value)
    if isinstance(dtype, T.TimestampNTZType):
        return value
    if isinstance(dtype, T.TimestampType):
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), value.cast("timestamp_ntz"))
    return value.try_cast("timestamp_ntz")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
