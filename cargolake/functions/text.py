"""Text expressions: stripping, tokens, file-name parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Code points that count as blank when text is stripped or split.
WHITESPACE = "".join(
    map(chr, (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760,
              *range(8192, 8203), 8232, 8233, 8239, 8287, 12288))
)
# the same characters as a pattern: Unicode white space and the four separators
BLANKS = r"(?U)[\s\x1c-\x1f]+"


def strip(c: Column) -> Column:
    """Remove blanks of every kind on both sides (Spark's ``trim`` takes only spaces)."""
    return F.trim(c, F.lit(WHITESPACE))


def collapse_blanks(c: Column) -> Column:
    """Every run of blanks becomes one space."""
    return F.regexp_replace(c, BLANKS, " ")


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def name_key(c: Column) -> Column:
    """The form in which person names are compared: upper case, single spaces."""
    return collapse_blanks(strip(F.upper(c)))


def plate_key(c: Column) -> Column:
    """The form in which number plates are compared."""
    return strip(F.upper(c))


def token(c: Column, i: int) -> Column:
    """The i-th blank-separated token; the empty string when there is none."""
    return F.coalesce(F.get(F.split(collapse_blanks(strip(c)), " "), F.lit(i)), F.lit(""))


def decoded_file_name(c: Column) -> Column:
    """A file name from file metadata, where blanks and non-ASCII are percent-encoded."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def key_from_file_name(c: Column) -> Column:
    """The second ``_``-separated part of a file name; NULL when there is none."""
    return F.get(F.split(c, "_"), F.lit(1))


def stem(c: Column) -> Column:
    """A file name without its last extension."""
    return F.regexp_replace(c, r"(?<=.)\.[^.]*$", "")


def base_name(c: Column) -> Column:
    """The last segment of a path."""
    return F.substring_index(c, "/", -1)
