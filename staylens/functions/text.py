"""Text clean-up and locale-aware number parsing as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes (Unicode white space).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Trim Unicode white space (including no-break spaces) from both ends."""
    return F.trim(text, F.lit(WHITESPACE))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_group(text: Column, pattern: str, group: int = 1) -> Column:
    """A capture group of the first match, NULL when absent or empty."""
    return blank_to_null(F.regexp_extract(text, pattern, group))


def contains_any(text: Column, phrases: list[str]) -> Column:
    """Whether the text contains one of some literal phrases."""
    return F.regexp_like(text, F.lit("|".join(rf"\Q{phrase}\E" for phrase in phrases)))


def sanitise_area(area: Column) -> Column:
    """Make a value safe as a partition directory.

    ``"Tirana, Albania"`` becomes ``"Tirana__Albania"``; the double underscore
    is what later separates city from country.
    """
    return F.regexp_replace(area, r"(?U)[^\w\-.]", "_")


def city_of(search_area: Column) -> Column:
    return F.split_part(search_area, F.lit("__"), F.lit(1))


def country_of(search_area: Column) -> Column:
    return F.split_part(search_area, F.lit("__"), F.lit(2))


def parse_number(text: Column) -> Column:
    """Read a number written with either decimal convention.

    With both separators present the last one is the decimal mark. A lone
    separator followed only by three-digit groups marks thousands, except that
    all-zero groups after dots are decimals (``758.000`` is 758). Signs are
    dropped. Anything unreadable is NULL.
    """
    kept = F.regexp_replace(text, "[^0-9.,]", "")
    dots, commas = F.contains(kept, F.lit(".")), F.contains(kept, F.lit(","))
    no_dots, no_commas = F.replace(kept, F.lit(".")), F.replace(kept, F.lit(","))
    decimal_dot_last = F.regexp_like(kept, F.lit(r"\.[0-9]*$"))
    normal = (
        F.when(dots & commas & decimal_dot_last, no_commas)
        .when(dots & commas, F.replace(no_dots, F.lit(","), F.lit(".")))
        .when(dots & F.regexp_like(kept, F.lit(r"^[0-9]*(\.000)+$")), F.substring_index(kept, ".", 1))
        .when(dots & F.regexp_like(kept, F.lit(r"^[0-9]*(\.[0-9]{3})+$")), no_dots)
        .when(dots, kept)
        .when(F.regexp_like(kept, F.lit(r"^[0-9]*(,[0-9]{3})+$")), no_commas)
        .otherwise(F.replace(kept, F.lit(","), F.lit(".")))
    )
    return normal.try_cast("double")


def parse_digits(text: Column) -> Column:
    """The digits of a text read as one integer (``"342 reviews"`` is 342)."""
    return F.regexp_replace(text, "[^0-9]", "").try_cast("bigint")


def timestamp_to_date_text(scraped_at: Column) -> Column:
    """The partition date of an ISO timestamp."""
    return F.substring(scraped_at, 1, 10)


def timestamp_to_run(scraped_at: Column) -> Column:
    """An ISO timestamp as a directory-safe run label."""
    return F.replace(scraped_at, F.lit(":"), F.lit("-"))


# Packed texts: the end of a text, and what stands for an empty text or a character that has a meaning here, in their order.
_END, _MARK = "\x00", "\x01"
_STANDS_FOR = {"": _MARK + "\x01", _END: _MARK + "\x02", _MARK: _MARK + "\x03"}


def _plain(value: Column) -> Column:
    """A text that is not empty and holds no end sign; texts keep their order."""
    marked = value
    for sign in (_MARK, _END):
        marked = F.replace(marked, F.lit(sign), F.lit(_STANDS_FOR[sign]))
    return F.when(value == "", _STANDS_FOR[""]).otherwise(marked)


def packed(*texts: str) -> Column:
    """Text columns as one text, which compares as the columns do one after the other, NULL first.

    One text takes less of a shuffled row than several, each with a place and padding of its own.
    """
    return F.concat_ws(_END, *[F.coalesce(_plain(F.col(name)), F.lit("")) for name in texts])


def packed_parts(text: Column) -> Column:
    """What :func:`unpacked` reads the columns from."""
    return F.split(text, _END)


def unpacked(parts: Column, place: int) -> Column:
    """One of the columns that :func:`packed` took."""
    value = blank_to_null(F.get(parts, F.lit(place)))
    for sign, written in _STANDS_FOR.items():
        value = F.replace(value, F.lit(written), F.lit(sign))
    return value
