"""Text to typed value, as native column expressions (no Python per row)."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "no number".
SENTINELS = ("Ip", "Acum", "Varias")

# Spanish month names.
MONTH_NUMBERS = {
    "enero": "01", "febrero": "02", "marzo": "03", "abril": "04",
    "mayo": "05", "junio": "06", "julio": "07", "agosto": "08",
    "septiembre": "09", "octubre": "10", "noviembre": "11", "diciembre": "12",
}

# Characters whose compatibility decomposition holds exactly one ASCII character, and that character.
_PLAIN = {
    chr(i): plain
    for i in range(0x80, 0x3000)
    if len(plain := unicodedata.normalize("NFKD", chr(i)).encode("ascii", "ignore").decode()) == 1
}

# All characters that count as blank at either end of a text.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

_MARGIN = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]*+"
_DECIMAL = rf"^{_MARGIN}([+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?){_MARGIN}$"
_INTEGER = rf"^{_MARGIN}([+-]?[0-9]+){_MARGIN}$"

# Written forms of a coordinate, a number in a cell, and a long date.
_COORDINATE = r"^([0-9]{2})([0-9]{2})([0-9]{2})([NSEW])$"
_NUMBER = r"-?[0-9]+(?:[.,][0-9]+)?"
_LONG_DATE = r"(?U)([0-9]{1,2})\s+(\w+)\s+([0-9]{4})"


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def blank_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def _matched(text: Column, pattern: str, group: int) -> Column:
    """NULL without a match: a failing cast of an empty text would raise inside, at a price."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def decimal_text(text: Column) -> Column:
    """Number with a point or comma; blanks, sentinels and anything else give NULL.

    Only plain decimal notation is accepted, so NaN and infinities, which would win
    every maximum, cannot enter.
    """
    plain = F.replace(text, F.lit(","), F.lit("."))
    return _matched(plain, _DECIMAL, 1).try_cast("double")


def integer_text(text: Column) -> Column:
    return _matched(text, _INTEGER, 1).try_cast("int")


def coordinate_text(text: Column) -> Column:
    """``DDMMSS`` plus hemisphere letter to signed decimal degrees."""
    plain = stripped(text)

    def part(i: int) -> Column:
        return F.regexp_extract(plain, _COORDINATE, i)

    degrees = (
        part(1).try_cast("int")
        + part(2).try_cast("int") / F.lit(60)
        + part(3).try_cast("int") / F.lit(3600)
    )
    signed = F.when(part(4).isin("S", "W"), -degrees).otherwise(degrees)
    return F.when(plain.rlike(_COORDINATE), signed)


def temperature_cell(text: Column) -> Column:
    """First signed number before the bracketed hour of ``36.8 (16:40)``."""
    number = _matched(F.split_part(text, F.lit("("), F.lit(1)), _NUMBER, 0)
    return F.replace(number, F.lit(","), F.lit(".")).try_cast("double")


def long_date_iso(text: Column) -> Column:
    """ISO text of a date such as ``11 julio 2026``; NULL without one or with an unknown month."""
    months = F.create_map(*[F.lit(x) for pair in MONTH_NUMBERS.items() for x in pair])
    month = F.try_element_at(months, F.lower(F.regexp_extract(text, _LONG_DATE, 2)))
    return F.concat_ws(
        "-",
        F.regexp_extract(text, _LONG_DATE, 3),
        month,
        F.lpad(F.regexp_extract(text, _LONG_DATE, 1), 2, "0"),
    ).substr(F.lit(1), F.when(month.isNotNull(), F.lit(10)))


def iso_date(text: Column) -> Column:
    return F.try_to_date(text, "yyyy-MM-dd")


def offset_instant(text: Column) -> Column:
    """Instant written with a numeric offset, ``+0000`` or ``+00:00``."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssxx")),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssxxx")),
    )


def local_clock(instant: Column, tz: str) -> Column:
    """Wall clock of ``tz`` for an instant; needs a session in UTC."""
    return F.from_utc_timestamp(instant, tz)


def accent_free_key(text: Column) -> Column:
    """Sort key without case and accents: what has no plain letter in it is left out."""
    plain = F.translate(text, "".join(_PLAIN), "".join(_PLAIN.values()))
    return F.lower(F.regexp_replace(plain, r"[^\x00-\x7F]", ""))
