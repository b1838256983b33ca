"""Minified JSON text out of columns, choosing per key between ``null`` and absence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scalar(value: Column) -> Column:
    """JSON text of a string, number or boolean; NULL stays NULL."""
    in_array = F.to_json(F.array(value))
    return F.when(value.isNotNull(), F.substring(in_array, F.lit(2), F.length(in_array) - 2))


def iso(day: Column) -> Column:
    """JSON text of a date."""
    return F.when(day.isNotNull(), F.concat(F.lit('"'), day.cast("string"), F.lit('"')))


def or_null(text: Column) -> Column:
    return F.coalesce(text, F.lit("null"))


def flag(name: str, when: Column) -> Column:
    """``"name":true``, or nothing at all."""
    return F.when(when, F.lit(f'"{name}":true'))


def obj(always: dict[str, Column], sometimes: list[Column] | None = None) -> Column:
    """Object with keys that are always there (``null`` if need be) and optional members."""
    members = [F.concat(F.lit(f'"{k}":'), or_null(v)) for k, v in always.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *members, *(sometimes or [])), F.lit("}"))


def arr(texts: Column) -> Column:
    """Array of JSON texts."""
    return F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))


def mapped(items: Column, to_text) -> Column:
    """Array of the texts that ``to_text`` gives for each item."""
    return arr(F.transform(items, to_text))
