"""Text clean-up: names, and dates or timestamps that arrive in three notations.

A parse that fails costs an exception inside the formatter, so trying three formats on every row is
slow. The separator positions already tell which notation a value can be in; only values that fit
none of them go through all formats. The result is the same as trying the formats in order.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted notations, in order of preference.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "dd/MM/yyyy")
TIME_SUFFIX = " HH:mm:ss"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _by_notation(text: Column, parse) -> Column:
    dashed, slashed, day_first = DATE_FORMATS
    fifth, third = F.substring(text, 5, 1), F.substring(text, 3, 1)
    return (F.when(fifth == "-", parse((dashed,)))
             .when(fifth == "/", parse((slashed,)))
             .when(third == "/", parse((day_first,)))
             .otherwise(parse(DATE_FORMATS)))


def parse_date(value: Column | str) -> Column:
    text = _column(value)
    return _by_notation(text, lambda formats: F.coalesce(*[F.try_to_date(text, f) for f in formats]))


def parse_timestamp(value: Column | str) -> Column:
    """Date with time of day; a date alone means midnight. Needs a UTC session to be reproducible."""
    text = _column(value)

    def parse(formats):
        timed = F.coalesce(*[F.try_to_timestamp(text, F.lit(f + TIME_SUFFIX)) for f in formats])
        dated = F.coalesce(*[F.try_to_date(text, f).cast("timestamp") for f in formats])
        return F.when(F.length(text) > 10, F.coalesce(timed, dated)).otherwise(F.coalesce(dated, timed))

    return _by_notation(text, parse)


def normalise_name(value: Column | str) -> Column:
    return F.upper(F.trim(_column(value)))


def title_case(value: Column | str) -> Column:
    return F.initcap(_column(value))
