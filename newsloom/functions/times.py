"""Time expressions. The session zone is expected to be UTC, as ``session.py`` sets it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


_DATE = r"\A\s*[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[T ][0-9].*)?\z"
_BASIC = r"\A\s*([0-9]{4})([0-9]{2})([0-9]{2})[T ]([0-9]{2})([0-9]{2})([0-9]{2})((?:[.,][0-9]+)?)(.*)\z"
_BASIC_DATE = r"\A\s*([0-9]{4})([0-9]{2})([0-9]{2})\s*\z"
_BASIC_ZONE = r"([+-][0-9]{2})([0-9]{2})\s*\z"


def parse_utc(text: Column) -> Column:
    """ISO text to timestamp: a zone in the text counts, no zone means UTC, junk is null. Each
    value is parsed by itself. The text must hold a whole date, in the extended or the basic form, so
    that no part of the result comes from the clock."""
    basic = F.regexp_replace(F.regexp_replace(text, _BASIC_ZONE, "$1:$2"), _BASIC, "$1-$2-$3T$4:$5:$6$7$8")
    return (
        F.when(text.rlike(_DATE), F.try_to_timestamp(text))
        .when(text.rlike(_BASIC), F.try_to_timestamp(basic))
        .when(text.rlike(_BASIC_DATE), F.try_to_timestamp(F.regexp_replace(text, _BASIC_DATE, "$1-$2-$3")))
    )


def run_day(moment: Column) -> Column:
    """The day a run belongs to."""
    return F.to_date(moment)


def offset_text(moment: Column) -> Column:
    """Timestamp as text with its offset, a fraction only where there is one."""
    whole = moment == F.date_trunc("second", moment)
    return F.when(whole, F.date_format(moment, "yyyy-MM-dd HH:mm:ssxxx")).otherwise(
        F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSSxxx"))


def stamp(moment: Column) -> Column:
    """Timestamp as text with microseconds, for exports and comparisons."""
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS")
