"""Column expressions. All are built-in functions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How many leading characters of an ISO 8601 text are read.
ISO_SECONDS = 19
ISO_DAYS = 10
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_timestamp(text: Column | str) -> Column:
    """ISO text to timestamp. Fraction and offset are ignored, bad text is NULL.

    A text that does not begin with a date is bad: a time alone would be taken as today's.
    """
    moment = _column(text).substr(1, ISO_SECONDS)
    return F.when(iso_date(text).isNotNull(), moment.try_cast("timestamp"))


def iso_date(text: Column | str) -> Column:
    """ISO text to date by its first ten characters; bad text is NULL."""
    return _column(text).substr(1, ISO_DAYS).try_cast("date")


def iso_text(moment: Column | str) -> Column:
    """Timestamp to ISO text of whole seconds."""
    return F.date_format(_column(moment), ISO_PATTERN)


def null_when(value: Column | str, condition: Column) -> Column:
    """NULL where ``condition`` is true; where it is false or NULL, the value."""
    return F.when(condition, F.lit(None)).otherwise(_column(value))


def array_text(array: Column | str, sep: str = ",") -> Column:
    """Join an array's elements as text; a NULL array stays NULL."""
    return F.array_join(_column(array).cast("array<string>"), sep)


def translation_key(prop: Column | str, locale: Column | str) -> Column:
    """``property_locale``, leaving out a missing part; ``''`` if both are missing."""
    return F.concat_ws("_", _column(prop), _column(locale))


def contact_address(username: Column | str, email: Column | str) -> Column:
    """The user name if it is an address, else the e-mail if it is one, else ''."""
    first, second = _column(username), _column(email)
    return (
        F.when(first.contains("@"), F.concat(first, F.lit(";")))
        .when(second.contains("@"), F.concat(second, F.lit(";")))
        .otherwise(F.lit(""))
    )


def split_point(coordinates: Column | str, sep: str = ",") -> dict[str, Column]:
    """Longitude (first part) and latitude (last part) of a point's text."""
    text = _column(coordinates)
    return {
        "long": F.substring_index(text, sep, 1),
        "lat": F.substring_index(text, sep, -1),
    }
