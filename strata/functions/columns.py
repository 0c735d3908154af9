"""Column expressions shared by the operators. All built-in, so they stay
inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_prefix(date_text: Column | str) -> Column:
    """Year read from the first four characters of a date text.

    Null when the text is null, empty or does not start with a number.
    """
    return F.left(_col(date_text), F.lit(4)).try_cast("int")


def lenient_date(text: Column | str, fmt: str) -> Column:
    """Text to date; a malformed date gives null instead of failing the job."""
    return F.try_to_date(_col(text), fmt)


def list_to_text(values: Column | str, separator: str = ",") -> Column:
    """Array of codes to one delimited text; null or empty array gives ''."""
    return F.concat_ws(separator, _col(values).cast("array<string>"))


def required(value: Column, message: str) -> Column:
    """The value, or a job failure with ``message`` when it is null."""
    return F.when(value.isNull(), F.raise_error(F.lit(message))).otherwise(value)
