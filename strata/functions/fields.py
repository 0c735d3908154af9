"""Fields of landed JSON elements, read by declared type.

Every reader gives a value and a fault (a text; null where the value is good),
and neither ever fails a job: whether a fault fails the job or puts the element
aside is the caller's choice. Elements are VARIANT, so a missing field is told
apart from one that is present with a JSON null.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Reading(NamedTuple):
    value: Column
    fault: Column


FAULT_TYPE = "struct<field:string,reason:string>"
NOT_AN_OBJECT = "element is not an object"
NULL_ID = "element with a null id"
BAD_TEXT = "element with an unreadable text"
BAD_NUMBER = "element with an unreadable number"
BAD_LIST = "element with an unreadable list"
BAD_PAGE = "page is not valid JSON"
PAGE_NOT_AN_OBJECT = "page is not a JSON object"
RESULTS_NOT_A_LIST = "results field is not a list"


def given(element: Column, field: str) -> Column:
    """The field as VARIANT; null when the element has no such field."""
    return F.variant_get(element, f"$.{field}", "variant")


def is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def is_list(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>").isNotNull()


def _fault(bad: Column, reason: str) -> Column:
    return F.when(F.coalesce(bad, F.lit(False)), F.lit(reason))


def read_text(element: Column, field: str, default: str) -> Reading:
    """Text, number or boolean as text. Missing: the default; JSON null: null.
    An object or a list is no text."""
    value = given(element, field)
    return Reading(F.when(value.isNull(), F.lit(default))
                   .otherwise(F.try_variant_get(element, f"$.{field}", "string")),
                   _fault(is_object(value) | is_list(value), BAD_TEXT))


def read_number(element: Column, field: str, spark_type: str, default) -> Reading:
    """A number, or a text that reads as one. Missing or JSON null: the default."""
    value = given(element, field)
    number = F.try_variant_get(element, f"$.{field}", spark_type)
    return Reading(F.coalesce(number, F.lit(default).cast(spark_type)),
                   _fault(value.isNotNull() & ~F.is_variant_null(value) & number.isNull(), BAD_NUMBER))


def read_list(element: Column, field: str, separator: str) -> Reading:
    """A list of texts, numbers or booleans as delimited text; nulls in it are
    left out. Missing, JSON null or empty: ''. An entry that is an object or a
    list, and a field that is no list, cannot be read."""
    value = given(element, field)
    entries = F.try_variant_get(element, f"$.{field}", "array<variant>")
    nested = F.exists(entries, lambda x: is_object(x) | is_list(x))
    unread = value.isNotNull() & ~F.is_variant_null(value) & (entries.isNull() | nested)
    return Reading(F.concat_ws(separator, F.try_variant_get(element, f"$.{field}", "array<string>")),
                   _fault(unread, BAD_LIST))


def read_field(element: Column, field: str, kind: str, default, separator: str = ",") -> Reading:
    if kind == "text":
        return read_text(element, field, default)
    if kind in ("double", "int"):
        return read_number(element, field, kind, default)
    if kind == "list":
        return read_list(element, field, separator)
    raise ValueError(f"unknown field kind {kind!r}")


def element_fault(element: Column, fields, id_column: str, separator: str = ",") -> Column:
    """``(field, reason)`` of the first fault of a result element, else null.
    ``fields`` are (field, column, kind, default); ``id_column`` may be missing
    (it takes its default) but not null."""
    def fault(field: str | None, reason: Column) -> Column:
        return F.when(reason.isNotNull(), F.struct(F.lit(field).cast("string").alias("field"),
                                                   reason.alias("reason")).cast(FAULT_TYPE))

    found = [fault(None, F.when(element.isNull() | ~is_object(element), F.lit(NOT_AN_OBJECT)))]
    for field, column, kind, default in fields:
        if column == id_column:
            found.append(fault(field, _fault(F.is_variant_null(given(element, field)), NULL_ID)))
        found.append(fault(field, read_field(element, field, kind, default, separator).fault))
    return F.coalesce(*found)


def page_fault(body: Column, doc: Column, results_field: str) -> Column:
    """Why a page as a whole cannot be read, else null. ``doc`` is the body as
    VARIANT, null where it is not JSON. A null body is no page; a page without
    the results field is a good page without results."""
    results = given(doc, results_field)
    return (F.when(body.isNull(), F.lit(None).cast("string"))
            .when(doc.isNull(), F.lit(BAD_PAGE))
            .when(~is_object(doc), F.lit(PAGE_NOT_AN_OBJECT))
            .when(results.isNotNull() & ~is_list(results), F.lit(RESULTS_NOT_A_LIST)))
