"""Ingest of landed JSON pages (result pages of a catalogue service and its
code dictionary).

Each landed record holds one page as JSON text. Pages are parsed on the
executors as VARIANT, one record at a time, so the driver never holds
records and the work grows with the number of pages, not with one machine.
VARIANT keeps a *missing* field apart from a field that is present with a
JSON null: a missing text field takes its default (``''``), an explicit null
stays null (and is later dropped by the clean step when it is the title).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import catalogue as C
from strata.functions import (
    element_fault,
    page_fault,
    read_field,
    read_text,
    required,
    year_prefix,
)
from strata.schemas import RAW_CODES, RAW_FILMS, conforming


class PageSplit(NamedTuple):
    good: DataFrame
    bad: DataFrame


def read_landed_pages(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Landed pages -> one ``body`` row per page: JSON Lines files (one page
    per line), or with ``whole_files=True`` one page per file (a saved
    response, possibly spread over many lines)."""
    return spark.read.text(path, wholetext=whole_files).withColumnRenamed("value", "body")


def _parsed(pages: DataFrame, body: str, results_field: str) -> DataFrame:
    """``body, doc, reason``: the page as VARIANT and why it cannot be read."""
    doc = F.try_parse_json(F.col(body))
    parsed = pages.select(F.col(body).alias("body"), doc.alias("doc"))
    return parsed.withColumn("reason", page_fault(F.col("body"), F.col("doc"), results_field))


def split_bad_pages(pages: DataFrame, body: str = "body",
                    results_field: str = C.RESULTS_FIELD) -> PageSplit:
    """Separate the pages that cannot be read as a whole (not JSON, not an
    object, results that are no list) from the rest.

    A page without a results list is *not* bad: it yields zero rows.
    """
    doc = F.try_parse_json(F.col(body))
    flagged = pages.withColumn("_bad", page_fault(F.col(body), doc, results_field).isNotNull())
    return PageSplit(
        good=flagged.filter(~F.col("_bad")).drop("_bad"),
        bad=flagged.filter(F.col("_bad")).drop("_bad"),
    )


def _projection(e: Column, fields, date_column: str, year_column: str) -> list[Column]:
    """The typed raw columns of a result element."""
    out = []
    for field, column, kind, default in fields:
        value = read_field(e, field, kind, default, C.CODE_SEPARATOR).value
        out.append(value.alias(column))
        if column == date_column:
            out.append(year_prefix(value).alias(year_column))
    return out


def ingest_films(
    pages: DataFrame,
    body: str = "body",
    fields=C.PAGE_FIELDS,
    results_field: str = C.RESULTS_FIELD,
    id_column: str = C.FILM_ID,
    date_column: str = C.RELEASE_DATE,
    year_column: str = C.RELEASE_YEAR,
    lenient: bool = False,
) -> DataFrame:
    """Result pages -> one typed raw row per result element.

    A page without the results field gives no rows. The year is the
    four-character prefix of the date text (null when empty or not a number).
    A page that cannot be read (see ``functions.fields.page_fault``) and an
    element with a fault (``element_fault``) fail the job; with
    ``lenient=True`` they give no row (:func:`faulty_pages` and
    :func:`sort_films` keep them).
    """
    e, doc = F.col("_e"), F.col("doc")
    items = F.try_variant_get(doc, f"$.{results_field}", "array<variant>")
    if not lenient:
        items = F.when(F.col("reason").isNotNull(), F.raise_error(F.col("reason"))).otherwise(items)
    elements = _parsed(pages, body, results_field).select(F.explode(items).alias("_e"))
    fault = element_fault(e, fields, id_column, C.CODE_SEPARATOR)
    if lenient:
        out = elements.where(fault.isNull()).select(*_projection(e, fields, date_column, year_column))
    else:
        checked = F.when(fault.isNotNull(), F.raise_error(F.concat_ws(
            ": ", fault["reason"], fault["field"])))
        out = elements.select(*[
            (checked.otherwise(c) if name == id_column else c).alias(name)
            for name, c in zip(_names(fields, date_column, year_column),
                               _projection(e, fields, date_column, year_column))])
    return conforming(out, RAW_FILMS) if fields is C.PAGE_FIELDS else out


def _names(fields, date_column: str, year_column: str) -> list[str]:
    names = []
    for _, column, _, _ in fields:
        names += [column, year_column] if column == date_column else [column]
    return names


#: Where a page's bad elements stand (from 0), and why.
FAULTS = "array<struct<index:int,field:string,reason:string>>"


def _marked(pages: DataFrame, body: str, fields, results_field: str, id_column: str) -> DataFrame:
    """``body, reason, marked``: each page with its elements and their faults."""
    items = F.try_variant_get("doc", f"$.{results_field}", "array<variant>")
    return _parsed(pages, body, results_field).select("body", "reason", F.transform(
        items, lambda e, i: F.struct(e.alias("e"), i.alias("index"),
                                     element_fault(e, fields, id_column, C.CODE_SEPARATOR).alias("fault")))
        .alias("marked"))


_ENTRY = f"struct<e:variant,report:struct<reason:string,body:string,faults:{FAULTS}>>"


def _faults() -> Column:
    bad = F.filter("marked", lambda m: m["fault"].isNotNull())
    return F.coalesce(F.transform(bad, lambda m: F.struct(
        m["index"].alias("index"), m["fault"]["field"].alias("field"),
        m["fault"]["reason"].alias("reason"))), F.array().cast(FAULTS)).cast(FAULTS)


def faulty_pages(
    pages: DataFrame,
    body: str = "body",
    fields=C.PAGE_FIELDS,
    results_field: str = C.RESULTS_FIELD,
    id_column: str = C.FILM_ID,
) -> DataFrame:
    """``reason, body, faults``: each page that holds anything that cannot be
    read, once: why the page as a whole (else null), or which of its elements
    by their index, field and reason."""
    marked = _marked(pages, body, fields, results_field, id_column)
    return (marked.select("reason", "body", _faults().alias("faults"))
            .where(F.col("reason").isNotNull() | (F.size("faults") > 0)))


def sort_films(
    pages: DataFrame,
    body: str = "body",
    fields=C.PAGE_FIELDS,
    results_field: str = C.RESULTS_FIELD,
    id_column: str = C.FILM_ID,
    date_column: str = C.RELEASE_DATE,
    year_column: str = C.RELEASE_YEAR,
) -> DataFrame:
    """Good elements and bad pages from one parse: the raw columns, ``reason``,
    ``body``, ``faults`` and ``bad``.

    A good element is a row with ``bad`` false and the last three null. A page
    with anything that cannot be read is one row with ``bad`` true and null raw
    columns, as :func:`faulty_pages` gives it: its text is stored once, however
    many of its elements are bad. The good elements of such a page still load.
    A page without the results field gives no row at all.
    """
    report = F.struct("reason", "body", "faults")
    found = _marked(pages, body, fields, results_field, id_column).select(
        "reason", "body", "marked", _faults().alias("faults"))
    none = F.lit(None).cast(f"struct<reason:string,body:string,faults:{FAULTS}>")
    no_entry = F.array().cast(f"array<{_ENTRY}>")
    good = F.coalesce(F.transform(F.filter("marked", lambda m: m["fault"].isNull()), lambda m: F.struct(
        m["e"].alias("e"), none.alias("report"))), no_entry)
    bad = F.when(F.col("reason").isNotNull() | (F.size("faults") > 0), F.array(F.struct(
        F.lit(None).cast("variant").alias("e"), report.alias("report")))).otherwise(no_entry)
    entry = found.select(F.explode(F.concat(good, bad)).alias("entry")).select("entry.e", "entry.report")
    is_bad = F.col("report").isNotNull()
    # defaults of missing fields belong to good elements only
    columns = [F.when(~is_bad, c).alias(name) for name, c in zip(
        _names(fields, date_column, year_column), _projection(F.col("e"), fields, date_column, year_column))]
    return entry.select(*columns, "report.reason", "report.body", "report.faults", is_bad.alias("bad"))


def ingest_dictionary(
    pages: DataFrame,
    body: str = "body",
    list_field_name: str = C.DICTIONARY_FIELD,
    id_field: str = C.DICTIONARY_ID_FIELD,
    name_field: str = C.DICTIONARY_NAME_FIELD,
    id_column: str = C.CODE_ID,
    name_column: str = C.CODE_NAME,
) -> DataFrame:
    """Dictionary pages -> (code as text, name). Both are mandatory: an entry
    that lacks either, or has a null in either, fails the job."""
    e = F.col("_e")
    items = F.when(F.col("reason").isNotNull(), F.raise_error(F.col("reason"))).otherwise(
        F.try_variant_get("doc", f"$.{list_field_name}", "array<variant>"))

    def mandatory(field: str) -> Column:
        value, fault = read_text(e, field, None)
        return required(F.when(fault.isNull(), value), f"dictionary entry without {field}")

    out = _parsed(pages, body, list_field_name).select(F.explode(items).alias("_e")).select(
        mandatory(id_field).alias(id_column), mandatory(name_field).alias(name_column))
    return conforming(out, RAW_CODES) if (id_column, name_column) == (C.CODE_ID, C.CODE_NAME) else out
