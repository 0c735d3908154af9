"""The catalogue layers: raw -> silver -> gold.

Each layer is a plain function over DataFrames; :func:`run_layers` writes
them in order, each layer reading the version the previous one wrote, and
publishes all tables as one release (``sources.releases``). Row counts are
observed inside the writing jobs (no extra counting passes). A run that fails
leaves its old tables as they were.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata import catalogue as C
from strata.operators import (
    clean,
    global_rank,
    resolve_codes,
    resolve_codes_by_position,
    top_n,
    top_ranked,
    yearly_trend,
)
from strata.schemas import RAW_FILMS
from strata.sources import (
    FAULTS,
    Draft,
    ensure_database,
    ingest_dictionary,
    ingest_films,
    qualified,
    sort_films,
)


def silver(raw_films: DataFrame, raw_codes: DataFrame, unique_rows: bool = False) -> DataFrame:
    """Clean the raw films, then resolve their code lists to names.

    ``unique_rows=True`` resolves row by row (``resolve_codes_by_position``):
    film rows are not regrouped, and rows equal on the silver key columns stay
    apart. The default merges them.
    """
    resolve = resolve_codes_by_position if unique_rows else resolve_codes
    return resolve(clean(raw_films), raw_codes)


def gold_ranking(silver_df: DataFrame, **options) -> DataFrame:
    """Popularity rank over the whole table and the dashboard columns.

    Unsorted: a table has no row order; readers sort (see :func:`preview`).
    Runs jobs and reads ``silver_df`` more than once (see ``global_rank``).
    """
    return global_rank(silver_df, C.POPULARITY, C.RANK, **options).select(*C.RANKING_COLUMNS)


def gold_trend(silver_df: DataFrame) -> DataFrame:
    """Count and rounded means per release year (unsorted, see ranking)."""
    return yearly_trend(silver_df)


def ranking_order() -> list[Column]:
    """A total order for the ranking: rank, then every other column."""
    return [F.col(C.RANK).asc()] + [F.col(c).asc_nulls_last() for c in C.RANKING_COLUMNS[1:]]


def preview(ranking: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows of a stored ranking."""
    return top_n(ranking, n, ranking_order())


def sorted_ranking(ranking: DataFrame) -> DataFrame:
    """The whole ranking in rank order, for readers that need it sorted: a
    range-partitioned sort (sampled bounds, every task sorts its range), never
    a single partition."""
    return ranking.orderBy(*ranking_order())


def sorted_trend(trend: DataFrame) -> DataFrame:
    """The trend in year order."""
    return trend.orderBy(F.col(C.RELEASE_YEAR).asc())


def trend_preview(trend: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` years of the trend (a top-n cut: years are unique)."""
    return top_n(trend, n, [F.col(C.RELEASE_YEAR).asc_nulls_first()])


def gold_top(silver_df: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows of the gold ranking straight from silver: the same
    rows and ranks as ``preview(gold_ranking(silver_df), n)``, from a top-n
    cut instead of a rank over the whole table."""
    top = top_ranked(silver_df, n, C.POPULARITY, ranking_order()[1:], C.RANK)
    return top.select(*C.RANKING_COLUMNS)


@dataclass
class LayerReport:
    database: str
    rows: dict[str, int] = field(default_factory=dict)
    quarantined: int | None = None      # pages and elements

    def table(self, name: str) -> str:
        return qualified(self.database, name)


# ---------------------------------------------------------------------------
# The four jobs. Each reads its inputs (landed pages or the previous layer's
# tables) and overwrites its own tables; the row counts come back observed. A job
# publishes what it wrote, unless it is given the draft of a longer run.
# ---------------------------------------------------------------------------

@contextmanager
def _run(spark: SparkSession, database: str, draft: Draft | None) -> Iterator[Draft]:
    if draft is not None:
        yield draft
        return
    with Draft(spark, database) as own:
        yield own
        own.publish()


def _check_bad_pages(bad_pages: str, fmt: str) -> None:
    if bad_pages not in ("fail", "quarantine"):
        raise ValueError(f"bad_pages must be 'fail' or 'quarantine', not {bad_pages!r}")
    if bad_pages == "quarantine" and fmt not in ("parquet", "orc", "json"):
        raise ValueError(f"a quarantine is one write of two folders: parquet, orc or json, not {fmt!r}")


def films_job(
    spark: SparkSession,
    film_pages: DataFrame,
    database: str = C.DATABASE,
    fmt: str = "parquet",
    bad_pages: str = "fail",
    draft: Draft | None = None,
) -> LayerReport:
    """Landed result pages -> raw film table, in one parse.

    ``bad_pages="fail"`` fails when a page or an element cannot be read (see
    ``ingest_films``); the old table stays. ``"quarantine"`` loads all elements
    that can be read; each page with anything else stands once in ``<raw
    table>_quarantine``, with why the page cannot be read or which of its
    elements (index, field, reason). One job writes both, as two folders that
    the two tables then point at. ``quarantined`` counts pages and elements.
    """
    _check_bad_pages(bad_pages, fmt)
    report = LayerReport(database)
    with _run(spark, database, draft) as run:
        if bad_pages == "fail":
            report.rows[C.RAW_FILMS_TABLE] = run.write(ingest_films(film_pages), C.RAW_FILMS_TABLE, fmt)
            return report
        rows, bad = sort_films(film_pages), F.col("bad")
        whole = F.when(F.col("reason").isNotNull(), 1).otherwise(F.size("faults"))
        counted, location = Observation(), run.location(C.RAW_FILMS_TABLE)
        (rows.observe(counted, F.count_if(~bad).alias("good"), F.count_if(bad).alias("pages"),
                      F.coalesce(F.sum(F.when(bad, whole)), F.lit(0)).alias("faults"))
         .write.format(fmt).partitionBy("bad").save(location))
        found = counted.get
        raw = StructType([f for f in RAW_FILMS])
        left = StructType([StructField("reason", StringType()), StructField("body", StringType()),
                           StructField("faults", _parse_type(FAULTS))])
        run.put(C.RAW_FILMS_TABLE, f"{location}/bad=false", raw, found["good"], fmt)
        run.put(f"{C.RAW_FILMS_TABLE}_quarantine", f"{location}/bad=true", left, found["pages"], fmt)
        report.rows[C.RAW_FILMS_TABLE] = int(found["good"])
        report.quarantined = int(found["faults"])
    return report


def _parse_type(ddl: str):
    return StructType.fromDDL(f"x {ddl}")["x"].dataType


def dictionary_job(
    spark: SparkSession,
    dictionary_pages: DataFrame,
    database: str = C.DATABASE,
    fmt: str = "parquet",
    draft: Draft | None = None,
) -> LayerReport:
    """Landed dictionary pages -> raw code table."""
    report = LayerReport(database)
    with _run(spark, database, draft) as run:
        report.rows[C.RAW_CODES_TABLE] = run.write(
            ingest_dictionary(dictionary_pages), C.RAW_CODES_TABLE, fmt)
    return report


def silver_job(
    spark: SparkSession,
    database: str = C.DATABASE,
    fmt: str = "parquet",
    unique_rows: bool = False,
    draft: Draft | None = None,
) -> LayerReport:
    """Raw film and code tables -> silver table (see :func:`silver`)."""
    report = LayerReport(database)
    with _run(spark, database, draft) as run:
        raw, codes = run.read(C.RAW_FILMS_TABLE), run.read(C.RAW_CODES_TABLE)
        report.rows[C.SILVER_TABLE] = run.write(silver(raw, codes, unique_rows), C.SILVER_TABLE, fmt)
    return report


def gold_job(
    spark: SparkSession,
    database: str = C.DATABASE,
    fmt: str = "parquet",
    draft: Draft | None = None,
) -> LayerReport:
    """Silver table -> ranking and trend tables, published together."""
    report = LayerReport(database)
    with _run(spark, database, draft) as run:
        stored = run.read(C.SILVER_TABLE)
        report.rows[C.RANKING_TABLE] = run.write(gold_ranking(stored), C.RANKING_TABLE, fmt)
        report.rows[C.TREND_TABLE] = run.write(gold_trend(stored), C.TREND_TABLE, fmt)
    return report


def run_layers(
    spark: SparkSession,
    film_pages: DataFrame,
    dictionary_pages: DataFrame,
    database: str = C.DATABASE,
    location: str | None = None,
    fmt: str = "parquet",
    bad_pages: str = "fail",
    unique_rows: bool = False,
) -> LayerReport:
    """The four jobs in order: five tables, each overwritten, each layer reading
    the versions of the one before. All of them become visible as one release
    when the last is written; a run that fails on the way changes nothing. See
    :func:`films_job` for ``bad_pages``."""
    _check_bad_pages(bad_pages, fmt)
    ensure_database(spark, database, location)
    with Draft(spark, database) as run:
        report = films_job(spark, film_pages, database, fmt, bad_pages, run)
        report.rows.update(dictionary_job(spark, dictionary_pages, database, fmt, run).rows)
        report.rows.update(silver_job(spark, database, fmt, unique_rows, run).rows)
        report.rows.update(gold_job(spark, database, fmt, run).rows)
        run.publish()
    return report
