"""


Every query reads whole driver tables (catalogue-shaped inputs are derived
from them in ``strata.sources.fixtures``; the SQL twins below derive the same
shapes independently).
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata import catalogue as C
from strata.operators import (
    clean,
    discover,
    global_rank,
    observed_counts,
    profile_files,
    profile_range,
    profile_table,
    resolve_codes,
    resolve_codes_by_position,
    tenure_columns,
)
from strata.plans import (
    films_job,
    gold_ranking,
    gold_top,
    gold_trend,
    run_layers,
    silver,
    sorted_ranking,
    sorted_trend,
    trend_preview,
)
from strata.session import checkpoint_dir, scratch_path
from strata.sources import (
    DriverTables,
    audit,
    ensure_database,
    ingest_dictionary,
    ingest_films,
    write_table,
)

SMOKE_DIR = "/root/testdata/sf0.001"
DISCOVER_LANGUAGE = "es"
TENURE_AS_OF = "2002-01-01"
PREVIEW_ROWS = 10
TREND_PREVIEW_YEARS = 20


def _tables(spark: SparkSession, sf_dir: str) -> DriverTables:
    checkpoint_dir(spark)
    return DriverTables(spark, sf_dir)


def _silver(t: DriverTables) -> DataFrame:
    return silver(t.raw_catalog(), t.code_dictionary())


# ---------------------------------------------------------------------------
# Queries, one per operator
# ---------------------------------------------------------------------------

def q_discover_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    flagged = t.labels.filter(F.col("toxic") == 1).select("doc_id")
    docs = t.documents.select("doc_id", "lang", "source", "n_chars")
    return discover(docs, "lang", DISCOVER_LANGUAGE, "n_chars", "doc_id",
                    num_pages=C.NUM_PAGES, page_size=C.PAGE_SIZE, exclude=flagged)


def q_ingest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_films(_tables(spark, sf_dir).film_pages())


def q_ingest_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_dictionary(_tables(spark, sf_dir).dictionary_pages())


def q_clean_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(_tables(spark, sf_dir).raw_catalog())


def q_resolve_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return resolve_codes(t.raw_catalog(), t.code_dictionary())


def q_resolve_codes_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return resolve_codes_by_position(t.raw_catalog(), t.code_dictionary())


def q_silver_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(_tables(spark, sf_dir))


def q_silver_catalog_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver with the shuffle-free resolution (film ids are unique here)."""
    t = _tables(spark, sf_dir)
    return silver(t.raw_catalog(), t.code_dictionary(), unique_rows=True)


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh scratch folder and read back."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def q_gold_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked over a stored silver, as the gold job does."""
    return gold_ranking(_stored(spark, _silver(_tables(spark, sf_dir)), "silver"))


def q_gold_ranking_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rank over a silver that is not stored: its window sums run inside
    value ranges, never over the whole table in one task."""
    return gold_ranking(_silver(_tables(spark, sf_dir)))


def q_sorted_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sorted_ranking(q_gold_ranking(spark, sf_dir))


def q_sorted_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sorted_trend(q_gold_trend_by_year(spark, sf_dir))


def q_rank_lineitem_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The global rank (C7, distributed) over the largest driver table: every
    """
    rows = _tables(spark, sf_dir).table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice")
    return global_rank(rows, "l_extendedprice", C.RANK)


def q_gold_trend_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_trend(_silver(_tables(spark, sf_dir)))


def q_trend_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend_preview(gold_trend(_silver(_tables(spark, sf_dir))), TREND_PREVIEW_YEARS)


def q_profile_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_range(_tables(spark, sf_dir).raw_catalog(), C.RELEASE_YEAR)


def q_tenure_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tenure_columns(_tables(spark, sf_dir).employees(), as_of=TENURE_AS_OF)


def q_top_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_top(_silver(_tables(spark, sf_dir)), PREVIEW_ROWS)


def q_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts observed by the writes: raw and clean in one job, then silver,
    ranking and trend, each by its own."""
    t = _tables(spark, sf_dir)
    raw, cleaned, resolved, ranked, trend = (Observation() for _ in range(5))
    one = F.count(F.lit(1)).alias("rows")
    kept = _stored(spark, clean(t.raw_catalog().observe(raw, one)).observe(cleaned, one), "clean")
    films = _stored(spark, resolve_codes(kept, t.code_dictionary()).observe(resolved, one), "silver")
    _stored(spark, gold_ranking(films).observe(ranked, one), "ranking")
    _stored(spark, gold_trend(films).observe(trend, one), "trend")
    return observed_counts(spark, {
        "raw": raw.get["rows"], "clean": cleaned.get["rows"], "silver": resolved.get["rows"],
        "gold_ranking": ranked.get["rows"], "gold_trend": trend.get["rows"]})


def _fresh_database(spark: SparkSession) -> tuple[str, str]:
    """Name and location of a database of its own below the shared folder."""
    location = scratch_path(spark, C.DATABASE)
    return f"{C.DATABASE}_{location.rsplit('-', 1)[-1]}", location


def _read_and_drop(spark: SparkSession, database: str, *tables: str) -> list[DataFrame]:
    """Copies of the stored tables in scratch folders; their database goes
    (with its folder, where the catalogue deletes that)."""
    out = [_stored(spark, spark.table(f"{database}.{name}"), name) for name in tables]
    spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return out


def _layered(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    database, location = _fresh_database(spark)
    run_layers(spark, t.film_pages(), t.dictionary_pages(), database=database, location=location)
    return _read_and_drop(spark, database, table)[0]


def q_layered_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full run into a fresh database under the shared checkpoint folder;
    returns the trend table as read back from storage."""
    return _layered(spark, sf_dir, C.TREND_TABLE)


def q_layered_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw film table as a full run stores it."""
    return _layered(spark, sf_dir, C.RAW_FILMS_TABLE)


def q_layered_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table as a full run stores it."""
    return _layered(spark, sf_dir, C.SILVER_TABLE)


def q_layered_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking table as a full run stores it."""
    return _layered(spark, sf_dir, C.RANKING_TABLE)


def q_layered_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each table of a full run, as its release keeps them."""
    t = _tables(spark, sf_dir)
    database, location = _fresh_database(spark)
    run_layers(spark, t.film_pages(), t.dictionary_pages(), database=database, location=location)
    kept = _stored(spark, audit(spark, database).select("table", "rows"), "audit")
    spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return kept


def q_profile_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile as SQL text over a stored catalogue table."""
    t = _tables(spark, sf_dir)
    database, location = _fresh_database(spark)
    ensure_database(spark, database, location)
    name = f"{database}.{C.RAW_FILMS_TABLE}"
    write_table(t.raw_catalog(), name)
    row = profile_table(spark, name, C.RELEASE_YEAR)
    out = spark.createDataFrame(row.collect(), row.schema)      # one row
    spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return out


def q_profile_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of stored files from the statistics in their footers."""
    path = scratch_path(spark, "profiled")
    _tables(spark, sf_dir).raw_catalog().write.parquet(path)
    return profile_files(spark, path, C.RELEASE_YEAR)


def _damaged_pages(t: DriverTables) -> DataFrame:
    """The film pages, some cut off, without a list of results or no object,
    and some with elements of null id, without a readable number, text or list,
    or that are no objects."""
    page = F.expr("cast(get_json_object(body, '$.page') as long)")
    body = (F.when(page % 7 == 0, F.substring("body", 1, 40))
            .when(page % 11 == 0, F.regexp_replace("body", r'"results":\[.*\]', '"results":{"a":1}'))
            .when(page % 13 == 0, F.concat(F.lit("["), "body", F.lit("]")))
            .when(page % 5 == 0, F.regexp_replace("body", r'"id":(\d*0),', '"id":null,'))
            .when(page % 3 == 0, F.regexp_replace("body", r'"vote_count":(\d*1)\b', '"vote_count":"n/a"'))
            .when(page % 17 == 0, F.regexp_replace("body", r'"id":(\d*2),', '"id":{"n":$1},'))
            .when(page % 2 == 0, F.regexp_replace("body", r'"genre_ids":\[(\d*4),', '"genre_ids":[{"n":$1},'))
            .when(page % 19 == 0, F.regexp_replace("body", r'"results":\[', '"results":[null,5,'))
            .otherwise(F.col("body")))
    return t.film_pages().select(body.alias("body"))


def q_quarantine_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Films that load from damaged pages, and what is put aside by reason:
    pages that cannot be read, and elements of pages that can."""
    t = _tables(spark, sf_dir)
    database, location = _fresh_database(spark)
    ensure_database(spark, database, location)
    films_job(spark, _damaged_pages(t), database, bad_pages="quarantine")
    good, bad = _read_and_drop(spark, database, C.RAW_FILMS_TABLE, C.RAW_FILMS_TABLE + "_quarantine")
    none = F.lit(None).cast("string")
    return (good.select(F.lit("loaded").alias("outcome"), C.FILM_ID)
            .union(bad.where("reason is not null").select("reason", none))
            .union(bad.select(F.explode("faults").alias("fault")).select("fault.reason", none))
            .groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"),
                                    F.countDistinct(C.FILM_ID).alias("films")))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "discover_pages": q_discover_pages,
    "ingest_pages": q_ingest_pages,
    "ingest_dictionary": q_ingest_dictionary,
    "clean_catalog": q_clean_catalog,
    "resolve_codes": q_resolve_codes,
    "resolve_codes_by_position": q_resolve_codes_by_position,
    "silver_catalog": q_silver_catalog,
    "silver_catalog_unique": q_silver_catalog_unique,
    "gold_ranking": q_gold_ranking,
    "gold_ranking_window": q_gold_ranking_window,
    "sorted_ranking": q_sorted_ranking,
    "sorted_trend": q_sorted_trend,
    "rank_lineitem_price": q_rank_lineitem_price,
    "gold_trend_by_year": q_gold_trend_by_year,
    "trend_preview": q_trend_preview,
    "profile_range": q_profile_range,
    "profile_stored": q_profile_stored,
    "profile_footers": q_profile_footers,
    "quarantine_films": q_quarantine_films,
    "tenure_columns": q_tenure_columns,
    "top_ranked": q_top_ranked,
    "stage_counts": q_stage_counts,
    "layered_run": q_layered_run,
    "layered_raw": q_layered_raw,
    "layered_silver": q_layered_silver,
    "layered_ranking": q_layered_ranking,
    "layered_audit": q_layered_audit,
}


# ---------------------------------------------------------------------------
# SQL twins (DuckDB)
# ---------------------------------------------------------------------------

_RAW_CATALOG = """
raw_catalog AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS pelicula_id,
         concat('  Order ', CAST(o_orderkey % 500 AS VARCHAR), ' ') AS titulo,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE concat(' ', o_orderstatus) END
           AS titulo_original,
         CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END
           AS fecha_estreno,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END
           AS anio_estreno,
         o_totalprice / 7 AS popularidad,
         (o_orderkey % 701) / 70.0::DOUBLE AS valoracion_media,
         CAST(o_orderkey % 100 AS INTEGER) AS num_votos,
         o_orderstatus AS idioma_original,
         o_orderpriority AS descripcion,
         concat_ws(',', CAST(o_custkey % 25 AS VARCHAR), CAST(o_orderkey % 30 AS VARCHAR),
                   CAST((o_orderkey * 7) % 25 AS VARCHAR)) AS genero_ids
  FROM orders)"""

_INGESTED_RAW = """
raw_catalog AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS pelicula_id,
         CASE WHEN o_orderkey % 17 = 0 THEN ''
              WHEN o_orderkey % 19 = 0 THEN NULL
              ELSE concat('  Order ', CAST(o_orderkey % 500 AS VARCHAR), ' ') END AS titulo,
         concat(' ', o_orderstatus) AS titulo_original,
         CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END
           AS fecha_estreno,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END
           AS anio_estreno,
         CASE WHEN o_orderkey % 23 = 0 THEN 0.0::DOUBLE ELSE o_totalprice / 7 END AS popularidad,
         (o_orderkey % 701) / 70.0::DOUBLE AS valoracion_media,
         CAST(o_orderkey % 100 AS INTEGER) AS num_votos,
         o_orderstatus AS idioma_original,
         o_orderpriority AS descripcion,
         CASE WHEN o_orderkey % 31 = 0 OR o_orderkey % 29 = 0 THEN ''
              ELSE concat_ws(',', CAST(o_custkey % 25 AS VARCHAR), CAST(o_orderkey % 30 AS VARCHAR),
                             CAST((o_orderkey * 7) % 25 AS VARCHAR)) END AS genero_ids
  FROM orders)"""

_CODE_DICT = """
code_dict AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS genero_id, n_name AS genero_nombre FROM nation)"""

_CLEAN = """
clean_catalog AS (
  SELECT pelicula_id, trim(titulo) AS titulo, trim(titulo_original) AS titulo_original,
         CAST(try_strptime(fecha_estreno, '%Y-%m-%d') AS DATE) AS fecha_estreno,
         anio_estreno, round(popularidad, 2) AS popularidad,
         round(valoracion_media, 2) AS valoracion_media, num_votos, idioma_original,
         descripcion, genero_ids
  FROM raw_catalog
  WHERE anio_estreno IS NOT NULL AND titulo IS NOT NULL AND num_votos >= 10)"""

_KEY = ("pelicula_id, titulo, titulo_original, fecha_estreno, anio_estreno, popularidad, "
        "valoracion_media, num_votos, idioma_original, descripcion")


def _resolved(name: str, source: str) -> str:
    return f"""
{name}_codes AS (
  SELECT {_KEY}, code, pos FROM (
    SELECT {_KEY}, unnest(string_split(genero_ids, ',')) AS code,
           generate_subscripts(string_split(genero_ids, ','), 1) AS pos
    FROM {source})),
{name} AS (
  SELECT {', '.join('e.' + c for c in _KEY.split(', '))},
         coalesce(string_agg(d.genero_nombre, ', ' ORDER BY e.pos, d.genero_nombre), '') AS generos
  FROM {name}_codes e LEFT JOIN code_dict d ON trim(e.code) = d.genero_id
  GROUP BY ALL)"""


_RANKING = """
ranking AS (
  SELECT CAST(rank() OVER (ORDER BY popularidad DESC NULLS LAST) AS BIGINT) AS ranking,
         titulo, titulo_original, anio_estreno, generos, popularidad, valoracion_media, num_votos
  FROM silver)"""

def _exact_mean(col: str, digits: int, value_digits: int) -> str:
    """Mean rounded half away from zero, in exact integer arithmetic."""
    unit, step = 10 ** value_digits, 10 ** (value_digits - digits)
    total = f"sum(CAST(round({col} * {unit}) AS HUGEINT))"
    n = f"count({col})"
    return (f"CAST(sign({total}) * ((2 * abs({total}) + {step} * {n}) // (2 * {step} * {n}))"
            f" AS DOUBLE) / {10 ** digits}")


_TREND = f"""
trend AS (
  SELECT anio_estreno, count(pelicula_id) AS num_peliculas,
         {_exact_mean('valoracion_media', 2, 2)} AS valoracion_media,
         {_exact_mean('popularidad', 2, 2)} AS popularidad_media,
         {_exact_mean('num_votos', 0, 0)} AS votos_medios
  FROM silver GROUP BY anio_estreno)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


_SILVER_CHAIN = (_RAW_CATALOG, _CODE_DICT, _CLEAN, _resolved("silver", "clean_catalog"))
_LAYERED = (_INGESTED_RAW, _CODE_DICT, _CLEAN, _resolved("silver", "clean_catalog"))

_ORACLE = {
    "discover_pages": """
SELECT doc_id, lang, source, n_chars, CAST(position AS INTEGER) AS position,
       CAST((position - 1) // 20 + 1 AS INTEGER) AS page
FROM (
  SELECT doc_id, lang, source, n_chars,
         row_number() OVER (ORDER BY n_chars DESC NULLS LAST, doc_id ASC NULLS LAST) AS position
  FROM documents d
  WHERE lang = 'es'
    AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1))
WHERE position <= 200""",
    "ingest_pages": _with(_INGESTED_RAW) + "SELECT * FROM raw_catalog",
    "ingest_dictionary": _with(_CODE_DICT) + "SELECT * FROM code_dict",
    "clean_catalog": _with(_RAW_CATALOG, _CLEAN) + "SELECT * FROM clean_catalog",
    "resolve_codes": _with(_RAW_CATALOG, _CODE_DICT, _resolved("resolved", "raw_catalog"))
    + "SELECT * FROM resolved",
    # film ids are unique in the fixture, so both resolution forms agree
    "resolve_codes_by_position": _with(_RAW_CATALOG, _CODE_DICT, _resolved("resolved", "raw_catalog"))
    + "SELECT * FROM resolved",
    "silver_catalog": _with(*_SILVER_CHAIN) + "SELECT * FROM silver",
    "silver_catalog_unique": _with(*_SILVER_CHAIN) + "SELECT * FROM silver",
    "gold_ranking": _with(*_SILVER_CHAIN, _RANKING) + "SELECT * FROM ranking",
    "gold_ranking_window": _with(*_SILVER_CHAIN, _RANKING) + "SELECT * FROM ranking",
    "rank_lineitem_price": """
SELECT l_orderkey, l_linenumber, l_extendedprice,
       CAST(rank() OVER (ORDER BY l_extendedprice DESC NULLS LAST) AS BIGINT) AS ranking
FROM lineitem""",
    "gold_trend_by_year": _with(*_SILVER_CHAIN, _TREND) + "SELECT * FROM trend",
    "trend_preview": _with(*_SILVER_CHAIN, _TREND)
    + "SELECT * FROM trend ORDER BY anio_estreno NULLS FIRST LIMIT 20",
    "profile_range": _with(_RAW_CATALOG) + """
SELECT count(*) AS row_count, min(anio_estreno) AS min_anio_estreno,
       max(anio_estreno) AS max_anio_estreno
FROM raw_catalog""",
    "tenure_columns": """
SELECT CAST(o_orderkey AS VARCHAR) AS EmpleadoID, upper(o_orderpriority) AS Departamento,
       CAST(o_orderdate AS DATE) AS FechaAlta, o_totalprice AS Salario,
       CAST(year(o_orderdate) AS INTEGER) AS AnioAlta,
       CAST(month(o_orderdate) AS INTEGER) AS MesAlta,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS INTEGER)
         AS DiasEnEmpresa,
       round(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') / 365, 1)
         AS AniosEnEmpresa,
       o_totalprice * 12 AS SalarioAnual
FROM orders""",
    "top_ranked": _with(*_SILVER_CHAIN, _RANKING) + """
SELECT * FROM ranking
ORDER BY ranking, titulo NULLS LAST, titulo_original NULLS LAST, anio_estreno NULLS LAST,
         generos NULLS LAST, popularidad NULLS LAST, valoracion_media NULLS LAST,
         num_votos NULLS LAST
LIMIT 10""",
    "stage_counts": _with(*_SILVER_CHAIN, _RANKING, _TREND) + """
SELECT 'raw' AS stage, count(*) AS rows FROM raw_catalog
UNION ALL SELECT 'clean', count(*) FROM clean_catalog
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'gold_ranking', count(*) FROM ranking
UNION ALL SELECT 'gold_trend', count(*) FROM trend""",
    "layered_audit": _with(*_LAYERED, _RANKING, _TREND) + """
SELECT 'peliculas_italianas_raw' AS "table", count(*) AS rows FROM raw_catalog
UNION ALL SELECT 'generos_raw', count(*) FROM code_dict
UNION ALL SELECT 'peliculas_italianas_silver', count(*) FROM silver
UNION ALL SELECT 'gold_ranking_popularidad', count(*) FROM ranking
UNION ALL SELECT 'gold_evolucion_por_anio', count(*) FROM trend""",
    "layered_run": _with(*_LAYERED, _TREND) + "SELECT * FROM trend",
    "layered_raw": _with(_INGESTED_RAW) + "SELECT * FROM raw_catalog",
    "layered_silver": _with(*_LAYERED) + "SELECT * FROM silver",
    "layered_ranking": _with(*_LAYERED, _RANKING) + "SELECT * FROM ranking",
    "quarantine_films": """
WITH films AS (
  SELECT o_orderkey AS id, o_orderkey // 20 + 1 AS page, o_orderkey % 100 AS votes,
         o_custkey % 25 AS code, o_orderkey % 31 = 0 OR o_orderkey % 29 = 0 AS no_codes
  FROM orders),
sorted AS (
  SELECT id, page,
         CASE WHEN page % 7 = 0 THEN 'page is not valid JSON'
              WHEN page % 11 = 0 THEN 'results field is not a list'
              WHEN page % 13 = 0 THEN 'page is not a JSON object'
              WHEN page % 5 = 0 THEN
                CASE WHEN id % 10 = 0 THEN 'element with a null id' ELSE 'loaded' END
              WHEN page % 3 = 0 THEN
                CASE WHEN votes % 10 = 1 THEN 'element with an unreadable number' ELSE 'loaded' END
              WHEN page % 17 = 0 THEN
                CASE WHEN id % 10 = 2 THEN 'element with an unreadable text' ELSE 'loaded' END
              WHEN page % 2 = 0 THEN
                CASE WHEN code % 10 = 4 AND NOT no_codes THEN 'element with an unreadable list'
                     ELSE 'loaded' END
              ELSE 'loaded' END AS outcome,
         page % 7 <> 0 AND page % 11 <> 0 AND page % 13 <> 0 AND page % 5 <> 0 AND page % 3 <> 0
           AND page % 17 <> 0 AND page % 2 <> 0 AND page % 19 = 0 AS padded
  FROM films)
SELECT outcome, CASE WHEN outcome LIKE 'page %' OR outcome LIKE 'results %'
                     THEN count(DISTINCT page) ELSE count(*) END AS rows,
       CASE WHEN outcome = 'loaded' THEN count(DISTINCT id) ELSE 0 END AS films
FROM sorted GROUP BY outcome
UNION ALL
SELECT 'element is not an object', 2 * count(DISTINCT page), 0
FROM sorted WHERE padded HAVING count(*) > 0""",
}
_ORACLE["sorted_ranking"] = _ORACLE["gold_ranking"]
_ORACLE["sorted_trend"] = _ORACLE["gold_trend_by_year"]
_ORACLE["profile_stored"] = _ORACLE["profile_range"]
_ORACLE["profile_footers"] = _ORACLE["profile_range"]


# ---------------------------------------------------------------------------
# Training-data operators: present only where their subpackage is installed
# ---------------------------------------------------------------------------

def _optional(name: str):
    """The module, or None where it (not something it needs) is absent."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as missing:
        if missing.name is None or not (name == missing.name or name.startswith(missing.name + ".")):
            raise
        return None


if (_llm := _optional("strata.llm.queries")) is not None:
    _QUERIES |= _llm.QUERIES
    _ORACLE |= _llm.ORACLE_SQL
    if (_pipeline := _optional("corpus_pipeline")) is not None:
        _QUERIES["pipeline"] = _pipeline.run
        if _pipeline.ORACLE_SQL:
            _ORACLE["pipeline"] = _pipeline.ORACLE_SQL


# ---------------------------------------------------------------------------
# Contract
# ---------------------------------------------------------------------------

def entry(spark: SparkSession) -> DataFrame:
    """
    the silver layer, ranked without a single-task window."""
    return q_gold_ranking(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """DuckDB twin of each query (same column names and types)."""
    return dict(_ORACLE)
