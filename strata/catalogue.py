"""The film-catalogue binding: names and constants of the layered catalogue.

The operators in ``strata.operators`` take column names as parameters; this
module supplies the ones the catalogue uses, so that output tables keep the
same names, types and thresholds.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# These must stay as they are for results to match.
# ---------------------------------------------------------------------------
DATABASE = "etl_cine"
RAW_FILMS_TABLE = "peliculas_italianas_raw"
RAW_CODES_TABLE = "generos_raw"
SILVER_TABLE = "peliculas_italianas_silver"
RANKING_TABLE = "gold_ranking_popularidad"
TREND_TABLE = "gold_evolucion_por_anio"

MIN_VOTES = 10            # films with fewer votes are dropped by the clean step
PAGE_SIZE = 20            # films per result page
NUM_PAGES = 10            # pages taken by the catalogue selection
NAME_SEPARATOR = ", "     # between resolved genre names
CODE_SEPARATOR = ","      # between genre codes in the raw table
DATE_FORMAT = "yyyy-MM-dd"
ROUND_DIGITS = 2          # popularity and rating in silver; trend means
VOTES_DIGITS = 0          # mean votes in the trend
YEARS_DIGITS = 1          # years of service in the tenure derivation
DAYS_PER_YEAR = 365
MONTHS_PER_YEAR = 12

# Raw film columns, in table order.
FILM_ID = "pelicula_id"
TITLE = "titulo"
ORIGINAL_TITLE = "titulo_original"
RELEASE_DATE = "fecha_estreno"
RELEASE_YEAR = "anio_estreno"
POPULARITY = "popularidad"
RATING = "valoracion_media"
VOTES = "num_votos"
LANGUAGE = "idioma_original"
OVERVIEW = "descripcion"
CODES = "genero_ids"

# Code dictionary columns.
CODE_ID = "genero_id"
CODE_NAME = "genero_nombre"

# Derived columns.
NAMES = "generos"
RANK = "ranking"
FILM_COUNT = "num_peliculas"
MEAN_POPULARITY = "popularidad_media"
MEAN_VOTES = "votos_medios"

# The ten film columns that survive code resolution (the regroup key).
SILVER_KEY = (
    FILM_ID, TITLE, ORIGINAL_TITLE, RELEASE_DATE, RELEASE_YEAR,
    POPULARITY, RATING, VOTES, LANGUAGE, OVERVIEW,
)

# Gold ranking projection, in table order.
RANKING_COLUMNS = (
    RANK, TITLE, ORIGINAL_TITLE, RELEASE_YEAR, NAMES, POPULARITY, RATING, VOTES,
)

# JSON field of a result element -> raw column: (field, column, kind, default
# used when the field is missing). Kinds: text, double, int, list.
PAGE_FIELDS = (
    ("id", FILM_ID, "text", ""),
    ("title", TITLE, "text", ""),
    ("original_title", ORIGINAL_TITLE, "text", ""),
    ("release_date", RELEASE_DATE, "text", ""),
    ("popularity", POPULARITY, "double", 0.0),
    ("vote_average", RATING, "double", 0.0),
    ("vote_count", VOTES, "int", 0),
    ("original_language", LANGUAGE, "text", ""),
    ("overview", OVERVIEW, "text", ""),
    ("genre_ids", CODES, "list", ""),
)
RESULTS_FIELD = "results"
DICTIONARY_FIELD = "genres"
DICTIONARY_ID_FIELD = "id"
DICTIONARY_NAME_FIELD = "name"

# Employee table of the tenure derivation.
EMPLOYEE_ID = "EmpleadoID"
HIRE_DATE = "FechaAlta"
SALARY = "Salario"
DEPARTMENT = "Departamento"
HIRE_YEAR = "AnioAlta"
HIRE_MONTH = "MesAlta"
DAYS_EMPLOYED = "DiasEnEmpresa"
YEARS_EMPLOYED = "AniosEnEmpresa"
ANNUAL_SALARY = "SalarioAnual"
