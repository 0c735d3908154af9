"""strata: layered catalogue analytics on Spark DataFrames.

Landed JSON pages and a code dictionary become typed raw tables; a clean and
resolve step gives the silver table; the gold layer ranks and summarises.
Every step is a ``DataFrame -> DataFrame`` function over built-in Catalyst
expressions.
"""

from strata.operators import (
    clean,
    discover,
    global_rank,
    profile_range,
    resolve_codes,
    resolve_codes_by_position,
    tenure_columns,
    top_ranked,
    yearly_trend,
)
from strata.plans import (
    dictionary_job,
    films_job,
    gold_job,
    gold_ranking,
    gold_top,
    gold_trend,
    run_layers,
    silver,
    silver_job,
)
from strata.session import build_session, checkpoint_dir
from strata.sources import ingest_dictionary, ingest_films, read_landed_pages, write_table

__all__ = [
    "build_session",
    "checkpoint_dir",
    "clean",
    "dictionary_job",
    "discover",
    "films_job",
    "global_rank",
    "gold_job",
    "gold_ranking",
    "gold_top",
    "gold_trend",
    "ingest_dictionary",
    "ingest_films",
    "profile_range",
    "read_landed_pages",
    "resolve_codes",
    "resolve_codes_by_position",
    "run_layers",
    "silver",
    "silver_job",
    "tenure_columns",
    "top_ranked",
    "write_table",
    "yearly_trend",
]
