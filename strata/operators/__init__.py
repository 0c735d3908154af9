"""DataFrame -> DataFrame operators of the catalogue layers."""

from strata.operators.audit import (
    footer_plan,
    observed_counts,
    profile_files,
    profile_range,
    profile_table,
    stage_counts,
)
from strata.operators.clean import clean
from strata.operators.codes import resolve_codes, resolve_codes_by_position
from strata.operators.derive import tenure_columns
from strata.operators.joins import fits, sized_broadcast
from strata.operators.rank import global_rank, rank_window, top_n, top_ranked
from strata.operators.select import discover
from strata.operators.trend import yearly_trend

__all__ = [
    "clean",
    "discover",
    "fits",
    "footer_plan",
    "global_rank",
    "observed_counts",
    "profile_files",
    "profile_range",
    "profile_table",
    "rank_window",
    "resolve_codes",
    "resolve_codes_by_position",
    "sized_broadcast",
    "stage_counts",
    "tenure_columns",
    "top_n",
    "top_ranked",
    "yearly_trend",
]
