"""Composite plans: the silver and gold layers and the layered run."""

from strata.plans.layers import (
    LayerReport,
    dictionary_job,
    films_job,
    gold_job,
    gold_ranking,
    gold_top,
    gold_trend,
    preview,
    ranking_order,
    run_layers,
    silver,
    silver_job,
    sorted_ranking,
    sorted_trend,
    trend_preview,
)

__all__ = [
    "LayerReport",
    "dictionary_job",
    "films_job",
    "gold_job",
    "gold_ranking",
    "gold_top",
    "gold_trend",
    "preview",
    "ranking_order",
    "run_layers",
    "silver",
    "silver_job",
    "sorted_ranking",
    "sorted_trend",
    "trend_preview",
]
