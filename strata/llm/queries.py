"""Registered queries of the subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm.bottom_k import op8_bottom_k
from strata.llm.byte_bpe import op10_byte_bpe
from strata.llm.graph_ann import op4_graph_ann
from strata.llm.html_extract import op5_html_extract
from strata.llm.license_scan import op6_license_scan
from strata.llm.line_dedup import op7_line_dedup
from strata.llm.mixing import op3_mixing
from strata.llm.packing import op13_packing
from strata.llm.repair import op12_repair
from strata.llm.simhash import op2_simhash
from strata.llm.spelling import op11_spelling
from strata.llm.toxicity import op9_toxicity
from strata.llm.wavelet import op1_wavelet_tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_wavelet_tokens": op1_wavelet_tokens,
    "op2_simhash": op2_simhash,
    "op3_mixing": op3_mixing,
    "op4_graph_ann": op4_graph_ann,
    "op5_html_extract": op5_html_extract,
    "op6_license_scan": op6_license_scan,
    "op7_line_dedup": op7_line_dedup,
    "op8_bottom_k": op8_bottom_k,
    "op9_toxicity": op9_toxicity,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_spelling": op11_spelling,
    "op12_repair": op12_repair,
    "op13_packing": op13_packing,
}

ORACLE_SQL: dict[str, str] = {}
