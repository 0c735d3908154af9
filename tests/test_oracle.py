"""Every registered query equals its SQL twin (DuckDB) on the smallest tables."""

import os
import re

import pytest

import __spark_entry__ as entry
from oracle import compare, duck

# ORACLE_SF=/root/testdata/sf0.01 runs the check at the driver's scale.
SF = os.environ.get("ORACLE_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_twin():
    # the training-data operators (op<N>_..., pipeline) have tests of their own
    own = {n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n)}
    assert own == {n for n in entry.oracle_sql() if not re.match(r"op\d+_|pipeline$", n)}


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql_twin(spark, con, name):
    df = entry.queries()[name](spark, SF)
    ok, message = compare(df, con, entry.oracle_sql()[name])
    assert ok, message


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["ranking", "titulo", "titulo_original", "anio_estreno", "generos",
                          "popularidad", "valoracion_media", "num_votos"]
    assert df.count() > 0
