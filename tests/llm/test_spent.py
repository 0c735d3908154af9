"""Intermediate folders go, results stay."""

import pytest

from strata.llm.common import spent, stage
from strata.sources.files import Folder


def names(spark, df):
    return Folder(spark, df.staged_at).names()


def test_spent_folders_go_and_kept_ones_stay(spark):
    outside = stage(spark, spark.range(2), "outside")
    with spent(spark) as keep:
        first = stage(spark, spark.range(5), "first")
        with spent(spark) as inner:
            second = inner(stage(spark, first.where("id > 1"), "second"))
            third = stage(spark, second, "third")
        assert names(spark, third) == [] and second.count() == 3
        last = keep(stage(spark, second.where("id > 2"), "last"))
    assert last.count() == 2 and outside.count() == 2
    assert names(spark, first) == [] and names(spark, second) == []


def test_folders_go_when_a_job_fails(spark):
    with pytest.raises(ZeroDivisionError):
        with spent(spark):
            made = stage(spark, spark.range(3), "made")
            raise ZeroDivisionError
    assert names(spark, made) == []
