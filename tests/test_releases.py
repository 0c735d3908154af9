"""Releases: all tables of a run at once, whatever step a run stops at."""

import pytest

import strata.sources.releases as R
from strata.session import scratch_path
from strata.sources import (
    Draft,
    audit,
    current_release,
    ensure_database,
    expire,
    read_released,
    sync_catalogue,
    write_table,
)
from strata.sources.files import Folder

TABLES = ("raw", "silver", "gold")


@pytest.fixture
def database(spark):
    location = scratch_path(spark, "releases")
    name = "rel_" + location.rsplit("-", 1)[-1]
    ensure_database(spark, name, location)
    return name


def run(spark, database, n, publish=True, columns=("id",)):
    """One run of three tables whose rows all say ``n``."""
    draft = Draft(spark, database)
    frame = spark.range(n)
    for c in columns[1:]:
        frame = frame.withColumn(c, frame["id"] * 2)
    draft.write(frame, "raw")
    draft.write(draft.read("raw"), "silver")
    draft.write(draft.read("silver"), "gold")
    if publish:
        draft.publish()
    return draft


def released(spark, database):
    return [df.count() for df in read_released(spark, database, *TABLES)]


def catalogued(spark, database):
    return [spark.table(f"{database}.{t}").count() for t in TABLES]


def test_each_layer_reads_its_own_run_and_all_appear_together(spark, database):
    run(spark, database, 3)
    assert released(spark, database) == catalogued(spark, database) == [3, 3, 3]
    draft = run(spark, database, 5, publish=False)
    assert released(spark, database) == catalogued(spark, database) == [3, 3, 3]
    draft.publish()
    assert released(spark, database) == catalogued(spark, database) == [5, 5, 5]
    assert current_release(spark, database).number == 2


class Stopped(Exception):
    pass


@pytest.mark.parametrize("columns", [("id",), ("id", "more")])
def test_a_run_that_stops_at_any_step_of_the_catalogue(spark, database, monkeypatch, columns):
    """Stops before each catalogue statement in turn: readers of the release see
    one run, and the next run's start brings the catalogue up to it."""
    run(spark, database, 3)
    statements = 0
    real = R._sql
    for stop_at in range(100):
        done = 0

        def limited(session, statement):
            nonlocal done
            if done == stop_at:
                raise Stopped(statement)
            done += 1
            real(session, statement)

        n = 10 + stop_at
        new_columns = columns if stop_at % 2 == 0 else ("id",)
        draft = run(spark, database, n, publish=False, columns=new_columns)
        with monkeypatch.context() as patched:
            patched.setattr(R, "_sql", limited)
            try:
                draft.publish()
                stopped = False
            except Stopped:
                stopped = True
        assert released(spark, database) == [n, n, n]
        sync_catalogue(spark, database)
        assert catalogued(spark, database) == [n, n, n]
        assert all(spark.table(f"{database}.{t}").columns == list(new_columns) for t in TABLES)
        assert sorted(t.name for t in spark.catalog.listTables(database)) == sorted(TABLES)
        if not stopped:
            statements = done
            break
    assert statements >= len(TABLES)


def test_a_run_that_stops_before_the_rename_changes_nothing(spark, database, monkeypatch):
    run(spark, database, 3)
    draft = run(spark, database, 9, publish=False)
    with monkeypatch.context() as patched:
        patched.setattr(Folder, "create", lambda *a: (_ for _ in ()).throw(Stopped()))
        with pytest.raises(Stopped):
            draft.publish()
    assert released(spark, database) == catalogued(spark, database) == [3, 3, 3]
    with pytest.raises(ZeroDivisionError):
        with Draft(spark, database) as failing:
            failing.write(spark.range(4), "raw")
            folder = failing.location("raw")
            raise ZeroDivisionError
    assert Folder(spark, folder).names() == [] and released(spark, database) == [3, 3, 3]


def test_two_runs_at_once(spark, database):
    run(spark, database, 3)
    first, second = run(spark, database, 4, publish=False), run(spark, database, 5, publish=False)
    other = Draft(spark, database)
    other.write(spark.range(8), "aside")
    first.publish()
    with pytest.raises(RuntimeError, match="meanwhile"):
        second.publish()
    other.publish()                                     # no table in common
    assert released(spark, database) == [4, 4, 4]
    assert read_released(spark, database, "aside")[0].count() == 8


def test_a_managed_table_keeps_its_data_until_the_new_entry_stands(spark, database, monkeypatch):
    real = R._sql
    for stop_at in range(4):
        name = f"{database}.managed{stop_at}"
        spark.range(6).write.saveAsTable(name)
        done = 0

        def limited(session, statement):
            nonlocal done
            if done == stop_at:
                raise Stopped
            done += 1
            real(session, statement)

        with monkeypatch.context() as patched:
            patched.setattr(R, "_sql", limited)
            with pytest.raises(Stopped):
                write_table(spark.range(2), name)
        assert read_released(spark, database, f"managed{stop_at}")[0].count() == 2
        entries = [t.name for t in spark.catalog.listTables(database) if t.name.startswith(f"managed{stop_at}")]
        assert any(spark.table(f"{database}.{t}").count() == 6 for t in entries)
        sync_catalogue(spark, database)
        assert spark.table(name).count() == 2


def test_disk_after_ten_runs_is_that_of_two(spark, database):
    for n in range(1, 11):
        run(spark, database, n)
        root = Folder(spark, R.database_folder(spark, database))
        for t in TABLES:
            assert len(Folder(spark, f"{root.path}/{t}.versions").names()) == min(n, 2)
    assert released(spark, database) == [10, 10, 10]
    previous = R._load(R._releases(spark, database), 9)
    assert previous.read(spark, "gold").count() == 9    # for readers that started before
    assert audit(spark, database).count() == 30
    rows = {(r.release, r.table): r.rows for r in audit(spark, database).collect()}
    assert rows[4, "silver"] == 4 and rows[10, "gold"] == 10


def test_retention_spares_runs_in_progress_and_ends_dead_ones(spark, database):
    run(spark, database, 3)
    running = run(spark, database, 7, publish=False)
    for n in (4, 5, 6):
        write_table(spark.range(n), f"{database}.other")
    assert running.written["raw"].read(spark).count() == 7
    assert expire(spark, database) == []
    gone = expire(spark, database, abandoned_s=-1)
    assert sorted(gone) == sorted(running.location(t) for t in TABLES)
    assert released(spark, database) == [3, 3, 3]


def test_partitions_formats_and_other_tables(spark, database):
    parts = spark.range(6).selectExpr("id", "id % 2 as p")
    with Draft(spark, database) as draft:
        assert draft.write(parts, "parts", partition_by=["p"]) == 6
        draft.write(spark.range(4), "lines", fmt="orc")
        draft.publish()
    assert spark.table(f"{database}.parts").where("p = 1").count() == 3
    by_part, lines = read_released(spark, database, "parts", "lines")
    assert by_part.where("p = 0").count() == 3 and lines.count() == 4
    spark.range(2).write.saveAsTable(f"{database}.foreign")
    assert read_released(spark, database, "foreign")[0].count() == 2
