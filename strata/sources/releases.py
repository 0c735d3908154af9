"""Publishing several tables at once.

Tables of a database live in version folders, ``<table>.versions/<run>``. A
*release* names one version of each table. It is a small file,
``_releases/release-<number>.json``, that appears by one rename: readers that go
by the newest release see either all tables of a run or none of them, never new
silver beside old gold. Releases are never changed, so they are also the audit
of every write: run, table, version and the rows that the write observed.

A run works on a :class:`Draft`: it writes new versions and reads its own
versions first, then those of the release that it started from. ``publish``
makes them the next release (of two runs that changed or read the same table the
later one fails), points the catalogue's entries at them one by one, and removes
what no kept release names. A run that stops before the rename leaves nothing
that a reader sees; one that stops after it has published, and the next
:func:`sync_catalogue` (every draft begins with one) finishes the entries.

The store's rename of a file must be atomic and must not replace a file (HDFS and
most stores with folders; on others put a lock around ``publish``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.sources.files import Folder

#: Releases whose versions stay: the newest, and the one before for its readers.
KEEP_RELEASES = 2
#: After so many seconds without an end a run counts as dead; its folders go.
ABANDONED_S = 7 * 24 * 3600
_DIGITS = 12


@dataclass(frozen=True)
class Version:
    """One version of a table: where its files are and how to read them."""

    location: str
    schema: str                  # as JSON
    rows: int
    run: str
    fmt: str = "parquet"
    partition_by: tuple[str, ...] = ()

    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.struct()).format(self.fmt).load(self.location)


@dataclass(frozen=True)
class Release:
    number: int = 0
    run: str = ""
    tables: Mapping[str, Version] = field(default_factory=dict)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """The table as of this release."""
        return self.tables[table].read(spark)


def database_folder(spark: SparkSession, database: str | None) -> str:
    name = database or spark.catalog.currentDatabase()
    return spark.catalog.getDatabase(name).locationUri.rstrip("/")


def _releases(spark: SparkSession, database: str | None) -> Folder:
    return Folder(spark, f"{database_folder(spark, database)}/_releases")


def _numbers(folder: Folder) -> list[int]:
    return [int(n[8:8 + _DIGITS]) for n in folder.names()
            if n.startswith("release-") and n.endswith(".json")]


def _load(folder: Folder, number: int) -> Release:
    stored = json.loads(folder.read(f"release-{number:0{_DIGITS}d}.json"))
    return Release(number, stored["run"], {
        name: Version(**{**v, "partition_by": tuple(v["partition_by"])})
        for name, v in stored["tables"].items()})


def current_release(spark: SparkSession, database: str | None) -> Release:
    """The newest release of a database; without any, an empty one."""
    folder = _releases(spark, database)
    numbers = _numbers(folder)
    return _load(folder, max(numbers)) if numbers else Release()


def read_released(spark: SparkSession, database: str | None, *tables: str) -> list[DataFrame]:
    """Several tables as of one release. A table that no release names is read
    from the catalogue."""
    release = current_release(spark, database)
    return [release.read(spark, t) if t in release.tables else
            spark.table(f"{database}.{t}" if database else t) for t in tables]


AUDIT_SCHEMA = "release long, run string, table string, version string, rows long"


def audit(spark: SparkSession, database: str | None) -> DataFrame:
    """Every write of every release, in no order: the release, the run, the
    table, its version folder and the rows that the writing job observed."""
    stored = ("number long, run string, written array<string>, "
              "tables map<string, struct<location: string, rows: long>>")
    path = f"{database_folder(spark, database)}/_releases/release-*.json"
    files = spark.read.schema(stored).json(path)
    version = F.col("tables")[F.col("table")]
    return files.select("number", "run", "tables", F.explode("written").alias("table")).select(
        F.col("number").alias("release"), "run", "table", version["location"].alias("version"),
        version["rows"].alias("rows"))


class Draft:
    """The tables of one run before they are published."""

    def __init__(self, spark: SparkSession, database: str | None):
        self.spark, self.database, self.run = spark, database, uuid.uuid4().hex
        self.folder = _releases(spark, database)
        self.base = current_release(spark, database)
        sync_catalogue(spark, database, self.base)
        self.folder.create(f"draft-{self.run}", "")
        self.written: dict[str, Version] = {}
        self.seen: set[str] = set()
        self.published = False

    def location(self, table: str) -> str:
        """The folder of this run's version of ``table``."""
        return f"{database_folder(self.spark, self.database)}/{table}.versions/{self.run}"

    def read(self, table: str) -> DataFrame:
        """The run's own version, else that of the release it started from,
        else the catalogue's table."""
        if table in self.written:
            return self.written[table].read(self.spark)
        self.seen.add(table)
        if table in self.base.tables:
            return self.base.read(self.spark, table)
        return self.spark.table(f"{self.database}.{table}" if self.database else table)

    def put(self, table: str, location: str, schema: StructType, rows: int, fmt: str = "parquet",
            partition_by=()) -> None:
        """A finished version whose files are written already."""
        self.written[table] = Version(location, schema.json(), int(rows), self.run, fmt,
                                      tuple(partition_by or ()))

    def write(self, df: DataFrame, table: str, fmt: str = "parquet", partition_by=None) -> int:
        """Write ``df`` as this run's version of ``table``; the rows, observed in
        the same job, come back. A lost executor only repeats its tasks."""
        observation = Observation()
        writer = df.observe(observation, F.count(F.lit(1)).alias("rows")).write.format(fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(self.location(table))
        rows = int(observation.get["rows"])
        self.put(table, self.location(table), df.schema, rows, fmt, partition_by)
        return rows

    def publish(self, keep: int = KEEP_RELEASES) -> Release:
        """All versions written so far become the next release, by one rename."""
        while True:
            latest = current_release(self.spark, self.database)
            ours = self.seen | set(self.written)
            changed = {t for t in ours if latest.tables.get(t) != self.base.tables.get(t)}
            if changed:
                raise RuntimeError(f"another run published {sorted(changed)} meanwhile")
            release = Release(latest.number + 1, self.run, {**latest.tables, **self.written})
            text = json.dumps({"number": release.number, "run": self.run, "written": sorted(self.written),
                               "tables": {t: asdict(v) for t, v in release.tables.items()}})
            if self.folder.create(f"release-{release.number:0{_DIGITS}d}.json", text):
                self.published = True
                break
        sync_catalogue(self.spark, self.database, release)
        self.folder.delete(f"draft-{self.run}")
        expire(self.spark, self.database, keep)
        return release

    def abandon(self) -> None:
        """Give up: the run's folders are removed."""
        root = Folder(self.spark, database_folder(self.spark, self.database))
        for name in root.names():
            if name.endswith(".versions"):
                root.delete(f"{name}/{self.run}")
        self.folder.delete(f"draft-{self.run}")

    def __enter__(self) -> "Draft":
        return self

    def __exit__(self, failed, *_) -> None:
        if failed is not None and not self.published:
            self.abandon()


# ---------------------------------------------------------------------------
# Catalogue entries
# ---------------------------------------------------------------------------

def _sql(spark: SparkSession, statement: str) -> None:
    spark.sql(statement)


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def point_table(spark: SparkSession, name: str, location: str, schema: StructType, fmt: str = "parquet",
                partition_by=None) -> None:
    """Let the catalogue's entry ``name`` read the finished files at ``location``.

    With an unchanged schema that is one ``SET LOCATION``. With a new one, or
    over a table that Spark manages, a second entry is made beside it and the two
    change places by renames; the old entry, with a managed table's files, goes
    last. A call that stops between these is finished by the next one: at every
    point one of the two entries exists, and no data is dropped before the new
    entry has the name.
    """
    next_name, old_name = f"{name}__next", f"{name}__old"
    exists = spark.catalog.tableExists
    if not exists(name):
        for other in (old_name, next_name):              # an earlier call stopped between the renames
            if exists(other):
                _sql(spark, f"ALTER TABLE {_quoted(other)} RENAME TO {_quoted(name)}")
                break
    known = exists(name)
    managed = known and spark.catalog.getTable(name).tableType == "MANAGED"
    same = known and not managed and not partition_by and [
        (f.name, f.dataType) for f in spark.table(name).schema] == [
        (f.name, f.dataType) for f in schema]
    if same:
        _sql(spark, f"ALTER TABLE {_quoted(name)} SET LOCATION '{location}'")
    else:
        if exists(next_name):
            _sql(spark, f"DROP TABLE {_quoted(next_name)}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        parts = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
        target = next_name if known else name
        _sql(spark, f"CREATE TABLE {_quoted(target)} ({columns}) USING {fmt}{parts} LOCATION '{location}'")
        if partition_by:
            spark.catalog.recoverPartitions(target)
        if known:
            _sql(spark, f"ALTER TABLE {_quoted(name)} RENAME TO {_quoted(old_name)}")
            _sql(spark, f"ALTER TABLE {_quoted(next_name)} RENAME TO {_quoted(name)}")
    for other in (old_name, next_name):
        if exists(other):
            _sql(spark, f"DROP TABLE {_quoted(other)}")
    spark.catalog.refreshTable(name)


def _location(spark: SparkSession, name: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def _plain(location: str | None) -> str | None:
    """A location without the ``file:`` scheme that the catalogue adds."""
    return location if location is None or not location.startswith("file:") else "/" + location[5:].lstrip("/")


def sync_catalogue(spark: SparkSession, database: str | None, release: Release | None = None) -> None:
    """Point every catalogue entry that stands elsewhere at its version of the
    newest release. Repeating it changes nothing."""
    release = release or current_release(spark, database)
    exists = spark.catalog.tableExists
    for table, version in release.tables.items():
        name = f"{database}.{table}" if database else table
        halfway = exists(f"{name}__old") or exists(f"{name}__next")
        if halfway or _plain(_location(spark, name)) != _plain(version.location):
            point_table(spark, name, version.location, version.struct(), version.fmt,
                        list(version.partition_by) or None)


# ---------------------------------------------------------------------------
# Retention
# ---------------------------------------------------------------------------

def expire(spark: SparkSession, database: str | None, keep: int = KEEP_RELEASES,
           abandoned_s: float = ABANDONED_S) -> list[str]:
    """Remove version folders that none of the newest ``keep`` releases names and
    no run in progress owns; the removed folders come back. Release files stay:
    they are the audit. A run whose draft is older than ``abandoned_s`` counts as
    dead. Only tables that some release names are touched."""
    folder = _releases(spark, database)
    held, known = set(), set()
    numbers = sorted(_numbers(folder))
    for number in numbers[-max(1, keep):]:
        for table, version in _load(folder, number).tables.items():
            known.add(table)
            held.add((table, version.run))
    alive = set()
    for name in folder.names():
        if name.startswith("draft-"):
            if folder.age(name) <= abandoned_s:
                alive.add(name[6:])
            else:
                folder.delete(name)
    removed, root = [], Folder(spark, database_folder(spark, database))
    for table in sorted(known):
        versions = Folder(spark, f"{root.path}/{table}.versions")
        for run in versions.names():
            if (table, run) not in held and run not in alive:
                versions.delete(run)
                removed.append(f"{versions.path}/{run}")
    return removed
