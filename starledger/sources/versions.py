"""Versioned publish: readers see a whole load or the one before.

A full refresh that drops tables and loads them again shows readers gaps,
and a load that dies half way leaves them with a mixture.  Here every load
goes into a database of its own, ``{database}_v{n}``:

1. load all tables into the new version and check their rows against the
   rows that came in; any failure ends the load, and nothing points to it,
2. commit: write the version's manifest (tables and rows), a file that is
   made whole or not at all and never overwritten,
3. switch: each table's view in ``database`` selects from the new version.
   A view keeps the bucketing of the table below it,
4. expire: drop versions beyond the newest ``keep`` committed ones, and
   what dead loads left behind.

The manifest is the commit: a driver that dies between 2 and 3 has
published, and :func:`switch_views`, which each load also begins with,
catches the views up.  Views switch one after the other; a reader that
needs several tables of one load reads :func:`version_table`.

One load runs at a time; a second one that started from the same state
fails on the version's database or manifest.
"""

from __future__ import annotations

import json
import uuid
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starledger.session import drop_path, run_concurrently
from starledger.sources.schemas import FACT_TABLES
from starledger.sources.warehouse import BUCKET_ROWS, publish


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    _, target, fs = _files(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def _number(name: str, before: str, after: str = "") -> int | None:
    inner = name[len(before):len(name) - len(after)]
    return int(inner) if name.startswith(before) and name.endswith(after) and inner.isdigit() else None


def version_database(database: str, version: int) -> str:
    return f"{database}_v{version}"


def versions(spark: SparkSession, location: str) -> list[int]:
    """Committed versions, oldest first."""
    found = (_number(n, "v", ".json") for n in _names(spark, f"{location.rstrip('/')}/_manifests"))
    return sorted(n for n in found if n is not None)


def manifest(spark: SparkSession, location: str, version: int) -> dict:
    """``{"version", "database", "rows": {table: rows}}`` of one version."""
    text = spark.read.text(f"{location.rstrip('/')}/_manifests/v{version}.json", wholetext=True).first()[0]
    return json.loads(text)


def _commit(spark: SparkSession, location: str, version: int, content: dict) -> None:
    """Make the manifest: written beside its place, then renamed, which
    fails where a version of that number is there."""
    folder = f"{location.rstrip('/')}/_manifests"
    jvm, draft, fs = _files(spark, f"{folder}/.draft-{uuid.uuid4().hex}")
    target = jvm.org.apache.hadoop.fs.Path(f"{folder}/v{version}.json")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise RuntimeError(f"version {version} is committed already")


def version_table(spark: SparkSession, location: str, table: str, version: int | None = None) -> DataFrame:
    """A table as of a committed version (default: the newest)."""
    known = versions(spark, location)
    version = known[-1] if version is None and known else version
    if version not in known:
        raise ValueError(f"no committed version {version} at {location}")
    return spark.table(f"{manifest(spark, location, version)['database']}.{table}")


def _views(spark: SparkSession, database: str, tables) -> set[str]:
    """Names of the views of a database; an error if one of ``tables`` is
    there as something else."""
    here = {t.name.lower(): t.tableType for t in spark.catalog.listTables(database) if not t.isTemporary}
    for table in tables:
        if here.get(table.lower(), "VIEW") != "VIEW":
            raise ValueError(f"{database}.{table} is a table; versions are published as views")
    return {name for name, kind in here.items() if kind == "VIEW"}


def switch_views(spark: SparkSession, location: str, database: str, version: int | None = None) -> int | None:
    """Let the views of ``database`` select from a committed version
    (default: the newest); views of tables it lacks go.  May be repeated."""
    known = versions(spark, location)
    if version is None:
        if not known:
            return None
        version = known[-1]
    elif version not in known:
        raise ValueError(f"no committed version {version} at {location}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    content = manifest(spark, location, version)
    here = _views(spark, database, content["rows"])
    for table in content["rows"]:
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS SELECT * FROM {content['database']}.{table}")
    prior = {t.lower() for v in known if v != version for t in manifest(spark, location, v)["rows"]}
    for table in (prior & here) - {t.lower() for t in content["rows"]}:
        spark.sql(f"DROP VIEW IF EXISTS {database}.{table}")
    return version


def expire(spark: SparkSession, location: str, database: str, keep: int = 2) -> list[int]:
    """Drop committed versions but the newest ``keep`` (1 at least) and all
    dead loads; the versions dropped.  No load may be running."""
    known = versions(spark, location)
    live = set(known[-max(1, keep):])
    folders = (_number(n, "v") for n in _names(spark, location))
    bases = (_number(d.name, f"{database}_v") for d in spark.catalog.listDatabases())
    gone = sorted(({n for n in (*folders, *bases) if n is not None} | set(known)) - live)
    for n in gone:
        drop_path(spark, f"{location.rstrip('/')}/_manifests/v{n}.json")    # first: no commit without its tables
        spark.sql(f"DROP DATABASE IF EXISTS {version_database(database, n)} CASCADE")
        drop_path(spark, f"{location.rstrip('/')}/v{n}")
    return gone


def publish_version(spark: SparkSession, tables: dict, schemas: dict, database: str, location: str,
                    buckets: int | None = None, workers: int = 4, optional: dict | None = None, keep: int = 2) -> int:
    """Publish ``tables`` (name -> frame) as the next version; its number.

    Types, bucketing and ``optional`` are those of
    ``warehouse.refresh_warehouse``.  Every frame is computed once: its rows
    are counted while it is written and compared with what the written
    files hold."""
    location = location.rstrip("/")
    known = versions(spark, location)
    switch_views(spark, location, database)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    _views(spark, database, tables)     # nothing in the way
    # what dead loads left goes with the next expiry; their numbers are not used again
    used = [n for n in (*known, *(_number(x, "v") for x in _names(spark, location)),
                        *(_number(d.name, f"{database}_v") for d in spark.catalog.listDatabases())) if n is not None]
    version = max(used, default=0) + 1
    target = version_database(database, version)
    spark.sql(f"CREATE DATABASE {target} LOCATION '{location}/v{version}/{target}.db'")
    if buckets is None:
        rows = max([tables[t].count() for t in FACT_TABLES if t in tables], default=0)
        buckets = max(1, -(-rows // BUCKET_ROWS))

    def load(table: str, df: DataFrame) -> int:
        seen = Observation()
        publish(df.observe(seen, F.count(F.lit(1)).alias("rows")), table, schemas[table], target,
                bucket_by="transaction_unique_key" if table in FACT_TABLES else None, buckets=buckets,
                path=f"{location}/v{version}/{table}", optional=(optional or {}).get(table, ()))
        written = spark.table(f"{target}.{table}").count()
        # the count of a plan that is known to be empty is never taken
        came = seen.get["rows"] if written or not df.isEmpty() else 0
        if written != came:
            raise RuntimeError(f"{target}.{table}: {came} rows came in, {written} were written")
        return written

    loaded = run_concurrently({t: partial(load, t, df) for t, df in tables.items()}, workers)
    _commit(spark, location, version, {"version": version, "database": target, "rows": loaded})
    switch_views(spark, location, database)
    expire(spark, location, database, keep)
    return version
