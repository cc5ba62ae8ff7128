"""Versioned publish: a failed load leaves the version before readable."""
import os

import pytest
from pyspark.sql import functions as F

from starledger.session import scratch_path
from starledger.sources import versions as vs
from starledger.sources.schemas import TABLES
from tests.conftest import rows


def frames(spark, n):
    agency = spark.createDataFrame([(str(i), f"agency {i} of load {n}") for i in range(n)], "agency_code string, agency_name string")
    people = spark.createDataFrame([(f"r{i}", f"name {n}") for i in range(2 * n)], "recipient_uei string, recipient_name_raw string")
    return {"DimAgency": agency, "DimRecipient": people}


@pytest.fixture
def place(spark, request):
    db = f"ver_{request.node.name.split('[')[0][-40:]}"
    yield db, scratch_path(spark, "versions")
    for d in [x.name for x in spark.catalog.listDatabases() if x.name.startswith(db)]:
        spark.sql(f"DROP DATABASE {d} CASCADE")


def test_views_follow_and_old_versions_expire(spark, place):
    db, at = place
    assert vs.versions(spark, at) == [] and vs.switch_views(spark, at, db) is None
    for n in (1, 2, 3):
        assert vs.publish_version(spark, frames(spark, n), TABLES, db, at, workers=1) == n
        assert rows(spark.table(f"{db}.DimAgency")) == rows(frames(spark, n)["DimAgency"])
    assert vs.versions(spark, at) == [2, 3]
    assert vs.manifest(spark, at, 2)["rows"] == {"DimAgency": 2, "DimRecipient": 4}
    assert vs.version_table(spark, at, "DimRecipient", 2).count() == 4
    assert vs.version_table(spark, at, "DimRecipient").count() == 6
    local = at.removeprefix("file:")
    assert sorted(x for x in os.listdir(local) if not x.startswith("_")) == ["v2", "v3"]
    with pytest.raises(ValueError, match="no committed version 1"):
        vs.version_table(spark, at, "DimAgency", 1)
    vs.switch_views(spark, at, db, 2)       # back to the version before
    assert spark.table(f"{db}.DimAgency").count() == 2


@pytest.mark.parametrize("when", ["computing", "missing column"])
def test_a_load_that_dies_between_two_tables(spark, place, when):
    db, at = place
    vs.publish_version(spark, frames(spark, 2), TABLES, db, at)
    bad = frames(spark, 5)
    bad["DimRecipient"] = (bad["DimRecipient"].drop("recipient_uei") if when == "missing column" else
                           bad["DimRecipient"].withColumn("recipient_uei", F.raise_error(F.lit("lost")).cast("string")))
    with pytest.raises(Exception):
        vs.publish_version(spark, bad, TABLES, db, at, workers=1)
    assert spark.catalog.tableExists(f"{db}_v2.DimAgency")       # the first table was loaded
    assert vs.versions(spark, at) == [1]
    assert rows(spark.table(f"{db}.DimAgency")) == rows(frames(spark, 2)["DimAgency"])
    assert spark.table(f"{db}.DimRecipient").count() == 4
    assert vs.publish_version(spark, frames(spark, 4), TABLES, db, at) == 3
    assert spark.table(f"{db}.DimRecipient").count() == 8
    assert vs.versions(spark, at) == [1, 3] and not spark.catalog.databaseExists(f"{db}_v2")


def test_a_driver_that_dies_after_the_commit(spark, place, monkeypatch):
    db, at = place
    vs.publish_version(spark, frames(spark, 1), TABLES, db, at)
    with monkeypatch.context() as m:
        real, calls = vs.switch_views, []
        m.setattr(vs, "switch_views", lambda *a: real(*a) if not calls and not calls.append(1) else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            vs.publish_version(spark, frames(spark, 3), TABLES, db, at)
    assert vs.versions(spark, at) == [1, 2] and spark.table(f"{db}.DimAgency").count() == 1
    assert vs.switch_views(spark, at, db) == 2 and spark.table(f"{db}.DimAgency").count() == 3
    with pytest.raises(RuntimeError, match="committed already"):
        vs._commit(spark, at, 2, {})
    assert [n for n in os.listdir(at.removeprefix("file:") + "/_manifests") if "draft" in n and not n.endswith(".crc")] == []


def test_empty_tables_are_published(spark, place):
    db, at = place
    vs.publish_version(spark, {t: df.limit(0) for t, df in frames(spark, 2).items()}, TABLES, db, at)
    assert spark.table(f"{db}.DimAgency").count() == 0 and vs.manifest(spark, at, 1)["rows"] == {"DimAgency": 0, "DimRecipient": 0}


def test_tables_in_the_way_and_tables_that_go(spark, place):
    db, at = place
    vs.publish_version(spark, frames(spark, 1), TABLES, db, at)
    vs.publish_version(spark, {"DimAgency": frames(spark, 2)["DimAgency"]}, TABLES, db, at)
    assert [t.name.lower() for t in spark.catalog.listTables(db) if not t.isTemporary] == ["dimagency"]
    spark.sql(f"CREATE TABLE {db}.DimRecipient (x int) USING parquet")
    with pytest.raises(ValueError, match="is a table"):
        vs.publish_version(spark, frames(spark, 3), TABLES, db, at)
