import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from starledger.session import scratch_path
from starledger.sources.files import (
    preview, read_csv, read_if_exists, read_layer, read_year, sql_over, write_layer, write_sized,
)
from starledger.sources.schemas import TABLES
from starledger.sources.warehouse import conform, publish


def test_csv_as_text_and_year_glob(spark, tmp_path):
    base = tmp_path / "landing"
    base.mkdir()
    (base / "FY2019_part1.csv").write_text("code,amount\n01001,1.50\n00002,x\n")
    (base / "FY2020_part1.csv").write_text("code,amount\n09000,2\n")
    df = read_year(spark, str(base), 2019)
    assert dict(df.dtypes) == {"code": "string", "amount": "string"}
    assert sorted(r.code for r in df.collect()) == ["00002", "01001"]       # leading zeros kept
    inferred = read_csv(spark, str(base / "FY2019_part1.csv"), infer=True)
    assert dict(inferred.dtypes)["code"] == "int"                           # what inference would do (Q9)
    with pytest.raises(FileNotFoundError):
        read_year(spark, str(base), 2031)
    with pytest.raises(ValueError):
        read_year(spark, str(base), "")


def test_read_if_exists_and_write_modes(spark):
    path = scratch_path(spark, "layer")
    assert read_if_exists(spark, path) is None
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    write_layer(df, path, mode="errorifexists")
    with pytest.raises(AnalysisException):
        write_layer(df, path, mode="errorifexists")
    assert read_if_exists(spark, path).count() == 10
    write_layer(df, path, files=1)
    assert read_layer(spark, path).count() == 10
    assert preview(read_layer(spark, path), 3).count() == 3
    assert sql_over(spark, {"layer_t": read_layer(spark, path)}, "select sum(v) as s from layer_t").first().s == 90


def test_write_sized_caps_rows_per_file(spark):
    path = scratch_path(spark, "sized")
    write_sized(spark.range(1000), path, rows_per_file=300)
    files = [f for f in os.listdir(path.replace("file:", "")) if f.endswith(".parquet")]
    assert len(files) >= 4 and read_layer(spark, path).count() == 1000
    exact = scratch_path(spark, "sized-exact")
    write_sized(spark.range(0), exact, rows_per_file=300, exact=True)    # empty frame: max(1, 0) partitions
    assert read_layer(spark, exact).count() == 0


def test_conform_by_name(spark):
    df = spark.createDataFrame([("x", "12.345", "junk", "2019")], "award_unique_key string, face_value_of_loan string, "
                               "total_face_value_of_loan string, transaction_unique_key string")
    with pytest.raises(ValueError, match="award_unique_key"):
        conform(df.withColumnRenamed("award_unique_key", "award_unique_kee"), TABLES["FactAssistance"],
                optional=[f.name for f in TABLES["FactAssistance"].fields if f.name != "award_unique_key"])
    out = conform(df, TABLES["FactAssistance"], optional=[f.name for f in TABLES["FactAssistance"].fields])
    assert [f.name for f in out.schema.fields] == [f.name for f in TABLES["FactAssistance"].fields]
    r = out.first()
    assert str(r.face_value_of_loan) == "12.35" and r.total_face_value_of_loan is None and r.cfda_number is None


def test_bucketed_facts_join_without_exchange(spark):
    db = "bucket_test"
    base = scratch_path(spark, "wh")
    a = spark.range(2000).select(F.col("id").cast("string").alias("transaction_unique_key"), F.lit("x").alias("award_unique_key"))
    for name in ("FactContract", "FactAssistance"):
        publish(a, name, TABLES[name], db, bucket_by="transaction_unique_key", buckets=4, path=f"{base}/{name}",
                optional=TABLES[name].fieldNames())
    j = spark.table(f"{db}.FactContract").join(spark.table(f"{db}.FactAssistance"), "transaction_unique_key")
    with_broadcast_off = j.hint("shuffle_merge")
    plan = with_broadcast_off._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    assert j.count() == 2000


def test_partitioned_year_landing_prunes(spark):
    from starledger.sources.files import write_csv_years
    df = spark.range(30).select((F.col("id") % 3 + 2019).alias("fy"), F.format_string("%05d", "id").alias("code"))
    base = write_csv_years(df, scratch_path(spark, "years"), "fy")
    year = read_year(spark, base, 2020, layout="partitioned", year_col="fy")
    assert year.columns == ["code"] and year.count() == 10
    assert sorted(r.code for r in year.collect())[0] == "00001"           # text kept as written
    with pytest.raises(FileNotFoundError):
        read_year(spark, base, 1999, layout="partitioned", year_col="fy")
    plan = year._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fy" in plan and "= 2020" in plan


def test_published_tables_carry_size_statistics(spark):
    db = "stats_test"
    dim = spark.createDataFrame([("1", "A")], "agency_code string, agency_name string")
    publish(dim, "DimAgency", TABLES["DimAgency"], db, path=scratch_path(spark, "stats"))
    stats = spark.sql(f"DESCRIBE TABLE EXTENDED {db}.DimAgency").where("col_name = 'Statistics'").collect()
    assert stats and "bytes" in stats[0].data_type


def test_run_concurrently_returns_results_and_raises_failures(spark):
    from starledger.session import run_concurrently
    out = run_concurrently({"a": lambda: spark.range(10).count(), "b": lambda: spark.range(5).count()}, 2)
    assert out == {"a": 10, "b": 5}
    with pytest.raises(AnalysisException):
        run_concurrently({"ok": lambda: 1, "bad": lambda: spark.read.parquet("/nonexistent/path").count()}, 2)


def test_partitioned_sized_write_keeps_one_file_per_small_year(spark):
    path = scratch_path(spark, "by-year")
    df = spark.range(3000).repartition(8).select((F.col("id") % 3 + 2019).alias("fy"), "id")
    write_sized(df, path, rows_per_file=1_000_000, partition_by="fy")
    root = path.replace("file:", "")
    per_year = {d: len([f for f in os.listdir(os.path.join(root, d)) if f.endswith(".parquet")])
                for d in os.listdir(root) if d.startswith("fy=")}
    assert per_year == {"fy=2019": 1, "fy=2020": 1, "fy=2021": 1}      # not one file per task per year
    assert read_layer(spark, path).count() == 3000
