"""Plan-shape checks: the physical strategy we rely on at scale."""

from pyspark.sql import functions as F

from starledger.operators.dims import calendar_dim
from starledger.operators.joins import lookup_roles
from starledger.operators.keys import dense_key
from starledger.operators.summaries import summary_agencies
from starledger.operators.winners import first_per_group, top_per_group


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dimension_of_checked_size_is_broadcast(spark):
    fact = spark.range(100).select(F.date_add(F.to_date(F.lit("2019-01-01")), F.col("id").cast("int")).alias("d"))
    cal = calendar_dim(spark, "2018-10-01", "2019-09-30")
    plan = _plan(lookup_roles(fact, cal, {"d": "k"}, "calendar_date", "date_key", unique=True, dim_bytes=4000))
    assert "BroadcastHashJoin" in plan


def test_dense_key_has_one_exchange_and_no_window(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("string").alias("c")).distinct()
    keyed = dense_key(df, ["c"], "k")
    plan = _plan(keyed)
    assert "Window" not in plan and "Exchange hashpartitioning" not in plan
    assert [r.k for r in keyed.orderBy("c").collect()] == list(range(1, 98))


def test_winners_reduce_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), (F.col("id") % 13).alias("v"), F.col("id").alias("k"))
    assert _plan(top_per_group(df, ["g"], "v")).count("WindowGroupLimit") == 2  # partial and final
    assert "Window" not in _plan(first_per_group(df, ["g"], ["v", "k"]))


def test_summaries_aggregate_before_the_dimension_join(spark):
    txn = spark.range(1000).select((F.col("id") % 30 + 20190101).cast("int").alias("action_date_key"),
                                   (F.col("id") % 5).cast("string").alias("funding_agency_code"))
    agency = spark.createDataFrame([(str(i), f"A{i}") for i in range(5)], "agency_code string, agency_name string")
    plan = _plan(summary_agencies(txn, agency, "day"))
    assert plan.count("HashAggregate") >= 3        # partial + final before the join, final after


def test_yearly_merge_prunes_silver_to_touched_years(spark):
    from starledger.operators.merge import touched_partitions
    from starledger.session import scratch_path
    silver, landed = scratch_path(spark, "prune-silver"), scratch_path(spark, "prune-new")
    spark.range(1000).select((F.col("id") % 5 + 2018).cast("int").alias("fy"), "id").write.partitionBy("fy").parquet(silver)
    spark.createDataFrame([(2021, 1), (2022, 2)], "fy int, id long").write.parquet(landed)
    current = spark.read.parquet(silver).where(touched_partitions(spark.read.parquet(landed), "fy"))
    plan = _plan(current)
    assert "PartitionFilters: [fy" in plan and "IN (" in plan and "2021" in plan and "2022" in plan
    assert current.count() == 400


def test_hot_key_in_a_shuffled_rekey_join_is_split(spark):
    """A third of the fact rows share one natural key.  With broadcasting
    off and tiny skew thresholds, AQE must split the hot partition."""
    from starledger.operators.dims import extract_dim
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        fact = spark.range(30000).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 500).cast("string")).alias("code"))
        _, rekeyed = extract_dim(fact, ["code"], "k", max_bytes=-1)
        assert len(rekeyed.collect()) == 30000        # runs this frame's own adaptive plan
        final = rekeyed._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in final and "skew=true" in final
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
