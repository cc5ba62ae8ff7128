"""Rejected rows as a table, in one pass with silver."""
import pytest
from pyspark.sql import functions as F

from starledger.operators import rejects as rj
from starledger.plans.jobs.bronze import job_b2s, job_b2s_routed, write_routed
from starledger.session import scratch_path
from starledger.sources.schemas import CONTRACT
from tests.conftest import rows
from tests.fixtures import write_landing


def test_reasons_untyped_values_and_raw_text(spark):
    df = spark.createDataFrame([("a", "1.5", "x"), ("a", "1.5", "x"), ("b", "n/a", "x"), (None, "2", None), ("c", None, ""),
                                (None, "junk", "y")], "k string, m string, note string")
    out = rj.route(df, {"m": "decimal(9,2)", "absent": "int"}, {"no_key": F.col("k").isNull(), "no_money": F.col("m").isNull()}, ["k"])
    got = sorted((str(r.k), r.outcome, r.reasons, r.untyped, r.raw) for r in out.collect())
    assert got == sorted([("a", "silver", None, None, None), ("a", "silver", None, None, None),
                          ("b", "reject", ["no_money"], ["m"], {"m": "n/a", "k": "b"}),
                          ("None", "reject", ["no_key"], None, {"m": "2", "k": None}),
                          ("c", "reject", ["no_money"], None, {"m": None, "k": "c"}),
                          ("None", "reject", ["no_key", "no_money"], ["m"], {"m": "junk", "k": None})])
    assert out.schema["m"].dataType.simpleString() == "decimal(9,2)"
    kept = rj.route(df, {"m": "int"}, {})
    assert kept.where("outcome = 'silver'").count() == 6 and kept.where("untyped is not null and raw['m'] = 'junk'").count() == 1
    assert rj.route(df, {}, {}).where("outcome = 'silver' and raw is null").count() == 6
    assert rj.route(df.limit(0), {"m": "int"}, {}).count() == 0
    with pytest.raises(ValueError, match="outcome"):
        rj.route(df.withColumn("outcome", F.lit(1)), {}, {})


@pytest.mark.parametrize("family", ["assistance", "contract"])
def test_routed_silver_is_the_jobs_silver(spark, tmp_path, family):
    landing = write_landing(str(tmp_path / "landing"), years=(2019, 2020))
    want = spark.read.parquet(job_b2s(spark, landing, scratch_path(spark, "plain"), family))
    base = scratch_path(spark, "routed")
    counts = job_b2s_routed(spark, landing, base, family)
    got = rj.silver_of(spark, f"{base}/{family}")
    assert set(got.columns) == set(want.columns)
    assert rows(got.select(want.columns)) == rows(want)
    gone = rj.rejects_of(spark, f"{base}/{family}")
    assert counts == {"silver": want.count(), "reject": gone.count()}
    assert gone.where("size(reasons) = 0 or raw is null").isEmpty()
    report = {(r.kind, r.code): r.n for r in rj.reject_report(spark, f"{base}/{family}").collect()}
    assert sum(n for (kind, _), n in report.items() if kind == "reason") >= counts["reject"]
    assert all(code in ("no_money", "no_key", "key_shape") for kind, code in report if kind == "reason")


def test_empty_input_and_lost_rows(spark):
    path = scratch_path(spark, "none")
    raw = spark.createDataFrame([], "contract_transaction_unique_key string, federal_action_obligation string, action_date_fiscal_year string")
    assert write_routed(spark, raw, CONTRACT, path) == {"silver": 0, "reject": 0}
    one = rj.route(spark.createDataFrame([("a",)], "k string"), {}, {})
    one.write.partitionBy("outcome").parquet(scratch_path(spark, "one") + "/t")
    path = scratch_path(spark, "two")
    one.write.partitionBy("outcome").parquet(path)
    assert rj.check_balance(spark, path, one.schema, 1) == {"silver": 1, "reject": 0}
    with pytest.raises(RuntimeError, match="2 rows came in"):
        rj.check_balance(spark, path, one.schema, 2)
