"""Bronze (raw CSV) to silver (typed parquet) for one award family."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starledger.functions.scalars import matches
from starledger.operators import rejects
from starledger.operators.clean import (
    cast_cols, cast_money, drop_all_null, filter_key_shape, rename, require_key,
    select_present, tag,
)
from starledger.operators.merge import merge_increment_to
from starledger.sources.files import read_year, write_sized
from starledger.sources.reconcile import read_csv_reconciled
from starledger.sources.schemas import COVID_COLUMNS, FAMILIES, WANTED_COLUMNS, FamilySpec

FISCAL_YEAR = "action_date_fiscal_year"
DATE_TYPES = {"action_date": "date", "last_modified_date": "date", FISCAL_YEAR: "int"}


def bronze_to_silver(raw: DataFrame, spec: FamilySpec, wanted=WANTED_COLUMNS,
                     observation=None) -> DataFrame:
    """Wish-list projection, common names, family tag, money typed (both
    COVID columns for both families, Q10), rows without any money or
    without a well-shaped key dropped, dates typed."""
    df = select_present(raw, wanted)
    df = rename(df, spec.renames)
    df = tag(df, spec.tag_column, spec.name)
    df = cast_money(df, list(spec.money) + [c for c in COVID_COLUMNS if c not in spec.money],
                    observation=observation)
    df = drop_all_null(df, spec.money)
    df = require_key(df, [spec.key])
    df = filter_key_shape(df, spec.key, spec.key_pattern)
    return cast_cols(df, {c: t for c, t in DATE_TYPES.items() if c in df.columns})


def route_bronze(raw: DataFrame, spec: FamilySpec, wanted=WANTED_COLUMNS) -> DataFrame:
    """The rules of :func:`bronze_to_silver` as routing: its rows are the
    ``silver`` outcome, all others are rejected as ``no_money`` (P8),
    ``no_key`` (P9) or ``key_shape`` (P11), with their raw text."""
    df = tag(rename(select_present(raw, wanted), spec.renames), spec.tag_column, spec.name)
    money = dict.fromkeys([*spec.money, *COVID_COLUMNS], "decimal(18,2)")
    present = [c for c in spec.money if c in df.columns]
    rules = {"no_money": reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNull() for c in present])} if present else {}
    rules["no_key"] = F.col(spec.key).isNull()
    rules["key_shape"] = ~matches(spec.key, spec.key_pattern)
    return rejects.route(df, money | DATE_TYPES, rules, [spec.key])


def write_routed(spark: SparkSession, raw: DataFrame, spec: FamilySpec, path: str) -> dict[str, int]:
    """Route ``raw`` to the table at ``path`` in one pass, partitioned by
    outcome and fiscal year; rows per outcome, checked against the input."""
    seen = Observation()
    routed = route_bronze(raw.observe(seen, F.count(F.lit(1)).alias("rows")), spec)
    parts = [rejects.OUTCOME, *([FISCAL_YEAR] if FISCAL_YEAR in routed.columns else [])]
    write_sized(routed, path, spec.rows_per_file, partition_by=parts)
    # the count of a plan that is known to be empty is never taken
    return rejects.check_balance(spark, path, routed.schema, 0 if raw.isEmpty() else seen.get["rows"])


def job_b2s_routed(spark: SparkSession, landing: str, silver: str, family: str) -> dict[str, int]:
    """As :func:`job_b2s`, but rejected rows stay as a table beside silver;
    read with ``rejects.silver_of`` and ``rejects.rejects_of``."""
    raw = read_csv_reconciled(spark, f"{landing}/{family}")
    return write_routed(spark, raw, FAMILIES[family], f"{silver}/{family}")


def job_b2s(spark: SparkSession, landing: str, silver: str, family: str, observation=None) -> str:
    """Full history of one family (E1).  Silver is partitioned by fiscal
    year so a later yearly merge rewrites one partition only.  The yearly
    files may differ in their columns and their order.  Pass an
    ``Observation`` to receive row and rejected-value counts."""
    spec = FAMILIES[family]
    out = bronze_to_silver(read_csv_reconciled(spark, f"{landing}/{family}"), spec, observation=observation)
    path = f"{silver}/{family}"
    write_sized(out, path, spec.rows_per_file, partition_by=FISCAL_YEAR)
    return path


def job_b2s_year(spark: SparkSession, landing: str, silver: str, family: str, year) -> str:
    """One fiscal year merged into silver (E2): full-row distinct with the
    rows already there, staged, then only that year's partition replaced."""
    spec = FAMILIES[family]
    new = bronze_to_silver(read_year(spark, f"{landing}/{family}", year), spec)
    path = f"{silver}/{family}"
    merge_increment_to(spark, path, new, partition_col=FISCAL_YEAR, rows_per_file=spec.rows_per_file)
    return path
