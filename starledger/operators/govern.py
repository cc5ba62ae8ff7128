"""Column masks and row filters per principal."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.operators.joins import semi_filter
from starledger.sources.schemas import ADMIN_PRINCIPALS, MASK_TEXT


def mask_columns(df: DataFrame, cols, privileged, mask: str = MASK_TEXT) -> DataFrame:
    """Replace the text of ``cols`` by a constant unless ``privileged``
    (a bool, folded at plan time, or a boolean Column).  Nulls stay null (G1)."""
    cond = F.lit(bool(privileged)) if not isinstance(privileged, Column) else privileged
    return df.withColumns({
        c: F.when(cond, F.col(f"`{c}`")).when(F.col(f"`{c}`").isNotNull(), F.lit(mask))
        for c in ([cols] if isinstance(cols, str) else cols)
    })


def current_principal(spark) -> str:
    """Name of the user the session runs as."""
    return spark.range(1).select(F.current_user()).first()[0]


def filter_for_principal(df: DataFrame, code_col: str, agency: DataFrame, principal: str | None = None,
                         admins=ADMIN_PRINCIPALS, dim_code: str = "agency_code",
                         dim_name: str = "agency_name") -> DataFrame:
    """Rows whose agency code belongs to the agency named like the
    principal; administrators see every row (G2, J14).

    The scalar subquery of a row-filter predicate becomes a ``left_semi``
    join with the principal's agency codes (several codes are tolerated,
    Q20).  That set is tiny; AQE broadcasts it from its measured size."""
    if principal is None:
        principal = current_principal(df.sparkSession)
    if principal in admins:
        return df
    allowed = agency.where(F.col(dim_name) == F.lit(principal)).select(
        F.col(dim_code).alias("_allowed")).distinct()
    return semi_filter(df, allowed, {code_col: "_allowed"})


@dataclass(frozen=True)
class Policy:
    """What a secured view applies: the filtered code column, the agency
    dimension that names principals, and the masked columns."""
    code_col: str | None
    agency: DataFrame | None
    masked: tuple = ()
    admins: tuple = ADMIN_PRINCIPALS


def secured(df: DataFrame, policy: Policy, principal: str | None = None) -> DataFrame:
    """Row filter, then column masks, for one principal (G3); by default
    the session's current user."""
    if principal is None:
        principal = current_principal(df.sparkSession)
    out = df
    if policy.code_col is not None:
        out = filter_for_principal(out, policy.code_col, policy.agency, principal, policy.admins)
    if policy.masked:
        out = mask_columns(out, list(policy.masked), principal in policy.admins)
    return out
