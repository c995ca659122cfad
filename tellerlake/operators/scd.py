"""Slowly changing dimensions: overwrite in place (type 1) and keep versions (type 2).

A merge is one full outer join on the natural key. Each joined pair unfolds into the rows it
leaves behind, so current rows and incoming rows are each shuffled once and nothing is looked up
row by row. Rows that still need a surrogate key come out with a null key.
"""

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tellerlake import schemas
from tellerlake.schemas import day_literal, text_literal, time_literal


@dataclass(frozen=True)
class Dimension:
    """How one dimension table is keyed, typed and compared.

    ``tracked`` columns open a new version when they differ (type 2); ``fixed`` columns keep the
    value of the first load (type 1).
    """

    name: str
    schema: StructType
    surrogate: str
    natural: str
    tracked: tuple[str, ...] = ()
    fixed: tuple[str, ...] = ()

    def kind(self, column: str) -> str:
        return self.schema[column].dataType.simpleString()


BRANCHES = Dimension("dim_branches", schemas.DIM_BRANCHES, "branch_key", "branch_id", fixed=("opened_date",))
MERCHANTS = Dimension("dim_merchants", schemas.DIM_MERCHANTS, "merchant_key", "merchant_id")
CUSTOMERS = Dimension(
    "dim_customers",
    schemas.DIM_CUSTOMERS,
    "customer_key",
    "customer_id",
    tracked=("customer_segment", "income_band", "risk_rating", "is_active", "kyc_verified"),
)
ACCOUNTS = Dimension(
    "dim_accounts",
    schemas.DIM_ACCOUNTS,
    "account_key",
    "account_id",
    tracked=("status", "credit_limit", "overdraft_limit", "interest_rate"),
)

INSERT, UPDATE, EXPIRE, KEEP = "insert", "update", "expire", "keep"


@dataclass(frozen=True)
class Load:
    """What stamps the rows of one run."""

    batch_id: str
    as_of: datetime.date
    loaded_at: datetime.datetime


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter("scd_is_current")


def first_rows(incoming: DataFrame, dimension: Dimension, load: Load) -> DataFrame:
    """Incoming rows as first versions of the dimension, without a surrogate key."""
    return schemas.conform(
        incoming,
        dimension.schema,
        **{dimension.surrogate: "NULL"},
        scd_start_date=day_literal(load.as_of),
        scd_end_date="NULL",
        scd_is_current="TRUE",
        scd_version="1",
        dw_created_at=time_literal(load.loaded_at),
        dw_batch_id=text_literal(load.batch_id),
    )


def _pair_up(dim: DataFrame, incoming: DataFrame, dimension: Dimension) -> DataFrame:
    """Old and new row of each key side by side, as structs; an absent side is null."""
    natural, columns = dimension.natural, ", ".join(dimension.schema.names)
    old = dim.selectExpr(f"{natural} AS _old_id", f"STRUCT({columns}) AS _old")
    new = incoming.selectExpr(f"{natural} AS _new_id", f"STRUCT({columns}) AS _new")
    return old.join(new, F.expr("_old_id = _new_id"), "full_outer")


def _row(dimension: Dimension, side: str, action: str, **changed: str) -> str:
    """A row of the dimension with the values of one side, some of them changed, and its outcome."""
    values = {name: f"{side}.{name}" for name in dimension.schema.names} | changed
    fields = ", ".join(f"'{name}', CAST({value} AS {dimension.kind(name)})" for name, value in values.items())
    return f"NAMED_STRUCT({fields}, '_action', '{action}')"


def scd1_merge(dim: DataFrame, incoming: DataFrame, dimension: Dimension, load: Load) -> DataFrame:
    """Upsert by natural key: new keys are added, known keys overwritten except their fixed columns.

    Result: the whole dimension plus ``_action``; added rows have a null surrogate key.
    """
    stays = (dimension.surrogate, dimension.natural, "dw_created_at", *dimension.fixed)
    taken = {name: f"_new.{name}" for name in dimension.schema.names if name not in stays}
    result = f"""CASE
        WHEN _new IS NULL THEN {_row(dimension, "_old", KEEP)}
        WHEN _old IS NULL THEN {_row(dimension, "_new", INSERT)}
        ELSE {_row(dimension, "_old", UPDATE, **taken)} END AS _row"""
    pairs = _pair_up(dim, first_rows(incoming, dimension, load), dimension)
    return pairs.selectExpr(result).select("_row.*")


def _differs(dimension: Dimension, column: str) -> str:
    """Changed or not: no flag means false, no amount means zero, no text is a value of its own."""
    old, new, kind = f"_old.{column}", f"_new.{column}", dimension.kind(column)
    if kind == "boolean":
        return f"COALESCE({old}, FALSE) <> COALESCE({new}, FALSE)"
    if kind.startswith("decimal"):
        return f"COALESCE({old}, 0) <> COALESCE({new}, 0)"
    return f"NOT ({old} <=> {new})"


def scd2_merge(current: DataFrame, incoming: DataFrame, dimension: Dimension, load: Load) -> DataFrame:
    """Versioned merge of unique incoming rows into the current rows of a dimension.

    Unchanged rows stay exactly as they are, untracked columns included. A change in a tracked
    column closes the current row on the day of the load and opens the next version. Keys missing
    from ``incoming`` stay current. Result: the current rows and those closed now, plus
    ``_action``; opened rows have a null surrogate key. Earlier history is never read.
    """
    changed = " OR ".join(_differs(dimension, column) for column in dimension.tracked)
    kept = _row(dimension, "_old", KEEP)
    added = _row(dimension, "_new", INSERT)
    closed = _row(dimension, "_old", EXPIRE, scd_end_date="_new.scd_start_date", scd_is_current="FALSE")
    opened = _row(dimension, "_new", UPDATE, scd_version="_old.scd_version + 1")
    unfolded = f"""INLINE(CASE
        WHEN _new IS NULL THEN ARRAY({kept})
        WHEN _old IS NULL THEN ARRAY({added})
        WHEN {changed} THEN ARRAY({closed}, {opened})
        ELSE ARRAY({kept}) END)"""
    return _pair_up(current, first_rows(incoming, dimension, load), dimension).selectExpr(unfolded)


def action_counts(merged: DataFrame) -> DataFrame:
    """Rows per outcome of a merge."""
    return merged.groupBy("_action").agg(F.expr("COUNT(*) AS n_rows"))


def resolve_account_keys(accounts: DataFrame, dim_branches: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Branch and current customer key of each account; null where there is none."""
    branch = dim_branches.select("branch_id", "branch_key")
    owner = current_rows(dim_customers).select("customer_id", "customer_key")
    return accounts.join(branch, "branch_id", "left").join(owner, "customer_id", "left")
