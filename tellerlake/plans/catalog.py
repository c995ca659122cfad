"""The query catalogue: every operator run over the stand-in views of the test tables."""

import datetime
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession

from tellerlake import schemas
from tellerlake.functions import bands, calendar, ids
from tellerlake.operators import dedup, dims, facts, keys, marts, quality, scd, silver, snapshots
from tellerlake.operators.velocity import with_daily_velocity
from tellerlake.plans import gold, incremental
from tellerlake.plans.standins import view
from tellerlake.session import materialise, path_exists, shared_dir
from tellerlake.sources import raw, slices, tables

Query = Callable[[SparkSession, str], DataFrame]

DAY_ONE = scd.Load("b1", datetime.date(2024, 1, 31), datetime.datetime(2024, 1, 31))
DAY_TWO = scd.Load("b2", datetime.date(2024, 2, 1), datetime.datetime(2024, 2, 1))

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _all(parts: dict[str, DataFrame], label: str) -> DataFrame:
    """The rows of several frames, each labelled with its name."""
    labelled = [frame.selectExpr(f"'{name}' AS {label}", "*") for name, frame in parts.items()]
    return reduce(DataFrame.union, labelled)


def _silver_accounts(spark: SparkSession, sf_dir: str, name: str = "accounts_in") -> DataFrame:
    return silver.accounts(view(spark, sf_dir, name), DAY_TWO.as_of)


def _silver_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.transactions(view(spark, sf_dir, "transactions_in"))


def _valid_transactions(spark: SparkSession, sf_dir: str, name: str = "transactions_in") -> DataFrame:
    """Silver transactions where velocity is not needed."""
    return silver.valid_transactions(view(spark, sf_dir, name))


# The gold dimensions after two days of loads


def _opened(incoming: DataFrame, dimension: scd.Dimension) -> DataFrame:
    """The first load of a dimension: every row is new."""
    rows = scd.first_rows(incoming, dimension, DAY_ONE).drop(dimension.surrogate)
    return keys.number_rows(rows, dimension.natural, dimension.surrogate)


def _keyed(merged: DataFrame, dimension: scd.Dimension) -> DataFrame:
    return keys.assign_keys(materialise(merged), dimension.natural, dimension.surrogate)


def _scd1(spark: SparkSession, sf_dir: str, dimension: scd.Dimension, clean) -> DataFrame:
    """An overwritten dimension after two days."""
    table = dimension.name.removeprefix("dim_")
    first, second = (clean(view(spark, sf_dir, f"{table}_day{n}")) for n in (1, 2))
    return _keyed(scd.scd1_merge(_opened(first, dimension), second, dimension, DAY_TWO), dimension)


def _scd2(first: DataFrame, second: DataFrame, dimension: scd.Dimension) -> DataFrame:
    """A versioned dimension after two days, every version included."""
    return _keyed(scd.scd2_merge(_opened(first, dimension), second, dimension, DAY_TWO), dimension)


def _branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd1(spark, sf_dir, scd.BRANCHES, silver.branches)


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = (silver.customers(view(spark, sf_dir, f"customers_day{n}")) for n in (1, 2))
    return _scd2(first, second, scd.CUSTOMERS)


def _accounts(spark: SparkSession, sf_dir: str, branches: DataFrame, customers: DataFrame) -> DataFrame:
    """Accounts of each day carry the keys their branch and customer had on that day."""
    early_branches = branches.filter(f"_action <> '{scd.INSERT}'")
    early_customers = customers.filter(f"scd_start_date = {schemas.day_literal(DAY_ONE.as_of)}").selectExpr(
        "customer_id", "customer_key", "TRUE AS scd_is_current"
    )
    first, second = (_silver_accounts(spark, sf_dir, f"accounts_day{n}") for n in (1, 2))
    return _scd2(
        scd.resolve_account_keys(first, early_branches, early_customers),
        scd.resolve_account_keys(second, branches, customers),
        scd.ACCOUNTS,
    )


@dataclass
class _Star:
    """The stored dimension tables."""

    branches: DataFrame
    merchants: DataFrame
    customers: DataFrame
    accounts: DataFrame
    types: DataFrame

    def resolve(self, transactions: DataFrame, versions: str = "current") -> DataFrame:
        resolved = facts.resolve_keys(
            transactions, self.accounts, self.merchants, self.types, self.branches, DAY_TWO, versions
        )
        return resolved.drop("transaction_key", "dw_loaded_at")


_STORED: dict[tuple[str, str], dict[str, DataFrame]] = {}


def stored_dimensions(spark: SparkSession, sf_dir: str) -> _Star:
    """The gold dimensions, loaded on first use and kept in the shared folder for the session."""
    at = (spark.sparkContext.applicationId, sf_dir)
    stored = _STORED.get(at, {})
    if not stored or not all(path_exists(spark, frame.inputFiles()[0]) for frame in stored.values()):
        stored = {
            "branches": materialise(_branches(spark, sf_dir)),
            "merchants": materialise(_scd1(spark, sf_dir, scd.MERCHANTS, silver.merchants)),
            "customers": materialise(_customers(spark, sf_dir)),
        }
        stored["accounts"] = materialise(_accounts(spark, sf_dir, stored["branches"], stored["customers"]))
        _STORED[at] = stored
    return _Star(**stored, types=dims.dim_transaction_type(spark))


# Silver


@query
def silver_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.branches(view(spark, sf_dir, "branches_in"))


@query
def silver_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.merchants(view(spark, sf_dir, "merchants_in"))


@query
def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.customers(view(spark, sf_dir, "customers_in"))


@query
def silver_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_accounts(spark, sf_dir)


@query
def silver_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_transactions(spark, sf_dir)


@query
def txn_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Velocity of every transaction, those without a positive amount included."""
    typed = materialise(silver.typed_transactions(view(spark, sf_dir, "transactions_in")))
    rows = with_daily_velocity(typed.selectExpr("*", f"{bands.is_completed('status')} AS is_completed"))
    return rows.select("transaction_id", "account_id", "transaction_date", "daily_txn_count", "daily_spend_total")


@query
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "transactions_in")
    return dedup.latest_by_key(rows, "transaction_id").select("transaction_id", "status", "_ingestion_ts", "_batch_id")


@query
def orphan_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = silver.customers(view(spark, sf_dir, "customers_in"))
    return quality.orphans(_silver_accounts(spark, sf_dir), customers, "customer_id").select(
        "account_id", "customer_id"
    )


@query
def orphan_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    transactions = _valid_transactions(spark, sf_dir).select("transaction_id", "account_id")
    return quality.orphans(transactions, _silver_accounts(spark, sf_dir), "account_id").select(
        "transaction_id", "account_id"
    )


@query
def orphan_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    branches = silver.branches(view(spark, sf_dir, "branches_in"))
    return quality.orphans(_silver_accounts(spark, sf_dir), branches, "branch_id").select("account_id", "branch_id")


@query
def orphan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    accounts = _silver_accounts(spark, sf_dir)
    customers = silver.customers(view(spark, sf_dir, "customers_in"))
    branches = silver.branches(view(spark, sf_dir, "branches_in"))
    transactions = _valid_transactions(spark, sf_dir)
    checks = {
        "accounts_without_customer": quality.orphan_count(accounts, customers, "customer_id"),
        "transactions_without_account": quality.orphan_count(transactions, accounts, "account_id"),
        "accounts_without_branch": quality.orphan_count(accounts, branches, "branch_id"),
    }
    return _all(checks, "check_name")


@query
def decline_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = quality.decline_rate(_valid_transactions(spark, sf_dir))
    return rates.withColumn("decline_rate_pct", rates.decline_rate_pct.cast("decimal(7,4)"))


@query
def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every silver table."""
    tables = {
        "branches": silver.branches(view(spark, sf_dir, "branches_in")),
        "merchants": silver.merchants(view(spark, sf_dir, "merchants_in")),
        "customers": silver.customers(view(spark, sf_dir, "customers_in")),
        "accounts": _silver_accounts(spark, sf_dir),
        "transactions": _valid_transactions(spark, sf_dir),
    }
    return _all({name: table.selectExpr("COUNT(*) AS n_rows") for name, table in tables.items()}, "table_name")


@query
def active_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = _silver_accounts(spark, sf_dir).filter("status = 'Active'")
    return active.select("account_id", "account_type", "account_age_days", "has_overdraft")


@query
def derived_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debit, weekend and season flags, signed amounts and ids rebuilt from their number."""
    rows = silver.typed_transactions(view(spark, sf_dir, "transactions_in"))
    is_debit = bands.is_debit_type("transaction_type")
    return rows.selectExpr(
        "transaction_id",
        f"{ids.id_number('transaction_id')} AS id_number",
        f"{ids.format_id('transactions', ids.id_number('transaction_id'))} AS rebuilt_id",
        f"{is_debit} AS is_debit_type",
        f"{bands.signed_amount('amount', is_debit)} AS signed_amount",
        f"{calendar.is_weekend('transaction_date')} AS weekend",
        f"{calendar.is_holiday_season('transaction_date')} AS holiday_season",
        f"{calendar.date_stamp('transaction_date')} AS date_stamp",
        f"{ids.short_reference('description')} AS short_reference",
        "TO_JSON(NAMED_STRUCT('channel', channel, 'status', status)) AS metadata",
    )


@query
def branch_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver.branches(view(spark, sf_dir, "branches_in"))
    return rows.selectExpr("branch_id", "city", f"{bands.branch_region('city')} AS region_by_city")


# Dimensions


@query
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar with the transactions of each day."""
    per_day = (
        _valid_transactions(spark, sf_dir)
        .selectExpr(f"{calendar.date_key('transaction_date')} AS date_key")
        .groupBy("date_key")
        .count()
    )
    days = dims.dim_date(spark)
    return days.join(per_day, "date_key", "left").selectExpr(*days.columns, "COALESCE(count, 0L) AS txn_count")


@query
def dim_transaction_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seeded types with the transactions of each."""
    per_type = spark.sql(
        """SELECT transaction_type AS txn_type_name, COUNT(*) AS n,
                  CAST(SUM(CAST(amount AS DECIMAL(15,2))) AS DECIMAL(18,2)) AS total
           FROM {rows} GROUP BY transaction_type""",
        rows=_valid_transactions(spark, sf_dir),
    )
    types = dims.dim_transaction_type(spark)
    counted = types.join(per_type, "txn_type_name", "left")
    return counted.selectExpr(*types.columns, "COALESCE(n, 0L) AS txn_count", "total")


@query
def scd1_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _branches(spark, sf_dir).drop("dw_created_at")


@query
def scd1_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd1(spark, sf_dir, scd.MERCHANTS, silver.merchants).drop("dw_created_at")


@query
def scd2_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customers(spark, sf_dir).drop("dw_created_at")


@query
def scd2_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = materialise(_branches(spark, sf_dir)), materialise(_customers(spark, sf_dir))
    return _accounts(spark, sf_dir, *parents).drop("dw_created_at")


@query
def scd2_action_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept, added, closed and reopened by the second day, per dimension."""
    star = stored_dimensions(spark, sf_dir)
    counts = {"dim_customers": scd.action_counts(star.customers), "dim_accounts": scd.action_counts(star.accounts)}
    return _all(counts, "table_name").withColumnRenamed("_action", "outcome")


@query
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver.customers(view(spark, sf_dir, "customers_in")).select("customer_id")
    return keys.number_rows(rows, "customer_id", "customer_key")


# Facts


@query
def fact_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.watermark(_valid_transactions(spark, sf_dir, "transactions_loaded"))


@query
def fact_incremental_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load takes after everything up to the watermark was loaded; late rows are lost."""
    incoming = _valid_transactions(spark, sf_dir)
    loaded = _valid_transactions(spark, sf_dir, "transactions_loaded")
    return facts.not_yet_loaded(incoming, loaded, late="drop").select("transaction_id", "transaction_date")


@query
def fact_incremental_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load keeping late rows."""
    incoming = _valid_transactions(spark, sf_dir)
    loaded = _valid_transactions(spark, sf_dir, "transactions_loaded")
    return facts.not_yet_loaded(incoming, loaded, late="anti_join").select("transaction_id", "transaction_date")


@query
def fact_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_dimensions(spark, sf_dir).resolve(_silver_transactions(spark, sf_dir))


@query
def fact_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with the account version valid on their day; transactions are moved to span the change."""
    rows = _silver_transactions(spark, sf_dir)
    moved = rows.selectExpr(
        *(n for n in rows.columns if n != "transaction_date"), "DATE_ADD(transaction_date, 15) AS transaction_date"
    )
    resolved = stored_dimensions(spark, sf_dir).resolve(moved, versions="as_of")
    return resolved.select("transaction_id", "transaction_date", "account_key", "customer_key", "branch_key")


@query
def account_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    accounts = stored_dimensions(spark, sf_dir).accounts
    days = snapshots.account_snapshots(_valid_transactions(spark, sf_dir), accounts, DAY_TWO)
    return days.drop("snapshot_key", "dw_loaded_at")


# Marts and reports


def _facts_of(spark: SparkSession, sf_dir: str) -> tuple[_Star, DataFrame]:
    star = stored_dimensions(spark, sf_dir)
    return star, star.resolve(_silver_transactions(spark, sf_dir))


@query
def mart_customer_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    star, fact = _facts_of(spark, sf_dir)
    return marts.customer_360(fact, star.customers, star.accounts)


@query
def mart_fraud_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, fact = _facts_of(spark, sf_dir)
    return marts.fraud_signals(fact)


@query
def mart_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    star, fact = _facts_of(spark, sf_dir)
    return marts.daily_transaction_summary(fact, star.types)


@query
def report_customer_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_report(mart_customer_360(spark, sf_dir))


@query
def report_customer_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's option of a first page."""
    return marts.customer_report(mart_customer_360(spark, sf_dir), rows=100)


@query
def report_fraud_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fraud_report(mart_fraud_signals(spark, sf_dir))


@query
def report_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last five days up to mid-January, selected by SQL text."""
    return marts.summary_report(mart_daily_summary(spark, sf_dir), datetime.date(2024, 1, 15), days=5)


# Appends, ids, quality


@query
def append_new_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of the second day appended to those of the first; existing rows win."""
    first, second = (view(spark, sf_dir, f"customers_day{n}") for n in (1, 2))
    return dedup.append_new(second, first, "customer_id").select("customer_id", "email", "_batch_id")


@query
def next_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next free business id of each numbered table."""
    free = {}
    for entity in ("customers", "accounts", "transactions"):
        number = keys.next_id_number(view(spark, sf_dir, f"{entity}_in"), schemas.KEYS[entity])
        free[entity] = number.selectExpr("next_number", f"{ids.format_id(entity, 'next_number')} AS next_id")
    return _all(free, "entity")


@query
def derived_flags_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many delivered flags differ from what the date and the type imply."""
    rows = silver.typed_transactions(view(spark, sf_dir, "transactions_in"))
    checks = [
        quality.agrees("is_weekend", calendar.is_weekend("transaction_date")),
        quality.agrees("is_holiday_season", calendar.is_holiday_season("transaction_date")),
        quality.agrees("is_debit", bands.is_debit_type("transaction_type")),
    ]
    return quality.row_checks("transactions", rows, "transaction_id", checks)


@query
def dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The data-quality log over silver, the dimensions and the facts."""
    star = stored_dimensions(spark, sf_dir)
    transactions = materialise(_silver_transactions(spark, sf_dir))
    fact = star.resolve(transactions)
    days = snapshots.account_snapshots(transactions, star.accounts, DAY_TWO)
    accounts = materialise(_silver_accounts(spark, sf_dir))
    customers = silver.customers(view(spark, sf_dir, "customers_in"))
    branches = silver.branches(view(spark, sf_dir, "branches_in"))
    parts = [
        *quality.silver_results(transactions, accounts, customers, branches),
        *quality.gold_results(
            fact, days, star.accounts, star.customers, star.merchants, star.branches, star.types, dims.dim_date(spark)
        ),
    ]
    return quality.all_results(parts, DAY_TWO.loaded_at).drop("checked_at")


# Three days through the stored layers


FEED_DAYS = tuple(
    scd.Load(f"f{n}", datetime.date(2024, 5, n), datetime.datetime(2024, 5, n, 12)) for n in (1, 2, 3)
)
_LOADED: dict[tuple[str, str], str] = {}


def _load_day(spark: SparkSession, sf_dir: str, root: str, number: int, load: scd.Load) -> None:
    """One day's delivery through bronze, silver and gold; dimensions get their second delivery on the second day."""
    delivered = partial(view, spark, sf_dir, spread=True)
    feed = delivered(f"feed_day{number}").drop("_ingestion_ts", "_batch_id")
    placed = feed.selectExpr("*", "'transactions.csv' AS _source_file", "CAST(NULL AS BIGINT) AS _source_row_number")
    batch = raw.with_lineage(placed, load.batch_id, load.loaded_at)
    tables.append_bronze(batch, f"{root}/bronze", "transactions", load.batch_id)
    incremental.merge_transactions(spark, f"{root}/bronze", f"{root}/silver", load.batch_id)

    warehouse, delivery = f"{root}/gold", min(number, 2)
    gold.load_seeds(spark, warehouse, load)
    for dimension, clean in ((scd.BRANCHES, silver.branches), (scd.MERCHANTS, silver.merchants), (scd.CUSTOMERS, silver.customers)):
        table = dimension.name.removeprefix("dim_")
        gold.load_dimension(spark, warehouse, dimension, clean(delivered(f"{table}_day{delivery}")), load)
    accounts = scd.resolve_account_keys(
        silver.accounts(delivered(f"accounts_day{delivery}"), DAY_TWO.as_of),
        gold.read_type1(spark, warehouse, scd.BRANCHES),
        gold.read_type2(spark, warehouse, scd.CUSTOMERS, current_only=True),
    )
    gold.load_dimension(spark, warehouse, scd.ACCOUNTS, accounts, load)
    now = slices.last_snapshot(spark, f"{root}/silver")
    last = tables.last_commit(spark, warehouse, gold.FACT)
    changed = incremental.changed_transactions(spark, f"{root}/silver", last.source if last else 0, now)
    gold.load_facts(spark, warehouse, changed, load, source=now)
    gold.load_snapshots(spark, warehouse, f"{root}/silver", load)


def three_days(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a warehouse that took three deliveries, filled on first use in a session."""
    at = (spark.sparkContext.applicationId, sf_dir)
    root = _LOADED.get(at)
    if root is None or not path_exists(spark, root):
        root = f"{shared_dir(spark)}/tellerlake/days-{uuid.uuid4()}"
        for number, load in enumerate(FEED_DAYS, 1):
            _load_day(spark, sf_dir, root, number, load)
        _LOADED[at] = root
    return root


@query
def silver_three_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver transactions merged delivery by delivery: what a rebuild from all of them gives."""
    rows = incremental.read_transactions(spark, f"{three_days(spark, sf_dir)}/silver")
    return rows.drop("_ingestion_ts", "_batch_id")


@query
def gold_customers_three_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored customer dimension, every version; the third load brings what the second did."""
    return gold.read_type2(spark, f"{three_days(spark, sf_dir)}/gold", scd.CUSTOMERS).drop("dw_created_at")


@query
def gold_accounts_three_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.read_type2(spark, f"{three_days(spark, sf_dir)}/gold", scd.ACCOUNTS).drop("dw_created_at")


@query
def daily_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored facts: late rows included, each as it was and with the keys that were current when it was loaded."""
    fact = gold.read_fact(spark, f"{three_days(spark, sf_dir)}/gold")
    return fact.drop("transaction_key", "dw_loaded_at")


@query
def fact_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the loads left out, and why."""
    rows = gold.read_rejects(spark, f"{three_days(spark, sf_dir)}/gold")
    return rows.select("transaction_id", "account_id", "amount", "status", "reason", "dw_batch_id")


@query
def daily_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and watermark of every committed fact load."""
    commits = tables.commits(spark, f"{three_days(spark, sf_dir)}/gold")
    return commits.filter(f"table_name = '{gold.FACT}'").select("batch_id", "n_rows", "watermark")


@query
def snapshots_three_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances carried from day to day, late and corrected days included: what a build from all rows gives."""
    root = f"{three_days(spark, sf_dir)}/gold/{gold.SNAPSHOTS}"
    rows = slices.read(spark, root, gold.DAYS, schemas.STORED_SNAPSHOT)
    return rows.drop("snapshot_key", "account_key", "customer_key", "dw_loaded_at", "dw_batch_id")


# Bronze


def _csv_of(spark: SparkSession, sf_dir: str, entity: str) -> str:
    """The stand-in rows of a table as raw CSV in the shared folder, with null tokens for nulls."""
    path = f"{shared_dir(spark)}/tellerlake/raw-{uuid.uuid4()}/{entity}.csv"
    rows = view(spark, sf_dir, f"{entity}_in").drop("_ingestion_ts", "_batch_id")
    if entity == "customers":
        rows = rows.selectExpr("*", "'0' AS id_number")
    rows.write.option("header", True).option("nullValue", "N/A").csv(path)
    return path


@query
def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts written as raw CSV and read back as bronze rows."""
    rows = raw.read_raw(spark, "accounts", _csv_of(spark, sf_dir, "accounts"))
    bronze = raw.with_lineage(rows, DAY_TWO.batch_id, DAY_TWO.loaded_at)
    return bronze.drop("_source_file", "_source_row_number")


@query
def bronze_row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per table: rows, and whether each file's numbers run from 1 to its row count."""
    text = """SELECT SUM(n) AS n_rows, BOOL_AND(low = 1 AND high = n AND total * 2 = n * (n + 1)) AS dense
              FROM (SELECT COUNT(*) AS n, MIN(_source_row_number) AS low, MAX(_source_row_number) AS high,
                           SUM(_source_row_number) AS total FROM {rows} GROUP BY _source_file)"""
    checked = {}
    for entity in schemas.RAW_COLUMNS:
        rows = raw.read_raw(spark, entity, _csv_of(spark, sf_dir, entity))
        checked[entity] = spark.sql(text, rows=rows)
    return _all(checked, "table_name")


@query
def bronze_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchants as raw CSV with names over two lines, short and long records: what is read, and what is kept apart.

    Names over several lines are records like others; each has its number in the file.
    """
    path = f"{shared_dir(spark)}/tellerlake/raw-{uuid.uuid4()}"
    columns = schemas.RAW_COLUMNS["merchants"]
    lines = spark.sql(
        f"""SELECT n DIV 500 AS file, n, CASE WHEN n % 10 = 5 THEN CONCAT_WS(',', merchant_id, merchant_name)
                WHEN n % 10 = 7 THEN CONCAT(line, ',extra') ELSE line END AS line
            FROM (SELECT n, merchant_id, merchant_name, CONCAT_WS(',', merchant_id,
                         CASE WHEN n % 10 = 3 THEN CONCAT('"', merchant_name, '\n', 'and, sons"') ELSE merchant_name END,
                         merchant_category, mcc_code, is_online) AS line
                  FROM (SELECT *, CAST(SUBSTR(merchant_id, 4) AS BIGINT) AS n FROM {{merchants}}) m) l
            UNION ALL SELECT DISTINCT CAST(SUBSTR(merchant_id, 4) AS BIGINT) DIV 500, -1, '{",".join(columns)}' FROM {{merchants}}""",
        merchants=view(spark, sf_dir, "merchants_in"),
    )
    files = lines.repartition("file").sortWithinPartitions("file", "n")
    files.select("file", "line").write.partitionBy("file").text(path)
    read = raw.read_raw(spark, "merchants", f"{path}/*").selectExpr(
        "merchant_id", "merchant_name", "_source_row_number AS source_row_number", "'loaded' AS reason", "NULL AS record"
    )
    rejects = raw.read_rejects(spark, "merchants", f"{path}/*").selectExpr(
        "NULL AS merchant_id", "NULL AS merchant_name", "source_row_number", "reason", "record"
    )
    return read.unionByName(rejects)
