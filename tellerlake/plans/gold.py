"""Gold tables: loading dimensions, facts and snapshots into committed versions.

A load whose batch is already committed does nothing, so a run that stopped half way is repeated
with the same batch id and continues where it stopped.
"""

import json
import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tellerlake import schemas
from tellerlake.operators import changes, dims, facts, keys, scd, snapshots
from tellerlake.operators.scd import Dimension, Load
from tellerlake.plans import incremental
from tellerlake.session import empty_frame, materialise
from tellerlake.sources import slices, tables
from tellerlake.sources.slices import Run

log = logging.getLogger(__name__)

FACT = "fact_transactions"
FACT_PARTITIONS = ("transaction_year", "transaction_month")
MONTH_OF_FACT = "FORMAT_STRING('%04d-%02d', transaction_year, transaction_month)"
STORED_FACT = StructType(
    [*schemas.FACT_TRANSACTIONS.fields, *(StructField(name, IntegerType()) for name in FACT_PARTITIONS)]
)
SNAPSHOTS = "fact_account_snapshots"
DAYS, BALANCES = "days", "balances"
FACT_KEYS, REJECTS = "fact_keys", "fact_rejects"
COMPACTED, MONTHS = "fact_compacted", "months"
CALENDAR, TYPES = "dim_date", "dim_transaction_type"


def read_whole(spark: SparkSession, root: str, table: str, schema: StructType) -> DataFrame:
    """The committed rows of a table that each load replaces."""
    last = tables.last_commit(spark, root, table)
    if last is None:
        return empty_frame(spark, schema)
    return tables.read_version(spark, root, table, last.version, schema)


def read_type1(spark: SparkSession, root: str, dimension: Dimension) -> DataFrame:
    return read_whole(spark, root, dimension.name, dimension.schema)


def read_types(spark: SparkSession, root: str) -> DataFrame:
    return read_whole(spark, root, TYPES, schemas.DIM_TRANSACTION_TYPE)


def read_calendar(spark: SparkSession, root: str) -> DataFrame:
    return read_whole(spark, root, CALENDAR, schemas.DIM_DATE)


def read_type2(spark: SparkSession, root: str, dimension: Dimension, current_only: bool = False) -> DataFrame:
    """The committed rows of a versioned dimension, closed versions included unless unwanted."""
    last = tables.last_commit(spark, root, dimension.name)
    if last is None:
        return empty_frame(spark, dimension.schema)
    current = tables.read_version(spark, root, f"{dimension.name}/current", last.version, dimension.schema)
    if current_only:
        return current
    closed = tables.read_up_to(spark, root, f"{dimension.name}/closed", last.version, dimension.schema)
    return current.unionByName(closed)


def read_fact(spark: SparkSession, root: str) -> DataFrame:
    """Committed facts: compacted months as far as they go, and the versions after that."""
    last = tables.last_commit(spark, root, FACT)
    if last is None:
        return empty_frame(spark, STORED_FACT)
    compacted = slices.current(spark, f"{root}/{COMPACTED}", MONTHS, snapshot=last.version)
    if not compacted:
        return tables.read_up_to(spark, root, FACT, last.version, STORED_FACT)
    later = _versions(spark, root, last.version).filter(_not_compacted(compacted)).select(*STORED_FACT.names)
    whole = slices.read(spark, f"{root}/{COMPACTED}", MONTHS, STORED_FACT, snapshot=last.version)
    return whole.unionByName(later)


def _versions(spark: SparkSession, root: str, version: int) -> DataFrame:
    schema = StructType([*STORED_FACT.fields, StructField("version", LongType())])
    return spark.read.schema(schema).parquet(f"{root}/{FACT}").filter(f"version <= {version}")


def _not_compacted(compacted: dict[str, int]) -> str:
    """SQL over directory columns only, so it prunes: rows that no compacted month has."""
    through = {}
    for month, version in compacted.items():
        through.setdefault(version, []).append(month)
    held = (
        f"version <= {version} AND {MONTH_OF_FACT} IN ({', '.join(map(schemas.text_literal, sorted(months)))})"
        for version, months in sorted(through.items())
    )
    return " AND ".join(f"NOT ({part})" for part in held)


def compact_facts(spark: SparkSession, root: str, batch_id: str, least: int = 16) -> int:
    """Rewrite the months that at least ``least`` loads wrote to since their last compaction; returns how many.

    A month becomes a few files of a good size, sorted by account and day as each load's are. Rows, keys and versions
    of the table stay what they are. The months of a run become visible with one commit; one that dies leaves nothing
    that readers see. Other months are not read, beyond the footers that tell which loads wrote to them.
    """
    last = tables.last_commit(spark, root, FACT)
    place = f"{root}/{COMPACTED}"
    if last is None or slices.last_snapshot(spark, place) >= last.version:
        return 0
    compacted = slices.current(spark, place, MONTHS)
    loads = tables.read_if_present(spark, f"{root}/{FACT}", "version long, transaction_year int, transaction_month int")
    if loads is None:
        return 0
    loads = loads.filter(f"version <= {last.version}").filter(_not_compacted(compacted) if compacted else "TRUE")
    counted = loads.groupBy(F.expr(MONTH_OF_FACT).alias("month")).agg(F.expr("COUNT(DISTINCT version) AS n"))
    months = [row.month for row in counted.filter(f"n >= {least}").collect()]  # one entry a month
    if not months:
        return 0
    run = Run(spark, place, batch_id, snapshot=last.version)
    # On the directories' columns and the compacted slices' own: both sides of the union are pruned.
    rows = read_fact(spark, root).filter(F.expr(MONTH_OF_FACT).isin(months))
    run.replace(rows, MONTHS, MONTH_OF_FACT, months, ("account_key", "transaction_date", "transaction_time"))
    run.commit()
    return len(months)


def read_snapshots(spark: SparkSession, root: str) -> DataFrame:
    return slices.read(spark, f"{root}/{SNAPSHOTS}", DAYS, schemas.STORED_SNAPSHOT).drop("account_id")


def register_views(spark: SparkSession, root: str) -> None:
    """Temporary views of the committed tables, for SQL."""
    views = {
        CALENDAR: read_calendar(spark, root),
        TYPES: read_types(spark, root),
        scd.BRANCHES.name: read_type1(spark, root, scd.BRANCHES),
        scd.MERCHANTS.name: read_type1(spark, root, scd.MERCHANTS),
        scd.CUSTOMERS.name: read_type2(spark, root, scd.CUSTOMERS),
        scd.ACCOUNTS.name: read_type2(spark, root, scd.ACCOUNTS),
        FACT: read_fact(spark, root),
        REJECTS: read_rejects(spark, root),
        SNAPSHOTS: read_snapshots(spark, root),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def _next(spark: SparkSession, root: str, table: str, load: Load) -> tuple[object, int] | None:
    """Last commit and number of the next version, or None when the batch is already in."""
    last = tables.last_commit(spark, root, table)
    if last is not None and tables.holds_batch(spark, root, table, load.batch_id):
        log.info("%s already holds batch %s", table, load.batch_id)
        return None
    return last, 1 if last is None else last.version + 1


def load_seeds(spark: SparkSession, root: str, load: Load) -> None:
    """Write the calendar and the transaction types where that is not done yet."""
    if tables.last_commit(spark, root, CALENDAR) is None:
        tables.overwrite(dims.dim_date(spark).coalesce(1), f"{root}/{CALENDAR}/version=1")
        tables.commit(spark, root, CALENDAR, 1, load.batch_id)
    if tables.last_commit(spark, root, TYPES) is None:
        tables.overwrite(dims.dim_transaction_type(spark).coalesce(1), f"{root}/{TYPES}/version=1")
        tables.commit(spark, root, TYPES, 1, load.batch_id, max_key=len(dims.TRANSACTION_TYPES))


def load_dimension(spark: SparkSession, root: str, dimension: Dimension, incoming: DataFrame, load: Load) -> dict:
    """Merge silver rows into a dimension; returns how many rows were added and changed.

    Natural keys that come twice are refused before anything but staging is written. New keys are numbered above the
    highest one ever committed: closed versions keep theirs, though the merge does not read them.

    The incoming rows are staged once, for the check and the merge, and so is the merge result, for the keys and the
    two writes. Closed versions are only appended: a load rewrites the current rows and leaves all earlier history alone.
    """
    following = _next(spark, root, dimension.name, load)
    if following is None:
        return {"n_rows": 0, "inserted": 0, "updated": 0}
    last, version = following
    incoming = materialise(incoming, f"{root}/staging/{dimension.name}_incoming")
    twice = incoming.groupBy(dimension.natural).agg(F.expr("COUNT(*) AS n")).filter("n > 1").first()
    if twice is not None:
        raise ValueError(f"{dimension.name}: {dimension.natural} {twice[0]!r} comes {twice.n} times in {load.batch_id}")
    highest = last.max_key or 0 if last else 0
    versioned = bool(dimension.tracked)
    if last is None:
        rows = scd.first_rows(incoming, dimension, load).drop(dimension.surrogate)
        keyed = keys.number_rows(rows, dimension.natural, dimension.surrogate).select(*dimension.schema.names)
        keyed = keyed.selectExpr("*", f"'{scd.INSERT}' AS _action")
    else:
        before = read_type2(spark, root, dimension, current_only=True) if versioned else read_type1(spark, root, dimension)
        merge = scd.scd2_merge if versioned else scd.scd1_merge
        merged = materialise(merge(before, incoming, dimension, load), f"{root}/staging/{dimension.name}")
        if versioned:
            closed = merged.filter(f"_action = '{scd.EXPIRE}'").drop("_action")
            tables.overwrite(closed, f"{root}/{dimension.name}/closed/version={version}")
            merged = merged.filter(f"_action <> '{scd.EXPIRE}'")
        keyed = keys.assign_keys(merged, dimension.natural, dimension.surrogate, highest)
    folder = f"{dimension.name}/current" if versioned else dimension.name
    taken = tables.overwrite(
        keyed,
        f"{root}/{folder}/version={version}",
        f"MAX({dimension.surrogate}) AS max_key",
        f"COUNT_IF(_action = '{scd.INSERT}') AS inserted",
        f"COUNT_IF(_action = '{scd.UPDATE}') AS updated",
        hidden=("_action",),
    )
    highest = max(highest, taken["max_key"] or 0)
    tables.commit(spark, root, dimension.name, version, load.batch_id, taken["n_rows"], highest)
    return taken


def load_facts(
    spark: SparkSession,
    root: str,
    transactions: DataFrame,
    load: Load,
    late: str = "anti_join",
    versions: str = "current",
    source: int | None = None,
) -> dict:
    """Append the transactions that the fact table does not hold yet, with their keys.

    Every incoming row takes one route, in one write: it is loaded, known, undated or, with ``late="drop"``, late.
    Known rows are in the table; undated and late ones go to ``fact_rejects``. The parts have to add up to what was
    read before anything is committed. Which ids are known is looked up in the key blocks that the incoming ids fall
    in, so a load reads neither the fact nor keys that it can't need; the table's watermark and highest key come from
    the last commit. The watermark never passes the day of the load, so a row dated in the future does not shut later
    ones out. A batch that brings nothing writes nothing but its commit.

    ``source`` is the silver snapshot that the rows are of.
    """
    following = _next(spark, root, FACT, load)
    if following is None:
        return {"n_rows": 0}
    last, version = following
    day = last.watermark if last else facts.BEGINNING
    path = f"{root}/staging/{FACT}"
    blocks = transactions.selectExpr(f"{changes.block_of()} AS block").distinct().collect()
    known = read_fact_keys(spark, root, last.version if last else 0, {row.block for row in blocks})
    # The route is a column like others: a directory each would sort all rows by it, for a few to be told apart.
    counted = tables.overwrite(facts.routed(transactions, known, late, day), path, *(_count_of(r) for r in ROUTES))
    if counted["n_rows"] != sum(counted[route] for route in ROUTES):
        raise RuntimeError(f"{FACT}: routes do not add up: {counted}")
    staged_schema = StructType([*transactions.schema.fields, StructField("route", StringType())])
    staged = spark.read.schema(staged_schema).parquet(path)
    result = {"n_rows": counted[facts.LOAD]} | {route: counted[route] for route in ROUTES if route != facts.LOAD}
    max_key, reached = (last.max_key, day) if last else (0, day)
    run = Run(spark, root, load.batch_id, snapshot=version)
    left_out = (facts.UNDATED, facts.LATE)
    if sum(counted[route] for route in left_out):
        rejects = facts.rejected(staged.filter(F.col("route").isin(*left_out)), load)
        tables.overwrite(rejects, f"{root}/{REJECTS}/version={version}")
        log.warning("batch %s: not loaded: %s", load.batch_id, {route: counted[route] for route in left_out})
    if counted[facts.LOAD]:
        fresh = staged.filter(f"route = '{facts.LOAD}'").drop("route")
        taken = _append_facts(spark, root, fresh, load, versions, version, max_key)
        max_key, reached = taken["max_key"], max(min(taken["watermark"], load.as_of), day)
        result |= {"without_account": taken["without_account"]}
        ids = fresh.select("transaction_id")
        touched = {row[0] for row in ids.selectExpr(changes.block_of()).distinct().collect()}
        held = read_fact_keys(spark, root, last.version if last else 0, touched)
        run.replace(held.union(ids), FACT_KEYS, changes.block_of(), touched)
    else:
        log.info("no new transactions in batch %s", load.batch_id)
    # The keys become readable with the fact's commit: they are read up to its version only.
    run.commit()
    tables.commit(spark, root, FACT, version, load.batch_id, counted[facts.LOAD], max_key, reached, source)
    return result


ROUTES = (facts.LOAD, facts.KNOWN, facts.UNDATED, facts.LATE)


def _count_of(route: str) -> str:
    return f"COUNT_IF(route = '{route}') AS {route}"


def _append_facts(
    spark: SparkSession, root: str, fresh: DataFrame, load: Load, versions: str, version: int, max_key: int
) -> dict:
    """Write the rows of one version of the fact table, clustered by account and day within each month."""
    resolved = facts.resolve_keys(
        fresh,
        read_type2(spark, root, scd.ACCOUNTS, current_only=versions == "current"),
        read_type1(spark, root, scd.MERCHANTS),
        read_types(spark, root),
        read_type1(spark, root, scd.BRANCHES),
        load,
        versions,
    )
    placed = tables.balanced(
        resolved.selectExpr(
            "*", "YEAR(transaction_date) AS transaction_year", "MONTH(transaction_date) AS transaction_month"
        ),
        *FACT_PARTITIONS,
    ).sortWithinPartitions(*FACT_PARTITIONS, "account_key", "transaction_date", "transaction_time")
    return tables.overwrite(
        facts.with_written_keys(placed, "transaction_key", max_key),
        f"{root}/{FACT}/version={version}",
        "MAX(transaction_key) AS max_key",
        "MAX(transaction_date) AS watermark",
        "COUNT_IF(account_key IS NULL) AS without_account",
        partitions=FACT_PARTITIONS,
    )


def read_fact_keys(spark: SparkSession, root: str, version: int, blocks: set[str] | None = None) -> DataFrame:
    """Ids that versions up to one loaded, of all blocks or some."""
    schema = StructType([schemas.FACT_TRANSACTIONS["transaction_id"]])
    return slices.read(spark, root, FACT_KEYS, schema, blocks, version)


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """What committed loads left out, with the reason."""
    last = tables.last_commit(spark, root, FACT)
    if last is None:
        return empty_frame(spark, schemas.FACT_REJECTS)
    return tables.read_up_to(spark, root, REJECTS, last.version, schemas.FACT_REJECTS)


def load_snapshots(spark: SparkSession, root: str, silver: str, load: Load) -> dict:
    """Bring the account snapshots up to the newest silver snapshot; returns how many days were written anew.

    Only days of accounts that silver changed are computed, from the months that they are in. An account's new days
    open with its stored last balance; a late or corrected day also reopens the day that follows it, wherever that
    is, and nothing else. Months without a moved row are not rewritten. Rows that stay keep their keys.
    """
    own = f"{root}/{SNAPSHOTS}"
    if slices.holds(spark, own, load.batch_id):
        return {"n_rows": 0}
    state = json.loads(slices.last_mark(spark, own) or '{"source": 0, "max_key": 0}')
    now = slices.last_snapshot(spark, silver)
    found = [incremental.read_changes(spark, silver, n) for n in range(state["source"] + 1, now + 1)]
    run = Run(spark, own, load.batch_id)
    moved = 0
    if found:
        touched = changes.touched_days(reduce(DataFrame.union, found)).filter("transaction_date IS NOT NULL")
        touched = materialise(touched, f"{own}/staging/touched")
        moved, state["max_key"] = _rechain(spark, root, silver, load, run, touched, now, state["max_key"])
    run.commit(mark=json.dumps({"source": now, "max_key": state["max_key"]}))
    return {"n_rows": moved}


def _rechain(
    spark: SparkSession, root: str, silver: str, load: Load, run: Run, touched: DataFrame, now: int, max_key: int
) -> tuple[int, int]:
    own = run.root
    months = {row[0] for row in touched.selectExpr(changes.month_of()).distinct().collect()}
    if not months:
        return 0, max_key
    later = {name for name in slices.current(spark, own, DAYS) if name >= min(months)}
    stored = slices.read(spark, own, DAYS, schemas.STORED_SNAPSHOT, later)
    blocks = {row[0] for row in touched.selectExpr(changes.block_of("account_id")).distinct().collect()}
    balance = StructType([schemas.STORED_SNAPSHOT["account_id"], schemas.STORED_SNAPSHOT["closing_balance"]])
    last = slices.read(spark, own, BALANCES, balance, blocks)

    days, on_same_day = changes.same_day(touched)
    rows = incremental.read_transactions(spark, silver, sorted(months), now).join(days, on_same_day, "left_semi")
    accounts = read_type2(spark, root, scd.ACCOUNTS, current_only=True)
    fresh = snapshots.new_days(snapshots.account_days(rows), accounts, load)
    base = materialise(snapshots.bases(stored, touched, last), f"{own}/staging/base")
    chain = materialise(snapshots.chained(stored, touched, fresh, base), f"{own}/staging/chain")

    # Days that are new to the table are numbered above all keys given out so far.
    day_id = "CONCAT_WS('|', CAST(snapshot_date AS STRING), account_id) AS _day_id"
    unnumbered = chain.filter("snapshot_key IS NULL").selectExpr("*", day_id)
    numbered = keys.number_rows(unnumbered, "_day_id", "snapshot_key", F.lit(max_key)).drop("_day_id")
    taken = unnumbered.count()
    whole = materialise(
        chain.filter("snapshot_key IS NOT NULL").unionByName(numbered.select(*chain.columns)), f"{own}/staging/whole"
    )
    month = changes.month_of("snapshot_date")
    rewritten = {row[0] for row in whole.filter("_moved").selectExpr(month).distinct().collect()} | (months & later)
    others = slices.read(spark, own, DAYS, schemas.STORED_SNAPSHOT, rewritten).join(
        base, F.expr("account_id <=> _account"), "left_anti"
    )
    mine = whole.filter(F.expr(month).isin(sorted(rewritten))).drop("_moved")
    run.replace(others.unionByName(mine), DAYS, month, rewritten)
    ends = snapshots.closing_balances(chain, base)
    kept = last.join(base, F.expr("account_id <=> _account"), "left_anti")
    run.replace(kept.unionByName(ends), BALANCES, changes.block_of("account_id"), blocks)
    return whole.filter("_moved").count(), max_key + taken
