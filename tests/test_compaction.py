import datetime

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tellerlake.plans import gold
from tellerlake.sources import tables
from tellerlake.sources.slices import Run

MONTHS = {1: (1, 2), 2: (1,), 3: (1, 2), 4: (1, 3), 5: (1, 2)}


def load(spark, root, version, commit=True):
    """One load: three facts for each month it writes to."""
    rows = [
        {"transaction_key": version * 100 + month * 10 + k, "transaction_id": f"{version}-{month}-{k}", "account_key": 9 - k,
         "transaction_date": datetime.date(2024, month, version), "transaction_year": 2024, "transaction_month": month}
        for month in MONTHS[version] for k in range(3)
    ]
    names = gold.STORED_FACT.names
    facts = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], gold.STORED_FACT)
    tables.overwrite(facts, f"{root}/{gold.FACT}/version={version}", partitions=gold.FACT_PARTITIONS)
    if commit:
        tables.commit(spark, root, gold.FACT, version, f"b{version}", len(rows))


def ids(spark, root):
    return sorted(r[0] for r in gold.read_fact(spark, root).select("transaction_id").collect())


def expected(*versions):
    return sorted(f"{v}-{m}-{k}" for v in versions for m in MONTHS[v] for k in range(3))


def files(spark, root, month):
    rows = gold.read_fact(spark, root).filter(f"transaction_month = {month}")
    return rows.select(F.input_file_name()).distinct().count()


def test_compacted_months_hold_the_same_rows_in_fewer_files(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    assert gold.compact_facts(spark, root, "c0") == 0
    for version in (1, 2, 3):
        load(spark, root, version)
    before = as_set(gold.read_fact(spark, root))
    many = files(spark, root, 1)
    with monkeypatch.context() as patched:
        patched.setattr(Run, "commit", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            gold.compact_facts(spark, root, "c1", least=3)
    assert as_set(gold.read_fact(spark, root)) == before and files(spark, root, 1) == many >= 3
    assert gold.compact_facts(spark, root, "c1", least=3) == 1
    assert as_set(gold.read_fact(spark, root)) == before
    assert files(spark, root, 1) == 1 and files(spark, root, 2) >= 2
    assert gold.compact_facts(spark, root, "c1", least=1) == 0

    load(spark, root, 4)
    load(spark, root, 5, commit=False)
    assert ids(spark, root) == expected(1, 2, 3, 4)
    tables.commit(spark, root, gold.FACT, 5, "b5")
    assert ids(spark, root) == expected(1, 2, 3, 4, 5)
    # January was last compacted at version 3, February never: both took enough loads since, March did not.
    assert gold.compact_facts(spark, root, "c2", least=2) == 2
    assert ids(spark, root) == expected(1, 2, 3, 4, 5)
    assert [files(spark, root, month) for month in (1, 2)] == [1, 1]
