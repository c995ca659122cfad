"""Bounded samples of labelled rows, for fitting classifiers on the driver."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Hash values that thresholds divide.
_FINE = 1 << 30


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``docs`` with a column ``label`` of 0 or 1: rows of ``labels`` whose label is null are left out.

    A document labelled twice comes twice.
    """
    known = labels.where(F.col(label).isNotNull()).select(
        F.col("doc_id").alias("_doc"), (F.col(label) != 0).cast("int").alias("label")
    )
    return docs.join(known, F.col("doc_id") == F.col("_doc")).drop("_doc")


def bounded(rows: DataFrame, labels: DataFrame, label: str, most: dict[int, int]) -> DataFrame:
    """The share of ``rows`` (with ``label`` and ``doc_id``) that leaves ``most[k]`` of class k, about.

    The share comes from the count of labels, the choice from a hash of the id: the same rows in every
    run. A limit of twice the number wards off ids that hash badly, such as one repeated often.
    """
    counts = dict(labels.where(F.col(label).isNotNull()).groupBy((F.col(label) != 0).cast("int")).count().collect())
    spot = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(_FINE))
    parts = []
    for k, n in most.items():
        share = min(1.0, n / max(counts.get(k, 0), 1))
        parts.append(rows.where((F.col("label") == k) & (spot < int(share * _FINE))).limit(2 * n))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out
