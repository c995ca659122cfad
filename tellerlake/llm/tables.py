"""Reading the given tables, and scratch tables in the shared folder."""

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and read it back, so that no later use computes it again.

    Lost executors don't touch it. The files last as long as the frames that read them may, so only a
    caller that knows its frame is used up can ``discard`` it.
    """
    path = f"{shared_dir(df.sparkSession)}/tellerlake-llm/{uuid.uuid4()}"
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.scratch_path = path
    return stored


def discard(stored: DataFrame) -> None:
    """Delete a stored frame that nothing will read any more."""
    spark = stored.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(stored.scratch_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id, modulus: int, remainder: int):
    """Whether crc32 of the id as text leaves the remainder; null ids count as not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now. It does so when the driver's JVM collects
    the plans that they belong to, which on a large heap can be long after they have filled the disks."""
    gc.collect()
    spark._jvm.System.gc()


FLAG_BITS = 20


def flags(df: DataFrame, key: str) -> np.ndarray:
    """Which leading bits occur among 64-bit keys: a table of fixed size, however many keys there are."""
    leading = df.select(F.shiftrightunsigned(key, 64 - FLAG_BITS).cast("int").alias("bits")).distinct()
    found = np.zeros(1 << FLAG_BITS, bool)
    found[leading.toArrow().column("bits").to_numpy()] = True
    return np.packbits(found)


def unpacked(marks: np.ndarray) -> np.ndarray:
    return np.unpackbits(marks).astype(bool)


def may_hold(keys: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which keys may be among those flagged; never false for one that is."""
    return found[(keys.view(np.uint64) >> np.uint64(64 - FLAG_BITS)).astype(np.int64)]


def flagged(key: str | Column, marks: np.ndarray) -> Column:
    """The column of ``may_hold`` over a column of keys; null keys are not held."""

    @F.arrow_udf("boolean")
    def held(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found = unpacked(marks)
        for keys in batches:
            yield pa.array(may_hold(keys.fill_null(0).to_numpy(zero_copy_only=False), found))

    return F.coalesce(held(key), F.lit(False))
