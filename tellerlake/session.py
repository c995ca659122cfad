"""Session defaults for standalone runs, and the shared folder used to cut lineage."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# Shuffled bytes one task should start with, before adaptive execution merges small partitions.
TASK_BYTES = 128 * 1024 * 1024


def build_session(app_name: str = "tellerlake", shuffle_bytes: int | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on and UTC dates.

    ``shuffle_bytes`` is the expected size of the largest shuffle, about that of the transactions:
    shuffles then start with enough partitions for it and adaptive execution merges what turns out
    small. Without it Spark's own number holds, which is too low for very large tables. Joins whose
    smaller side turns out to fit a task's memory partition by partition are hashed instead of
    sorted; the sizes are those of the finished shuffle, and larger ones still sort.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.compression.codec", "snappy")
    )
    if shuffle_bytes is not None:
        partitions = min(max(shuffle_bytes // TASK_BYTES, 200), 1_000_000)
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a
    temporary folder, because on a cluster executors could not read it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tellerlake-"))
    return context.getCheckpointDir()


def materialise(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write the frame once; later uses read the columns they need from there.

    It goes to ``path``, replacing what is there, or to a new place in the shared folder.
    """
    path = path or f"{shared_dir(df.sparkSession)}/tellerlake/{uuid.uuid4()}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def empty_frame(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """No rows, as a plan that the optimiser knows to be empty: joins with it cost nothing."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))


# More rows than this are handed over as data instead of as literals of the plan.
LITERAL_ROWS = 200


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows made by the driver, such as those of a commit, in one partition and without a Python worker."""
    if not rows or len(rows) > LITERAL_ROWS:
        return spark.createDataFrame(rows, schema).coalesce(1)
    fields = StructType.fromDDL(schema).fields
    structs = [F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields))) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern matches anything, on any file system Spark is set up for."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop_path)
    return found is not None and len(found) > 0
