"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators are written for; on a cluster put them in the submit configuration.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("callspark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a
    temporary folder, because there the driver and the executors are one process.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="callspark-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoints ``df`` in the shared folder; partitions and their order stay.

    Spark computes the rows twice for it; :func:`written` computes them once.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Writes ``df`` as Parquet below the shared checkpoint folder and goes on from the files.

    The rows are computed once; how they are dealt to partitions is not kept.
    """
    path, schema = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/written/{uuid.uuid4().hex}", df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    """Partitions for an explicit repartition: the shuffle setting, but no fewer than the cores."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """Deals the rows of a scan over all cores if it has fewer partitions than there are cores.

    Meant for work that is dear per row, such as text patterns or edit distances. A table of any
    size has more partitions than cores and is left as it is. Where short rows bring long work, bytes
    tell little of it: with ``rows_per_task`` the rows are counted, which a Parquet footer answers, and dealt
    over as many tasks as have so many each, but no fewer than the cores.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if rows_per_task:
        return df.repartition(max(cores, -(-df.count() // rows_per_task)))
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
