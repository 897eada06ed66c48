"""Session settings and the shared folder that written tables and checkpoints use."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings only, so they can be applied to a session somebody else created.
# AQE splits a hot join partition at run time; "force" lets it do so even where the split costs one
# more shuffle downstream, which is the right trade when one key holds a third of the rows.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Key-only rows are so narrow that tens of millions stay under the usual 256 MB.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PARTITIONS_PER_CORE = 3


def tune(spark: SparkSession) -> SparkSession:
    """Applies the runtime settings.

    On a cluster, shuffles start with a few partitions per core, however small the default number is; small
    ones are merged again at run time. A number somebody has set is left alone.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if not _is_local(spark) and spark.conf.get(INITIAL_PARTITIONS, None) is None:
        default = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
        spark.conf.set(INITIAL_PARTITIONS, str(max(default, wanted)))
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local")


def local_session(cpus: str | int = "*", app: str = "millrace") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Call sites in error messages cost a stack walk per expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-wh-"))
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="run-")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster such a folder exists on one
    machine alone.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_dir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A folder under :func:`shared_dir` that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: computed once, kept in the shared folder, safe when executors are lost."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
