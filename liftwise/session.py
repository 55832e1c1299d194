"""Session settings and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. Shuffle partition counts are left to the
# cluster: AQE merges small partitions and splits skewed ones from there.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splitting a hot join key is worth the extra exchange it may cost.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# For the campaign tables, unless the session has its own values. Lines, transactions and
# their aggregates take some twenty times as much memory in a task as in a shuffle, so what one
# task reads is kept small: many partitions first, of which adaptive execution merges the
# smallest. Both matter: with few partitions to start from, a task grows with the input.
PARTITIONS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def small_partitions(spark: SparkSession) -> SparkSession:
    """Bound what a task of a large shuffle reads, whatever the size of the tables."""
    for key, value in PARTITIONS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else may have built."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "liftwise", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
        .config("spark.driver.memory", "20g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: `spark.checkpoint.dir`, as the cluster set it.

    Only a local session without the setting gets a folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="liftwise-"))
    return context.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; nothing is written to it yet."""
    return f"{shared_dir(spark)}/scratch/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so later stages see fixed rows
    in fixed partitions even when executors are lost."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, as --py-files would; once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for p in sorted(root.rglob("*.py")):
            out.write(p, p.relative_to(root.parent))
    # Code, not data: Spark copies the file to the executors.
    path = Path(tempfile.mkdtemp(prefix="package-")).resolve() / f"{root.name}.zip"
    path.write_bytes(packed.getvalue())
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)
