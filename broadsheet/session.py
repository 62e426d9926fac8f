"""Session settings and the reliable cut of long lineages."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Session with adaptive execution on; master and sizes are left to the cluster unless given."""
    builder = (
        SparkSession.builder.appName("broadsheet")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", "12g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers, wherever they start; Spark distributes the archive. Once per session."""
    name = "broadsheet-package.zip"
    if any(f.endswith(name) for f in spark.sparkContext.listFiles):
        return
    root, at = Path(__file__).resolve().parent, Path(tempfile.mkdtemp(prefix="broadsheet-ship-")) / name
    with zipfile.ZipFile(at, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(at))


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see. The cluster names it in spark.checkpoint.dir; local runs get a temporary one."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    current = sc.getCheckpointDir()
    if current:
        return current
    if sc.master != "local" and not sc.master.startswith("local["):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="broadsheet-"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and read it back, so that lost executors never force a recompute."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back.

    For loops: a checkpoint hands on what the optimiser knows of its columns, which grows with every round; a table does not."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
