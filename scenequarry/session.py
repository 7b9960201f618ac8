"""Session settings shared by the tests, the benchmark and the check tool."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "scenequarry", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session; on a cluster the submit configuration is used instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder named in ``spark.checkpoint.dir``; only a local master may fall back to a temp folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        path = tempfile.mkdtemp(prefix="scenequarry-ckpt-")
    sc.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table into the shared checkpoint folder and read it back.

    Lineage ends here and the loss of an executor costs nothing that was computed before. A written table is used rather
    than an RDD checkpoint because loops stay cheap to plan: a checkpointed frame carries the constraints of its old plan
    into every later round. The tables live under the application's own checkpoint folder.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
