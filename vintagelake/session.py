"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    # Dates become timestamps at UTC midnight everywhere.
    "spark.sql.session.timeZone": "UTC",
    # A month rewrite must only replace the months it carries.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Split a hot join key even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on; tuning stays with the cluster."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build(master: str, app: str = "vintagelake", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by spark.checkpoint.dir.

    Only a local session without the setting (tests, a laptop) gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that is no longer read."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def staged(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Compute df once into the shared folder: its rows read back, and the folder for discard()."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame) -> DataFrame:
    """Rows that no longer depend on what they were computed from."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()
