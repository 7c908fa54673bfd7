"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", memory: str = "8g", **settings: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("snapfold")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores.replace("*", "8"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, the folder all executors share.

    Only a local session may do without the setting; it then uses a temporary folder.
    """
    name = "spark.checkpoint.dir"
    base = spark.conf.get(name, None) or spark.sparkContext.getConf().get(name)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="snapfold-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def saved(df: DataFrame, folder: str) -> DataFrame:
    """Write a DataFrame to a shared folder and read it back, which cuts its lineage.

    What reads it more than once does not compute it again, and its true size is known.
    """
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
