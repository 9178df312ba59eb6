"""Session defaults and the shared scratch folder."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "8", name: str = "tideline") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_own_root: list[str] = []


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, visible to every executor.

    Only a local session without that setting falls back to a temporary folder.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        if not _own_root:
            _own_root.append(tempfile.mkdtemp(prefix="tideline-"))
        root = _own_root[0]
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df):
    """Write ``df`` to the shared folder and read it back.

    Used where one frame feeds several jobs (a learner's folds, a search): the
    upstream joins and windows run once, and a lost executor costs a re-read.
    """
    spark = df.sparkSession
    path = shared_folder(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
