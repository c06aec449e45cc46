"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Where a session without ``spark.checkpoint.dir``, which is fixed at start, keeps its local folder.
LOCAL_WORK = "spark.plantlens.localWorkDir"


def get_session(app: str = "plantlens", master: str | None = None, **conf) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Only in local mode, where one machine is all there is, a missing setting
    is replaced by a local folder, recorded in the session so that later calls
    share it. On a cluster it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(LOCAL_WORK, None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="plantlens-")
        spark.conf.set(LOCAL_WORK, root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Survives the loss of any executor, unlike blocks cached on executors.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
