"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "cohortgrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    return builder.config(map=settings).getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Where the setting is missing a temporary folder serves, in local mode only:
    on a cluster no other machine could read it, so that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="cohortgrid-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder and read it back.

    The files survive the loss of any executor, and each later use reads them
    rather than running the plan again.
    """
    spark, schema = df.sparkSession, df.schema
    path = work_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)
