"""Session helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "sievemill", cores: str = "*", **conf: str) -> SparkSession:
    """A session for local runs; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Let the Python workers import this package.

    The package's parent folder is put on the workers' PYTHONPATH. On a
    cluster without a shared folder, install the package on the nodes.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for data that must outlive an executor: that of ``spark.checkpoint.dir``.

    Only a session on one machine (tests) may name none and gets a temporary
    folder; on a cluster that is an error.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="sievemill-")


def scratch(spark: SparkSession) -> str:
    """A new folder below :func:`shared_folder`."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in :func:`shared_folder`."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=eager)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
