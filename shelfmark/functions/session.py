"""What an operator needs of the session: table access and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, where intermediate rows outlive an executor; only a session without any (a test) gets a local one."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="shelfmark-"))
    return sc._jsc.sc().getCheckpointDir().get()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Writes the rows to the shared folder and goes on from there, so that a lost executor costs one re-read."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per context, for sessions whose workers cannot import it."""
    import os
    import zipfile

    import shelfmark

    sc = spark.sparkContext
    if getattr(sc, "_shelfmark_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(shelfmark.__file__))
    at = os.path.join(tempfile.mkdtemp(prefix="shelfmark-"), "shelfmark.zip")
    with zipfile.ZipFile(at, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("shelfmark", os.path.relpath(full, root)))
    sc.addPyFile(at)
    sc._shelfmark_shipped = True
