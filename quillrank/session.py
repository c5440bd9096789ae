"""Session settings, checkpoint folder and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job of this package relies on. Sizes stay with the cluster's own configuration.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split of a hot join partition is worth one more exchange after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the settings above and send this package to the workers, whose Python functions import it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    sc = spark.sparkContext
    if getattr(sc, "_quillrank", None) is None:
        sc.addPyFile(_packed())
        sc._quillrank = True
    return spark


def _packed() -> str:
    """This package as a zip file; the driver serves it to the workers."""
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="quillrank-"), "quillrank.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(here)))
    return path


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quillrank")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a private one only on a local master."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="quillrank-")
    sc.setCheckpointDir(folder)
    return folder


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, for a table or a stream checkpoint of this run."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: ends the lineage and fixes rows and partitions."""
    sc = df.sparkSession.sparkContext
    folder = shared_dir(df.sparkSession)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table that several later steps read, and read it back.

    The table lies in the shared folder, so a lost executor costs no recomputation, and its real size is known to
    the planner of the next step. A frame that is such a table already is returned as it is.
    """
    if getattr(df, "_staged", False):
        return df
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._staged = True
    return table


def view(table: DataFrame, *columns) -> DataFrame:
    """Columns of a staged table; the result counts as staged still."""
    out = table.select(*columns)
    out._staged = getattr(table, "_staged", False)
    return out
