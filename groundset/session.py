"""Session defaults and the few helpers every part needs."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, memory: str = "4g") -> SparkSession:
    """A session with the defaults; an active one is returned as it is."""
    b = SparkSession.builder.master(master).appName("groundset").config("spark.driver.memory", memory)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    return b.config("spark.sql.shuffle.partitions", str(shuffle_partitions)).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data: one Parquet file or folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder for written intermediate data: spark.checkpoint.dir of the session, which all executors of a cluster share.

    Only a session on one machine, as in tests, may leave it unset and gets a folder of that
    machine. What lies in the folder is removed when the driver's JVM ends.
    """
    sc = spark.sparkContext
    jsc = sc._jsc.sc()
    if not jsc.getCheckpointDir().isDefined():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix=f"groundset-{os.getpid()}-"))
        made = sc._jvm.org.apache.hadoop.fs.Path(jsc.getCheckpointDir().get())
        made.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(made)
    return jsc.getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, for what is read more than once or by columns."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int, most: int) -> DataFrame:
    """Marked for broadcast if it has at most ``most`` rows; a larger side is joined by shuffle."""
    return F.broadcast(df) if rows <= most else df


def small_rows(df: DataFrame, bound: int, what: str) -> list:
    """The rows of a control table on the driver; more rows than the bound are an error, never cut off."""
    rows = df.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"{what} has more than {bound} rows; it isn't a control table")
    return rows


def ship(spark: SparkSession) -> None:
    """Send this package to the workers of a session, once; Spark serves the archive to executors that come later too."""
    sc = spark.sparkContext
    if getattr(sc, "_groundset_shipped", False):
        return
    root = Path(__file__).resolve().parent
    if root.is_dir():
        archive = Path(tempfile.mkdtemp(prefix="groundset-")) / "groundset.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(archive))
    sc._groundset_shipped = True
