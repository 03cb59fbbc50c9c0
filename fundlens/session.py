"""Spark session factory and lineage helpers."""

from __future__ import annotations

import io
import os
import re
import tempfile
import zipfile

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(app: str = "fundlens", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings every query expects (UTC, AQE, Arrow)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return (
        b.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and continue from the files.

    The folder is the one the cluster names in ``spark.checkpoint.dir`` (see ``shared_folder``).
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(sc))
    return df.checkpoint(eager=True)


def shared_folder(sc: SparkContext) -> str:
    """``spark.checkpoint.dir``; only a local master, where there is one machine, may go without and gets a temporary folder."""
    named = sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every node can reach")
    return tempfile.mkdtemp(prefix="fundlens-")


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast of ``df`` only after counting that it has at most ``max_rows`` rows.

    The count stops after ``max_rows + 1`` rows.  A larger side is returned without a
    hint: Spark then shuffles the join and AQE splits skewed keys.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that it need not be installed there.

    The archive lies in the shared folder (see ``shared_folder``).
    """
    sc = spark.sparkContext
    if getattr(sc, "_fundlens_shipped", None) == sc.applicationId:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("fundlens", os.path.relpath(full, root)))
    shared = shared_folder(sc)
    path = sc._jvm.org.apache.hadoop.fs.Path(shared, f"fundlens-{sc.applicationId}.zip")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(buffer.getvalue()))
    out.close()
    sc.addPyFile(path.toString())
    sc._fundlens_shipped = sc.applicationId
