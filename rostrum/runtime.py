"""Session helpers shared by all operators."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names in ``spark.checkpoint.dir``; set an own one only where none is named."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    named = context.getConf().get("spark.checkpoint.dir")
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="rostrum-checkpoint-")
    context.setCheckpointDir(named)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` reliably to the shared checkpoint folder and go on from the written copy.

    Shuffle files of the job that made it are removed at its end.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str | None:
    """The checkpoint folder as a path, if it lies in a file system that executors read by path."""
    ensure_checkpoint_dir(spark)
    named = urlparse(spark.sparkContext._jsc.sc().getCheckpointDir().get())
    return unquote(named.path) if named.scheme in ("", "file") else None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a scan over all cores where it has fewer partitions than there are cores (one small file); a larger scan stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def ship(spark: SparkSession) -> None:
    """Make this package importable on every executor: sent once per application as a zip."""
    context = spark.sparkContext
    if getattr(context, "_rostrum_shipped", False):
        return
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="rostrum-code-")) / "rostrum_code.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(here.rglob("*.py")):
            archive.write(path, path.relative_to(here.parent))
    context.addPyFile(str(target))
    context._rostrum_shipped = True
