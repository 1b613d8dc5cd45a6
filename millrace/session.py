"""Session set-up for tests and benches, and the shared folder jobs may write to."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the session's workers, once per application, so that they find it wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parent
        spark.sparkContext.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp(prefix='millrace-')}/millrace", "zip", package.parent, package.name))
        _shipped.add(app)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A private folder is made up only for a local master, where driver and executors share one disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="millrace-")
    return _local_roots[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a fresh folder below the shared root; nothing is created until Spark writes there."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back, for results that are used more than once.

    Lineage ends at the files, columns can be pruned again, and Spark knows the true size for its joins.
    """
    folder = new_folder(df.sparkSession, "stored")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
