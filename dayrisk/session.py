"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable
from multiprocessing.pool import ThreadPool
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Set what results depend on (UTC), give the workers this package, and leave sizing to the cluster's own configuration."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Let the workers import this package wherever they were started: once for each context its files travel as a zip."""
    context = spark.sparkContext
    if getattr(context, "_dayrisk_shipped", False):
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="dayrisk-code-")) / "dayrisk.zip"  # read by the driver only, which hands it on
    with zipfile.ZipFile(path, "w") as packed:
        for file in sorted(root.rglob("*.py")):
            packed.write(file, Path(root.name) / file.relative_to(root))
    context.addPyFile(str(path))
    context._dayrisk_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that ``spark.checkpoint.dir`` names.

    Without the setting, a session whose executors are threads of the driver gets a temporary folder; on a cluster executors could not
    read the driver's folder, so there it is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not shared and not is_local(context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="dayrisk-checkpoint-"))


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def settled(df: DataFrame) -> DataFrame:
    """The rows of ``df`` written to the shared folder: computed once, the same for every reader, safe from lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def local_session(cpus: int | str = "*", app: str = "dayrisk") -> SparkSession:
    """A session for tests and the bench on one machine."""
    parts = 8 if cpus == "*" else max(1, int(cpus))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def side_by_side(job: Callable, items: Iterable, parallelism: int = 8) -> list:
    """Run independent fits as concurrent Spark jobs, so small ones do not wait for each other."""
    items = list(items)
    with ThreadPool(max(1, min(parallelism, len(items)))) as pool:
        return pool.map(inheritable_thread_target(SparkSession.active())(job), items)
