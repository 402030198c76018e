"""Session helpers: nothing here changes settings of a session that the caller made."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent


def build_session(app: str = "quillfeed", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings that tests and bench.py use."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # large expressions build faster without call sites
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder; the path may be any that Spark's readers open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Sends this package to Python workers that do not have it on their path already."""
    sc = spark.sparkContext
    parent = str(ROOT.parent)
    if parent in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_quillfeed_shipped", False):
        return
    target = Path(tempfile.mkdtemp(prefix="quillfeed-")) / "quillfeed_package.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(ROOT.rglob("*.py")):
            archive.write(path, path.relative_to(ROOT.parent))
    sc.addPyFile(str(target))  # served by the driver; executors fetch their own copy
    sc._quillfeed_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; a temporary one where driver and executors are one process.

    A cluster that names none is an error: a folder of one machine would lose what the others write.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or ""
    if not current:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {sc.master}")
        current = tempfile.mkdtemp(prefix="quillfeed-checkpoint-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)
        sc.setCheckpointDir(current)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame, scratch: list[str] | None = None) -> DataFrame:
    """A reliable checkpoint: survives the loss of any executor.

    Its files go when the process ends, or earlier by `discard` of the paths that `scratch` gathers.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    done = df.checkpoint(eager=True)
    file = done._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        remember(spark, file.get(), scratch)
    return done


_written: list[tuple[SparkSession, str]] = []


def materialise(df: DataFrame, scratch: list[str] | None = None, **options: str | int) -> DataFrame:
    """Writes `df` as Parquet under the shared checkpoint folder and reads it back: lineage is cut, columns stay prunable.

    The files go when the process ends, or earlier by `discard` of the paths that `scratch` gathers. `options` are those
    of the Parquet writer.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quillfeed-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    remember(spark, path, scratch)
    return spark.read.schema(df.schema).parquet(path)


def remember(spark: SparkSession, path: str, scratch: list[str] | None = None) -> None:
    """Marks a path for deletion when the process ends, or earlier by `discard`."""
    if not _written:
        atexit.register(_remove_written)
    _written.append((spark, path))
    if scratch is not None:
        scratch.append(path)


def discard(spark: SparkSession, scratch: list[str]) -> None:
    """Deletes materialised and checkpointed tables that nothing will read again."""
    for path in scratch:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    scratch.clear()


def _remove_written() -> None:
    for spark, path in _written:
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session has ended before the process, or another has taken its place
            continue
