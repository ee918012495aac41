"""Session helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it.

    Where `spark.checkpoint.dir` is unset and the master is local (tests, one machine) a
    temporary folder is set; on a cluster an unset folder is an error, because a path of
    one machine is not readable from the others.
    """
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isDefined():
        return jsc.getCheckpointDir().get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="lorespark-checkpoint-")
    spark.sparkContext.setCheckpointDir(named)
    return jsc.getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder, so that lost executors cost no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Makes this package importable in the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        package = Path(__file__).parent
        archive = os.path.join(tempfile.mkdtemp(prefix="lorespark-code-"), "lorespark.zip")  # Spark hands it to the executors
        with zipfile.ZipFile(archive, "w") as z:
            for p in sorted(package.rglob("*.py")):
                z.write(p, p.relative_to(package.parent))
        spark.sparkContext.addPyFile(archive)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def local_session(cpus: int | None = None, app: str = "lorespark") -> SparkSession:
    """A session for one machine: tests and bench."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", os.environ.get("LORESPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what lies there is removed when the program ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    fs.deleteOnExit(folder)  # registers only what exists
    return f"{folder.toString()}/data"


def remove(spark: SparkSession, path: str) -> None:
    """Removes what lies at a path of `scratch` before the program ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame) -> DataFrame:
    """Writes `df` as a table in the shared folder and reads it back; it is removed when the program ends."""
    spark = df.sparkSession
    path = scratch(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
