"""Session set-up and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(app: str = "docloom", cpus: int | str = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("DOCLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_LOCAL_DIRS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Workers import what a function refers to; they need not share the driver's
    working folder or search path.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="docloom-package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as bundle:
        for source in sorted(package.rglob("*.py")):
            bundle.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: there the driver
    and the executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="docloom-")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is ever written there twice."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df, name: str):
    """A frame written under the shared folder and read back: fixed rows, a short lineage, safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df, key: str):
    """Redistribute a scan that has fewer splits than the cluster has slots.

    A single-row-group file reads as one task. Work that is heavy per row
    (Python kernels, long regular expressions) gains from one cheap shuffle
    then; a scan that already fills the cluster is left alone.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= slots:
        return df
    return df.repartition(slots, key)
