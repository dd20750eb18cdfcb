"""Session helpers.

The library never builds its own cluster configuration: on a cluster the
session comes from the caller.  ``local_session`` exists for tests and the
bench; ``ensure_checkpoint_dir`` honours ``spark.checkpoint.dir`` when the
cluster names one and only falls back to a fresh scratch folder when it is
unset (local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


#: Bytes of a row group of written intermediate tables, about.
ROW_GROUP_BYTES = 8 << 20


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "cardlens") -> SparkSession:
    """A local-mode session with AQE on and the UI off (tests, bench)."""
    n = (os.cpu_count() or 8) if cores == "*" else int(cores)
    parts = shuffle_partitions or max(int(n), 1)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CARDLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.int96RebaseModeInRead", "CORRECTED")
        .config("spark.sql.parquet.datetimeRebaseModeInRead", "CORRECTED")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object store)
    folder and is used as is.  Only when nothing is configured and the master
    is local (tests) a fresh temporary folder is taken; on a cluster that would
    be a folder the executors cannot see, so it raises.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not conf_dir:
        if not _single_process(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="cardlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return spark.sparkContext.getCheckpointDir() or conf_dir


def _single_process(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the Python workers once per application.

    Workers import functions by module name. On a cluster they have no copy of
    the package; in a local session their path holds the driver's working
    folder at most, which need not be the one the package lies in.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="cardlens-code-"), "cardlens_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)  # served by the driver; the temporary copy is only its source
    _shipped.add(sc.applicationId)


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (never a local checkpoint).

    The frame is persisted first so the checkpoint write reuses the rows the
    action computed instead of running the whole plan a second time.
    """
    ensure_checkpoint_dir(df.sparkSession)
    df.persist()
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame into the shared folder and read it back.

    A join against the files shuffles both sides, so AQE can split a hot key
    of the other side; against an aggregate it cannot.  Row groups are small, so
    a table that few tasks wrote is still read by as many as there are cores.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/cardlens-tables/" + name
