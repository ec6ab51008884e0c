"""Session factory, table access and lineage cuts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


#: Spark 4.1 unions branches partition by partition where all are partitioned alike, and fails ("Can't zip RDDs with unequal
#: numbers of partitions") where adaptive execution then merges partitions of some of them only.
UNION_SETTING = "spark.sql.unionOutputPartitioning"


def get_spark(app: str = "lotline", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; keyword settings use ``__`` for dots."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        UNION_SETTING: "false",
    }
    for k, v in {**base, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    _checkpoint_folder(spark)
    return spark


def sizing(input_gb: float, cores: int, memory_gb_per_core: float = 4.0) -> dict[str, str]:
    """Settings for an input of that size: shuffle partitions of about 128 MB and at least two a core, scans of 128 MB
    (256 MB beyond 10 TB, to keep task counts down), skew splitting from 256 MB, broadcasts up to 1 % of an executor core's memory."""
    partitions = max(2 * cores, round(input_gb * 1024 / 128))
    return {
        "spark.sql.shuffle.partitions": str(min(partitions, 200_000)),
        "spark.sql.files.maxPartitionBytes": "256m" if input_gb > 10_240 else "128m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
        "spark.sql.autoBroadcastJoinThreshold": f"{max(10, round(memory_gb_per_core * 10.24))}m",
    }


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application, for the kernels that run in Python workers."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="lotline-")  # the driver hands the file to the executors
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    out = os.path.join(folder, "lotline.zip")
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(out)
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    if spark.conf.get(UNION_SETTING, None) is None:
        spark.conf.set(UNION_SETTING, "false")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _checkpoint_folder(spark: SparkSession) -> str | None:
    """The folder of the session's ``spark.checkpoint.dir``; a temporary one where that is unset and all runs on one machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and sc.master.startswith("local"):
            folder = tempfile.mkdtemp(prefix="lotline-ckpt-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        if folder:
            sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the cluster's shared checkpoint folder and cut its lineage.

    The folder is the session's ``spark.checkpoint.dir``; a cluster without one is an error, since a machine's own folder
    is lost with the machine. The files go when the frame is no longer used (get_spark's session), or by ``drop_cuts``.
    """
    if _checkpoint_folder(df.sparkSession) is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    return df.checkpoint(eager=True)


def drop_cuts(spark: SparkSession) -> None:
    """Delete what ``cut`` has written in this application; frames made of it can't be read any more."""
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for s in fs.listStatus(path) if fs.exists(path) else []:
            fs.delete(s.getPath(), True)
