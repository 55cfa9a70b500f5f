"""Spark session and checkpoint-directory helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcast only what the code proves small; never by accident.
    "spark.sql.autoBroadcastJoinThreshold": str(16 * 1024 * 1024),
    # checkpoint files are removed once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "tabspark",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is used as it is.
    When it is unset, a fresh local folder is created on a ``local`` master (tests); on any
    other master that folder would not be shared, so this raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to shared storage")
        path = tempfile.mkdtemp(prefix="tabspark-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its file system (one without a scheme: the default one)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def path_glob(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match ``pattern`` on its file system, sorted."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return sorted(f.getPath().toString() for f in found or [])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tabspark`` importable in the executors' Python workers
    (``addPyFile`` of a zip of the package, once per application)."""
    import zipfile

    import tabspark
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(tabspark.__file__)))
    zpath = os.path.join(tempfile.mkdtemp(prefix="tabspark-pkg-"), "tabspark.zip")
    with zipfile.ZipFile(zpath, "w") as z:
        for dirpath, _, files in os.walk(os.path.join(root, "tabspark")):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)


def local_frame(spark: SparkSession, rows, schema):
    """A small driver-built table (bounded: statistics, intervals, results) as
    a ``LocalTableScan`` (Arrow from pandas), not a Python RDD scan."""
    import pandas as pd
    from pyspark.sql import types as T
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    names = [f.name for f in schema.fields]
    pdf = pd.DataFrame([tuple(r) for r in rows], columns=names, dtype=object)
    return spark.createDataFrame(pdf, schema=schema)


def scale_conf(input_bytes: int, total_cores: int, scan_split_bytes: int = 256 << 20,
               shuffle_partition_bytes: int = 256 << 20) -> dict:
    """Scan/shuffle sizing for a cluster run (pass as ``get_session(extra=...)``).

    Scan splits of ``scan_split_bytes`` and an initial shuffle partition count
    that keeps each partition near ``shuffle_partition_bytes`` (AQE coalesces
    the small ones, splits skewed ones); at least two tasks per core.
    E.g. 100 TB on 8 000 cores → ~400k scan splits, 409 600 initial shuffle
    partitions coalesced at runtime.
    """
    import math
    parts = max(2 * total_cores, math.ceil(input_bytes / shuffle_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * shuffle_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }
