"""Spark session helpers.

The library never assumes local mode: it only reads settings from the active
session.  ``get_spark`` is a convenience for tests, benches and scripts.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Ceilings on bytes and rows for any side we broadcast after a size check.
MAX_BROADCAST_BYTES = 64 << 20
DEFAULT_BROADCAST_ROWS = 2_000_000


def get_spark(master: str | None = None, partitions: int | None = None, app: str = "textlens") -> SparkSession:
    """Build (or reuse) a session configured for the library.

    AQE is on so shuffle partitions are coalesced and skewed joins split at
    run time; the web UI is off (no server in batch jobs).
    """
    master = master or os.environ.get("TEXTLENS_MASTER", "local[8]")
    partitions = partitions or int(os.environ.get("TEXTLENS_SHUFFLE_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Spark runs one Python worker per core: keep NumPy's BLAS single
        # threaded inside each so workers do not oversubscribe the cores.
        .config("spark.executorEnv.OPENBLAS_NUM_THREADS", "1")
        .config("spark.executorEnv.OMP_NUM_THREADS", "1")
        .config("spark.driver.memory", os.environ.get("TEXTLENS_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only a session that
    runs in one process (``local[...]``) may go without: a scratch folder is
    then made and registered.  On a cluster a machine-local folder would be
    lost to the other machines, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="textlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def partition_count(spark: SparkSession) -> int:
    """Shuffle partition count used for explicit repartitioning."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``textlens`` importable in Python workers (needed by the pandas
    UDF / mapInPandas helpers): zip the package once per context and add it
    with ``addPyFile``, which distributes it to every executor."""
    import shutil

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="textlens-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "textlens"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="textlens")
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
