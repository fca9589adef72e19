"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import atexit
import os
import tempfile

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every job relies on: UTC so timestamps agree with the
# oracle, AQE for runtime re-planning (partition coalescing, skew-join
# splitting, broadcast conversion from real sizes), no UI server.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    # Small dims broadcast automatically once their measured size is
    # below this bound; larger sides fall back to sort-merge joins.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # Streaming state off the JVM heap, checkpointed as change logs.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(app: str = "storelens", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the project defaults.

    On a cluster leave ``master`` unset and size
    ``spark.sql.shuffle.partitions`` to the data (about 128-256 MB per
    partition); AQE coalesces small ones at run time.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names this folder; we only pick one ourselves when it is
    unset and the master is local (tests), never a machine-local folder
    on a cluster.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="storelens-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


_SCRATCH: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables. All
    of one application's lie in one folder, which is removed when the
    driver's Python ends."""
    root = f"{checkpoint_dir(spark)}/storelens-{spark.sparkContext.applicationId}"
    if root not in _SCRATCH:
        _SCRATCH.add(root)

        def remove():
            try:
                p = spark._jvm.org.apache.hadoop.fs.Path(root)
                p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
            except Exception:  # the session has ended: nothing can be done here any more
                pass
        atexit.register(remove)
    return f"{root}/{name}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``storelens`` importable in the Python workers of this
    application (pandas UDF stages pickle references to its functions).

    The package is zipped once per application and handed to
    ``SparkContext.addPyFile``, which distributes it with the job; a
    deployment that installs the package on the executors can skip it."""
    import zipfile

    import storelens
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(storelens.__file__))
    root = os.path.dirname(pkg)
    zpath = os.path.join(tempfile.mkdtemp(prefix="storelens-lib-"), "storelens.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)
