"""Session helpers: a tuned local session for tests/bench, and a shared scratch
location derived from ``spark.checkpoint.dir``.

On a cluster the checkpoint directory is set by the deployment (a shared file
system path).  The library only reads it; it sets its own directory solely when
none is configured, which is the case for local tests.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults that matter for this workload at any scale: AQE re-plans joins and
# coalesces/splits shuffle partitions at runtime; skew-join splits the
# partition of a hot word on the postings side.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # remove reliable-checkpoint files once their DataFrame is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench (local mode, UI off)."""
    b = (SparkSession.builder.master(f"local[{cores}]")
         .appName("docrank")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory (``spark.checkpoint.dir``).

    A cluster names a shared directory there; the library never invents one
    on a cluster (a machine-local folder would not survive executor loss and
    is not visible to other nodes) and raises instead.  Only a local-mode
    session without one (tests, the bench) gets a private temporary folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    # local-cluster[...] has executors of its own, like any cluster
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder: docrank writes "
                           "intermediate tables and indexes below it")
    local = tempfile.mkdtemp(prefix="docrank-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


# scratch folders of this process and their sessions, removed when it ends
_scratch: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint directory.  What is written there
    is removed by ``remove_scratch``, ``clear_scratch``, or when the process ends."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/docrank-{name}-{uuid.uuid4().hex[:12]}"
    if not _scratch:
        atexit.register(_clear_at_exit)
    _scratch[path] = spark
    return path


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    _scratch.pop(path, None)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of this library through Spark's own file system."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if not path.startswith(f"{base}/docrank-"):
        raise ValueError(f"not a scratch folder: {path}")
    _delete(spark, path)


def clear_scratch(spark: SparkSession) -> int:
    """Delete all scratch folders of this process; DataFrames that read them cannot be used
    any more.  Returns their number.  For sessions that live long."""
    paths = list(_scratch)
    for path in paths:
        _delete(spark, path)
    return len(paths)


def _clear_at_exit() -> None:
    for path, spark in list(_scratch.items()):
        try:
            _delete(spark, path)
        except Exception:  # the driver's JVM is gone already
            return


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query go when the query ends.  Spark else removes them
    when the driver's garbage collector finds them unused, which may be never in a run of
    several large jobs."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
