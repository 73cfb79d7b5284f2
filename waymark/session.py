"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on: adaptive execution (runtime join strategy,
# partition coalescing, skew-join splitting), UTC timestamps and Arrow for the
# few pandas boundaries.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "waymark",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    On a cluster, call with ``master=None`` and let spark-submit decide; the
    shuffle partition count then stays whatever the cluster configured.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory", "12g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    The cluster names it; only a local session (tests, benches) without one
    gets a fresh private folder under the system temp directory.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="waymark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    if spark.sparkContext.master.split("[")[0] == "local":
        # Workers of a local session may run in another folder than the driver.
        ship_package(spark)
    return current


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for intermediate tables.

    Only the name is made here; the writers create the folder in whatever
    file system ``spark.checkpoint.dir`` names. :func:`drop_scratch` removes
    what was written."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables that this application has written so far, and
    return how many there were. DataFrames that still read them cannot be
    evaluated any more, so call it when their results have been written."""
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        drop_path(spark, path)
    return len(paths)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete what was written below a path, in whatever file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``waymark`` importable in Python workers (``mapInPandas``,
    ``pandas_udf``) of a local session: zip the package once per application
    and add it with ``addPyFile``. Needed whenever the driver imported the
    package from a path the workers do not have. On a cluster the package is
    shipped with ``spark-submit --py-files`` instead, so nothing is written
    to a machine-local folder there."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED or not sc.master.startswith("local"):
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    parent = os.path.dirname(pkg_dir)
    zip_path = os.path.join(tempfile.mkdtemp(prefix="waymark-pyfiles-"), "waymark.zip")
    with zipfile.ZipFile(zip_path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    z.write(full, os.path.relpath(full, parent))
    sc.addPyFile(zip_path)
    _SHIPPED.add(sc.applicationId)
