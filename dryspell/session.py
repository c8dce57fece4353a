"""Session construction and the few session-level services the operators use."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: adaptive execution re-plans joins and
# partition counts from measured shuffle sizes and splits skewed join
# partitions; ANSI mode makes a malformed number fail the job, as the
# reference's float() does.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app_name: str = "dryspell",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    On a cluster, call ``SparkSession.builder.getOrCreate()`` yourself with
    the cluster's settings; the operators do not require this helper.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once a session, unless their PYTHONPATH has it.

    Python workers load the package by name; without this they find it only where
    it is installed or the driver's PYTHONPATH names it.
    """
    sc = spark.sparkContext
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    named = {os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if home in named or getattr(sc, "_dryspell_shipped", False):
        return
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="dryspell-ship-"), "dryspell"), "zip", home,
                                  "dryspell")
    sc.addPyFile(archive)
    sc._dryspell_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, choosing one only if none is configured.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value
    (or a folder already set on the SparkContext) always wins. Only in local
    mode with nothing configured (local runs and tests) is a private scratch
    folder created; on a cluster a missing setting is an error.
    """
    try:
        sc = spark.sparkContext
        current = sc.getCheckpointDir()
    except Exception:  # noqa: BLE001 - sessions without a SparkContext
        sc, current = None, None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a folder every "
                               "executor can read and write (shared storage)")
        configured = tempfile.mkdtemp(prefix="dryspell-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared checkpoint folder.

    Used for written intermediate tables and round-trip outputs so that every
    executor (and a restarted one) can read them.
    """
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex}")
