"""Session helpers: runtime settings the operators rely on, and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every operator assumes. They are session-scoped and safe to
# set on a running session (no static confs here).
RUNTIME_CONF = {
    # runtime re-planning: coalesce small shuffles, split skewed join partitions,
    # turn a shuffle join into a broadcast once the real size is known
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # INFO maps: a repeated key keeps the last value instead of failing the row
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application (Python workers import it)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    import shutil

    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="varframe-pkg-")
    archive = shutil.make_archive(os.path.join(out, "varframe"), "zip", os.path.dirname(pkg), "varframe")
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def configure(spark: SparkSession) -> SparkSession:
    """Apply RUNTIME_CONF, ship the package and make sure a checkpoint directory exists."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ship_package(spark)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment (a shared file system path). Only
    when it is unset (tests, local runs) do we pick a fresh local folder.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="varframe-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def default_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "varframe") -> SparkSession:
    """Session for tests and local runs (the cluster gets its own from spark-submit)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
