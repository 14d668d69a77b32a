"""Session helpers: builder defaults and the shared checkpoint folder."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Settings every job in the package relies on. Event times are UTC; AQE re-plans
# joins and coalesces shuffle partitions at runtime.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.scheduler.mode": "FAIR",  # the consumer groups' pools share the cores (T8)
}


def build_session(master: str = "local[*]", app: str = "citystream",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster the submitter owns the session config."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.sql.streaming.stateStore.providerClass",
                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the semantics the operators need on an existing session and make
    the package usable in Python workers (idempotent)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package()
    return spark


def ship_package() -> None:
    """Python tasks (mapInPandas, applyInPandasWithState) run functions of
    this package. They travel by value inside the pickled task, so executors
    need neither the package on their path nor a file in a shared folder."""
    cloudpickle.register_pickle_by_value(sys.modules[__package__])


_LOCAL_ROOT: str | None = None


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder (a path or URI) for checkpoints and lineage-cutting tables.

    Read from ``spark.checkpoint.dir``, the cluster's shared folder. Where it
    is unset, a per-process scratch folder serves ``local`` masters only; on a
    cluster that would be a folder per machine, so the call raises.
    """
    global _LOCAL_ROOT
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if _LOCAL_ROOT is None:
            _LOCAL_ROOT = tempfile.mkdtemp(prefix="citystream-ckpt-")
        root = _LOCAL_ROOT
    root = root.rstrip("/")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(f"{root}/rdd")
    return root


def checkpoint_location(spark: SparkSession, query_name: str) -> str:
    """One streaming checkpoint directory per query name (K9)."""
    return f"{checkpoint_root(spark)}/streams/{query_name}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for a table or archive of one run."""
    return f"{checkpoint_root(spark)}/scratch/{name}-{uuid.uuid4().hex}"
