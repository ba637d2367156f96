"""Session construction and cluster-safe scratch locations."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  Timestamps inside the library are
# timestamp_ntz holding UTC wall-clock, so results do not depend on the
# session zone; UTC is still pinned for the JSON/CSV parsers.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "12g",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "riskspark", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the cluster's shared checkpoint directory.

    Reads ``spark.checkpoint.dir`` from the session.  Where it is unset, a local
    master gets a private scratch folder, and any other one an error, so the
    same code never writes to a machine-local folder on a cluster.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not base:
        base = _LOCAL_BASE.get(id(sc))
    if not base:
        # Unset: a private scratch folder, which only a local master can see everywhere.
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="riskspark-")
        _LOCAL_BASE[id(sc)] = base
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(os.path.join(base, "rdd"))
    return base.rstrip("/") + "/" + name.strip("/")


_LOCAL_BASE: dict = {}
