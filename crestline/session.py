"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings the library relies on.  Event times are compared as instants, so the zone
# is pinned; skewed join partitions are split even where that costs one more shuffle; join
# and window state lives in RocksDB, off the heap, one instance per partition and operator,
# and is uploaded as changelogs.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


# Names of the zone that event times are compared in.
UTC = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "Zulu", "Universal"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` where the session leaves them open; sizes stay the cluster's.

    A time zone that the caller has set to something else would change results: an error.
    """
    own = spark.conf.getAll
    zone = own.get("spark.sql.session.timeZone")
    if zone is not None and zone not in UTC:
        raise ValueError(f"event times need spark.sql.session.timeZone=UTC, the session has {zone!r}")
    for key, value in SETTINGS.items():
        if key not in own:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may leave that unset, as in tests; its folder is temporary.  What is
    written there is kept until the caller, or whoever owns the folder, clears it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="crestline-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
