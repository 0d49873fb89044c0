"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"

# Worth having on any cluster. Memory, cores and shuffle.partitions depend on the cluster and
# the job and are left to the caller; note that a stateful stream keeps the
# shuffle.partitions of its first start for as long as its checkpoint lives.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Window state lives off-heap and on local disk, and only its changes are uploaded.
    _PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    _CHANGELOG: "true",
}


def build_session(app_name: str = "tidemark", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """All clocks here are UTC; casts between zoned and zone-less times use this setting."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def keep_state_off_heap(spark: SparkSession) -> None:
    """Use RocksDB for stream state unless the session names a provider itself.

    The default keeps all windows of a partition on the executor's heap.
    """
    for key in (_PROVIDER, _CHANGELOG):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, DEFAULTS[key])


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path below the cluster's shared folder (``spark.checkpoint.dir``).

    Executors on other machines must see it, so a machine-local folder is used only when
    Spark itself runs in one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="tidemark-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
