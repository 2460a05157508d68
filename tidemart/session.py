"""Session settings every job relies on."""

import tempfile

from pyspark.sql import SparkSession

# Settings that can be changed on a running session. Shuffle partition counts
# are left to the cluster; adaptive execution splits and merges them.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting rows would cost a read per write.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # State is mostly text. A query goes on from its last micro-batch; the state of a hundred earlier ones, which Spark
    # keeps otherwise, would take many times the room.
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.minBatchesToRetain": "2",
    # One store per join partition instead of four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """Create a session; ``settings`` override the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local session may run without that setting; it then gets a fresh
    temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    made = tempfile.mkdtemp(prefix="tidemart-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made
