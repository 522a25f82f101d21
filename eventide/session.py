"""Session construction and the shared storage root.

Everything that has to survive an executor loss (stream checkpoints, stream
sink output, lineage cuts) lives under the folder the cluster names in
``spark.checkpoint.dir``.  We only invent a folder when the setting is
absent, which happens in local tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package assumes.  Shuffle partition count is a
# local default; on a cluster it is sized to the data (about 128-256 MB of
# shuffle output per partition) and AQE coalesces small ones at run time.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "eventide", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root, setting one only if none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        # Local runs only: on a cluster a folder of this machine would lose
        # what other machines write, so one must be named.
        master = spark.sparkContext.master
        if not is_one_machine(master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        root = tempfile.mkdtemp(prefix="eventide-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def is_one_machine(master: str) -> bool:
    """``local``, ``local[4]``, ``local[*, 2]``; not ``local-cluster[...]``."""
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the shared checkpoint root, made through
    whatever file system it names."""
    root = ensure_checkpoint_dir(spark)
    path = f"{root}/eventide/{purpose}/{uuid.uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    return path


def cut_lineage(df, spark: SparkSession | None = None):
    """Reliable lineage cut: ``checkpoint()`` into the shared folder.

    Used where a plan is reused by several outputs (side outputs of one
    operator) so that a lost executor does not recompute the whole chain.
    """
    spark = spark or df.sparkSession
    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ensure_rocksdb_state_store(spark: SparkSession) -> None:
    """Stateful processors (``transformWithState``) need the RocksDB state
    store; it is also the provider to use for large state.  Set it when the
    session names another provider (it is read when a query starts)."""
    if spark.conf.get(STATE_STORE, None) != ROCKSDB_PROVIDER:
        spark.conf.set(STATE_STORE, ROCKSDB_PROVIDER)
