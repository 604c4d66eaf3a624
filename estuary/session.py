"""Session settings shared by the library, the tests and the bench.

On a cluster the session is built by the platform. ``configure`` sets what results
depend on (UTC session zone, ANSI mode, Arrow transfer) in every session, and
performance settings only where the cluster's own configuration names no value.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Results depend on these; they are set in every session.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Set only where the cluster's configuration has no value of its own. AQE coalesces
# small shuffles, splits skewed join partitions and turns sort-merge joins into
# broadcast joins only when the runtime size of a side is under the threshold. Small
# Arrow batches bound the memory of Python workers that handle long texts.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # streaming state outside the heap; processors with lists, maps and timers need it
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
CORE_CONF = SEMANTIC_CONF | DEFAULT_CONF


def configure(spark: SparkSession) -> SparkSession:
    """Set the session options above and let Python workers import this package
    from the place the driver imported it from (a no-op where it is installed)."""
    given = spark.sparkContext.getConf()
    for key, value in CORE_CONF.items():
        if key in SEMANTIC_CONF or not given.contains(key):
            spark.conf.set(key, value)
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (root, env.get("PYTHONPATH", ""))))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    A scratch folder is created only for a local[...] session without the
    setting, where driver and executors are one process. On a cluster a missing
    setting is an error: a machine-local folder would not be shared.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a SparkContext handle (e.g. Spark Connect)
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        if sc is not None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not spark.conf.get("spark.master", "").startswith("local") or "local-cluster" in spark.conf.get("spark.master"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
    local = tempfile.mkdtemp(prefix="estuary-ckpt-", dir=os.environ.get("ESTUARY_SCRATCH", "/tmp"))
    if sc is not None:
        sc.setCheckpointDir(local)
    return local


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "estuary") -> SparkSession:
    """Local session for tests and the bench; the UI stays off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("ESTUARY_DRIVER_MEMORY", "12g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="estuary-wh-"))
    )
    for key, value in CORE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
