"""Session helpers: shared checkpoint / scratch locations and tuning defaults."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a cluster deployment is expected to carry; ``tuned_builder`` applies
# them for local runs and tests. AQE re-plans joins from runtime sizes
# (broadcast only when the measured side is small), coalesces tiny shuffle
# partitions and splits skewed ones.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def tuned_builder(master: str = "local[8]", shuffle_partitions: int = 8, driver_memory: str = "8g"):
    b = SparkSession.builder.master(master)
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    return b.config("spark.sql.shuffle.partitions", str(shuffle_partitions)).config("spark.driver.memory", driver_memory)


def application_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001
        return str(id(spark))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session (unit tests) that has none gets a temporary folder: there
    driver and tasks share a disk. On a cluster a missing setting raises, as a
    machine-local folder would leave executors without each other's files.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect: the server's spark.checkpoint.dir applies
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="kestrel-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/kestrel-scratch/{application_id(spark)}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder of this application under the shared checkpoint location."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch folder, when no frame that reads from it is used any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_scratch(spark: SparkSession, path: str | None) -> None:
    """Delete the scratch folder ``path``, which no frame in use reads, and let Spark delete the files of shuffles that nothing refers to.

    Spark deletes them when the driver collects its garbage, which a loop with a small driver may else put off past its end.
    """
    if path is not None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    gc.collect()
    spark._jvm.System.gc()


def cut_lineage(df):
    """Write ``df`` once into the shared scratch folder and read it back.

    Used by iterative operators (PageRank, BFS levels, Louvain sweeps) so the
    plan does not grow with the iteration count and a lost executor does not
    replay previous rounds. Unlike ``checkpoint()`` the plan runs a single time
    and nothing has to be cached; ``clear_scratch`` removes the files.
    """
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
