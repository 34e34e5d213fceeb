"""Session construction and lineage helpers.

Library code never creates its own session; callers pass one in. The
builder here is for tests, ``bench.py`` and local experiments only.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

# Settings every run of the library expects. AQE gives runtime broadcast
# conversion (with the measured size as the check), partition coalescing and
# skew-join splitting; the session zone is pinned so timestamp parts agree
# with the DuckDB oracle.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files of frames that went out of scope are deleted.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Rows that one task sorts or groups, where their number sets the number of tasks.
TASK_ROWS = 1 << 18
MOST_TASKS = 1 << 14


def tasks_for(rows: int | None) -> int:
    """Tasks that share ``rows`` rows, about ``TASK_ROWS`` each. Partitions made
    by number are not merged by the size of their files, so what a task holds
    does not grow with the input; beyond ``MOST_TASKS`` tasks spill."""
    return max(1, min(MOST_TASKS, math.ceil((rows or 0) / TASK_ROWS)))


def local_session(cpus: int = 8, partitions: int | None = None,
                  app: str = "quillspark", driver_memory: str = "16g") -> SparkSession:
    """A ``local[cpus]`` session configured like the cluster sessions."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(partitions or cpus)
    conf["spark.driver.memory"] = driver_memory
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints that driver and executors share.

    ``spark.checkpoint.dir`` names it on a cluster. Where that is unset (tests,
    local runs) a folder in the warehouse is taken, which is shared as well.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = shared_folder(spark, "_checkpoints")
    sc.setCheckpointDir(folder)
    return folder


def shared_folder(spark: SparkSession, name: str) -> str:
    """Where files go that driver and executors share: ``spark.checkpoint.dir``,
    or, where that is unset, the folder ``name`` of the warehouse. A cluster
    without the setting is refused if its warehouse is on a machine's own disk."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = spark.sparkContext.master.split("[")[0] == "local"
    if not local and (warehouse.startswith("file:") or "://" not in warehouse):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{warehouse}/{name}"


def materialize(df: DataFrame) -> DataFrame:
    """Checkpoint a frame that several jobs or branches read: lineage is cut,
    a lost executor costs a re-read, and the files go when the frame does
    (``spark.cleaner.referenceTracking.cleanCheckpoints``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
