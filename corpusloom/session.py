"""Sessions and the shared folder that cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Rows and bytes that one Arrow batch into a Python worker may hold: a worker then needs tens of MB, whatever
#: the lengths of the rows.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
#: Folders of local applications without the setting, by application id.
_own_folders: dict[str, str] = {}


def local_session(cpus: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("corpusloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``.

    Where the setting is absent and driver and executors are one process (tests, local runs), the application gets a fresh local
    folder; on a cluster no machine's own folder would do, so the setting has to be there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        application = spark.sparkContext.applicationId
        if application not in _own_folders:  # the setting can't be changed once a session runs
            _own_folders[application] = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
        path = _own_folders[application]
    return path.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; every call gives another one, so a rerun never meets old files."""
    return f"{shared_dir(spark)}/corpusloom/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    It cuts lineage like a reliable checkpoint: what follows reads files that survive the loss of any executor,
    keeps column pruning and gives the optimizer true sizes. The files stay until the shared folder is cleaned.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out over all cores if it has fewer partitions, as a small table of one file has: for steps that cost
    much more than moving their rows. Tables of more partitions stay as they are. Call it on tables as they are read, as
    counting partitions behind a shuffle would run it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def bounded(spark: SparkSession) -> None:
    """Set the session's Arrow batch limits, where they are larger."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        if not 0 < int(str(spark.conf.get(name)).rstrip("b")) <= most:
            spark.conf.set(name, str(most))
