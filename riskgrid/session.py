"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the engine assumes. The time zone matters for results (all day
# boundaries are UTC days); the rest are execution choices.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "riskgrid", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's settings.

    On a cluster pass ``master=None``: master and ``spark.sql.shuffle.partitions``
    are then what spark-submit was given (see ``sizing_conf``). A local master
    without ``shuffle_partitions`` gets 8.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is None and master and master.startswith("local"):
        shuffle_partitions = 8
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("RISKGRID_DRIVER_MEMORY", _driver_memory()))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _driver_memory() -> str:
    """Half the machine's RAM, between 1 and 8 GiB (local mode: the driver is the executor)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    gib = max(1, min(8, int(total * 0.5) >> 30))
    return f"{gib}g"


def use_utc(spark: SparkSession) -> None:
    """Every query judges days in UTC; set it on whatever session we are given."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    Read ``spark.checkpoint.dir`` from the session (the cluster names a shared
    folder there). Only a local-mode session without one gets a fresh temp
    folder, as in tests; on a cluster a missing setting is an error, never a
    machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if sc.master.startswith("local"):
        local = tempfile.mkdtemp(prefix="riskgrid-ckpt-", dir="/tmp")
        sc.setCheckpointDir(local)
        return sc.getCheckpointDir() or local
    raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for it")


def materialize(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Used after the big -> small reductions (the region-day tally, the feature
    table): later stages and repeated reads start from the written table, not
    from the raw events, and a lost executor costs a re-read, not a recompute
    of the event scan.
    """
    return df.sparkSession.read.parquet(write_table(df, name))


def write_table(df, name: str) -> str:
    import uuid
    spark = df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    # One folder per application, so a retention policy can expire a run's tables as a unit.
    app = spark.sparkContext.applicationId
    path = f"{base}/riskgrid-tables/{app}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return path


def drop_tables(*tables) -> None:
    """Delete tables that ``materialize`` wrote, once nothing reads them any more."""
    for df in tables:
        files = df.inputFiles()
        if files and "/riskgrid-tables/" in files[0]:
            sc = df.sparkSession.sparkContext
            path = sc._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def file_stamp(spark: SparkSession, paths) -> tuple:
    """Name, size and modification time of every file under each path (any Hadoop file
    system), to key stored tables; a missing path has no files."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        fs = at.getFileSystem(conf)
        files, found = fs.listFiles(at, True) if fs.exists(at) else None, []
        while files and files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        out.append(tuple(sorted(found)))
    return tuple(out)


def sizing_conf(input_bytes: int, executor_cores: int, executors: int,
                target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle/scan sizing for a cluster run over ``input_bytes`` of Parquet.

    Scan splits of 256 MiB keep a task's input well inside executor memory;
    the initial shuffle partition count is sized for the *raw* event volume
    (the tally's partial aggregates are far smaller, and AQE coalesces down to
    the advisory size); skew-join splitting handles a hot key.
    """
    slots = max(1, executor_cores * executors)
    parts = max(slots * 2, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        # Broadcast only what Spark measured below this size (region, nation, the tally).
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
