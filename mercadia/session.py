"""Session construction and the few settings the library relies on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every model assumes: UTC wall clock (timestamps are zone-less), ANSI
# arithmetic, adaptive execution with skew-join splitting and partition coalescing.
# Broadcast joins only for relations estimated (statically, or measured at run
# time by AQE) under 1 MB: the code-list dimensions (translations, nations).
# Anything that grows with the data is shuffle-joined. A partition after a shuffle holds
# 16 MB (compressed): sorts, joins and hash maps of one task take up to 25 times that, and
# the default of 64 MB leaves a few tasks, each near an executor's share of memory.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when the operator above reuses the
    # join's partitioning (it then re-shuffles after a map-side partial aggregate)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "1MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "1MB",
}


#: Spark's setting by which a query deletes its shuffle files when it ends; else they stay
#: until the driver's garbage collector finds that nothing refers to them.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str = "local[8]", app: str = "mercadia", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, pass your own builder and call ``configure``."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings models depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint directory from ``spark.checkpoint.dir``.

    On a cluster this must name a shared, durable folder; the library never
    invents one there. Only a session in one process (``local``, as in tests; not
    ``local-cluster``) without the setting gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for distributed windows")
        conf_dir = tempfile.mkdtemp(prefix="mercadia-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def recommended_conf(input_bytes: int, target_partition_bytes: int = 256 << 20, min_partitions: int = 200) -> dict[str, str]:
    """Sizing for a cluster run over ``input_bytes`` of compressed input.

    Shuffle partitions start at about one per ``target_partition_bytes`` of
    input (AQE then coalesces the small ones), scan splits and AQE's advisory
    size use the same target, so a task's share of any stage stays bounded as
    the data grows; skewed partitions above the target are split by AQE.
    """
    n = max(min_partitions, -(-int(input_bytes) // target_partition_bytes))
    size = str(target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def drop_intermediates(spark: SparkSession) -> None:
    """Delete the intermediate tables that this library has written to the shared
    folder. Frames built on them are invalid afterwards: call it once a run's results
    are written."""
    jvm = spark.sparkContext._jvm
    for name in ("mercadia-tables", "mercadia-io"):
        path = jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shared_table_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for an intermediate table inside the shared checkpoint folder."""
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/mercadia-tables/{uuid.uuid4().hex}/{name}"


def cut_lineage(df, name: str):
    """Write ``df`` as a Parquet table into the shared checkpoint folder and read
    it back: later passes see exactly these rows (also after an executor loss),
    read only the columns they need, and do not re-run the upstream plan. The shuffle
    files of the write are deleted at its end, as the table stands for them."""
    spark = df.sparkSession
    path = shared_table_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.parquet(path)
