"""Tables replaced without a gap: versioned folders and a manifest.

Each load is written into a folder of its own under the table's root. The manifest,
a file with the name of the current folder, is then replaced by one atomic rename.
A reader looks the folder up first and reads it as it was written, whatever is
loaded meanwhile; there is no moment without the table. Folders of earlier versions stay until
``drop_versions`` is told how many to keep.

The file system must rename a file over another in one step, as HDFS and local disks do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

MANIFEST = "_current"


def _jvm(spark: SparkSession):
    sc = spark.sparkContext
    return sc._jvm, sc._jsc.hadoopConfiguration()


def _fs(spark: SparkSession, path: str):
    jvm, conf = _jvm(spark)
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def _root(root: str) -> str:
    return root.rstrip("/")


def current_version(spark: SparkSession, root: str) -> str | None:
    """The name of the current folder, None if there is none yet."""
    fs, path = _fs(spark, f"{_root(root)}/{MANIFEST}")
    if not fs.exists(path):
        return None
    jvm, _ = _jvm(spark)
    stream = fs.open(path)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def is_versioned(spark: SparkSession, root: str) -> bool:
    fs, path = _fs(spark, f"{_root(root)}/{MANIFEST}")
    return fs.exists(path)


def write_version(df: DataFrame, root: str, partition_by: list[str] | None = None, name: str | None = None) -> str:
    """Write ``df`` in full as a new folder under ``root`` and return its name. Nothing refers to it yet."""
    name = name or f"v-{uuid.uuid4().hex}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{_root(root)}/{name}")
    return name


def switch_version(spark: SparkSession, root: str, name: str) -> None:
    """Make a written folder the current one, in one step."""
    jvm, conf = _jvm(spark)
    fs, fresh = _fs(spark, f"{_root(root)}/{MANIFEST}.{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(name, "utf-8"))
    finally:
        out.close()
    overwrite = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = overwrite
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri() if fresh.toUri().getScheme() else fs.getUri(), conf)
    context.rename(context.makeQualified(fresh), context.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{_root(root)}/{MANIFEST}")), options)


def replace_version(df: DataFrame, root: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as a new version and make it the current one; ``df`` may read the old one."""
    name = write_version(df, root, partition_by)
    switch_version(df.sparkSession, root, name)
    return name


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The current version, as it was written; later loads don't change what this reads."""
    name = current_version(spark, root)
    if name is None:
        raise FileNotFoundError(f"{root} has no current version")
    return spark.read.parquet(f"{_root(root)}/{name}")


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all folders but the current one and the ``keep - 1`` youngest others; their names.
    Readers of dropped versions fail, so keep as many as loads happen during the longest read."""
    if keep < 1:
        raise ValueError("the current version stays")
    fs, path = _fs(spark, _root(root))
    now = current_version(spark, root)
    others = sorted(((s.getModificationTime(), s.getPath()) for s in fs.listStatus(path)
                     if s.isDirectory() and s.getPath().getName().startswith("v-") and s.getPath().getName() != now), key=lambda x: x[0])
    gone = [p for _, p in (others[:len(others) - (keep - 1)])]
    for p in gone:
        fs.delete(p, True)
    return [p.getName() for p in gone]
