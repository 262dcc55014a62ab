"""Readers and writers for source tables and published models."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .schemas import SOURCE_SCHEMAS, SOURCE_TABLES


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | str,
                   multiline: bool | None = None) -> DataFrame:
    """One CSV file (or folder of parts) per table, header row, declared schema.

    ``schema`` may be a source table name. Timestamps parse as zone-less
    instants. With ``multiline`` fields may hold quoted line breaks, but a file is
    then read by one task; it is on by default for reviews only, whose texts do.
    """
    if multiline is None:
        multiline = schema == "order_reviews"
    if isinstance(schema, str):
        schema = SOURCE_SCHEMAS[schema]
    return (spark.read.schema(schema)
            .option("header", True)
            .option("multiLine", multiline)
            .option("escape", '"')
            .option("mode", "FAILFAST")
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
            .csv(path))


def read_csv_quarantine(spark: SparkSession, path: str, schema: T.StructType | str, quarantine: str | None = None,
                        multiline: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """As ``read_csv_table``, but lines that don't fit the schema do not end the load.

    Returns the good rows and the bad ones (``table, file, line``: the text as it stands
    in the file). Too few or too many fields, or a field that its type cannot hold,
    make a line bad. All columns are parsed once, into a written table, so a query of few
    columns sees the same good rows as one of all. With ``quarantine`` (a folder) the bad
    lines of this load are added to a Parquet table there, with the time of the load.
    """
    name = schema if isinstance(schema, str) else ""
    fields = SOURCE_SCHEMAS[schema] if isinstance(schema, str) else schema
    if multiline is None:
        multiline = schema == "order_reviews"
    with_line = T.StructType([*fields.fields, T.StructField("_line", T.StringType())])
    parsed = (spark.read.schema(with_line)
              .option("header", True).option("multiLine", multiline).option("escape", '"')
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").option("columnPruning", False)
              .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
              .csv(path).select("*", F.col("_metadata.file_path").alias("_file")))
    loaded = cut_lineage(parsed, "csv_load")
    good = loaded.where("_line IS NULL").select(*fields.names)
    bad = loaded.where("_line IS NOT NULL").select(F.lit(name).alias("table"), F.col("_file").alias("file"), F.col("_line").alias("line"))
    if quarantine:
        bad.withColumn("loaded_at", F.current_timestamp()).write.mode("append").parquet(quarantine)
    return good, bad


def read_jdbc_table(spark: SparkSession, table: str, options: dict, single_task: bool = False) -> DataFrame:
    """Table or ``(query) AS t`` from a JDBC database.

    ``options`` carries url/user/password/driver from configuration (never from
    code) and ``partitionColumn``/``lowerBound``/``upperBound``/``numPartitions``
    for a parallel read; without these, ``single_task`` must say that one task may
    read the whole table. ``fetchsize`` defaults to 10,000 rows.
    """
    if not single_task and (missing := {"partitionColumn", "lowerBound", "upperBound", "numPartitions"} - options.keys()):
        raise ValueError(f"a parallel read needs {sorted(missing)}; or ask for single_task")
    opts = {"fetchsize": "10000", **options, "dbtable": table}
    return spark.read.format("jdbc").options(**opts).load()


def read_parquet_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_tables(spark: SparkSession, root: str, fmt: str = "parquet",
                names: list[str] | None = None) -> dict[str, DataFrame]:
    """All source tables found under ``root/<name>.<fmt>``."""
    out = {}
    for name in names or SOURCE_TABLES:
        path = f"{root.rstrip('/')}/{name}.{fmt}"
        out[name] = read_csv_table(spark, path, name) if fmt == "csv" else read_parquet_table(spark, path)
    return out


def footer_row_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``table, row_count`` of Parquet tables from their footers: the aggregate is pushed down
    into the (DSv2) reader, and no column is read. In a session of its own, whose
    settings leave the caller's alone."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    counts = [own.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table"), "row_count")
              for name, path in paths.items()]
    return reduce(DataFrame.unionByName, counts)


def publish_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """Publish a table bucketed and sorted by ``key`` under ``path``, as ``name`` in the session's
    catalog. Joins and groupings by ``key`` of tables with the same number of buckets need no
    exchange of either; rows of one key are in one bucket, so a heavy key makes a large one."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    # one task a bucket writes one file a bucket
    df.repartition(buckets, key).write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return spark.table(name)


def write_replace(df: DataFrame, target: str, fmt: str = "parquet",
                  partition_by: list[str] | None = None,
                  bucket_by: tuple[int, str] | None = None) -> None:
    """Replace ``target``: a path, or a table name (always a table when bucketing).

    A path is first written in full beside the target; only then the old folder is
    dropped and the new one renamed to it, so a load that fails leaves the old
    data, and ``df`` may read it. Between the two steps there is a moment without
    the target; a store without folder renames copies. A table is overwritten by Spark, which
    drops it first.
    """
    path = not bucket_by and ("/" in target or target.startswith("file:"))
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        fresh = f"{target.rstrip('/')}.new-{uuid.uuid4().hex}"
        w.save(fresh)
        jvm = df.sparkSession.sparkContext._jvm
        old, new = jvm.org.apache.hadoop.fs.Path(target), jvm.org.apache.hadoop.fs.Path(fresh)
        fs = new.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
        fs.delete(old, True)
        if not fs.rename(new, old):
            raise OSError(f"{fresh} holds the new data; it could not be renamed to {target}")
        return
    if bucket_by:
        n, col = bucket_by
        w.bucketBy(n, col).sortBy(col).saveAsTable(target)
    else:
        w.saveAsTable(target)


def publish(df: DataFrame, name: str, kind: str = "view", path: str | None = None) -> DataFrame:
    """Publish a model as a view (lazy, re-evaluated) or a fully refreshed table.

    A table is written and read back, which also cuts the lineage for the
    models downstream of it.
    """
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind != "table":
        raise ValueError(f"unknown materialisation {kind!r}")
    if path:
        write_replace(df, path)
        out = spark.read.parquet(path)
        out.createOrReplaceTempView(name)
        return out
    write_replace(df, name)
    return spark.table(name)
