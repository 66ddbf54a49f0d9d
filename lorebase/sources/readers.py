"""Readers: catalog and parquet tables, document folders, policy files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

POLICY_SCHEMA = "policy STRING, policy_details STRING, last_updated DATE"
BINARY_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same table as a stream, in the schema it has now."""
    schema = read_table(spark, folder, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def read_texts(spark: SparkSession, folder: str, name: str, keys: list[str], *columns: str) -> DataFrame:
    """(keys, columns) of a table whose texts are costly to work on.

    A file is cut at its row groups only, so a small table can arrive in fewer tasks than there are cores; then,
    and only then, its rows are dealt out by their keys, which together are unique.
    """
    rows = read_table(spark, folder, name).select(*keys, *columns)
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores, *keys) if rows.rdd.getNumPartitions() < cores else rows


def scan(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by its one- to three-part name."""
    return spark.table(name)


def read_documents(spark: SparkSession, folder: str, suffix: str = ".pdf") -> DataFrame:
    """Files of one folder whose name ends in `suffix` (case matters, sub-folders are left out), as bytes."""
    return spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder)


def stream_documents(spark: SparkSession, folder: str, suffix: str = ".pdf", files_per_batch: int = 1_000) -> DataFrame:
    """The same folder as a stream: each file is read once, also across restarts from a checkpoint.

    Spark looks up the files of a batch again by a job with a task for each file; it gets as many tasks as there are cores.
    """
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(spark.sparkContext.defaultParallelism))
    return (
        spark.readStream.format("binaryFile")
        .schema(BINARY_SCHEMA)
        .option("pathGlobFilter", f"*{suffix}")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )


def read_policies(spark: SparkSession, path: str) -> DataFrame:
    """Policy file: CSV with a header, quoted fields and a date column."""
    return spark.read.option("header", True).option("multiLine", True).schema(POLICY_SCHEMA).csv(path)


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema of `df` as rows (position, column, type, nullable)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position INT, column STRING, type STRING, nullable BOOLEAN")
