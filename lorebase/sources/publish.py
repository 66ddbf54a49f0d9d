"""Versioned tables on plain parquet: publish, history, change feed, gate.

A table is a folder with one sub-folder per version and a ledger. A version is readable once its ledger row is
written, so a job that dies half-way leaves the version before it in force, and running it again overwrites the
unfinished folder.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.types import StructType

from lorebase.session import stored

LEDGER_SCHEMA = (
    "version BIGINT, ts TIMESTAMP, operation STRING, mode STRING, row_count BIGINT, schema_json STRING, "
    "source STRING, batch_id BIGINT"
)


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """One row per publish of the table at `root`."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(f"{root}/ledger")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def history(spark: SparkSession, root: str) -> DataFrame:
    """The ledger, newest version first."""
    return ledger(spark, root).orderBy(F.desc("version"))


def latest_version(spark: SparkSession, root: str) -> int | None:
    return ledger(spark, root).agg(F.max("version")).first()[0]


def publish(
    df: DataFrame, root: str, operation: str = "WRITE", source: str | None = None, batch_id: int | None = None
) -> int:
    """Write `df` as the next version, replacing rows and schema; returns the version.

    A batch of a stream (`source`, `batch_id`) already in the ledger is not written again. The rows are counted by
    reading the written version back, which takes no more than the file footers and holds after task retries.
    """
    spark = df.sparkSession
    if source is not None:
        done = ledger(spark, root).filter((F.col("source") == source) & (F.col("batch_id") == batch_id))
        seen = done.agg(F.max("version")).first()[0]
        if seen is not None:
            return seen
    last = latest_version(spark, root)
    version = 0 if last is None else last + 1
    df.write.mode("overwrite").parquet(f"{root}/v{version}")
    written = spark.read.schema(df.schema).parquet(f"{root}/v{version}").count()
    entry = spark.createDataFrame(
        [(version, operation, "overwrite", written, df.schema.json(), source, batch_id)],
        "version BIGINT, operation STRING, mode STRING, row_count BIGINT, schema_json STRING, source STRING, batch_id BIGINT",
    ).withColumn("ts", F.current_timestamp())
    entry.select("version", "ts", "operation", "mode", "row_count", "schema_json", "source", "batch_id").coalesce(
        1
    ).write.mode("append").parquet(f"{root}/ledger")
    return version


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A published version, the newest if none is named, with the schema it was published with."""
    entries = ledger(spark, root)
    if version is not None:
        entries = entries.filter(F.col("version") == version)
    entry = entries.agg(F.max_by(F.struct("version", "schema_json"), "version")).first()[0]
    if entry is None:
        raise ValueError(f"version {version} is not published at {root}" if version is not None else f"nothing is published at {root}")
    return spark.read.schema(StructType.fromJson(json.loads(entry.schema_json))).parquet(f"{root}/v{entry.version}")


def publish_catalog(
    df: DataFrame, table: str, keys: list[str] | None = None, buckets: int = 0, path: str | None = None
) -> None:
    """Overwrite a catalog table together with its schema; managed by the catalog unless a path is given.

    With `buckets` the rows are bucketed by `keys`; tables bucketed alike join on those keys without a shuffle.
    """
    writer = df.write.mode("overwrite").option("overwriteSchema", "true")
    if path:
        writer = writer.option("path", path)
    if buckets:
        writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    writer.saveAsTable(table)


def _fingerprint(columns: list[str]) -> Column:
    """128 bits over all columns. The text form tells nulls from everything else, at any depth."""
    exact = {
        "ignoreNullFields": "false",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    }
    return F.md5(F.to_json(F.struct(*columns), exact))


def _named(key: list[str], name: str) -> list[Column]:
    return [F.col(k).alias(f"{name}{place}") for place, k in enumerate(key)]


def _same(key: list[str], one: str, other: str) -> Column:
    """The keys are equal; a null key is a key like any other."""
    return reduce(Column.__and__, [F.col(f"{one}{n}").eqNullSafe(F.col(f"{other}{n}")) for n in range(len(key))])


def snapshot_changes(before: DataFrame, after: DataFrame, key: list[str], version: int) -> DataFrame:
    """Change rows that lead from one snapshot to the next.

    `_change_type` is insert, delete, update_preimage or update_postimage. Both snapshots have the same columns
    and one row per key. Only keys and row fingerprints are shuffled to find the changed keys; these are stored,
    so that Spark knows how few they are when it fetches their rows.
    """
    columns = before.columns
    old = before.select(*_named(key, "_a"), _fingerprint(columns).alias("_old"))
    new = after.select(*_named(key, "_b"), _fingerprint(columns).alias("_new"))
    keys = [F.coalesce(f"_a{n}", f"_b{n}").alias(f"_c{n}") for n in range(len(key))]
    changed = stored(
        old.join(new, _same(key, "_a", "_b"), "full_outer")
        .filter(~F.col("_old").eqNullSafe(F.col("_new")))
        .select(*keys, F.col("_old").isNotNull().alias("_was"), F.col("_new").isNotNull().alias("_is")),
        "changed",
    )
    both = F.col("_was") & F.col("_is")

    def rows(side: DataFrame, present: str, kind: Column) -> DataFrame:
        return side.select("*", *_named(key, "_a")).join(changed.filter(present), _same(key, "_a", "_c")).select(
            *columns, kind.alias("_change_type"), F.lit(version).cast("long").alias("_commit_version")
        )

    return rows(before, "_was", F.when(both, "update_preimage").otherwise("delete")).unionByName(
        rows(after, "_is", F.when(both, "update_postimage").otherwise("insert"))
    )


def apply_changes(base: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """`base` with a change feed applied; of several changes to a key the one of the highest version counts."""
    columns = base.columns
    last = (
        changes.filter(F.col("_change_type") != "update_preimage")
        .groupBy(*key)
        .agg(F.max_by(F.struct("_change_type", *columns), "_commit_version").alias("_last"))
    )
    touched = last.select(*_named(key, "_b"))
    kept = base.select("*", *_named(key, "_a")).join(touched, _same(key, "_a", "_b"), "left_anti").select(*columns)
    written = last.filter(F.col("_last._change_type") != "delete").select(*[F.col(f"_last.{c}").alias(c) for c in columns])
    return kept.unionByName(written)


def publish_gate(source: DataFrame, published: DataFrame, key: str) -> DataFrame:
    """One row that says whether a published table may be used.

    Columns: rows in and out, rows without a key, rows whose key occurs more than once, and the verdict. Keys are
    counted per group before they are shuffled, so a key with many copies is one small row.
    """
    per_key = published.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    checked = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_out"),
        F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_n"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.when(F.col("_key").isNotNull() & (F.col("_n") > 1), F.col("_n"))), F.lit(0)).alias("repeated_keys"),
    )
    rows_in = source.agg(F.count(F.lit(1))).scalar()
    return checked.select(rows_in.alias("rows_in"), "rows_out", "null_keys", "repeated_keys").withColumn(
        "passed", (F.col("rows_in") == F.col("rows_out")) & (F.col("null_keys") == 0) & (F.col("repeated_keys") == 0)
    )


def _hash60(text: Column) -> Column:
    """60 bits of a text's hash as a whole number."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(20,0)")


def _texts(df: DataFrame) -> list[tuple[str, Column]]:
    """Every column, and the row as a whole, as a text that tells nulls from everything else."""
    columns = [(name, F.to_json(F.struct(F.col(name).alias("v")), {"ignoreNullFields": "false"})) for name in df.columns]
    return [*columns, ("*", _fingerprint(df.columns))]


def content_sums(df: DataFrame, sketches: bool = False) -> DataFrame:
    """One row per column and one for whole rows ("*"): (column, rows, nulls, checksum).

    The checksum is the sum of the values' hashes: it doesn't depend on the order of rows or on how they are dealt to tasks, and a
    changed, lost or doubled value changes it but for a chance of about 2^-60. One scan, one row per task in the shuffle. `sketches`
    adds the estimated number of distinct values and, for numbers, the median and the 95th percentile.
    """
    names = [*df.columns, "*"]
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for place, (name, text) in enumerate(_texts(df)):
        aggregates.append(F.coalesce(F.sum(_hash60(text)), F.lit(0).cast("decimal(30,0)")).cast("string").alias(f"sum{place}"))
        aggregates.append((F.count_if(F.col(name).isNull()) if name != "*" else F.lit(0).cast("long")).alias(f"nulls{place}"))
        if sketches:
            number = name != "*" and isinstance(df.schema[name].dataType, T.NumericType)
            aggregates.append(F.approx_count_distinct(text).alias(f"distinct{place}"))
            quantiles = F.percentile_approx(F.col(name).cast("double"), [0.5, 0.95]) if number else F.lit(None).cast("array<double>")
            aggregates.append(quantiles.alias(f"quantiles{place}"))
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.col("rows"),
            F.col(f"nulls{place}").alias("nulls"),
            F.col(f"sum{place}").alias("checksum"),
            *([F.col(f"distinct{place}").alias("distinct"), F.col(f"quantiles{place}").alias("quantiles")] if sketches else []),
        )
        for place, name in enumerate(names)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def content_gate(source: DataFrame, published: DataFrame) -> DataFrame:
    """Whether a published table holds what its source does: (column, rows_in, rows_out, nulls_in, nulls_out, checksum, passed).

    One scan of each. `*` stands for whole rows, which tells values that changed places among rows; a column that only one of
    the two has fails, as its other side is null.
    """
    before = content_sums(source).withColumnsRenamed({"rows": "rows_in", "nulls": "nulls_in"})
    after = content_sums(published.select(*[c for c in source.columns if c in published.columns], *[c for c in published.columns if c not in source.columns]))
    after = after.withColumnsRenamed({"rows": "rows_out", "nulls": "nulls_out", "checksum": "_checksum"})
    same = reduce(Column.__and__, [F.col(a).eqNullSafe(F.col(b)) for a, b in (("rows_in", "rows_out"), ("nulls_in", "nulls_out"), ("checksum", "_checksum"))])
    return before.join(after, "column", "full_outer").select("column", "rows_in", "rows_out", "nulls_in", "nulls_out", "checksum", same.alias("passed"))


def schema_matches(df: DataFrame, expected: DataFrame) -> bool:
    """Same column names and types in the same order."""
    return [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in expected.schema]
