"""Products joined with their documents into one tagged text per product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lorebase.functions.text import preview
from lorebase.operators.skew import HOT_ROWS, split_join

# The columns of the published table; the tags below are named after them.
COMBINED = ["product_id", "product_name", "product_doc", "product_category", "product_sub_category", "indexed_doc"]


def join_documents(products: DataFrame, docs: DataFrame, rows: int = HOT_ROWS) -> DataFrame:
    """Inner join on `product_name`, which comes first and once; names without a partner are dropped."""
    columns = ["product_name"] + [c for c in (*products.columns, *docs.columns) if c != "product_name"]
    return split_join(products, docs, ["product_name"], rows=rows).select(*columns)


def tagged_document() -> Column:
    """Category, sub-category, name and text, each inside its tag; null when any of them is null."""
    lines = []
    for field in ("product_category", "product_sub_category", "product_name"):
        lines += [F.lit(f"<{field}>"), F.col(field), F.lit(f"</{field}>\n")]
    return F.concat(*lines, F.lit("<product_doc>\n"), F.col("product_doc"), F.lit("\n</product_doc>"))


def product_docs_combined(products: DataFrame, docs: DataFrame, rows: int = HOT_ROWS) -> DataFrame:
    """The published table: six columns in fixed order."""
    return join_documents(products, docs, rows).withColumn("indexed_doc", tagged_document()).select(*COMBINED)


def join_coverage(products: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows the inner join loses: (side, product_name, row_count)."""

    def names(df: DataFrame) -> DataFrame:
        return df.groupBy("product_name").agg(F.count(F.lit(1)).alias("row_count"))

    left, right = names(products), names(docs)
    return (
        left.join(right, "product_name", "left_anti")
        .select(F.lit("product without document").alias("side"), "product_name", "row_count")
        .unionByName(
            right.join(left, "product_name", "left_anti").select(
                F.lit("document without product").alias("side"), "product_name", "row_count"
            )
        )
    )


def fan_out(products: DataFrame, docs: DataFrame) -> DataFrame:
    """How many rows the join yields per name, without building them: (product_name, products, docs, joined)."""
    left = products.groupBy("product_name").agg(F.count(F.lit(1)).alias("products"))
    right = docs.groupBy("product_name").agg(F.count(F.lit(1)).alias("docs"))
    return left.join(right, "product_name").withColumn("joined", F.col("products") * F.col("docs"))


def first_rows(df: DataFrame, order: list[str], size: int = 5) -> DataFrame:
    """A sample report of the first `size` rows in a stated order."""
    return df.orderBy(*order).limit(size)


def first_document(combined: DataFrame) -> DataFrame:
    """The first document by name, shortened for reading."""
    return first_rows(combined.select("product_name", "indexed_doc"), ["product_name"], 1).select(
        "product_name", preview(F.col("indexed_doc")).alias("shown")
    )
