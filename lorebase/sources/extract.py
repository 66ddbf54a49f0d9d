"""Document-to-text job: bytes in, one text per document out, failures kept apart."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lorebase.functions.text import document_key, html_text, strip

EXTRACTED = "product_name STRING, product_doc STRING, error STRING"


def form_feed_pages(content: bytes) -> list[str]:
    """Default page reader: UTF-8 text with pages separated by form feeds."""
    return content.decode("utf-8").split("\f")


def extract_documents(
    files: DataFrame, pages: Callable[[bytes], list[str]] = form_feed_pages, suffix: str = ".pdf"
) -> DataFrame:
    """(path, content) to (product_name, product_doc, error).

    Each page's text is followed by a line break, the whole is stripped. One unreadable page makes the whole
    document null and names the error. `pages` is any reader of one document's bytes.
    """

    def read(content: bytes) -> tuple[str | None, str | None]:
        try:
            return "".join(page + "\n" for page in pages(bytes(content))).strip(), None
        except Exception as problem:
            return None, f"{type(problem).__name__}: {problem}"

    def job(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [read(content) for content in batch["content"]]
            yield pd.DataFrame(
                {
                    "product_name": batch["product_name"].to_numpy(),
                    "product_doc": [text for text, _ in done],
                    "error": [error for _, error in done],
                }
            )

    return files.select(document_key(F.col("path"), suffix).alias("product_name"), "content").mapInPandas(job, EXTRACTED)


def extract_pages(pages: DataFrame, path: str, html: str) -> DataFrame:
    """The same job for HTML, without Python: (product_name, product_doc, error)."""
    return pages.select(
        document_key(F.col(path), ".html").alias("product_name"),
        strip(html_text(F.col(html))).alias("product_doc"),
        F.lit(None).cast("string").alias("error"),
    )


def _readable(text: Column) -> Column:
    return F.coalesce(text != "", F.lit(False))


def accepted(extracted: DataFrame) -> DataFrame:
    """Documents with text: (product_name, product_doc)."""
    return extracted.filter(_readable(F.col("product_doc"))).select("product_name", "product_doc")


def rejects(extracted: DataFrame) -> DataFrame:
    """Documents without text and why: (product_name, reason)."""
    return extracted.filter(~_readable(F.col("product_doc"))).select(
        "product_name",
        F.coalesce("error", F.when(F.col("product_doc") == "", "empty text").otherwise("no text")).alias("reason"),
    )


def ingest_summary(extracted: DataFrame) -> DataFrame:
    """One row: documents found, extracted and failed, and characters extracted."""
    readable = _readable(F.col("product_doc"))
    return extracted.agg(
        F.count(F.lit(1)).alias("found"),
        F.count_if(readable).alias("extracted"),
        F.count_if(~readable).alias("failed"),
        F.coalesce(F.sum(F.when(readable, F.length("product_doc"))), F.lit(0)).cast("long").alias("characters"),
    )
