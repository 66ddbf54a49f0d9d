"""Queries over ingest, combination and publishing, each with the SQL that gives the same rows."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from lorebase.functions.text import document_key
from lorebase.operators import combine
from lorebase.plans import roles
from lorebase.session import fresh_path, stored
from lorebase.sources import extract, pages, publish
from lorebase.sources.readers import read_documents, read_policies, read_table, read_texts, schema_rows
from lorebase.sources.readers import scan as read_catalog

#: Bytes of a document that one task reads; small, so that documents of the given tables are cut as long ones are.
PAGE_SPLIT = 8 << 10
COUNTED = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def scan_products(spark: SparkSession, sf: str) -> DataFrame:
    return roles.products(spark, sf)


def scan_docs(spark: SparkSession, sf: str) -> DataFrame:
    return roles.product_docs(spark, sf)


def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = [
        read_table(spark, sf, name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name in COUNTED
    ]
    return reduce(DataFrame.unionByName, counts)


def filter_url_suffix(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "pages").filter(F.endswith(F.col("url"), F.lit(".html"))).select("page_id", "url")


def derive_doc_key(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "pages").select("page_id", document_key(F.col("url"), ".html").alias("doc_key"))


def extract_page_text(spark: SparkSession, sf: str) -> DataFrame:
    pages = read_texts(spark, sf, "pages", ["page_id"], "url", "html")
    return extract.extract_pages(pages, "url", "html").select("product_name", "product_doc")


def ingest_accepted(spark: SparkSession, sf: str) -> DataFrame:
    return extract.accepted(roles.extracted_pages(spark, sf))


def ingest_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return extract.rejects(roles.extracted_pages(spark, sf))


def ingest_summary(spark: SparkSession, sf: str) -> DataFrame:
    return extract.ingest_summary(roles.extracted_pages(spark, sf))


def join_products_docs(spark: SparkSession, sf: str) -> DataFrame:
    return combine.join_documents(roles.products(spark, sf), roles.product_docs(spark, sf))


def join_fanout(spark: SparkSession, sf: str) -> DataFrame:
    return combine.join_documents(roles.named_products(spark, sf), roles.named_docs(spark, sf))


def join_fanout_salted(spark: SparkSession, sf: str) -> DataFrame:
    """The same with every name of more than two products dealt to salts, as hot ones are at full size."""
    return combine.join_documents(roles.named_products(spark, sf), roles.named_docs(spark, sf), rows=2)


def fanout_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return combine.fan_out(roles.named_products(spark, sf), roles.named_products(spark, sf))


def join_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return combine.join_coverage(roles.products(spark, sf), roles.product_docs(spark, sf))


def product_docs_combined(spark: SparkSession, sf: str) -> DataFrame:
    return combine.product_docs_combined(roles.products(spark, sf), roles.product_docs(spark, sf))


def tagged_doc_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Products without a document keep a null text, so their tagged text is null too."""
    joined = roles.products(spark, sf).join(roles.product_docs(spark, sf), "product_name", "left")
    return joined.select("product_id", combine.tagged_document().alias("indexed_doc"))


def preview_products(spark: SparkSession, sf: str) -> DataFrame:
    return combine.first_rows(roles.products(spark, sf), ["product_id"], 5)


def doc_preview(spark: SparkSession, sf: str) -> DataFrame:
    return combine.first_document(product_docs_combined(spark, sf))


def publish_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Overwritten in the catalog with another schema, then read back by name."""
    name, folder = f"combined_{uuid.uuid4().hex}", fresh_path(spark, "combined")
    publish.publish_catalog(roles.products(spark, sf), name, path=folder)
    publish.publish_catalog(product_docs_combined(spark, sf), name, path=folder)
    return read_catalog(spark, name)


def document_job(spark: SparkSession, sf: str) -> DataFrame:
    """Files listed, read, keyed and extracted; the accepted ones."""
    files = read_documents(spark, roles.page_files(spark, sf))
    return extract.accepted(extract.extract_documents(files))


def document_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Documents read page by page through the data source, long ones by several tasks, and put together; the accepted ones."""
    read = pages.read_pages(spark, roles.paged_files(spark, sf), split_bytes=PAGE_SPLIT)
    return extract.accepted(pages.documents_of(read))


def policy_file(spark: SparkSession, sf: str) -> DataFrame:
    """The policies written to a CSV file and read from it."""
    path = fresh_path(spark, "policies")
    roles.policies(spark, sf).write.option("header", True).option("quoteAll", True).csv(path)
    return read_policies(spark, path).withColumn("last_updated", F.col("last_updated").cast("string"))


def publish_history(spark: SparkSession, sf: str) -> DataFrame:
    root = fresh_path(spark, "documents")
    publish.publish(roles.first_version(spark, sf), root, "CREATE")
    publish.publish(roles.second_version(spark, sf), root, "REPLACE")
    return publish.history(spark, root).select("version", "operation", "mode", "row_count")


def snapshot_changes(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = stored(roles.second_version(spark, sf), "cleaned")
    return publish.snapshot_changes(roles.first_version(spark, sf), cleaned, ["product_name"], 1)


def apply_changes(spark: SparkSession, sf: str) -> DataFrame:
    return publish.apply_changes(roles.first_version(spark, sf), snapshot_changes(spark, sf), ["product_name"])


def publish_gate(spark: SparkSession, sf: str) -> DataFrame:
    """The gate over what was published and is read back: products under their trade names, which repeat."""
    root, named = fresh_path(spark, "named"), roles.named_products(spark, sf)
    publish.publish(named, root)
    return publish.publish_gate(named, publish.read_version(spark, root), "product_name")


def table_schemas(spark: SparkSession, sf: str) -> DataFrame:
    """The columns of every table as rows."""
    rows = [schema_rows(read_table(spark, sf, name)).select(F.lit(name).alias("table"), "position", "column", "type") for name in COUNTED]
    return reduce(DataFrame.unionByName, rows)


def content_gate(spark: SparkSession, sf: str) -> DataFrame:
    """The gate by content over the published policies: of every column and of whole rows."""
    root, source = fresh_path(spark, "policies"), roles.policies(spark, sf)
    publish.publish(source, root)
    return publish.content_gate(source, publish.read_version(spark, root))


QUERIES = {
    f.__name__: f
    for f in (
        scan_products,
        scan_docs,
        table_counts,
        filter_url_suffix,
        derive_doc_key,
        extract_page_text,
        ingest_accepted,
        ingest_rejects,
        ingest_summary,
        join_products_docs,
        join_fanout,
        join_fanout_salted,
        fanout_sizes,
        join_coverage,
        product_docs_combined,
        tagged_doc_nulls,
        preview_products,
        doc_preview,
        publish_roundtrip,
        document_job,
        document_pages,
        policy_file,
        publish_history,
        snapshot_changes,
        apply_changes,
        publish_gate,
        content_gate,
        table_schemas,
    )
}

PRODUCTS = (
    "SELECT p_partkey AS product_id, 'doc-' || p_partkey AS product_name, p_type AS product_category, "
    "p_brand AS product_sub_category FROM part"
)
DOCS = "SELECT 'doc-' || doc_id AS product_name, text AS product_doc FROM documents"


def page_text(html: str) -> str:
    dropped = html
    for pattern in (r"(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>", "(?s)<!--.*?-->", "(?s)<[^>]*>"):
        dropped = f"regexp_replace({dropped}, '{pattern}', ' ', 'g')"
    return rf"trim(regexp_replace({dropped}, '\s+', ' ', 'g'))"


DOC_KEY = "replace(list_extract(string_split(url, '/'), -1), '.html', '')"
EXTRACTED = f"SELECT {DOC_KEY} AS product_name, {page_text('html')} AS product_doc FROM pages"
PAGE_FILES = (
    "SELECT 'page-' || page_id AS product_name, regexp_replace(html, '^[\\s\\x{85}\\x{a0}]+|[\\s\\x{85}\\x{a0}]+$', '', 'g') "
    "AS product_doc FROM pages WHERE html IS NOT NULL AND html <> ''"
)
PAGED_FILES = (
    "SELECT * FROM (SELECT 'doc-' || doc_id AS product_name, regexp_replace(replace(text, chr(12), chr(10)), "
    "'^[\\s\\x{85}\\x{a0}\\x{1c}-\\x{1f}]+|[\\s\\x{85}\\x{a0}\\x{1c}-\\x{1f}]+$', '', 'g') AS product_doc FROM documents) WHERE product_doc <> ''"
)
GATED = (
    "SELECT 'Policy ' || item_id AS policy, text AS policy_details, "
    "CAST(CAST(DATE '2023-01-01' + CAST(item_id % 365 AS INT) AS DATE) AS VARCHAR) AS last_updated FROM benchmark"
)
TAGGED = (
    "'<product_category>' || product_category || '</product_category>' || chr(10) || "
    "'<product_sub_category>' || product_sub_category || '</product_sub_category>' || chr(10) || "
    "'<product_name>' || product_name || '</product_name>' || chr(10) || "
    "'<product_doc>' || chr(10) || product_doc || chr(10) || '</product_doc>'"
)
COMBINED = (
    f"SELECT product_id, product_name, product_doc, product_category, product_sub_category, {TAGGED} AS indexed_doc "
    f"FROM ({PRODUCTS}) JOIN ({DOCS}) USING (product_name)"
)
SECOND = (
    "SELECT 'doc-' || doc_id AS product_name, CASE WHEN quality = 0 THEN trim(regexp_replace(text, '\\s+', ' ', 'g')) "
    "ELSE text END AS product_doc FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(toxic, 0) = 0 "
    f"UNION ALL SELECT 'page-' || page_id, {page_text('html')} FROM pages"
)

FANOUT = (
    "SELECT p_name AS product_name, p_partkey AS product_id, f.doc_id, n_chars FROM part "
    "JOIN (SELECT p_name AS name, min(p_partkey) AS doc_id FROM part GROUP BY 1) f ON name = p_name "
    "JOIN documents ON documents.doc_id = f.doc_id"
)

ORACLES = {
    "scan_products": PRODUCTS,
    "scan_docs": DOCS,
    "table_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in COUNTED),
    "filter_url_suffix": "SELECT page_id, url FROM pages WHERE ends_with(url, '.html')",
    "derive_doc_key": f"SELECT page_id, {DOC_KEY} AS doc_key FROM pages",
    "extract_page_text": f"SELECT {DOC_KEY} AS product_name, {page_text('html')} AS product_doc FROM pages",
    "ingest_accepted": f"SELECT * FROM ({EXTRACTED}) WHERE product_doc <> ''",
    "ingest_rejects": f"SELECT product_name, CASE WHEN product_doc IS NULL THEN 'no text' ELSE 'empty text' END AS reason "
    f"FROM ({EXTRACTED}) WHERE product_doc IS NULL OR product_doc = ''",
    "ingest_summary": f"SELECT count(*) AS found, count(*) FILTER (product_doc <> '') AS extracted, "
    f"count(*) FILTER (product_doc IS NULL OR product_doc = '') AS failed, "
    f"CAST(coalesce(sum(length(product_doc)), 0) AS BIGINT) AS characters FROM ({EXTRACTED})",
    "join_products_docs": f"SELECT * FROM ({PRODUCTS}) JOIN ({DOCS}) USING (product_name)",
    "join_fanout": FANOUT,
    "join_fanout_salted": FANOUT,
    "fanout_sizes": "SELECT p_name AS product_name, count(*) AS products, count(*) AS docs, count(*) * count(*) AS joined "
    "FROM part GROUP BY 1",
    "join_coverage": f"SELECT 'product without document' AS side, product_name, count(*) AS row_count FROM ({PRODUCTS}) "
    f"WHERE product_name NOT IN (SELECT product_name FROM ({DOCS})) GROUP BY 2 UNION ALL "
    f"SELECT 'document without product', product_name, count(*) FROM ({DOCS}) "
    f"WHERE product_name NOT IN (SELECT product_name FROM ({PRODUCTS})) GROUP BY 2",
    "product_docs_combined": COMBINED,
    "tagged_doc_nulls": f"SELECT product_id, {TAGGED} AS indexed_doc FROM ({PRODUCTS}) LEFT JOIN ({DOCS}) USING (product_name)",
    "preview_products": f"{PRODUCTS} ORDER BY p_partkey LIMIT 5",
    "doc_preview": f"SELECT product_name, substring(indexed_doc, 1, 500) || '...' AS shown FROM ({COMBINED}) "
    "ORDER BY product_name LIMIT 1",
    "publish_roundtrip": COMBINED,
    "document_job": PAGE_FILES,
    "document_pages": PAGED_FILES,
    "policy_file": "SELECT 'Policy ' || item_id AS policy, text AS policy_details, "
    "CAST(CAST(DATE '2023-01-01' + CAST(item_id % 365 AS INT) AS DATE) AS VARCHAR) AS last_updated FROM benchmark",
    "publish_history": f"SELECT CAST(0 AS BIGINT) AS version, 'CREATE' AS operation, 'overwrite' AS mode, count(*) AS row_count "
    f"FROM ({DOCS}) UNION ALL SELECT CAST(1 AS BIGINT), 'REPLACE', 'overwrite', count(*) FROM ({SECOND})",
    "snapshot_changes": f"""
        WITH j AS (SELECT o.product_name AS old_name, n.product_name AS new_name, o.product_doc AS old_doc, n.product_doc AS new_doc
                   FROM ({DOCS}) o FULL JOIN ({SECOND}) n ON o.product_name = n.product_name)
        SELECT new_name AS product_name, new_doc AS product_doc, 'insert' AS _change_type, CAST(1 AS BIGINT) AS _commit_version
        FROM j WHERE old_name IS NULL
        UNION ALL SELECT old_name, old_doc, 'delete', 1 FROM j WHERE new_name IS NULL
        UNION ALL SELECT old_name, old_doc, 'update_preimage', 1 FROM j WHERE old_name = new_name AND old_doc IS DISTINCT FROM new_doc
        UNION ALL SELECT new_name, new_doc, 'update_postimage', 1 FROM j WHERE old_name = new_name AND old_doc IS DISTINCT FROM new_doc""",
    "apply_changes": SECOND,
    "table_schemas": " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", CAST(cid AS INT) AS position, name AS \"column\", CASE type WHEN 'VARCHAR' THEN 'string' "
        f"WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' ELSE lower(type) END AS type "
        f"FROM pragma_table_info('{name}')"
        for name in COUNTED
    ),
    "content_gate": f"""
        WITH p AS ({GATED}),
        t AS (SELECT 'policy' AS "column", CAST(json_object('v', policy) AS VARCHAR) AS v, policy IS NULL AS gone FROM p
              UNION ALL SELECT 'policy_details', CAST(json_object('v', policy_details) AS VARCHAR), policy_details IS NULL FROM p
              UNION ALL SELECT 'last_updated', CAST(json_object('v', last_updated) AS VARCHAR), last_updated IS NULL FROM p
              UNION ALL SELECT '*', md5(CAST(json_object('policy', policy, 'policy_details', policy_details, 'last_updated', last_updated) AS VARCHAR)), false FROM p)
        SELECT "column", count(*) AS rows_in, count(*) AS rows_out, count(*) FILTER (gone) AS nulls_in, count(*) FILTER (gone) AS nulls_out,
               CAST(sum(CAST(CAST('0x' || substring(md5(v), 1, 15) AS BIGINT) AS HUGEINT)) AS VARCHAR) AS checksum, true AS passed
        FROM t GROUP BY 1""",
    "publish_gate": """
        WITH n AS (SELECT p_name, count(*) AS c FROM part GROUP BY 1)
        SELECT (SELECT count(*) FROM part) AS rows_in, CAST(sum(c) AS BIGINT) AS rows_out,
               CAST(coalesce(sum(c) FILTER (p_name IS NULL), 0) AS BIGINT) AS null_keys,
               CAST(coalesce(sum(c) FILTER (p_name IS NOT NULL AND c > 1), 0) AS BIGINT) AS repeated_keys,
               (SELECT count(*) FROM part) = sum(c) AND count(*) FILTER (p_name IS NULL) = 0
                 AND count(*) FILTER (p_name IS NOT NULL AND c > 1) = 0 AS passed
        FROM n""",
}
