"""Text expressions and chunkers. All of them stay inside the row: no shuffle, no Python.

The chunkers use the outer form of explode and drop the rows of empty texts themselves: for the inner form the
optimizer would add a filter that cuts the whole text a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Separators and markup patterns.
TOKEN_SEPARATOR = r"[^\p{L}\p{N}]+"
EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"
HTML_DROPPED = [
    r"(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>",
    r"(?s)<!--.*?-->",
    r"(?s)<[^>]*>",
]


def strip(text: Column) -> Column:
    """Remove white space of every kind, Unicode's included, from both ends (`trim` removes blanks only)."""
    return F.regexp_replace(text, EDGE_SPACE, "")


def tokens(text: Column) -> Column:
    """Lower-case words and numbers, in order."""
    return F.array_remove(F.split(F.lower(text), TOKEN_SEPARATOR), "")


def html_text(html: Column) -> Column:
    """Visible text of a page: scripts, styles, comments and tags dropped, white space squeezed."""
    for pattern in HTML_DROPPED:
        html = F.regexp_replace(html, pattern, " ")
    return F.trim(F.regexp_replace(html, r"\s+", " "))


def document_key(path: Column, suffix: str) -> Column:
    """File name of `path` with every occurrence of `suffix` removed, not only the last one."""
    return F.replace(F.element_at(F.split(path, "/"), -1), F.lit(suffix), F.lit(""))


def preview(text: Column, size: int = 500) -> Column:
    """The first `size` characters, always followed by three dots."""
    return F.concat(F.substring(text, 1, size), F.lit("..."))


def fixed_chunks(df: DataFrame, text: str, size: int = 500, overlap: int = 100) -> DataFrame:
    """One row per chunk of `size` characters, each starting `size - overlap` after the one before.

    The text is cut once into steps and neighbouring steps are glued, so the cost is linear in its length.
    Adds `chunk_no` and `chunk`; drops the text.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than size")
    step = size - overlap
    glue = -(-size // step)
    pieces = df.withColumn("_pieces", F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{step}}}"), F.lit(0)))
    # The last piece repeats what the chunk before it already ends with when it lies inside the overlap.
    count = F.greatest(F.lit(1), F.ceil((F.length(text) - overlap) / step)).cast("int")
    cut = pieces.select(
        *[c for c in df.columns if c != text],
        count.alias("_count"),
        F.col("_pieces"),
        F.posexplode_outer("_pieces").alias("chunk_no", "_piece"),
    ).filter(F.col("chunk_no") < F.col("_count"))
    glued = F.concat(F.col("_piece"), *[F.coalesce(F.get("_pieces", F.col("chunk_no") + i), F.lit("")) for i in range(1, glue)])
    return cut.withColumn("chunk", F.substring(glued, 1, size)).drop("_pieces", "_piece", "_count")


def packed_chunks(df: DataFrame, text: str, size: int = 500) -> DataFrame:
    """Whole sentences packed greedily into chunks of at most `size` characters.

    A sentence longer than `size` is cut at `size`. The chunks of a text put together again are that text.
    """
    rest, sentences, cut = rf".{{1,{size}}}\z", rf".{{0,{size - 1}}}[.!?\n]", rf".{{1,{size}}}"
    pattern = f"(?s){rest}|{sentences}|{cut}"
    return df.select(
        *[c for c in df.columns if c != text],
        F.posexplode_outer(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).alias("chunk_no", "chunk"),
    ).filter(F.col("chunk_no").isNotNull())


def semantic_chunks(df: DataFrame, text: str, threshold: float = 0.1) -> DataFrame:
    """Runs of neighbouring sentences; a new chunk starts where two neighbours share too few words.

    Likeness of two sentences is the cosine of their word sets: |common| / sqrt(|a| * |b|).
    """
    sentence = F.regexp_extract_all(F.col(text), F.lit(r"(?s)[^.!?\n]*[.!?\n]+|[^.!?\n]+"), F.lit(0))
    cut = df.withColumn("_sentences", sentence)
    words = F.transform("_sentences", lambda s: F.array_distinct(tokens(s)))
    # The neighbours are paired with arrays_zip, so each word list is built once and not looked up by index.
    cut = cut.withColumn("_words", words).withColumn(
        "_pairs",
        F.zip_with(
            F.concat(F.array(F.lit(None).cast("array<string>")), F.slice("_words", 1, F.greatest(F.size("_words") - 1, F.lit(0)))),
            F.col("_words"),
            lambda a, b: F.when(a.isNull(), True).otherwise(
                F.size(F.array_intersect(a, b)) / F.greatest(F.sqrt((F.size(a) * F.size(b)).cast("double")), F.lit(1.0))
                < threshold
            ),
        ),
    )
    starts = F.filter(F.transform("_pairs", lambda opens, i: F.when(opens, i)), lambda i: i.isNotNull())
    numbered = cut.withColumn("_starts", starts).select(
        *[c for c in df.columns if c != text], "_sentences", "_starts", F.posexplode_outer("_starts").alias("chunk_no", "_from")
    ).filter(F.col("chunk_no").isNotNull())
    until = F.coalesce(F.get("_starts", F.col("chunk_no") + 1), F.size("_sentences"))
    return numbered.withColumn(
        "chunk", F.array_join(F.slice("_sentences", F.col("_from") + 1, until - F.col("_from")), "")
    ).drop("_sentences", "_starts", "_from")
