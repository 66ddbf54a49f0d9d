"""Near-duplicate documents: fast similarity sketches, banding, exact verification, connected components.

Method: a document is the set of its word shingles. Equal sets are one class, so copies cost nothing further. The sketch of a
set has one coordinate per bin; rounds of hashed placement fill the bins, and the later rounds, one bin each, guarantee
that every bin fills. Coordinates are read in bands. Classes that share a band are compared with the smallest id among them, on
their full sets. Where a band still holds classes of several components, its classes are compared with one another in
tiles of bounded size: a task gets two slices of classes with their sets, counts common shingles through an index of the
shingles, and hands on only the links that join components. So no pairs are listed, no band is capped, and a band of any
size is spread over many tasks; what grows with the square of a band is the work in tiles of classes that are alike but
not linked.

Cases: words are what stands between ASCII white space, with A-Z in lower case. A text with fewer words than a shingle has
its whole sequence as one; a null text or one without words has the empty set, is linked with nothing and is kept. Repeated rows
are copies; rows that share an id count as one document: what is linked with one is linked with all. A row with a null id
is linked with nothing, has a null component and is kept. Other columns are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lorebase.llm.common import Batches, Written, in_batches, map_batches, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Coordinates are grouped into BANDS bands of ROWS. Two sets of similarity 0.8 share no band with a probability of
#: (1 - 0.8 ** 6) ** 48 = 5e-7, and less the more alike they are.
BANDS, ROWS = 48, 6
PRIME, MIX_1, MIX_2 = (np.uint64(v) for v in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: Words that a task remembers the hash of.
MEMO_WORDS = 1 << 17
#: Bytes of sets in one slice of a tile; a tile holds two slices.
SLICE_BYTES = 8 << 20


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix of whole numbers."""
    values = (values ^ (values >> np.uint64(30))) * MIX_1
    values = (values ^ (values >> np.uint64(27))) * MIX_2
    return values ^ (values >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered as far as MEMO_WORDS allows."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode())
        return value


def shingles(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    """The distinct shingles of a text as ascending 64-bit hashes; a text of fewer words is one shingle."""
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return np.empty(0, dtype=np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(size, len(words))
    rolled = np.full(len(values) - width + 1, width, dtype=np.uint64)
    for offset in range(width):
        rolled = mixed(rolled * PRIME + values[offset : offset + len(rolled)])
    return np.unique(rolled)


def sketch(items: np.ndarray, coordinates: int) -> np.ndarray:
    """Fast similarity sketch of a set that is not empty.

    In round i every item is placed in one bin by a hash of its own, with a value that lies above those of all earlier
    rounds; a bin keeps its smallest value. After `coordinates` rounds, round coordinates + j puts every item into bin j,
    so all bins fill. Rounds are made several at a time: a bin that is full can't change any more.
    """
    filled = np.full(coordinates, np.iinfo(np.uint64).max, dtype=np.uint64)
    at_once = max(1, -(-3 * coordinates // (2 * len(items))) * 4)
    for start in range(0, coordinates, at_once):
        rounds = np.arange(start, min(start + at_once, coordinates), dtype=np.uint64)
        drawn = mixed(items[None, :] ^ mixed((rounds + np.uint64(1)) * PRIME)[:, None])
        bins = ((drawn >> np.uint64(32)) * np.uint64(coordinates)) >> np.uint64(32)
        values = (rounds[:, None] << np.uint64(32)) | (drawn & np.uint64(0xFFFFFFFF))
        np.minimum.at(filled, bins.ravel().astype(np.int64), values.ravel())
        if filled.max() != np.iinfo(np.uint64).max:
            return filled
    for empty in np.flatnonzero(filled == np.iinfo(np.uint64).max).tolist():
        number = np.array([coordinates + empty], dtype=np.uint64)
        drawn = mixed(items ^ mixed((number + np.uint64(1)) * PRIME)) & np.uint64(0xFFFFFFFF)
        filled[empty] = (number[0] << np.uint64(32)) | drawn.min()
    return filled


def bands(coordinates: np.ndarray, count: int, rows: int) -> np.ndarray:
    """One key for each band; keys of different bands differ."""
    parts = coordinates.reshape(count, rows)
    keys = mixed((np.arange(count, dtype=np.uint64) + np.uint64(1)) * PRIME)
    for column in range(rows):
        keys = mixed(keys * PRIME + parts[:, column])
    return keys


def fingerprint(items: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    high, low = np.frombuffer(hashlib.blake2b(items.tobytes(), digest_size=16).digest(), dtype="<i8").tolist()
    return high, low


def sketch_step(size: int, band_count: int, band_rows: int):
    schema = pa.schema(
        [(n, pa.int64()) for n in ("doc_id", "n_shingles", "high", "low")] + [("bands", pa.list_(pa.int64()))]
    )

    def rows(batches: Batches) -> Iterator[tuple]:
        hashes, nothing = WordHashes(), np.empty(0, dtype=np.int64)
        for doc_id, text in rows_of(batches):
            items = shingles(text, size, hashes)
            keys = bands(sketch(items, band_count * band_rows), band_count, band_rows).view(np.int64) if len(items) else nothing
            yield doc_id, len(items), *fingerprint(items), keys

    return lambda batches: in_batches(rows(batches), schema)


def items_step(size: int):
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "high", "low")] + [("items", pa.list_(pa.int64()))])

    def rows(batches: Batches) -> Iterator[tuple]:
        hashes = WordHashes()
        for doc_id, text in rows_of(batches):
            items = shingles(text, size, hashes)
            yield doc_id, *fingerprint(items), items.view(np.int64)

    return lambda batches: in_batches(rows(batches), schema)


def alike(common: Column, left: Column, right: Column, percent: int) -> Column:
    return 100 * common >= percent * (left + right - common)


def components(edges: DataFrame) -> Written:
    """(node, component): the smallest node that each node of the edges (a, b) reaches.

    Alternates large and small stars: every node links its larger neighbours, then its smaller ones, to its smallest
    one, until nothing changes; that takes about as many rounds as the logarithm of the longest chain. Each round is written
    to the shared folder. Hubs are joined, never gathered.
    """
    current = Written(edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").where("a <> b").distinct(), "edges")
    state = None
    while True:
        links = current.df
        found = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(found) == state:
            break
        state = tuple(found)
        both = links.unionByName(links.selectExpr("b AS a", "a AS b"))
        lowest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = with_lowest(both, lowest).where("b > a").selectExpr("b AS a", "low AS b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = with_lowest(large, lowest).where("b <> low").selectExpr("b AS a", "low AS b")
        after = Written(small.unionByName(lowest.selectExpr("a", "low AS b")).distinct(), "edges")
        current.drop()
        current = after
    nodes = current.df.selectExpr("a AS node", "b AS component")
    labels = Written(nodes.unionByName(nodes.selectExpr("component AS node", "component").distinct()), "components")
    current.drop()
    return labels


def with_lowest(links: DataFrame, lowest: DataFrame) -> DataFrame:
    """Links with the smallest neighbour of their first node.

    The nodes are compared as decimals, so that both sides are dealt out for this join and not as they were for the grouping
    before it: only then can adaptive execution split the links of a hub.
    """
    named = lowest.select(F.col("a").cast("decimal(20,0)").alias("hub"), "low")
    return links.join(named, links["a"].cast("decimal(20,0)") == named["hub"]).select("a", "b", "low")


def tile_links(percent: int):
    """Links between classes of different components in one tile; only those that join components are handed on."""

    def links(tile: pd.DataFrame) -> pd.DataFrame:
        ids, slices = tile["rep"].to_numpy(), tile["slice"].to_numpy()
        sizes = np.fromiter(map(len, tile["items"]), dtype=np.int64, count=len(tile))
        flat = np.concatenate(tile["items"].to_list())
        owner = np.repeat(np.arange(len(tile)), sizes)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        fresh = np.r_[True, flat[1:] != flat[:-1]]
        first = np.flatnonzero(fresh)
        many = np.diff(np.r_[first, len(flat)])
        place = np.empty(len(flat), dtype=np.int64)
        place[order] = np.cumsum(fresh) - 1
        ends = np.cumsum(sizes)
        group = np.unique(tile["component"].to_numpy(), return_inverse=True)[1]
        largest = np.bincount(group).argmax()
        found: list[tuple[int, int]] = []
        within = slices.min() == slices.max()
        # Of two classes in different components one is outside the component that was largest at first.
        for mine in np.flatnonzero(group != largest).tolist():
            entries = place[ends[mine] - sizes[mine] : ends[mine]]
            counts = many[entries]
            entries, counts = entries[counts > 1], counts[counts > 1]
            if not len(entries):
                continue
            steps = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            common = np.bincount(owner[np.repeat(first[entries], counts) + steps], minlength=len(tile))
            near = 100 * common >= percent * (sizes[mine] + sizes - common)
            if not within:
                near &= slices != slices[mine]
            for other in np.flatnonzero(near & (group != group[mine])).tolist():
                if group[other] != group[mine]:
                    found.append((int(ids[mine]), int(ids[other])))
                    group[group == group[other]] = group[mine]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return links


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = 5,
    percent: int = 80,
    band_count: int = BANDS,
    band_rows: int = ROWS,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): documents are linked if 100 * common >= percent * all shingles."""
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketches = Written(
        map_batches(
            texts,
            "doc_id BIGINT, n_shingles BIGINT, high BIGINT, low BIGINT, bands ARRAY<BIGINT>",
            sketch_step(size, band_count, band_rows),
        ),
        "sketches",
    )
    named = sketches.df.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = named.groupBy("high", "low").agg(F.min("doc_id").alias("rep"))
    # A class's bands are those of its smallest id, so they needn't be carried through the grouping.
    in_bands = (
        named.join(classes.withColumnRenamed("rep", "doc_id"), ["high", "low", "doc_id"], "left_semi")
        .select(F.col("doc_id").alias("rep"), F.explode("bands").alias("band"))
    )
    shared = in_bands.groupBy("band").agg(F.min("rep").alias("leader"), F.max("rep").alias("last")).where("leader < last")
    members = Written(in_bands.join(shared.drop("last"), "band"), "bands")
    sought = members.df.select(F.col("rep").alias("doc_id")).distinct()
    # The row of the class itself: rows that share an id may have other texts.
    sets = Written(
        map_batches(
            texts.join(sought, "doc_id", "left_semi"),
            "doc_id BIGINT, high BIGINT, low BIGINT, items ARRAY<BIGINT>",
            items_step(size),
        )
        .where(F.size("items") > 0)
        .groupBy("doc_id", "high", "low")
        .agg(F.first("items").alias("items"))
        .select(F.col("doc_id").alias("rep"), "items"),
        "sets",
    )
    links = Written(starred(members.df, sets.df, percent), "links")
    labels = components(links.df)
    joined = Written(tiled(members.df, sets.df, labels.df, percent, slice_bytes), "links")
    members.drop()
    sets.drop()
    final = components(labels.df.selectExpr("node AS a", "component AS b").unionByName(joined.df))
    for table in (links, joined, labels):
        table.drop()
    component = classes.join(final.df.withColumnRenamed("node", "rep"), "rep", "left").select(
        "high", "low", F.coalesce("component", "rep").alias("found")
    )
    # Written, so that both sides of the last join are dealt out for it and adaptive execution can split a class of many copies.
    component = Written(component, "classes").df
    own = F.when(F.col("n_shingles") > 0, F.col("found")).otherwise(F.col("doc_id"))
    return (
        sketches.df.drop("bands")
        .join(component, ["high", "low"], "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), own))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.expr("doc_id = component_id"), F.lit(True)).alias("kept"))
    )


def starred(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the classes of a band and its smallest one, on their full sets."""
    pairs = members.where("rep <> leader").selectExpr("leader AS a", "rep AS b").distinct()
    left = sets.selectExpr("rep AS a", "items AS left_items")
    right = sets.selectExpr("rep AS b", "items AS right_items")
    common = F.size(F.array_intersect("left_items", "right_items"))
    return (
        pairs.join(right, "b")
        .join(left, "a")
        .where(alike(common, F.size("left_items"), F.size("right_items"), percent))
        .select("a", "b")
    )


def tiled(members: DataFrame, sets: DataFrame, labels: DataFrame, percent: int, slice_bytes: int) -> DataFrame:
    """Links that join components within bands that hold several of them."""
    known = labels.withColumnRenamed("node", "rep")
    labelled = members.join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    several = labelled.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_bands = labelled.join(several.where("low < high").select("band"), "band", "left_semi")
    # Classes that are connected through such bands form a cluster; its size decides into how many slices it is cut.
    clusters = components(open_bands.selectExpr("rep AS a", "leader AS b"))
    bytes_of = sets.select("rep", (F.size("items") * F.lit(8)).cast("long").alias("bytes"))
    cluster = clusters.df.withColumnsRenamed({"node": "rep", "component": "cluster"})
    slices = cluster.join(bytes_of, "rep").groupBy("cluster").agg(
        F.ceil(F.sum("bytes") / F.lit(slice_bytes)).cast("int").alias("slices")
    )
    placed = (
        cluster.join(slices, "cluster")
        .join(known, "rep", "left")
        .withColumn("component", F.coalesce("component", "rep"))
        .withColumn("slice", F.expr("CAST(pmod(xxhash64(rep), slices) AS INT)"))
        .withColumn("other", F.explode(F.expr("sequence(0, slices - 1)")))
        .selectExpr("rep", "component", "cluster", "slice", "least(slice, other) AS one", "greatest(slice, other) AS two")
    )
    return placed.join(sets, "rep").groupBy("cluster", "one", "two").applyInPandas(tile_links(percent), "a BIGINT, b BIGINT")
