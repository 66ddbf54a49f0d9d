"""Names in texts: which of many known names a text mentions, and tool calls whose arguments are what was asked about.

A name is found where it stands as a whole: a letter or digit at its edge has no other one next to it. Letters match in either case. A
mention inside a longer one is left out, so "Policy 12" isn't also "Policy 1"; mentions that only overlap stay.

Names are dealt to blocks of a fixed size that are written to the shared folder. One scan of the texts goes over a block: each worker builds
an automaton of the block's names once and passes every text through it, so no text is moved and no name is broadcast. More than
SCANS blocks would be too many scans; then every run of words in a text that is as long as some name is a row, and the rows meet the names
in a join. Both ways find the same.

Cases: names without a letter or digit, null names and null texts match nothing; names that differ in case only are one, of which the
least by code points stands for all; repeated names count once; texts are told by their ids, which occur once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from lorebase.operators.tools import Tool
from lorebase.session import fresh_path, stored

#: Bytes of names in a block (an automaton takes some tens of times as much), and blocks up to which texts are scanned once for each.
NAME_BYTES, SCANS = 4 << 20, 4


def folded(text: str) -> str:
    """Lower case, character for character, so that places stay what they are."""
    return text.replace("İ", "i").lower() if "İ" in text else text.lower()


def whole(text: str, start: int, end: int) -> bool:
    """Whether what stands at these places has no letter or digit that goes on beyond its edges."""
    before = start > 0 and text[start].isalnum() and text[start - 1].isalnum()
    return not before and not (end < len(text) and text[end - 1].isalnum() and text[end].isalnum())


def core(name: str) -> tuple[int, int]:
    """Where the first letter or digit of a name is, and the end of its last one; (0, 0) without any."""
    places = [place for place, sign in enumerate(name) if sign.isalnum()]
    return (places[0], places[-1] + 1) if places else (0, 0)


class NameBlock:
    """The names of one block; a worker reads them and builds their automaton once."""

    def __init__(self, folder: str):
        self.folder, self.automaton = folder, None

    def __getstate__(self) -> dict:
        return {"folder": self.folder, "automaton": None}

    def get(self):
        if self.automaton is None:
            import ahocorasick

            filesystem, name = pyarrow.fs.FileSystem.from_uri(self.folder)
            table = ds.dataset(name, filesystem=filesystem, format="parquet").to_table(["key", "name"])
            self.automaton = ahocorasick.Automaton()
            for key, known in zip(*(column.to_pylist() for column in table.columns)):
                self.automaton.add_word(key, (len(key), known))
            self.automaton.make_automaton()
        return self.automaton


def distinct_names(names: DataFrame, name: str) -> DataFrame:
    """(key, name): the names by their folded form, each once."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(folded(one), one) for one in batch.column(0).to_pylist() if one and core(one)[1]]
            if rows:
                yield pa.record_batch([pa.array(column, pa.string()) for column in zip(*rows)], names=["key", "name"])

    keyed = names.select(F.col(name).cast("string")).mapInArrow(job, "key STRING, name STRING")
    return keyed.groupBy("key").agg(F.min("name").alias("name"))


def scanned(texts: DataFrame, ids: list[str], text: str, folder: str) -> DataFrame:
    """All mentions of a block's names: (ids, start, end, name)."""
    block: Broadcast = texts.sparkSession.sparkContext.broadcast(NameBlock(folder))
    kinds = dict(texts.dtypes)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = block.value.get()
        for batch in batches:
            found = []
            for row, body in enumerate(batch.column(len(ids)).to_pylist()):
                low = folded(body or "")
                for last, (size, known) in automaton.iter(low) if low else ():
                    if whole(low, last + 1 - size, last + 1):
                        found.append((row, last + 1 - size, last + 1, known))
            if found:
                rows, starts, ends, known = zip(*found)
                columns = [batch.column(place).take(pa.array(rows)) for place in range(len(ids))]
                columns += [pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(known, pa.string())]
                yield pa.record_batch(columns, names=[*ids, "start", "end", "name"])

    fields = ", ".join(f"`{one}` {kinds[one]}" for one in ids)
    return texts.select(*ids, F.col(text).cast("string")).mapInArrow(job, f"{fields}, start INT, end INT, name STRING")


def joined(texts: DataFrame, ids: list[str], text: str, names: DataFrame) -> DataFrame:
    """The same by a join of the names' cores with all runs of words that are as long as one of them."""

    def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, known in zip(*(column.to_pylist() for column in batch.columns)):
                start, end = core(key)
                rows.append((key[start:end], key, start, words_in(key[start:end]), known))
            if rows:
                yield pa.record_batch([pa.array(column) for column in zip(*rows)], names=["phrase", "key", "lead", "words", "name"])

    keyed = stored(names.select("key", "name").mapInArrow(cores, "phrase STRING, key STRING, lead BIGINT, words BIGINT, name STRING"), "cores")
    lengths = sorted(row.words for row in keyed.select("words").distinct().collect())
    kinds = dict(texts.dtypes)
    fields = ", ".join(f"`{one}` {kinds[one]}" for one in ids)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, body in enumerate(batch.column(len(ids)).to_pylist()):
                low = folded(body or "")
                spots = word_places(low)
                found = [(low[spots[at][0] : spots[at + n - 1][1]], spots[at][0]) for n in lengths for at in range(len(spots) - n + 1)]
                for start in range(0, len(found), 1 << 14):
                    phrases, places = zip(*found[start : start + (1 << 14)])
                    columns = [batch.column(place).take(pa.array([row] * len(places))) for place in range(len(ids))]
                    yield pa.record_batch([*columns, pa.array(phrases), pa.array(places)], names=[*ids, "phrase", "place"])

    said = texts.select(*ids, F.col(text).cast("string")).mapInArrow(runs, f"{fields}, phrase STRING, place BIGINT")
    met = said.join(keyed, "phrase").join(texts.select(*ids, F.col(text).cast("string").alias("_body")), ids)
    start = (F.col("place") - F.col("lead")).cast("int")
    size = F.length("key")
    # What stands around the core must be the rest of the name; only names with signs at their edges have any.
    same = (start >= 0) & (F.lower(F.translate(F.expr("substring(_body, CAST(place - lead + 1 AS INT), length(key))"), "İ", "i")) == F.col("key"))
    return met.filter(same).select(*ids, start.alias("start"), (start + size).alias("end"), "name")


def word_places(text: str) -> list[tuple[int, int]]:
    """Start and end of every run of letters and digits."""
    edges = [0, *(place for place in range(1, len(text)) if text[place].isalnum() != text[place - 1].isalnum()), len(text)]
    return [(start, end) for start, end in zip(edges, edges[1:]) if end > start and text[start].isalnum()]


def words_in(text: str) -> int:
    return len(word_places(text))


def mentions(texts: DataFrame, ids: list[str], text: str, names: DataFrame, name: str = "name", block_bytes: int = NAME_BYTES, scans: int = SCANS) -> DataFrame:
    """Every mention of a known name: (ids, start, end, name), places in characters, end exclusive."""
    spark = texts.sparkSession
    known = stored(distinct_names(names, name), "names")
    blocks = -(-(known.agg(F.coalesce(F.sum(F.octet_length("key") + 1), F.lit(0))).first()[0]) // block_bytes)
    if not blocks:
        return texts.select(*ids, F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("").alias("name")).filter(F.lit(False))
    if blocks > scans:
        found = joined(texts, ids, text, known)
    else:
        path = fresh_path(spark, "name-blocks")
        dealt = known.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
        dealt.repartition("block").write.partitionBy("block").parquet(path)
        used = sorted(row.block for row in spark.read.parquet(path).select("block").distinct().collect())
        found = reduce(DataFrame.unionByName, [scanned(texts, ids, text, f"{path}/block={number}") for number in used])
    # In the order of their starts, longer ones first, a mention lies inside an earlier one if that ends no sooner.
    earlier = Window.partitionBy(*ids).orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("_end", F.max("end").over(earlier)).filter("_end IS NULL OR _end < end").drop("_end")


def asked_calls(questions: DataFrame, ids: list[str], text: str, found: DataFrame, tools: list[Tool], kinds: dict[str, str], fallback: Tool) -> DataFrame:
    """Tool calls for questions: (ids, name, arguments).

    `found` has the ids, start and name of mentions and their `kind`; `kinds` gives the kind of name that each parameter takes. A tool is
    called once for every question that mentions all it needs, each argument being the first mention of its kind; a question
    that calls for no tool goes to `fallback` with its text.
    """
    wanted = sorted(set(kinds.values()))
    firsts = found.groupBy(*ids).agg(*(F.min(F.when(F.col("kind") == kind, F.struct("start", "name"))).alias(f"_{kind}") for kind in wanted))
    known = questions.select(*ids, F.col(text).alias("_text")).join(firsts, ids, "left")
    calls = []
    for tool in tools:
        needed = {param: F.col(f"_{kinds[param]}")["name"] for param in tool.needs}
        made = F.struct(F.lit(tool.name).alias("name"), F.to_json(F.struct(*(value.alias(param) for param, value in needed.items()))).alias("arguments"))
        calls.append(F.when(reduce(lambda a, b: a & b, [value.isNotNull() for value in needed.values()]), made))
    last = F.struct(F.lit(fallback.name).alias("name"), F.to_json(F.struct(F.col("_text").alias(fallback.needs[0]))).alias("arguments"))
    called = F.filter(F.array(*calls), lambda call: call.isNotNull())
    return known.select(*ids, F.explode(F.when(F.size(called) > 0, called).otherwise(F.array(last))).alias("_call")).select(*ids, "_call.name", "_call.arguments")
