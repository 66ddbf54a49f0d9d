"""SentencePiece BPE: encoding and decoding with any BPE model file that has byte fallback.

Method: texts are cut into words where no vocabulary entry can reach across. The words that a task meets for the first time
are merged together, in rounds over flat numpy arrays: every word finds the lowest rank among its neighbouring pairs, all
of its leftmost, non-overlapping occurrences are merged at once, the arrays are compacted, and words without a pair leave.
Merging several occurrences at once equals the library's one-at-a-time order unless a merge gives rise to a pair of the
same or a lower rank; words where that happens are merged again, one pair a round, so the ids are always the library's.

Cases: a null text counts as empty; an empty text gives only the begin and end ids; rows with equal keys or null keys are
encoded one by one; other columns are ignored; an empty table gives an empty table. Decoding skips control ids, and
gives U+FFFD for every byte that is not part of a valid UTF-8 sequence, as the library does.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from lorebase.llm.common import Batches, by_runs, free_name, in_batches, key_type, map_batches, rows_of

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
CODE_POINTS = 0x110000
NO_RANK = np.iinfo(np.int32).max
#: Words up to this length are remembered by a task, so many of them at most.
MEMO_CHARS, MEMO_WORDS = 48, 1 << 17
#: New words are merged together once they have so many characters; a longer text is cut into parts of about that size.
ROUND_CHARS = 1 << 18


class PieceModel:
    """The tables of a model file: single symbols, mergeable pairs, and the bytes of every id."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules, kinds = model.normalizer_spec, {piece.type for piece in model.pieces}
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or kinds & {USER_DEFINED, UNUSED}:
            raise ValueError(f"{path}: not a BPE model with byte fallback and plain pieces")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError(f"{path}: its normalisation changes texts")
        if model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError(f"{path}: white space as a suffix")
        self.prefix = SPACE if rules.add_dummy_prefix else ""
        self.size = len(model.pieces)
        self.bos, self.eos = model.trainer_spec.bos_id, model.trainer_spec.eos_id
        normal = {piece.piece: number for number, piece in enumerate(model.pieces) if piece.type == NORMAL}
        self._fill_singles(normal)
        self._fill_pairs(normal, model.pieces)
        self._fill_bytes(model)
        self.words = self._word_pattern(normal)

    def _fill_singles(self, normal: dict[str, int]) -> None:
        known = [(ord(piece), number) for piece, number in normal.items() if len(piece) == 1]
        self.known = np.array(known, dtype=np.int64).reshape(-1, 2)

    def symbol(self, piece: str, normal: dict[str, int]) -> int | None:
        """A character outside the vocabulary is a symbol of its own, above the ids."""
        return normal.get(piece, self.size + ord(piece) if len(piece) == 1 else None)

    def _fill_pairs(self, normal: dict[str, int], pieces) -> None:
        base = self.size + CODE_POINTS
        found = [
            (left * base + right, number)
            for piece, number in normal.items()
            for cut in range(1, len(piece))
            if (left := self.symbol(piece[:cut], normal)) is not None
            and (right := self.symbol(piece[cut:], normal)) is not None
        ]
        found.sort()
        self.pair_keys = np.array([key for key, _ in found], dtype=np.int64)
        self.pair_into = np.array([number for _, number in found] + [-1], dtype=np.int32)
        # Equal scores share a rank: among them the leftmost pair goes first.
        scores = np.array([-pieces[number].score for _, number in found])
        self.pair_rank = np.append(np.unique(scores, return_inverse=True)[1].astype(np.int32), np.int32(NO_RANK))
        inside = {ord(a) * CODE_POINTS + ord(b) for piece in normal for a, b in zip(piece, piece[1:])}
        self.inside = np.array(sorted(inside), dtype=np.int64)

    def _fill_bytes(self, model) -> None:
        self.surfaces, self.is_control = [], np.zeros(self.size, dtype=bool)
        self.byte_ids = np.zeros(256, dtype=np.int32)
        for number, piece in enumerate(model.pieces):
            if piece.type == BYTE:
                value = int(piece.piece[3:5], 16)
                self.byte_ids[value] = number
                self.surfaces.append(bytes([value]))
            elif piece.type == CONTROL:
                self.is_control[number] = True
                self.surfaces.append(b"")
            elif piece.type == UNKNOWN:
                self.surfaces.append(model.trainer_spec.unk_surface.encode())
            else:
                self.surfaces.append(piece.piece.replace(SPACE, " ").encode())
        self.starts_with_space = np.array(
            [piece.type == NORMAL and piece.piece.startswith(SPACE) for piece in model.pieces]
        )

    def _word_pattern(self, normal: dict[str, int]) -> str | None:
        """How to find words that no piece reaches across, or None if pieces have spaces inside."""
        if any(SPACE in piece.lstrip(SPACE) for piece in normal):
            return None
        alone = "".join(c for c in "\n\t\r" if not any(c in piece and len(piece) > 1 for piece in normal))
        words = f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+"
        return f"{words}|[{alone}]" if alone else words


class Encoder:
    """Encodes words with the tables of a model; one for each task."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.single = np.arange(model.size, model.size + CODE_POINTS, dtype=np.int32)
        self.single[model.known[:, 0]] = model.known[:, 1]
        self.find = re.compile(model.words or ".+", re.DOTALL).findall
        self.memo: dict[str, bytes] = {}

    def slots(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where each pair stands in the pair table; the last place is for pairs that don't merge."""
        keys = left.astype(np.int64) * (self.model.size + CODE_POINTS) + right
        at = np.searchsorted(self.model.pair_keys, keys)
        at[at == len(self.model.pair_keys)] = 0
        return np.where(self.model.pair_keys[at] == keys, at, len(self.model.pair_keys)).astype(np.int32)

    def merge(self, symbols: np.ndarray, words: np.ndarray, single: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Merge until no pair remains. `words` numbers the word of each symbol, ascending from 0 without a gap.

        Returns the symbols in order and their words. `single` merges one pair per word and round.
        """
        rank_of, into, none = self.model.pair_rank, self.model.pair_into, len(self.model.pair_keys)
        first_symbols, first_words = symbols.copy(), words
        doubtful: list[np.ndarray] = []
        done: list[tuple[np.ndarray, np.ndarray]] = []
        slot = np.full(len(symbols), none, dtype=np.int32)
        joined = np.flatnonzero(words[1:] == words[:-1])
        slot[joined] = self.slots(symbols[joined], symbols[joined + 1])
        while len(symbols):
            rank = rank_of[slot]
            starts = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
            lengths = np.diff(np.r_[starts, len(words)])
            best = np.minimum.reduceat(rank, starts)
            open_words = best < NO_RANK
            if not open_words.all():
                keep = np.repeat(open_words, lengths)
                done.append((symbols[~keep], words[~keep]))
                symbols, words, slot, rank = symbols[keep], words[keep], slot[keep], rank[keep]
                best, lengths = best[open_words], lengths[open_words]
                if not len(symbols):
                    break
            target = np.repeat(best, lengths)
            hits = np.flatnonzero(rank == target)
            if single:
                hits = hits[np.r_[True, words[hits[1:]] != words[hits[:-1]]]]
            # In a run of overlapping hits every other one, from the left. A word's last symbol is never a hit.
            fresh = np.r_[True, np.diff(hits) > 1]
            order = np.arange(len(hits))
            hits = hits[(order - np.maximum.accumulate(np.where(fresh, order, 0))) % 2 == 0]
            merged, limit, of_word = into[slot[hits]], target[hits], words[hits]
            several = np.zeros(len(hits), dtype=bool)
            if len(hits) > 1:
                same = of_word[1:] == of_word[:-1]
                several[1:] |= same
                several[:-1] |= same
                # The pair that a merged symbol makes, for a moment, with the next one to be merged.
                touching = np.flatnonzero(same & (hits[1:] == hits[:-1] + 2))
                between = rank_of[self.slots(merged[touching], symbols[hits[touching] + 2])]
                doubtful.append(of_word[touching][between <= limit[touching]])
            symbols[hits] = merged
            keep = np.ones(len(symbols), dtype=bool)
            keep[hits + 1] = False
            place = (np.cumsum(keep) - 1)[hits]
            symbols, words, slot = symbols[keep], words[keep], slot[keep]
            for at, mine in ((place, slice(None)), (place - 1, place > 0)):
                at, bound, many = at[mine], limit[mine], several[mine]
                inside = at + 1 < len(words)
                inside[inside] = words[at[inside]] == words[at[inside] + 1]
                slot[at[(at + 1 >= len(words)) | ~inside]] = none
                at, bound, many = at[inside], bound[inside], many[inside]
                slot[at] = self.slots(symbols[at], symbols[at + 1])
                same_word = many & (rank_of[slot[at]] <= bound)
                doubtful.append(words[at][same_word])
        symbols = np.concatenate([s for s, _ in done]) if done else symbols
        words = np.concatenate([w for _, w in done]) if done else words
        again = np.unique(np.concatenate(doubtful)) if doubtful and not single else np.empty(0, dtype=words.dtype)
        if len(again):
            fixed = ~np.isin(words, again)
            from_start = np.isin(first_words, again)
            numbers = np.searchsorted(again, first_words[from_start])
            redone, of_redone = self.merge(first_symbols[from_start], numbers, single=True)
            symbols = np.concatenate([symbols[fixed], redone])
            words = np.concatenate([words[fixed], again[of_redone]])
        order = np.argsort(words, kind="stable")
        return symbols[order], words[order]

    def encode_words(self, texts: list[str]) -> list[bytes]:
        """The ids of each word as little-endian 32-bit integers."""
        points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        word = np.repeat(np.arange(len(texts)), sizes)
        # A word may be cut between characters that stand side by side in no piece; that keeps long words cheap.
        cut = np.r_[False, word[1:] != word[:-1]]
        long = np.flatnonzero(~cut & (sizes[word] > MEMO_CHARS))
        long = long[long > 0]
        keys = points[long - 1] * CODE_POINTS + points[long]
        at = np.minimum(np.searchsorted(self.model.inside, keys), max(0, len(self.model.inside) - 1))
        cut[long] |= self.model.inside[at] != keys if len(self.model.inside) else True
        part = np.cumsum(cut)
        part_word = word[np.r_[True, part[1:] != part[:-1]]]
        symbols, parts = self.merge(self.single[points], part)
        unknown = symbols >= self.model.size
        if unknown.any():
            symbols, parts = self.with_bytes(symbols, parts, unknown)
        counts = np.bincount(part_word[parts], minlength=len(texts))
        ends = np.cumsum(counts) * 4
        flat = symbols.astype("<u4").tobytes()
        return [flat[end - 4 * count : end] for end, count in zip(ends.tolist(), counts.tolist())]

    def with_bytes(self, symbols: np.ndarray, parts: np.ndarray, unknown: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters outside the vocabulary as the ids of their bytes."""
        encoded = [chr(point).encode() for point in (symbols[unknown] - self.model.size).tolist()]
        repeats = np.ones(len(symbols), dtype=np.int64)
        repeats[unknown] = [len(value) for value in encoded]
        wide, of_part = np.repeat(symbols, repeats), np.repeat(parts, repeats)
        wide[np.repeat(unknown, repeats)] = self.model.byte_ids[np.frombuffer(b"".join(encoded), dtype=np.uint8)]
        return wide, of_part

    def parts(self, text: str) -> Iterator[str]:
        """A text with its spaces escaped; a very long one in parts that end before a space."""
        text = self.model.prefix + text.replace(" ", SPACE)
        start = 0
        while len(text) - start > ROUND_CHARS and self.model.words:
            cut = text.find(SPACE, start + ROUND_CHARS)
            while cut > 0 and text[cut - 1] == SPACE:
                cut = text.find(SPACE, cut + 1)
            if cut < 0:
                break
            yield text[start:cut]
            start = cut
        yield text[start:] if start else text

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of whole texts, without begin and end, as little-endian 32-bit integers.

        The new words of several texts are merged together."""
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        found = [[self.find(part) for part in self.parts(text)] if text else [] for text in texts]
        new = sorted({word for text in found for part in text for word in part if word not in memo})
        held, size = [], 0
        for word in new:
            held.append(word)
            size += len(word)
            if size >= ROUND_CHARS:
                memo.update(zip(held, self.encode_words(held)))
                held, size = [], 0
        if held:
            memo.update(zip(held, self.encode_words(held)))
        ids = [b"".join([b"".join(map(memo.__getitem__, part)) for part in text]) for text in found]
        for word in new:
            if len(word) > MEMO_CHARS:
                del memo[word]
        return ids


def _utf8_or_replacement(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("replace_each_byte", _utf8_or_replacement)


def decode_ids(model: PieceModel, ids: np.ndarray) -> str:
    """The text of ids; a space that starts the text is the one that encoding put there."""
    codecs.register_error("replace_each_byte", _utf8_or_replacement)
    if len(ids) and (int(ids.max()) >= model.size or int(ids.min()) < 0):
        raise ValueError("id outside the vocabulary")
    ids = ids[~model.is_control[ids]]
    text = b"".join(map(model.surfaces.__getitem__, ids.tolist())).decode("utf-8", "replace_each_byte")
    return text[1:] if model.prefix and len(ids) and model.starts_with_space[ids[0]] else text


def encode_step(tables: Broadcast, key: pa.DataType, bos: bool, eos: bool):
    schema = pa.schema([("key", key), ("ids", pa.list_(pa.int32()))])

    def rows(batches: Batches) -> Iterator[tuple]:
        model: PieceModel = tables.value
        encoder = Encoder(model)
        begin = np.array([model.bos] * bos, dtype=np.int32)
        end = np.array([model.eos] * eos, dtype=np.int32)

        def encoded(held: list[tuple]) -> Iterator[tuple]:
            for (row_key, _), ids in zip(held, encoder.encode([text or "" for _, text in held])):
                yield row_key, np.concatenate([begin, np.frombuffer(ids, dtype="<i4"), end])

        held, size = [], 0
        for row in rows_of(batches):
            held.append(row)
            size += len(row[1] or "")
            if size >= ROUND_CHARS:
                yield from encoded(held)
                held, size = [], 0
        yield from encoded(held)

    return lambda batches: in_batches(rows(batches), schema)


def decode_step(tables: Broadcast, key: pa.DataType):
    """Adds the decoded text; the ids stay as they are."""
    schema = pa.schema([("key", key), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def step(batches: Batches) -> Batches:
        model: PieceModel = tables.value
        for batch in batches:
            lists = batch.column(1)
            flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
            texts = [decode_ids(model, flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.record_batch([batch.column(0), lists, pa.array(texts, type=pa.string())], schema=schema)

    return step


def tables_of(df: DataFrame, path: str) -> Broadcast:
    """The tables of a model file, built once by the driver: a few MB whatever the data."""
    return df.sparkSession.sparkContext.broadcast(PieceModel(path))


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", bos: bool = True, eos: bool = True) -> DataFrame:
    """(key, ids): the ids of every whole text, as the library gives them without sampling."""
    name, arrow = key_type(df, key)
    out = map_batches(df.select(key, text), f"key {name}, ids ARRAY<INT>", encode_step(tables_of(df, path), arrow, bos, eos))
    return out.withColumnRenamed("key", key)


def decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, ids, decoded): the text of every id list; a null list counts as empty."""
    name, arrow = key_type(df, key)
    lists = df.selectExpr(f"`{key}` AS key", f"coalesce(CAST(`{ids}` AS ARRAY<INT>), CAST(array() AS ARRAY<INT>)) AS ids")
    out = map_batches(lists, f"key {name}, ids ARRAY<INT>, decoded STRING", decode_step(tables_of(df, path), arrow))
    return out.withColumnRenamed("key", key)


def roundtrip(df: DataFrame, path: str, schema: str, *steps, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, decode, then `steps` over (key, ids, decoded) batches, all in one task: the ids never leave Python."""
    _, arrow = key_type(df, key)
    tables = tables_of(df, path)
    return map_batches(df.select(key, text), schema, encode_step(tables, arrow, True, True), decode_step(tables, arrow), *steps)


def tokenised(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`df` with the ids of `text`, their number, and whether they decode to the text again.

    The new columns are called ids, n_tokens and round_trip, with underscores before them where `df` has such columns.
    """
    tables, place = tables_of(df, path), df.columns.index(text)
    names = [free_name(df, name) for name in ("ids", "n_tokens", "round_trip")]
    added = [pa.field(name, kind) for name, kind in zip(names, (pa.list_(pa.int32()), pa.int64(), pa.bool_()))]

    def step(batches: Batches) -> Batches:
        model: PieceModel = tables.value
        encoder = Encoder(model)
        begin, end = (np.array([one], dtype=np.int32) for one in (model.bos, model.eos))
        for part in by_runs(batches, place, ROUND_CHARS):
            texts = [value or "" for value in part.column(place).to_pylist()]
            ids = [np.concatenate([begin, np.frombuffer(one, dtype="<i4"), end]) for one in encoder.encode(texts)]
            same = [decode_ids(model, one) == value for one, value in zip(ids, texts)]
            columns = [pa.array(ids, pa.list_(pa.int32())), pa.array(list(map(len, ids)), pa.int64()), pa.array(same)]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], schema=pa.schema([*part.schema, *added]))

    fields = StructType([*df.schema.fields, *from_arrow_schema(pa.schema(added)).fields])
    return map_batches(df, fields, step)

