"""Binary token files: concatenated ids with Elias-Fano encoded document boundaries.

File format, integers little-endian:

    8 bytes   the magic "EFTOKENS"
    ids       all ids of all documents, 2 or 4 bytes each, written as they come
    ends      Elias-Fano sequence: for each document the number of ids up to and including its own
    keys      Elias-Fano sequence: the keys of the documents less the first one; documents with a null key come first
    footer    JSON: ids, documents, nulls, width, first_key, and the place and length in bytes of ends and keys
    12 bytes  length of the footer as 4 bytes, and the magic again

An Elias-Fano sequence of n ascending numbers below u keeps the lower floor(log2(u / n)) bits of each number packed, and the
upper bits as a bit vector with one bit per number and one per step: about 2 + log2(u / n) bits a number. For select, every
512th one of the bit vector has its position as a 32-bit integer; from there a few bytes are counted.

Encoding: the tokenizers library encodes every word, the words that are new to a worker together. For byte-level BPE with the
usual pattern a text may be cut before a lone space between two characters that are not white space, as no token reaches
across; and a NUL that stands between words merges with nothing. A word of letters, signs after letters, and a lone line end
after them are pieces of that pattern by themselves, so the library's model merges them without looking for where to
split. Where a tokenizer or a text doesn't allow that, whole texts go to the library.

Cases: a null text counts as empty; an empty text has only the end id; rows that share a key stand next to each other, ordered
by a hash of their text; rows with a null key come first; other columns are ignored; an empty table gives no file and
no row.
"""

from __future__ import annotations

import json
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, compress, repeat
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lorebase.llm.common import Batches, Written, in_batches, map_batches, rows_of, runs_of
from lorebase.llm.files import attempt_path, one_file_a_task, open_input, open_output
from lorebase.session import fresh_path

MAGIC = b"EFTOKENS"
SAMPLE = 512
#: Values whose low bits are packed at once.
SLICE = 1 << 13
#: A file is closed once it holds so many ids, or so many documents; the numbers inside stay below 32 bits.
FILE_IDS, FILE_DOCUMENTS = 1 << 27, 1 << 20
#: Words, and ids of words, that a Python worker remembers from task to task (about 200 MB), words that go to the library
#: in one call, and pieces whose tokens are held at once.
MEMO_WORDS, MEMO_IDS, CALL_WORDS, MERGE_PIECES = 1 << 20, 1 << 24, 200, 1 << 13
#: Bytes of text that are encoded at once.
ENCODE_BYTES = 8 << 20
#: Signs that the usual pattern never joins to a letter before them, nor splits: visible ASCII but for the apostrophe.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: A word's slot before the library has seen it.
UNKNOWN = -2
# In byte-level vocabularies a visible byte stands for itself, the others, in order, for the characters from 256.
VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {byte: chr(byte) for byte in VISIBLE}
BYTE_LETTERS |= {byte: chr(256 + place) for place, byte in enumerate(sorted(set(range(256)) - set(VISIBLE)))}
POPULATION = np.array([bin(value).count("1") for value in range(256)], dtype=np.uint8)


class EliasFano:
    """An ascending sequence of whole numbers in near-minimal space."""

    def __init__(self, count: int, width: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.count, self.width, self.low, self.high, self.samples = count, width, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """`values`: ascending int64, none below 0."""
        count = len(values)
        if not count:
            return cls(0, 0, *(np.empty(0, dtype=np.uint8),) * 2, np.empty(0, dtype="<u4"))
        width = max(0, (int(values[-1]) // count).bit_length() - 1)
        # Slices of a multiple of eight values end at whole bytes.
        low = np.concatenate(
            [
                np.packbits(((part[:, None] >> np.arange(width)) & 1).astype(np.uint8).ravel(), bitorder="little")
                for part in np.split(values, range(SLICE, count, SLICE))
            ]
        )
        ones = (values >> width) + np.arange(count)
        vector = np.zeros(int(ones[-1]) + 1, dtype=np.uint8)
        vector[ones] = 1
        return cls(count, width, low, np.packbits(vector, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        return struct.pack("<QBII", self.count, self.width, len(self.low), len(self.high)) + b"".join(
            part.tobytes() for part in (self.low, self.high, self.samples)
        )

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        head = struct.calcsize("<QBII")
        count, width, low, high = struct.unpack("<QBII", data[:head])
        parts = np.frombuffer(data, dtype=np.uint8, offset=head)
        return cls(count, width, parts[:low], parts[low : low + high], parts[low + high :].view("<u4"))

    def select(self, number: int) -> int:
        """The value at place `number`: find its one in the bit vector, then add the low bits."""
        if not 0 <= number < self.count:
            raise IndexError(number)
        at = int(self.samples[number // SAMPLE])
        left = number % SAMPLE
        byte, inside = divmod(at, 8)
        current = int(self.high[byte]) >> inside << inside
        while left >= (ones := int(POPULATION[current])):
            left -= ones
            byte += 1
            current = int(self.high[byte])
        for _ in range(left):
            current &= current - 1
        position = 8 * byte + (current & -current).bit_length() - 1
        return (position - number) << self.width | self.low_bits(number, number + 1)[0]

    def low_bits(self, start: int, stop: int) -> list[int] | np.ndarray:
        first, last = start * self.width, stop * self.width
        bits = np.unpackbits(self.low[first // 8 : -(-last // 8)], bitorder="little")[first % 8 :][: last - first]
        return bits.reshape(stop - start, self.width).astype(np.int64) @ (1 << np.arange(self.width, dtype=np.int64))

    def values(self, start: int, stop: int) -> np.ndarray:
        """The values of a run of places; reads only the bytes from the sample before to the sample after."""
        if start >= stop:
            return np.empty(0, dtype=np.int64)
        first = start // SAMPLE
        after = -(-stop // SAMPLE)
        begin = int(self.samples[first])
        end = int(self.samples[after]) if after < len(self.samples) else 8 * len(self.high)
        bits = np.unpackbits(self.high[begin // 8 : -(-end // 8)], bitorder="little")
        bits[: begin % 8] = 0
        ones = np.flatnonzero(bits)[start - first * SAMPLE : stop - first * SAMPLE] + begin // 8 * 8
        return (ones - np.arange(start, stop)) << self.width | self.low_bits(start, stop)


class TokenFileWriter:
    """Writes one file; holds a key and a boundary for each document, but no ids."""

    def __init__(self, path: str, width: int):
        self.path, self.width, self.ids = path, width, 0
        self.nulls, self.keys, self.ends = 0, array("q"), array("q")
        self.file = open_output(path)
        self.file.write(MAGIC)

    def room(self, keys: pa.Array, ends: np.ndarray) -> int:
        """How many of the next documents still belong here: the file isn't full, and the keys span less than 63 bits."""
        before = self.ids + np.r_[0, ends[:-1]]
        many = min(int(np.searchsorted(before, FILE_IDS)), FILE_DOCUMENTS - len(self.ends), len(ends))
        known = keys.drop_null().to_pylist()
        first = self.keys[0] if self.keys else known[0] if known else 0
        if known and known[-1] - first >= 1 << 63:
            many = min(many, keys.null_count + sum(key - first < 1 << 63 for key in known))
        return many

    def add(self, keys: pa.Array, ids: np.ndarray, ends: np.ndarray) -> None:
        """A run of documents; keys ascend, nulls come first."""
        known = keys.drop_null().to_numpy()
        self.nulls += keys.null_count
        self.keys.frombytes(known.astype(np.int64).tobytes())
        self.ends.frombytes((self.ids + ends).astype(np.int64).tobytes())
        self.file.write(ids.tobytes())
        self.ids += len(ids)

    def close(self) -> tuple[str, int, int]:
        """Path, number of documents and of ids."""
        first = self.keys[0] if self.keys else 0
        keys = np.frombuffer(self.keys, dtype=np.int64) - first if self.keys else np.empty(0, dtype=np.int64)
        footer = {"ids": self.ids, "documents": len(self.ends), "nulls": self.nulls, "width": self.width, "first_key": first}
        place = len(MAGIC) + self.ids * self.width
        for name, values in (("ends", np.frombuffer(self.ends, dtype=np.int64)), ("keys", keys)):
            data = EliasFano.of(values).to_bytes()
            footer[name] = [place, len(data)]
            place += len(data)
            self.file.write(data)
        text = json.dumps(footer).encode()
        self.file.write(text + struct.pack("<I", len(text)) + MAGIC)
        self.file.close()
        return self.path, len(self.ends), self.ids


class TokenFile:
    """Reads a token file; boundaries are looked up, ids are read where they are needed."""

    def __init__(self, path: str):
        self.file = open_input(path)
        size, tail = self.file.size(), len(MAGIC) + 4
        end = self.file.read_at(tail, max(0, size - tail))
        if end[4:] != MAGIC:
            raise ValueError(f"{path}: not a token file, or not a whole one")
        length = struct.unpack("<I", end[:4])[0]
        self.footer = json.loads(self.file.read_at(length, size - tail - length))
        self.ends, self.keys = (EliasFano.from_bytes(self.part(name)) for name in ("ends", "keys"))
        self.documents, self.width = self.footer["documents"], self.footer["width"]

    def part(self, name: str) -> bytes:
        place, length = self.footer[name]
        return self.file.read_at(length, place)

    def bounds(self, number: int) -> tuple[int, int]:
        """First id of a document and the one after its last, by select."""
        return self.ends.select(number - 1) if number else 0, self.ends.select(number)

    def key(self, number: int) -> int | None:
        nulls = self.footer["nulls"]
        return None if number < nulls else self.footer["first_key"] + self.keys.select(number - nulls)

    def ids(self, start: int, stop: int) -> np.ndarray:
        data = self.file.read_at((stop - start) * self.width, len(MAGIC) + start * self.width)
        return np.frombuffer(data, dtype=f"<u{self.width}")

    def rows(self, step: int = 4096) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(key, start, ids) of every document, read in runs of at most `step` documents."""
        nulls, before = self.footer["nulls"], 0
        for first in range(0, self.documents, step):
            last = min(first + step, self.documents)
            ends = self.ends.values(first, last).tolist()
            known = self.keys.values(max(0, first - nulls), max(0, last - nulls)) + self.footer["first_key"]
            keys = [None] * (last - first - len(known)) + known.tolist()
            for key, end in zip(keys, ends):
                yield key, before, self.ids(before, end)
                before = end

    def close(self) -> None:
        self.file.close()


#: Distinct words, the number of each word among them, and the places of the first word of each text and of the end.
Words = tuple[list[str], np.ndarray, np.ndarray]


def words_of(texts: pa.Array) -> Words:
    """What stands between single spaces; Arrow finds the words and their distinct ones."""
    split = pc.split_pattern(texts.fill_null(""), " ")
    words, borders = split.flatten().dictionary_encode(), split.offsets.to_numpy()
    return words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices.to_numpy(), (borders - borders[0]).astype(np.int64)


class TextEncoder:
    """Whole texts to ids, as the tokenizers library gives them without special tokens.

    A word that a worker has met has a slot: a stretch of one flat array that holds its ids. Texts are put together from the
    stretches of their words with numpy, all texts of a call at once. `sharing`: encoders that share a worker's memory.
    """

    def __init__(self, definition: str, width: int, sharing: int = 1):
        from tokenizers import Tokenizer

        self.sharing = sharing

        self.library = Tokenizer.from_str(definition)
        self.kind, self.size = f"<u{width}", width
        model = json.loads(definition)
        before = model.get("pre_tokenizer") or {}
        added = model.get("added_tokens", [])
        nul = self.library.encode("\0", add_special_tokens=False)
        self.by_words = (
            model["model"]["type"] == "BPE"
            and not model["model"].get("dropout")
            and model.get("normalizer") is None
            and before == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
            and model.get("truncation") is None
            and model.get("padding") is None
            and len(nul.ids) == 1
            # Special tokens inside a word are found there as well; those that take in spaces are not.
            and not any(token["lstrip"] or token["rstrip"] or token["single_word"] for token in added)
            and not any(token["content"].isalpha() for token in added)
            and not any(sign.isspace() or sign == "\0" for token in added for sign in token["content"])
            and sum(nul.tokens[0] in token for token in model["model"]["vocab"]) == 1
        )
        self.between = nul.ids[0] if nul.ids else -1
        # Signs that stand in no added token, so that none reaches from letters into them.
        self.ending = "".join(sign for sign in SIGNS if not any(sign in token["content"] for token in added))
        self.forget()

    def forget(self) -> None:
        """Start with no word but the empty one, which has no ids."""
        self.flat, self.used = np.empty(1 << 16, dtype=self.kind), 0
        self.starts, self.sizes, self.slots = np.zeros(1 << 14, dtype=np.int32), np.zeros(1 << 14, dtype=np.int32), 1
        #: Which slots a later call has met again.
        self.again = np.zeros(1 << 14, dtype=bool)
        #: Slots of words that follow a space (-1: can't be cut off), of words that start a text, and of pieces of the usual
        #: pattern inside words.
        self.spaced: dict[str, int] = {}
        self.first: dict[str, int] = {"": 0}
        self.pieces: dict[str, int] = {}

    def forget_rare(self) -> None:
        """Start with the words after a space that were met again: they needn't be encoded once more because of the rare ones."""
        slots = np.fromiter(self.spaced.values(), dtype=np.int32, count=len(self.spaced))
        met = (slots > 0) & self.again[slots]
        kept = list(compress(self.spaced, met.tolist()))
        ids, ends = self.gathered(slots[met])
        self.forget()
        self.spaced.update(zip(kept, self.store(ids, np.diff(ends, prepend=0))))

    def store(self, ids: np.ndarray, sizes: np.ndarray) -> range:
        """The new slots of words with so many ids each."""
        first, used = self.slots, self.used
        self.slots, self.used = first + len(sizes), used + len(ids)
        self.flat = grown(self.flat, self.used)
        self.starts, self.sizes, self.again = (grown(values, self.slots) for values in (self.starts, self.sizes, self.again))
        self.flat[used : self.used] = ids
        self.sizes[first : self.slots] = sizes
        self.starts[first : self.slots] = used + np.cumsum(sizes) - sizes
        return range(first, self.slots)

    def gathered(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of slots one after the other, and where those of each end."""
        sizes = self.sizes[slots]
        ends = np.cumsum(sizes, dtype=np.int32)
        total = int(ends[-1]) if len(ends) else 0
        place = np.arange(total, dtype=np.int32) + np.repeat(self.starts[slots] - ends + sizes, sizes)
        return self.flat[place], ends

    def whole(self, texts: list[str]) -> range:
        """New slots with the ids of whole texts, from the library."""
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        lists = [one.ids for one in found]
        sizes = np.fromiter(map(len, lists), dtype=np.int32, count=len(lists))
        return self.store(np.fromiter(chain.from_iterable(lists), dtype=self.kind, count=int(sizes.sum())), sizes)

    def pieces_of(self, word: str) -> tuple[str, list[str]] | None:
        """The letters that a word starts with and the pieces after them, if all of its lines are letters and then signs."""
        found = []
        for line in word.split("\n"):
            letters = line.rstrip(self.ending)
            if not letters.isalpha():
                return None
            found += ["\n", letters, line[len(letters) :]]
        return found[1], list(filter(None, found[2:]))

    def learn(self, words: list[str]) -> None:
        """Give slots to new words that follow a space."""
        letters, others, several, heads, rests, sizes = [], [], [], [], [], []
        for word in words:
            if word.isalpha():
                letters.append(word)
            elif (core := word.rstrip(self.ending)).isalpha():
                several.append(word)
                heads.append(core)
                rests.append(word[len(core) :])
                sizes.append(2)
            elif not word or word[0].isspace() or word[-1].isspace() or "\0" in word:
                self.spaced[word] = -1
            elif found := self.pieces_of(word):
                several.append(word)
                heads.append(found[0])
                rests += found[1]
                sizes.append(1 + len(found[1]))
            else:
                others.append(word)
        self.learn_joined(others)
        letters = list(dict.fromkeys(chain(letters, (core for core in heads if core not in self.spaced))))
        self.spaced.update(zip(letters, self.merged([" " + word for word in letters])))
        if several:
            stops = np.cumsum(sizes)
            starts_word = np.zeros(stops[-1], dtype=bool)
            starts_word[np.r_[0, stops[:-1]]] = True
            slots = np.empty(stops[-1], dtype=np.int32)
            slots[starts_word] = np.fromiter(map(self.spaced.__getitem__, heads), dtype=np.int32, count=len(heads))
            slots[~starts_word] = self.slots_of(self.pieces, rests, self.learn_pieces)
            ids, ends = self.gathered(slots)
            self.spaced.update(zip(several, self.store(ids, np.diff(ends[stops - 1], prepend=0))))

    def learn_pieces(self, pieces: list[str]) -> None:
        new = list(dict.fromkeys(pieces))
        self.pieces.update(zip(new, self.merged(new)))

    def merged(self, pieces: list[str]) -> range:
        """New slots with the ids of pieces of the usual pattern, none with a NUL: the library's model need only merge them."""
        first = self.slots
        for start in range(0, len(pieces), MERGE_PIECES):
            joined = self.as_letters("\0".join(pieces[start : start + MERGE_PIECES]))
            tokens = list(map(self.library.model.tokenize, joined.split(BYTE_LETTERS[0])))
            sizes = np.fromiter(map(len, tokens), dtype=np.int32, count=len(tokens))
            ids = map(attrgetter("id"), chain.from_iterable(tokens))
            self.store(np.fromiter(ids, dtype=self.kind, count=int(sizes.sum())), sizes)
        return range(first, self.slots)

    def as_letters(self, text: str) -> str:
        """The bytes of a text as the characters that stand for them in the vocabulary."""
        return text.encode().decode("latin-1").translate(BYTE_LETTERS)

    def learn_joined(self, words: list[str]) -> None:
        """Words without odd characters, each after a space, with a NUL between them, many in one call."""
        for start in range(0, len(words), CALL_WORDS):
            some = words[start : start + CALL_WORDS]
            joined = self.library.encode_batch_fast([" " + "\0 ".join(some)], add_special_tokens=False)[0].ids
            ids = np.array(joined, dtype=self.kind)
            kept = ids != self.between
            cuts = np.flatnonzero(~kept)
            if len(cuts) != len(some) - 1:
                raise ValueError("words and ids don't fit together")
            sizes = np.diff(np.r_[-1, cuts, len(ids)]) - 1
            self.spaced.update(zip(some, self.store(ids[kept], sizes)))

    def slots_of(self, known: dict[str, int], words: list[str], learn) -> np.ndarray:
        slots = np.fromiter(map(known.get, words, repeat(UNKNOWN)), dtype=np.int32, count=len(words))
        places = np.flatnonzero(slots == UNKNOWN)
        if len(places):
            new = list(map(words.__getitem__, places.tolist()))
            learn(new)
            slots[places] = np.fromiter(map(known.__getitem__, new), dtype=np.int32, count=len(new))
        return slots

    def encode_flat(self, texts: pa.Array, spaced: bool = False, words: Words | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where those of each end.

        `spaced`: every text as if a space stood before it. `words`: `words_of(texts)`, if it is known.
        """
        texts = texts.fill_null("")
        if not len(texts):
            return np.empty(0, dtype=self.kind), np.empty(0, dtype=np.int64)
        if not self.by_words:
            self.forget()
            return self.gathered(np.array(self.whole([" " * spaced + text for text in texts.to_pylist()])))
        remembered = len(self.spaced) + len(self.first) + len(self.pieces)
        if remembered > MEMO_WORDS // self.sharing or self.used > MEMO_IDS // self.sharing:
            self.forget_rare()
        distinct, index, borders = words or words_of(texts)
        known = self.slots
        slots = self.slots_of(self.spaced, distinct, self.learn)
        self.again[slots[(slots > 0) & (slots < known)]] = True
        slots = slots[index]
        starts = borders[:-1]
        if not spaced:
            # The first word of a text follows no space, so it is encoded by itself; white space at its end reaches further.
            firsts = list(map(distinct.__getitem__, index[starts].tolist()))
            slots[starts] = self.slots_of(self.first, firsts, self.learn_first)
        # A word that can't be cut off, or nothing to cut: the whole text at once, in the place of its first word.
        odd = np.flatnonzero(np.minimum.reduceat(slots, starts) < 0)
        before = self.slots, self.used
        if len(odd):
            slots[np.repeat(np.isin(np.arange(len(texts)), odd), np.diff(borders))] = 0
            slots[starts[odd]] = self.whole([" " * spaced + texts[number].as_py() for number in odd.tolist()])
        ids, ends = self.gathered(slots)
        self.slots, self.used = before
        return ids, ends[borders[1:] - 1].astype(np.int64)

    def learn_first(self, words: list[str]) -> None:
        new = list(dict.fromkeys(words))
        self.first.update(zip(new, self.whole(new)))
        self.first.update((word, -1) for word in new if word[-1].isspace())

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The packed ids of each text."""
        ids, ends = self.encode_flat(texts)
        return [ids[a:b].tobytes() for a, b in zip([0, *ends.tolist()], ends.tolist())]


def grown(values: np.ndarray, size: int) -> np.ndarray:
    """`values` with room for `size` numbers."""
    if size <= len(values):
        return values
    out = np.zeros(max(size, 2 * len(values)), dtype=values.dtype)
    out[: len(values)] = values
    return out


class SharedEncoder:
    """What the driver broadcasts: each worker makes one encoder of it and keeps that for its later tasks."""

    def __init__(self, definition: str, width: int):
        self.definition, self.width, self.encoder = definition, width, None

    def get(self) -> TextEncoder:
        self.encoder = self.encoder or TextEncoder(self.definition, self.width)
        return self.encoder


def with_end(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """`end_id` after the ids of every text."""
    return np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)


def write_step(folder: str, shared: Broadcast, end_id: int):
    schema = pa.schema([("path", pa.string())] + [(n, pa.int64()) for n in ("task", "number", "documents", "ids")])

    def rows(batches: Batches) -> Iterator[tuple]:
        encoder, width = shared.value.get(), shared.value.width
        task, number, out = TaskContext.get().partitionId(), 0, None

        def encoded() -> Iterator[tuple]:
            for batch in batches:
                keys, texts = batch.columns
                for start, count in runs_of(texts, ENCODE_BYTES):
                    yield keys.slice(start, count), *with_end(*encoder.encode_flat(texts.slice(start, count)), end_id)

        for keys, ids, ends in encoded():
            while len(ends):
                if out and not out.room(keys, ends):
                    path, documents, total = out.close()
                    yield path, task, number, documents, total
                    out, number = None, number + 1
                out = out or TokenFileWriter(attempt_path(folder, "ids", task, number, ".eft"), width)
                many = out.room(keys, ends)
                stop = int(ends[many - 1])
                out.add(keys.slice(0, many), ids[:stop], ends[:many])
                keys, ids, ends = keys.slice(many), ids[stop:], ends[many:] - stop
        if out:
            path, documents, total = out.close()
            yield path, task, number, documents, total

    return lambda batches: in_batches(rows(batches), schema)


def write(df: DataFrame, path: str, end_id: int, key: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """Write the ids of all texts in ascending order of their keys; the listing of the files, stored.

    (path, task, number, documents, ids, start): `start` is the number of ids in all files before.
    """
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    model = json.loads(definition)
    largest = max([end_id, *model["model"]["vocab"].values(), *(t["id"] for t in model.get("added_tokens", []))])
    folder = folder or fresh_path(df.sparkSession, "token-files")
    ordered = (
        df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        # Rows equal in id and text are dealt out as well; they give the same ids in any order.
        .repartitionByRange("key", "tie", F.rand(seed=0))
        .sortWithinPartitions("key", "tie")
        .select("key", "text")
    )
    fields = "path STRING, task BIGINT, number BIGINT, documents BIGINT, ids BIGINT"
    encoder = SharedEncoder(definition, 2 if largest < 1 << 16 else 4)
    step = write_step(folder, df.sparkSession.sparkContext.broadcast(encoder), end_id)
    listing = Written(map_batches(ordered, fields, step), "token-listing").df
    # One row per file, so the sum over all of them is small.
    before = Window.orderBy("task", "number").rowsBetween(Window.unboundedPreceding, -1)
    return listing.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_step(schema: pa.Schema, row):
    def rows(batches: Batches) -> Iterator[tuple]:
        for path, start in rows_of(batches):
            file = TokenFile(path)
            for key, offset, ids in file.rows():
                yield row(key, start + offset, ids)
            file.close()

    return lambda batches: in_batches(rows(batches), schema)


def read(listing: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of every document from its file."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int32()))])
    files = one_file_a_task(listing.select("path", "start"))
    step = read_step(schema, lambda key, start, ids: (key, start, ids.astype(np.int32)))
    return map_batches(files, "doc_id BIGINT, start BIGINT, ids ARRAY<INT>", step)


def checksums(listing: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document from its file; the ids stay in the task that reads them."""
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])
    files = one_file_a_task(listing.select("path", "start"))
    step = read_step(schema, lambda key, start, ids: (key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
    return map_batches(files, "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT", step)
