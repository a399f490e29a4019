"""Encoding to SentencePiece ids and back by a weighted finite-state transducer.

The transducer is composed of three parts, compiled once from the model: the normaliser (a state that reads blanks as the piece mark, behind a
mark on the way in), an arc for each piece with its weight, and an arc for each character outside of the vocabulary that gives its byte pieces. An input is composed with
it lazily: states are positions in the input, arcs the pieces that start there; the encoding is the shortest path in the tropical
semiring (weights add along a path, the least total wins).

In a unigram model an arc weighs the negative score. In a BPE model merging decides, not a sum, so a state also holds the last
piece, and an arc weighs 0 where merging leaves the two pieces apart and infinity otherwise: a sequence is the model's
encoding if and only if each pair of neighbours is, so one path of finite weight is left, and one state for each position. Pairs
are decided by undoing the merges of the two pieces at their border, once for each pair. The arcs into a position are found by an automaton over all pieces.

Words are independent where no piece has the mark behind another character. A BPE model's words fall into parts further, at borders between
two characters that stand side by side in no piece, since no arc but those of the characters themselves ends or starts across one. The words of a
batch, and then their parts, become a dictionary; each different part is searched once and kept in a cache of bounded size. Those of a batch are
searched in order, each from what it shares with the one before. Caches end with their task, as a worker may serve other queries afterwards.

Defined results: a null text has null ids, an empty text none; text of any length is encoded whole; the mark itself is read as a
blank; ids outside of the model decode to nothing, control pieces likewise, bytes that are no UTF-8 to U+FFFD. Each row stands
alone, so ids of rows don't matter; extra columns stay, an empty table gives an empty table.
"""

from __future__ import annotations

import re
import struct
import sys
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanforge.llm.common import give_back, text_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNIGRAM, BPE = 1, 2
# Piece types of the model format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
# A longer part isn't kept after its batch.
LONG_WORD = 64
# Some 200 bytes each.
CACHED_CHARACTERS = 100_000
CACHED_WORDS = 300_000
CACHED_PAIRS = 400_000


def fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


@dataclass
class Model:
    """Pieces in order of id, their scores and types, and what the transducer needs of the model's settings."""

    pieces: list[str]
    scores: list[float]
    types: list[int]
    kind: int
    front_mark: bool = True
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


def read_model(spark: SparkSession, path: str) -> Model:
    """Read through Spark, so the path may be in any store. Normalisers with a character map aren't supported."""
    local = path if "://" in path else f"file://{path}"
    data = bytes(spark.read.format("binaryFile").load(local).select("content").first()[0])
    model = Model([], [], [], UNIGRAM)
    for number, value in fields(data):
        if number == 1:
            piece = dict(fields(value))
            model.pieces.append(piece[1].decode())
            model.scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
            model.types.append(piece.get(3, NORMAL))
        elif number == 2:
            model.kind = dict(fields(value)).get(3, UNIGRAM)
        elif number == 3:
            spec = dict(fields(value))
            model.front_mark = bool(spec.get(3, 1))
            if spec.get(2) or spec.get(4, 1) or not spec.get(5, 1):
                raise ValueError("this model's normaliser has a character map, trims blanks or keeps them: not supported")
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    return model


@dataclass
class Transducer:
    """The compiled model: arcs by piece, bytes, and the pairs decided so far."""

    model: Model
    arcs: dict[str, int] = field(default_factory=dict)
    bytes_of: dict[int, int] = field(default_factory=dict)
    pairs: dict[int, bool] = field(default_factory=dict)
    # Arcs by number: what each gives, what it reads, and those of characters without a piece. Pieces have their ids.
    labels: list[tuple[int, ...]] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    other: dict[str, int] = field(default_factory=dict)
    plain: list[str | None] = field(default_factory=list)
    words: dict[str, tuple[int, ...]] = field(default_factory=dict)
    # Characters side by side in a piece, as numbers in order.
    beside: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    by_word: bool = False
    shown: pa.Array | None = None
    order: dict[str, int] = field(default_factory=dict)
    made_of: dict[str, tuple[str, str]] = field(default_factory=dict)
    unmade: set[str] = field(default_factory=set)
    irregular: set[str] = field(default_factory=set)
    endings: ahocorasick.Automaton = field(default_factory=ahocorasick.Automaton)
    longest: int = 1
    unknown: int = 0
    unknown_weight: float = 0.0
    words_in: re.Pattern = re.compile("")
    lead: str = ""

    def __post_init__(self):
        m = self.model
        for i, (piece, kind) in enumerate(zip(m.pieces, m.types)):
            if kind == BYTE:
                self.bytes_of[int(piece[3:5], 16)] = i
            elif kind == UNKNOWN:
                self.unknown = i
            elif kind in (NORMAL, USER):
                self.arcs[piece] = i
        # Single characters need no search: each is the arc where no longer one fits.
        for piece in [p for p in self.arcs if len(p) > 1]:
            self.endings.add_word(piece, (len(piece), self.arcs[piece]))
        if not len(self.endings):
            self.endings.add_word("\0\0", (2, 0))
        self.endings.make_automaton()
        self.labels, self.texts = [(i,) for i in range(len(m.pieces))], list(m.pieces)
        self.plain = [None if k == BYTE else " ⁇ " if k == UNKNOWN else "" if k == CONTROL else p for p, k in zip(m.pieces, m.types)]
        self.longest = max(map(len, self.arcs), default=1)
        self.by_word = all(MARK not in p.lstrip(MARK) for p in self.arcs)
        self.lead = MARK if self.by_word and m.front_mark else ""
        self.words_in = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if self.by_word else ".+", re.DOTALL)
        # What decoding shows; bytes from 0x80 on need their neighbours. A byte below is a character whatever stands beside it.
        shown = [p.replace(MARK, " ") if p is not None else None for p in self.plain]
        for byte, i in self.bytes_of.items():
            shown[i] = chr(byte) if byte < 0x80 else None
        self.shown = pa.array([*shown, None], pa.string())
        if m.kind == BPE:
            self.learn_merges()
            self.beside = np.array(sorted({(ord(x) << 21) + ord(y) for p in self.arcs for x, y in zip(p, p[1:])}), np.int64)
        self.unknown_weight = 10 - min(m.scores, default=0.0)

    def merged(self, text: str, n: int = 1) -> list[str]:
        """Pieces that merging leaves, or the first ``n`` or fewer: the best score first, then the leftmost."""
        parts = list(text)
        while len(parts) > n:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = self.arcs.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.model.scores[piece] > best):
                    best, at = self.model.scores[piece], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def learn_merges(self) -> None:
        """How merging makes each piece: its last two parts, and its place in the order of merges."""
        place = {score: i for i, score in enumerate(sorted({self.model.scores[i] for i in self.arcs.values()}, reverse=True))}
        self.order = {p: place[self.model.scores[i]] for p, i in self.arcs.items()}
        parts = {p: self.merged(p, 2) for p in self.arcs if len(p) > 1}
        self.made_of = {p: (x[0], x[1]) for p, x in parts.items() if len(x) == 2}
        self.unmade = parts.keys() - self.made_of.keys()
        for piece in sorted(self.arcs, key=len):
            made = [p for p in self.made_of.get(piece, ()) if p in self.made_of]
            if any(p in self.irregular or self.order[p] >= self.order[piece] for p in made):
                self.irregular.add(piece)

    def left_apart(self, left: str, right: str) -> bool:
        """Undoes the merges of both pieces, latest first: do the parts at the border never join before the next merge?

        Needs parts that merge before their whole. Of equal scores the leftmost merge comes first: left, border, right.
        """
        if left in self.unmade or right in self.unmade:
            return False
        until = float("inf")
        while left:
            joined = self.order.get(left + right)
            if joined is not None and 3 * joined + 1 < until:
                return False
            made_left = 3 * self.order[left] if left in self.made_of else -1
            made_right = 3 * self.order[right] + 2 if right in self.made_of else -1
            if made_left == made_right:
                break
            until = max(made_left, made_right)
            if made_left > made_right:
                left = self.made_of[left][1]
            else:
                right = self.made_of[right][0]
        return True

    def apart(self, left: str, right: str) -> bool:
        """Does merging leave these two neighbours as they are? Characters without a piece never merge."""
        if left in self.irregular or right in self.irregular:
            return self.merged(left + right) == ([left, right] if left else [right])
        return self.left_apart(left, right)

    def byte_arc(self, char: str) -> int:
        """Number of the arc that reads a character without a piece and gives its byte pieces, or the unknown piece."""
        number = self.other.get(char)
        if number is None:
            number = self.other[char] = len(self.labels)
            self.labels.append(tuple(self.bytes_of[b] for b in char.encode("utf-8", "surrogatepass")) if self.bytes_of else (self.unknown,))
            self.texts.append(char)
        return number

    def first_arc(self, char: str) -> int:
        """Number of the arc that reads one character."""
        return self.arcs[char] if char in self.arcs else self.byte_arc(char)

    def bpe_paths(self, words: list[str]) -> Iterator[list[int]]:
        """Arcs of the path of finite weight through each word; words in order.

        The last arc into a position depends on what is before it alone, so a word goes on from what it shares with the word before.
        """
        known, before, last, widths = self.pairs, "", [-1], [0]
        for word in words:
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            # A character of which no longer piece fits stands alone.
            last[shared + 1 :] = map(self.first_arc, word[shared:])
            widths[shared + 1 :] = [1] * (len(word) - shared)
            decided = shared
            # Arcs come by their end, the longest first.
            for at, (width, number) in self.endings.iter(word, max(0, shared + 1 - self.longest)):
                if at >= decided:
                    pair = (last[at + 1 - width] << 32) + number
                    apart = known.get(pair)
                    if apart is None:
                        apart = self.decide(pair, last[at + 1 - width], number)
                    if apart:
                        last[at + 1], widths[at + 1], decided = number, width, at + 1
            before = word
            path, end = [], len(word)
            while end:
                path.append(last[end])
                end -= widths[end]
            yield path[::-1]

    def decide(self, pair: int, left: int, right: int) -> bool:
        """Weight of an arc after another, as whether it is finite; kept for the pair."""
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        self.pairs[pair] = known = self.apart(self.texts[left] if left >= 0 else "", self.texts[right])
        return known

    def unigram_paths(self, words: list[str]) -> Iterator[list[int]]:
        """Arcs of the lightest path through each word."""
        for word in words:
            best, last, widths = [0.0] + [float("inf")] * len(word), [-1] * (len(word) + 1), [0] * (len(word) + 1)
            for end in range(1, len(word) + 1):
                for start in range(max(0, end - self.longest), end):
                    number = self.arcs.get(word[start:end])
                    if number is None:
                        if end - start > 1:
                            continue
                        number, weight = self.byte_arc(word[start]), best[start] + self.unknown_weight
                    else:
                        weight = best[start] - self.model.scores[number]
                    if weight < best[end]:
                        best[end], last[end], widths[end] = weight, number, end - start
            path, end = [], len(word)
            while end:
                path.append(last[end])
                end -= widths[end]
            yield path[::-1]

    def unigram_path(self, word: str) -> list[str]:
        return [self.texts[n] for n in next(self.unigram_paths([word]))]

    def normal(self, text: str) -> str:
        """The normaliser: one state, an arc from each character to itself but for the blank, and a mark on the way in."""
        return (MARK if self.model.front_mark else "") + text.replace(" ", MARK)

    def split(self, text: str) -> list[str]:
        """Words of a text, without the mark that they all begin with (``lead``)."""
        if self.lead and "  " not in text and MARK not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        words = self.words_in.findall(self.normal(text))
        return [w[1:] for w in words] if self.lead else words

    def search(self, words: list[str]) -> list[tuple[int, ...]]:
        """Ids of different words or parts, marks included. Those that aren't known yet are searched together, in order."""
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        if len(self.labels) > len(self.model.pieces) + CACHED_CHARACTERS:
            self.forget_characters()
        known, labels = self.words, self.labels
        new = sorted(w for w in words if w not in known)
        paths = self.bpe_paths if self.model.kind == BPE else self.unigram_paths
        for word, path in zip(new, paths(new)):
            known[word] = tuple(chain.from_iterable([labels[n] for n in path]))
        found = [known[w] for w in words]
        for word in new:
            if len(word) > LONG_WORD:
                del known[word]
        return found

    def encode_all(self, texts: list[str | None]) -> list[list[int] | None]:
        """Ids of each text, whatever blanks and marks it has."""
        split = [self.split(t) if t else [] for t in texts]
        words = list(set(chain.from_iterable(split)))
        ids = dict(zip(words, self.search([self.lead + w for w in words])))
        return [None if t is None else list(chain.from_iterable(map(ids.__getitem__, some))) for t, some in zip(texts, split)]

    def encode_array(self, texts: pa.Array) -> pa.Array:
        """Ids of each text. Texts with single blanks between words, and no mark, go by way of a dictionary of their words; others by ``encode_all``."""
        texts = texts.cast(pa.string())
        plain = self.plainly_spaced(texts) if self.by_word else np.zeros(len(texts), bool)
        odd = as_lists(self.encode_all(texts.filter(pa.array(~plain)).to_pylist()))
        if not plain.any():
            return odd
        even = self.encode_spaced(texts.filter(pa.array(plain)))
        place = np.where(plain, np.cumsum(plain) - 1, len(even) + np.cumsum(~plain) - 1)
        return pa.concat_arrays([even, odd]).take(pa.array(place)) if len(odd) else even

    def plainly_spaced(self, texts: pa.Array) -> np.ndarray:
        """Which texts aren't null or empty, have no mark, and single blanks within only."""
        odd = np.zeros(len(texts), bool)
        for mask in (pc.is_null(texts), pc.equal(pc.binary_length(texts), 0), pc.match_substring(texts, MARK), pc.starts_with(texts, " "), pc.ends_with(texts, " "), pc.match_substring(texts, "  ")):
            odd |= mask.fill_null(True).to_numpy(zero_copy_only=False)
        return ~odd

    def encode_spaced(self, texts: pa.Array) -> pa.Array:
        """Ids of plainly spaced texts: of the different parts, put together to the different words, and these to the texts."""
        if self.lead:
            texts = pc.binary_join_element_wise("", texts, " ")
        ends, data = string_buffers(texts)
        words, first_word = cut_strings(data, ends, np.flatnonzero(data == ord(" ")))
        words = words.dictionary_encode()
        ends, data = string_buffers(words.dictionary)
        parts, first_part = cut_strings(data, ends, self.borders(data))
        parts = parts.dictionary_encode()
        ids = as_lists(self.search([p.replace(" ", MARK) for p in parts.dictionary.to_pylist()]))
        return together(together(ids, parts.indices, first_part), words.indices, first_word)

    def borders(self, data: np.ndarray) -> np.ndarray:
        """Places in UTF-8 between characters that no piece has side by side, blanks being marks; none in a unigram model."""
        if self.model.kind != BPE:
            return np.empty(0, np.int64)
        chars = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").replace(" ", MARK).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        pairs = (chars[:-1] << 21) + chars[1:]
        near = np.append(self.beside, -1)[np.searchsorted(self.beside, pairs)]
        return np.flatnonzero((data & 0xC0) != 0x80)[1:][near != pairs]

    def forget(self) -> None:
        """Empties the caches; what was compiled from the model stays."""
        self.words.clear()
        self.forget_characters()

    def forget_characters(self) -> None:
        n = len(self.model.pieces)
        del self.labels[n:], self.texts[n:]
        self.other.clear()
        self.pairs.clear()

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> str:
        """The way back: bytes are read together, the mark gives a blank, and the mark in front goes."""
        size = len(self.plain)
        parts = [self.plain[i] if i is not None and 0 <= i < size else "" for i in ids]
        if None in parts:
            parts = self.with_bytes(ids, parts)
        text = "".join(parts).replace(MARK, " ")
        return text[1:] if self.model.front_mark and text.startswith(" ") else text

    def with_bytes(self, ids: list[int], parts: list[str | None]) -> list[str]:
        out, held = [], bytearray()
        for i, part in zip(ids, parts):
            if part is None:
                held.append(int(self.model.pieces[i][3:5], 16))
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held = bytearray()
            out.append(part)
        return [*out, held.decode("utf-8", "replace")]


def compiled(model: Model) -> Transducer:
    """The transducer of a model; a Python worker keeps the last one between tasks, without its caches."""
    kept = sys.__dict__.setdefault("_piece_transducers", {})
    if model.name not in kept:
        kept.clear()
        kept[model.name] = Transducer(model)
    return kept[model.name]


def as_lists(rows: list[tuple[int, ...] | list[int] | None]) -> pa.Array:
    """Arrow lists by way of one flat array, since Arrow takes single Python numbers slowly."""
    ends = np.cumsum([0, *[len(r) if r else 0 for r in rows]], dtype=np.int32)
    flat = np.fromiter(chain.from_iterable([r for r in rows if r]), np.int32, ends[-1])
    nulls = np.array([r is None for r in rows] + [False])
    return pa.ListArray.from_arrays(pa.array(ends, mask=nulls), pa.array(flat))


def string_buffers(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of an array without nulls, from 0 on."""
    _, offsets, data = strings.buffers()
    ends = np.frombuffer(offsets, np.int32)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return ends - ends[0], data[ends[0] : ends[-1]]


def cut_strings(data: np.ndarray, ends: np.ndarray, places: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Strings cut further at ``places``, and the number of the first piece of each (and one more, behind the last)."""
    cuts = np.union1d(ends, places).astype(np.int32)
    return pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))), np.searchsorted(cuts, ends)


def together(lists: pa.Array, numbers: pa.Array, first: np.ndarray) -> pa.Array:
    """Lists by their numbers, those from each ``first`` to the next made one."""
    taken = lists.take(numbers)
    return pa.ListArray.from_arrays(pa.array(taken.offsets.to_numpy()[first]), taken.values)


def decode_array(machine: Transducer, rows: pa.Array) -> pa.Array:
    """Texts of lists of ids. Pieces are looked up and joined as arrays; rows with bytes of longer characters, or ids outside of the model, one by one."""
    ends, flat = rows.offsets.to_numpy(), rows.values
    last = len(machine.shown) - 1
    ids = flat.fill_null(-1).to_numpy()
    ids = np.where((ids >= 0) & (ids < last), ids, last)
    parts = machine.shown.take(pa.array(ids))
    missing = np.concatenate([[0], np.cumsum(parts.is_null().to_numpy(zero_copy_only=False))])[ends]
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), parts.fill_null("")), "")
    if machine.model.front_mark:
        text = pc.if_else(pc.starts_with(text, " "), pc.utf8_slice_codeunits(text, 1), text)
    text = pc.if_else(rows.is_valid(), text, None)
    slow = np.flatnonzero(missing[1:] > missing[:-1])
    if not len(slow):
        return text
    mask = np.zeros(len(rows), bool)
    mask[slow] = True
    return pc.replace_with_mask(text, pa.array(mask), pa.array([None if r is None else machine.decode(r) for r in rows.take(pa.array(slow)).to_pylist()], pa.string()))


def in_task(machine: Transducer, batches: Iterator[pa.Array], of: Callable[[pa.Array], pa.Array]) -> Iterator[pa.Array]:
    """``of`` each batch of a task. The caches, and the memory that they and the batches took, go at its end."""
    try:
        for texts in batches:
            yield of(texts)
    finally:
        machine.forget()
        give_back()


def encode(text: Column, model) -> Column:
    """Ids of each text; ``model`` is a broadcast Model."""

    @F.arrow_udf("array<int>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine = compiled(model.value)
        yield from in_task(machine, batches, machine.encode_array)

    return encoded(text)


def decode(ids: Column, model) -> Column:
    @F.arrow_udf("string")
    def decoded(rows: pa.Array) -> pa.Array:
        return decode_array(compiled(model.value), rows)

    return decoded(ids)


def encode_and_back(text: Column, model) -> Column:
    """struct(ids, restored): ids of each text, and the text that they decode to. One call, so that a text is encoded once."""

    @F.arrow_udf("struct<ids:array<int>,restored:string>")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine = compiled(model.value)

        def both(texts: pa.Array) -> pa.Array:
            ids = machine.encode_array(texts)
            return pa.StructArray.from_arrays([ids, decode_array(machine, ids)], ["ids", "restored"])

        yield from in_task(machine, batches, both)

    return coded(text)


def tokenise(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, text, ids and restored (the text decoded from the ids) of each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    text_batches(spark)
    model = spark.sparkContext.broadcast(read_model(spark, path))
    rows = docs.select("doc_id", "text", encode_and_back(F.col("text"), model).alias("coded"))
    return rows.select("doc_id", "text", "coded.ids", "coded.restored")
