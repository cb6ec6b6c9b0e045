"""Packing tokenised documents into training windows.

Every task packs the documents of its input partition online; there is no
shuffle.  A document longer than the window first fills whole windows of its
own; the remainder is placed by the sum-of-squares rule: with N(l) the number
of windows filled to level l (0 < l < window), it goes to the level, or into a
new window, that makes the sum of the squares of N smallest.  The counts live
in one level array; ties go to the fullest window.

Only open windows are held.  When the input ends, or when ``max_open`` windows
are open, their pieces are cut anew into full windows; what is left at the end
becomes sequences whose lengths are powers of two, which need no padding.

Tokenising is exact: the tokenizer lower-cases, drops white space and cuts at
it and before marks, so texts are cut there first, each distinct string is
encoded once per task, and its ids are used again; texts that hold ``<|`` (it
could start a special token) are encoded whole.  A task keeps the words of the last two
generations of ``_GENERATION`` words: a word that is met again moves to the newer one, so
common words stay and rare ones go.

Defined cases: a null or empty text is the closing id alone; a null id is kept;
repeated rows are packed each; an empty table gives no rows; only the id and
text columns are read.  Sequence ids are unique: input partition in the upper
bits, a counter below.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .textops import giving_back, slices

WINDOW = 2048
END_ID = 1
MAX_OPEN = 512
_GENERATION = 200_000
#: Where the tokenizer itself always cuts: a letter or digit, then an ASCII mark other than the apostrophe.
_MARK_AFTER_WORD = r"([\p{L}\p{N}])([!-&(-/:-@\[-`{-~])"


class WordTokenizer:
    """Encodes texts word by word, remembering the ids of each distinct word."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.recent: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.begin = np.zeros(1, np.int64)  # where the ids of entry k begin; one more at the end

    def age(self) -> None:
        """The recent words become the older ones; the ids of those are forgotten."""
        entries = np.fromiter(self.recent.values(), np.int64, len(self.recent))
        sizes = (self.begin[1:] - self.begin[:-1])[entries]
        ends = np.cumsum(sizes)
        self.ids = self.ids[np.arange(int(ends[-1])) + np.repeat(self.begin[entries] - (ends - sizes), sizes)]
        self.begin = np.concatenate([[0], ends])
        self.older, self.recent = dict(zip(self.recent, range(len(entries)), strict=True)), {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def places(self, distinct: list[str]) -> np.ndarray:
        """The entry of each word."""
        if len(self.recent) > _GENERATION:
            self.age()
        recent, older = self.recent, self.older
        new = []
        for w in distinct:
            if w not in recent:
                entry = older.get(w)
                if entry is None:
                    new.append(w)
                else:
                    recent[w] = entry
        if new:
            found = self.encode(new)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            end = int(self.begin[-1])
            total = end + int(sizes.sum())
            if total > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(total, np.uint32)])
            self.ids[end:total] = np.concatenate(found)
            first = len(self.begin) - 1
            self.begin = np.concatenate([self.begin, end + np.cumsum(sizes)])
            recent.update(zip(new, range(first, first + len(new)), strict=True))
        return np.fromiter(map(recent.__getitem__, distinct), np.int64, len(distinct))

    def documents(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text."""
        whole = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        plain = pc.replace_substring(pc.ascii_lower(pc.if_else(pa.array(whole), "", texts)), "\n", " ")
        parts = pc.split_pattern(pc.replace_substring_regex(plain, _MARK_AFTER_WORD, r"\1 \2"), " ")
        words = parts.flatten().dictionary_encode()
        place = self.places(words.dictionary.to_pylist())[words.indices.to_numpy()]
        sizes = (self.begin[1:] - self.begin[:-1])[place]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        shift = np.repeat(self.begin[place] - ends[:-1], sizes)
        ids = self.ids[np.arange(ends[-1]) + shift]
        borders = ends[np.asarray(parts.offsets) - parts.offsets[0].as_py()]
        for i, is_whole in enumerate(whole):
            yield self.encode([texts[i].as_py()])[0] if is_whole else ids[borders[i] : borders[i + 1]]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


class Packer:
    """Sum-of-squares packing.  A piece is (document, start, ids, document tokens);
    ``out`` receives finished sequences as lists of pieces."""

    def __init__(self, window: int, max_open: int):
        self.window, self.max_open = window, max_open
        self.counts = np.zeros(window + 1, np.int64)  # N(l); entry `window` stays 0
        self.at: dict[int, list[list]] = defaultdict(list)
        self.open = 0
        self.out: list[list[tuple]] = []

    def add(self, doc, ids: np.ndarray) -> None:
        start = 0
        while len(ids) - start >= self.window:
            self.out.append([(doc, start, ids[start : start + self.window], len(ids))])
            start += self.window
        if start < len(ids):
            self.place((doc, start, ids[start:], len(ids)))
        if self.open > self.max_open:
            self.recut(final=False)

    def place(self, piece: tuple) -> None:
        size = len(piece[2])
        levels = np.flatnonzero(self.counts[: self.window - size + 1])
        # change of the sum of squares; a full window counts nowhere
        change = 2 * (self.counts[levels + size] - self.counts[levels]) + 1 + (levels + size < self.window)
        level = 0
        if len(levels):
            best = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[best] <= 2 * self.counts[size] + 1:  # that of a new window
                level = int(levels[best])
        if level:
            pieces = self.at[level].pop()
            self.counts[level] -= 1
            self.open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level + size == self.window:
            self.out.append(pieces)
        else:
            self.at[level + size].append(pieces)
            self.counts[level + size] += 1
            self.open += 1

    def recut(self, final: bool) -> None:
        """Cut the pieces of all open windows into full ones."""
        pieces = [p for level in sorted(self.at, reverse=True) for w in self.at[level] for p in w]
        self.at.clear()
        self.counts[:] = 0
        self.open = 0
        left = sum(len(p[2]) for p in pieces)
        sizes = [self.window] * (left // self.window)
        rest = left % self.window
        sizes += [1 << b for b in reversed(range(self.window.bit_length())) if rest >> b & 1] if final else [rest] * (rest > 0)
        source = iter(pieces)
        piece = None
        for size in sizes:
            sequence, filled = [], 0
            while filled < size:
                piece = piece or next(source)
                doc, start, ids, total = piece
                take = min(len(ids), size - filled)
                sequence.append((doc, start, ids[:take], total))
                piece = (doc, start + take, ids[take:], total) if take < len(ids) else None
                filled += take
            if size == self.window or final:
                self.out.append(sequence)
            else:
                self.at[size].append(sequence)
                self.counts[size] += 1
                self.open += 1


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    max_open: int = MAX_OPEN,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset and, with ``with_ids``, the token ids."""
    id_type = docs.schema[id_col].dataType
    schema = f"doc_id {id_type.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    if with_ids:
        schema += ", ids array<int>"

    def rows(sequences: list, first_id: int, names: list) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in names]
        for k, sequence in enumerate(sequences):
            offset = 0
            for doc, start, ids, total in sequence:
                values = (doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, first_id + k, offset)
                for column, value in zip(columns, values, strict=False):
                    column.append(value)
                if with_ids:
                    columns[-1].append(ids.astype(np.int32))
                offset += len(ids)
        types = [doc_type, *[pa.int64()] * 6, pa.list_(pa.int32())]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names)

    from pyspark.sql.pandas.types import to_arrow_type

    doc_type = to_arrow_type(id_type)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, packer = word_tokenizer(tokenizer_path), Packer(window, max_open)
        next_id = TaskContext.get().partitionId() << 40
        end = np.array([end_id], np.uint32)
        for batch in batches:
            ids_of = batch.column(0)
            for first, n, texts in slices(batch, "text"):
                for doc, ids in zip(ids_of.slice(first, n).to_pylist(), tokenizer.documents(texts), strict=True):
                    packer.add(doc, np.concatenate([ids, end]))
                if packer.out:
                    yield rows(packer.out, next_id, names)
                    next_id += len(packer.out)
                    packer.out = []
        tokenizer.clear()  # a reused worker keeps the vocabulary, not the words
        packer.recut(final=True)
        if packer.out:
            yield rows(packer.out, next_id, names)

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(giving_back(pack), schema)


def op4_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
