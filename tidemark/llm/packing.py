"""Hierarchical multi-length packing of documents into training sequences.

Windows come in tiers, powers of two up to the longest sequence. A document longer than the longest window is cut into
full windows; its rest is routed to the smallest tier that holds it. Tiers are packed from the longest down: a window
starts with the largest piece of its tier, its gap takes the largest shorter pieces that fit, and what then remains
open is closed by cutting one more piece at the border. A window therefore is always exactly full, and nothing is
padded. What is left in a partition when the last tier cannot fill a window becomes sequences of smaller powers of two.
Sequences of one tier are dealt into step groups of the same number of tokens.

Packing is done partition by partition while the partition is read: no shuffle, no order over the whole table, and
memory bounded by one block of documents. The partition number is the upper part of the sequence id, so ids are unique,
and a task that runs again after a lost executor gives the same rows.

Tokens are those of the given tokenizer over the whole text, followed by ``end_id``. The tokenizer drops white space and
never looks across it, so a text is encoded space by space through a bounded cache of words.

Defined cases: null and empty texts are one ``end_id``. Rows with equal or null doc_ids are separate documents. Extra
columns are ignored. Empty input gives an empty result.
"""

from __future__ import annotations

import functools
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import give_back

MAX_LENGTH = 2048
SMALLEST_TIER = 256
STEP_TOKENS = 16 * MAX_LENGTH
BLOCK_TOKENS = 2 << 20  # documents held back for packing at a time
CACHED_WORDS = 320_000  # and as many of the generation before
CACHED_WORD_CHARS = 40

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_id long"
_ARROW = pa.schema([(n, pa.int32() if n == "tier" else pa.int64()) for n in (c.split()[0] for c in PIECES.split(", "))])


_TWO_MARKS = re.compile(r"[^\w\s][^\w\s]")
#: Marks that ``\w`` takes for letters, the letter whose lower case depends on its place, and separators that the tokenizer does not take for
#: white space.
_ODD = "_\u03a3\x1c\x1d\x1e\x1f"


def _ends_in_letter(word: str) -> bool:
    """Also as the tokenizer sees it: some letters end in a mark once composed or lower-cased, and a mark joins what follows."""
    return unicodedata.normalize("NFC", word).lower()[-1].isalpha()


class WordIds(dict):
    """Token ids of a run of characters without spaces, as little-endian 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.before: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if word == "":
            return b""
        if len(word) > CACHED_WORD_CHARS:
            return self.encode(word)
        ids = self.before.get(word)
        if ids is None:
            if word[-1] in ".," and word[:-1].isalpha() and _ends_in_letter(word[:-1]):  # punctuation is a token run of its own
                ids = self[word[:-1]] + self[word[-1]]
            elif word.isalpha() and "Σ" not in word and (low := word.lower()) != word:
                ids = self[low]
            else:
                ids = self.encode(word)
        if len(self) >= CACHED_WORDS:
            self.before = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def encode(self, word: str) -> bytes:
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def text(self, text: str | None) -> bytes:
        if not text:
            return b""
        low = text.lower()
        if any(c in text for c in _ODD) or _TWO_MARKS.search(low) or not unicodedata.is_normalized("NFC", text):
            return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))
        # lower case is what the tokenizer sees, and a full stop or comma with no other mark beside it is a token run of its own
        return b"".join(map(self.__getitem__, low.replace(".", " . ").replace(",", " , ").split()))


@functools.cache
def words_of(path: str) -> WordIds:
    """One cache per worker process, kept from task to task."""
    return WordIds(path)


class Pool:
    """Pieces (document, start, length) by length, with the largest that fits found at once."""

    def __init__(self):
        self.by_length: dict[int, list[tuple[int, int]]] = {}
        self.lengths = 0  # bit n is set while there are pieces of length n
        self.tokens = 0

    def add(self, doc: int, start: int, length: int) -> None:
        self.by_length.setdefault(length, []).append((doc, start))
        self.lengths |= 1 << length
        self.tokens += length

    def take(self, at_most: int) -> tuple[int, int, int] | None:
        fitting = self.lengths & ((2 << at_most) - 1)
        return self._pop(fitting.bit_length() - 1) if fitting else None

    def take_over(self, at_least: int) -> tuple[int, int, int] | None:
        """The shortest piece longer than ``at_least``."""
        longer = self.lengths >> (at_least + 1)
        return self._pop(at_least + (longer & -longer).bit_length()) if longer else None

    def _pop(self, length: int) -> tuple[int, int, int]:
        own = self.by_length[length]
        doc, start = own.pop()
        if not own:
            self.lengths &= ~(1 << length)
        self.tokens -= length
        return doc, start, length


def fill(pool: Pool, size: int, longest: int) -> list[tuple[int, int, int]]:
    """Pieces that fill one window of ``size`` exactly, the first one at most ``longest``; the pool must hold enough tokens."""
    window, gap = [], size
    piece = pool.take(min(longest, size))
    while gap:
        if piece is None:
            doc, start, length = pool.take_over(gap)
            pool.add(doc, start + gap, length - gap)
            piece = doc, start, gap
        window.append(piece)
        gap -= piece[2]
        piece = pool.take(gap) if gap else None
    return window


def windows(pool: Pool, sizes: list[int], final: bool) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """Full windows, longest tier first; with ``final`` the pool is emptied into smaller powers of two."""
    for size in sizes:
        shorter = size // 2 if size > sizes[-1] else 0
        while pool.tokens >= size and pool.lengths >> (shorter + 1):  # while a piece of this tier is left
            yield size, fill(pool, size, size)
    while pool.tokens >= sizes[-1]:
        yield sizes[-1], fill(pool, sizes[-1], sizes[-1])
    while final and pool.tokens:
        size = 1 << (pool.tokens.bit_length() - 1)
        yield size, fill(pool, size, size)


def _packer(path: str, max_length: int, smallest: int, end_id: int):
    sizes = []
    while max_length >= smallest:
        sizes.append(max_length)
        max_length //= 2
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pool = words_of(path), Pool()
        docs: list[tuple[int | None, bytes]] = []
        next_id = TaskContext.get().partitionId() << 40
        steps: dict[int, list[int]] = {}
        next_step = next_id

        def packed(final: bool) -> pa.RecordBatch:
            nonlocal next_id, next_step, docs, pool
            rows = []
            for size, window in windows(pool, sizes, final):
                step = steps.setdefault(size, [0, 0])
                if step[0] == 0:
                    step[:], next_step = [STEP_TOKENS // size, next_step], next_step + 1
                step[0] -= 1
                offset = 0
                for doc, start, length in window:
                    doc_id, ids = docs[doc]
                    rows.append((doc_id, start, length, zlib.crc32(memoryview(ids)[4 * start:4 * (start + length)]), len(ids) // 4, next_id, offset, size, step[1]))
                    offset += length
                next_id += 1
            left, kept, moved = Pool(), [], {}
            for length, own in pool.by_length.items():  # fewer tokens than the smallest tier, or than one window of their tier
                for doc, start in own:
                    if doc not in moved:
                        moved[doc] = len(kept)
                        kept.append(docs[doc])
                    left.add(moved[doc], start, length)
            docs, pool = kept, left
            give_back()
            columns = list(zip(*rows)) if rows else [[] for _ in _ARROW]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = words.text(text.as_py()) + end
                n = len(ids) // 4
                for start in range(0, n, sizes[0]):
                    pool.add(len(docs), start, min(sizes[0], n - start))
                docs.append((doc_id, ids))
                held += n
                if held >= BLOCK_TOKENS:
                    yield packed(final=False)
                    held = pool.tokens
        yield packed(final=True)
    return run


def pack(docs: DataFrame, tokenizer_path: str, max_length: int = MAX_LENGTH, smallest: int = SMALLEST_TIER, end_id: int = 1) -> DataFrame:
    """One row per piece: its document, place in it and in its sequence, CRC-32 of its ids, the window size and the step group."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_packer(tokenizer_path, max_length, smallest, end_id), PIECES)


def padding(pieces: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """Tokens and padding of packed sequences, where a sequence whose length is no power of two is padded to ``max_length``."""
    lengths = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    whole = F.col("n").bitwiseAND(F.col("n") - 1) == 0
    return lengths.agg(F.sum("n").alias("tokens"), F.sum(F.when(whole, 0).otherwise(max_length - F.col("n"))).alias("padding"),
                       F.count("*").alias("sequences"))


def token_ids(texts: list[str | None], path: str, end_id: int = 1) -> list[np.ndarray]:
    """Ids of whole texts with the end id, as the packer sees them."""
    words = words_of(path)
    return [np.frombuffer(words.text(t) + struct.pack("<I", end_id), "<u4") for t in texts]
