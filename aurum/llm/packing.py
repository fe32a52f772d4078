"""Packing token sequences with bounded-space online best-fit.

A packer holds a fixed number of open bins. The bins are found by their free
space: a bitset has bit f set when some open bin has f places free, so the
best fit for a piece of s tokens is the lowest set bit at or above s. If none
fits, a bin is opened; if too many are then open, the fullest is closed first.

Every task packs its own stream of documents (tokenised there; no text or
token ids are shuffled). The pieces in the few bins that a task still holds
open at its end are packed again, longest first, by the same packer in far
fewer tasks. Memory per task is bounded by the open bins.

Semantics: a document is its token ids and an end id; null text is empty, so
it is the end id alone. Documents longer than ``capacity`` are cut; the first
piece takes the remainder, every further piece is full. Repeated rows are
packed as rows of their own. Sequence ids are unique and arbitrary; offsets in
a sequence are gapless from 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import materialise, process_cache, ship_by_value, text_or_empty, tokenizer_file

ship_by_value(__name__)

VOCAB_FILE = "byte_bpe_50k.json"
SPECIAL = "<|endoftext|>"


class ByteBPE:
    """The ids that ``tokenizers`` gives for a byte-level BPE file, computed by ``tiktoken`` (six times as fast).

    The ranks come from the same file. Special strings in a text become their
    id, as is the library's default.
    """

    #: the file's pre-tokeniser (fixed value of byte-level BPE)
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        byte_of = {c: b for b, c in enumerate(self._alphabet())}
        vocab = self.library.get_vocab(with_added_tokens=False)
        ranks = {bytes(byte_of[c] for c in piece): i for piece, i in vocab.items() if all(c in byte_of for c in piece)}
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        ranks = {p: i for p, i in ranks.items() if i not in self.special.values()}
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.allowed = set(self.special)

    @staticmethod
    def _alphabet() -> list[str]:
        """The printable character that stands for each byte: itself, or the next free one from U+0100."""
        kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        out, free = [], 0x100
        for b in range(256):
            if b in kept:
                out.append(chr(b))
            else:
                out.append(chr(free))
                free += 1
        return out

    def encode(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special=self.allowed)
        except ValueError:  # a run (of white space, say) that is too long for its pattern matcher
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)


def byte_bpe(path: str) -> ByteBPE:
    cache = process_cache("packing")
    if (key := ("byte_bpe", path)) not in cache:
        cache[key] = ByteBPE(path)
    return cache[key]


class BestFit:
    """Bounded-space best-fit over bins of ``capacity`` places."""

    def __init__(self, capacity: int, max_open: int):
        self.capacity, self.max_open = capacity, max_open
        self.mask = 0  # bit f: some open bin has f places free
        self.by_free: dict[int, list[int]] = {}
        self.items: dict[int, list] = {}  # open bin -> its items
        self.next_bin = 0

    def add(self, size: int, item) -> Iterator[tuple[int, list]]:
        """Place an item; yields (bin, items) of bins that this closes. Items are (offset, item)."""
        fits = self.mask >> size << size
        if fits:
            free = (fits & -fits).bit_length() - 1
            b = self._take(free)
        else:
            if len(self.items) >= self.max_open:
                fullest = (self.mask & -self.mask).bit_length() - 1
                old = self._take(fullest)
                yield old, self.items.pop(old)
            free, b = self.capacity, self.next_bin
            self.next_bin += 1
            self.items[b] = []
        self.items[b].append((self.capacity - free, item))
        left = free - size
        if left:
            self.by_free.setdefault(left, []).append(b)
            self.mask |= 1 << left
        else:
            yield b, self.items.pop(b)

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        b = bins.pop()
        if not bins:
            del self.by_free[free]
            self.mask &= ~(1 << free)
        return b

    def rest(self) -> Iterator[tuple[int, int, list]]:
        """(bin, used places, items) of the bins still open."""
        for free in sorted(self.by_free):
            for b in self.by_free[free]:
                yield b, self.capacity - free, self.items[b]


PIECES = ["doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset", "used"]


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=PIECES)


def _pack(path: str, end_id: int, capacity: int, max_open: int):
    def run(batches):
        tok, packer = byte_bpe(path), BestFit(capacity, max_open)
        own = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                ids = np.append(tok.encode(text), np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
                for piece, (i, j) in enumerate(zip(cuts, cuts[1:])):
                    item = (doc_id, piece, i, j - i, zlib.crc32(ids[i:j].tobytes()))
                    for closed, items in packer.add(j - i, item):
                        rows += [(*x, own + closed, offset, None) for offset, x in items]
            if len(rows) >= 20_000:
                yield _piece_batch(rows)
                rows = []
        for k, used, items in packer.rest():
            rows += [(*x, own + k, offset, used) for offset, x in items]
        if rows:
            yield _piece_batch(rows)
    return run


def _repack(capacity: int, max_open: int):
    """Pieces in falling length -> packed pieces."""
    def run(batches):
        packer = BestFit(capacity, max_open)
        own = (1 << 60) + (TaskContext.get().partitionId() << 40)
        rows: list[tuple] = []
        for b in batches:
            for item in zip(*(b.column(c).to_pylist() for c in PIECES[:5])):
                for closed, items in packer.add(item[3], item):
                    rows += [(*x, own + closed, offset, None) for offset, x in items]
            if len(rows) >= 20_000:
                yield _piece_batch(rows)
                rows = []
        for k, used, items in packer.rest():
            rows += [(*x, own + k, offset, used) for offset, x in items]
        if rows:
            yield _piece_batch(rows)
    return run


def pack(docs: DataFrame, capacity: int = 2048, end_id: int = 0, max_open: int = 512, repack_bins: int = 8192,
         vocab: str | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    ``max_open`` open bins per packer; a repacking task takes the contents of about ``repack_bins`` leftover bins.
    """
    path = vocab or tokenizer_file(VOCAB_FILE)
    schema = ", ".join(f"{c} long" for c in PIECES)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    placed = materialise(source.mapInArrow(_pack(path, end_id, capacity, max_open), schema), "packed-pieces")
    closed, left = placed.where("used is null"), placed.where("used is not null")
    tasks = max(1, round((left.agg(F.sum("length")).first()[0] or 0) / (capacity * repack_bins)))
    again = left.repartition(tasks, F.xxhash64("doc_id", "piece", "ids_crc32")) \
        .sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32").mapInArrow(_repack(capacity, 2 * repack_bins), schema)
    return closed.unionByName(again) \
        .select("doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")
