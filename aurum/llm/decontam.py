"""Benchmark decontamination with an FM-index per shard of the training documents.

Test phrases are windows of ``size`` consecutive words of an item (a shorter
item is one window). Each task indexes its own documents, shard by shard:
words become symbols of the benchmark's vocabulary, and runs of known words
too short to hold any window are left out, as no phrase can lie there. A shard
has a suffix array, its Burrows-Wheeler transform in a wavelet tree (one bit
vector with prefix sums per level, pointerless layout) and every
``SAMPLE``-th suffix position. All phrases are searched backward at once by
wavelet-tree ranks; occurrences are located by walking to a sampled position;
removal spans are merged by document.

The documents never shuffle. The phrases are sent to the tasks in parts of at
most ``part_chars`` characters of benchmark text, one narrow pass a part, so
what is sent at once does not grow with the benchmark.

Semantics: A-Z are lower-cased; a word is a run of ASCII letters, digits and
non-ASCII characters. Null texts have no words; items without words have no
windows; repeated items count once by id. The passages of an item without an
id are hit like all others, but there is no id to list. Ids keep their type. Rows of documents are
judged one by one, so repeated rows give repeated results.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from aurum.llm.common import materialise, ship_by_value, text_or_empty, tidy

ship_by_value(__name__)

WINDOW = 10
#: symbols of a shard, distance of sampled suffix positions
SHARD, SAMPLE = 1 << 18, 8
# fixed value of the contract: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z, as a byte table
FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
#: the same words in a text as it is
WORD_TEXT = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split()


def phrases_of(items: list[tuple], size: int) -> SimpleNamespace:
    """The distinct windows of a part of the benchmark: vocabulary, symbols (right-aligned), lengths and items of each."""
    vocab: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set[int]] = {}
    for item, text in items:
        ids = [vocab.setdefault(w, len(vocab) + 1) for w in words(text)]
        for i in range(max(1, len(ids) - size + 1) if ids else 0):
            found.setdefault(tuple(ids[i:i + size]), set()).update(() if item is None else (item,))
    symbols = np.zeros((len(found), size), np.int64)
    for k, w in enumerate(found):
        symbols[k, size - len(w):] = w
    length = np.array([len(w) for w in found], np.int64)
    return SimpleNamespace(vocab=vocab, items=[sorted(x) for x in found.values()], length=length, symbols=symbols,
                           least=int(length.min()) if found else 0)


class WaveletTree:
    """Ranks of symbols in a sequence, by one bit vector per bit of the alphabet."""

    def __init__(self, seq: np.ndarray, largest: int):
        self.levels = []
        for shift in range(max(1, int(largest).bit_length()) - 1, -1, -1):
            bits = (seq >> shift) & 1
            ones = np.concatenate([[0], np.cumsum(bits)])
            self.levels.append((shift, ones, len(seq) - int(ones[-1])))
            seq = np.concatenate([seq[bits == 0], seq[bits == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each end."""
        begin = np.zeros_like(end)
        for shift, ones, zeros in self.levels:
            bit = ((symbol >> shift) & 1).astype(bool)
            b1, e1 = ones[begin], ones[end]
            begin = np.where(bit, zeros + b1, begin - b1)
            end = np.where(bit, zeros + e1, end - e1)
        return end - begin

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for _, ones, zeros in self.levels:
            bit = ones[at + 1] - ones[at]
            symbol = symbol << 1 | bit
            at = np.where(bit == 1, zeros + ones[at], at - ones[at])
        return symbol


class FMIndex:
    """Index of a sequence of symbols; 0 separates runs, and no phrase holds it."""

    def __init__(self, seq: np.ndarray):
        n = len(seq)
        self.sa = suffix_array(seq)
        bwt = seq[self.sa - 1]
        largest = int(seq.max())
        self.tree = WaveletTree(bwt, largest)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=largest + 1))])
        self.largest = largest
        # sampled: every SAMPLE-th position, and the first of every run, so that no walk crosses a separator
        at = self.sa
        keep = (at % SAMPLE == 0) | (bwt == 0)
        self.rank_kept = np.concatenate([[0], np.cumsum(keep)])
        self.kept = at[keep]
        self.n = n
        del self.sa

    def search(self, phrases: SimpleNamespace) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all phrases: their ranges of rows."""
        lo = np.zeros(len(phrases.length), np.int64)
        hi = np.full(len(phrases.length), self.n, np.int64)
        size = phrases.symbols.shape[1]
        for k in range(size - 1, -1, -1):
            live = np.flatnonzero((hi > lo) & (phrases.length > size - 1 - k))
            if not len(live):
                break
            c = phrases.symbols[live, k]
            known = c <= self.largest
            hi[live[~known]] = lo[live[~known]]
            live, c = live[known], c[known]
            lo[live], hi[live] = self.first[c] + self.tree.rank(c, lo[live]), self.first[c] + self.tree.rank(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position of each row: walk backward to a sampled one."""
        out, row, todo, steps = np.empty_like(rows), rows.copy(), np.arange(len(rows)), 0
        while len(todo):
            kept = self.rank_kept[row + 1] > self.rank_kept[row]
            out[todo[kept]] = self.kept[self.rank_kept[row[kept]]] + steps
            todo, row = todo[~kept], row[~kept]
            c = self.tree.access(row)
            row = self.first[c] + self.tree.rank(c, row)
            steps += 1
        return out


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Prefix doubling; the separators (0) sort first, each apart by its position."""
    n = len(seq)
    sep = seq == 0
    start = seq + int(sep.sum())
    start[sep] = np.arange(int(sep.sum()))
    rank = np.unique(start, return_inverse=True)[1].astype(np.int64)
    k = 1
    while True:
        key = rank * (n + 1)
        key[:n - k] += rank[k:] + 1
        sa = np.argsort(key, kind="stable")
        ordered = key[sa]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[sa] = new
        if new[-1] == n - 1 or k >= n:
            return sa
        k *= 2


def runs_of_known(ids: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal runs of non-zero symbols of at least ``least``."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (ids != 0).astype(np.int8), [0]])))
    begin, end = edge[::2], edge[1::2]
    long = end - begin >= least
    return list(zip(begin[long].tolist(), end[long].tolist()))


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


class _Shard:
    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.starts: list[int] = []  # of each run in the shard's sequence
        self.where: list[tuple[int, int]] = []  # document and its word at that start
        self.n = 0

    def add(self, doc: int, at: int, ids: np.ndarray) -> None:
        self.starts.append(self.n)
        self.where.append((doc, at))
        self.parts += [ids, np.zeros(1, np.int64)]
        self.n += len(ids) + 1

    def hits(self, phrases: SimpleNamespace, spans: dict[int, list], items: dict[int, set]) -> None:
        """Adds the removal spans and items found in this shard, by document."""
        if not self.n:
            return
        index = FMIndex(np.concatenate(self.parts))
        lo, hi = index.search(phrases)
        found = np.flatnonzero(hi > lo)
        if not len(found):
            return
        counts = (hi - lo)[found]
        rows = np.repeat(lo[found] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(int(counts.sum()))
        at, which = index.locate(rows), np.repeat(found, counts)
        run = np.searchsorted(np.array(self.starts), at, side="right") - 1
        for pos, k, r in zip(at.tolist(), which.tolist(), run.tolist()):
            doc, word = self.where[r]
            begin = word + pos - self.starts[r]
            spans.setdefault(doc, []).append((begin, begin + int(phrases.length[k])))
            items.setdefault(doc, set()).update(phrases.items[k])


SPANS = "array<struct<start:int,end:int>>"
SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _pass(shared, item_type: pa.DataType):
    """One narrow pass: spans and items of one part of the benchmark, added to those already there."""
    def run(batches):
        phrases = shared.value
        get = phrases.vocab.get
        for b in batches:
            texts = b.column("_text").to_pylist()
            n_words, spans, items, shard = [], {}, {}, _Shard()
            for k, text in enumerate(texts):
                ws = words(text)
                n_words.append(len(ws))
                if phrases.least and len(ws) >= phrases.least:
                    ids = np.fromiter((get(w, 0) for w in ws), np.int64, len(ws))
                    for i, j in runs_of_known(ids, phrases.least):
                        shard.add(k, i, ids[i:j])
                if shard.n >= SHARD:
                    shard.hits(phrases, spans, items)
                    shard = _Shard()
            shard.hits(phrases, spans, items)
            for k, (old, had) in enumerate(zip(b.column("spans").to_pylist(), b.column("items").to_pylist())):
                if old or had:
                    spans[k] = [*spans.get(k, []), *((s["start"], s["end"]) for s in old)]
                    items[k] = items.get(k, set()) | set(had)
            merged = [merge(spans[k]) if k in spans else [] for k in range(len(texts))]
            cols = {n: b.column(n) for n in b.schema.names if n not in ("n_words", "spans", "items")}
            cols["n_words"] = pa.array(n_words, pa.int64())
            cols["spans"] = pa.array([[{"start": s, "end": e} for s, e in m] for m in merged], SPAN_TYPE)
            cols["items"] = pa.array([sorted(items.get(k, ())) for k in range(len(texts))], pa.list_(item_type))
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))
    return run


def find(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, part_chars: int = 4_000_000, text: str = "text",
         item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (merged word ranges hit) and ``items`` (ids of items with occurring windows).

    Input columns of these names are replaced.
    """
    sc = docs.sparkSession.sparkContext
    bench = benchmark.select(F.col(item_id).alias("item"), F.col(item_text).alias("t")).where("t is not null")
    id_type = bench.schema["item"].dataType
    chars = bench.agg(F.sum(F.length("t")).alias("n")).first()["n"] or 0
    parts = max(1, -(-chars // part_chars))
    out = docs.drop("n_words", "spans", "items").withColumns(
        {"_text": text_or_empty(text), "n_words": F.lit(0).cast("long"), "spans": F.array().cast(SPANS), "items": F.array().cast(T.ArrayType(id_type))})
    for part in range(parts):
        own = bench.where(F.pmod(F.xxhash64("item", "t"), F.lit(parts)) == part).select("item", "t").toLocalIterator()
        shared = sc.broadcast(phrases_of([(r["item"], r["t"]) for r in own], size))
        # one part at a time: a task never holds the phrases of several
        out = (materialise(out, "decontam-part") if part else out).mapInArrow(tidy(_pass(shared, to_arrow_type(id_type))), out.select(*[c for c in out.columns if c not in ("n_words", "spans", "items")], "n_words", "spans", "items").schema)
    return out.drop("_text")


def n_hit() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + (s["end"] - s["start"]).cast("long"))


def without_words(text: Column, spans: Column) -> Column:
    """``text`` without the characters from the first to the last word of each span (sorted, disjoint)."""
    ends = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"].cast("int")))
    kept = F.arrays_zip(ends.alias("a"), F.transform(spans, lambda s: s["start"].cast("int")).alias("b"))

    def joined(t: Column) -> Column:
        def part(x: Column) -> Column:
            # gaps and words up to the next span (or all the rest), then the gap in front of it
            n = F.coalesce(x["b"], F.size(t["words"]))
            both = F.zip_with(F.slice(t["gaps"], x["a"] + 1, n - x["a"]), F.slice(t["words"], x["a"] + 1, n - x["a"]), lambda gap, word: F.concat(gap, word))
            return F.concat(both, F.slice(t["gaps"], n + 1, 1))
        return F.array_join(F.flatten(F.transform(kept, part)), "")

    # an array of one: the text is split once, not once for each span
    once = F.array(F.struct(F.split(text, WORD_TEXT, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(WORD_TEXT), F.lit(0)).alias("words")))
    return F.transform(once, joined)[0]


def remove_hits(found: DataFrame, text: str = "text") -> DataFrame:
    """The result of :func:`find` with the hit words cut out of ``text`` (its own columns dropped)."""
    # expressions: a Python function behind the search would hold a second worker for each task
    hit = F.size("spans") > 0
    return found.withColumn(text, F.when(hit, without_words(F.col(text), F.col("spans"))).otherwise(F.col(text))).drop("n_words", "spans", "items")
