"""Substring dedup with repeated-phrase automata.

A passage recurs if it holds a window of ``size`` consecutive words that also
starts somewhere else, in any document or the same. All words of such windows
are removed.

1. Confirm. Tasks hash all windows of their documents, block by block. Every
   window names an anchor, the smallest hash of its 16-word grams, so equal
   windows name equal anchors and runs of neighbouring windows share one: a run
   is one shuffled row (anchor, text key, place, window hashes). Windows that
   recur inside a block are settled there, and one copy of them travels, so a
   group of copies that holds a third of the corpus is a row per block and
   anchor. One shuffle by anchor confirms the rest; windows under an anchor that
   a sample shows to be very common travel each by its own key.
2. Compile. Confirmed windows go to shards, a shard being the documents of one
   range of text keys of bounded size. Of documents of a block and shard that hold
   the same run of confirmed windows it is enough that one names it. A run
   becomes the phrases that cover it: its first and last window and every
   ``size``-th between. The shard's phrases are compiled into an Aho-Corasick
   automaton.
3. Stream. All documents of the shard run through its automaton, which locates
   every occurrence word for word; covered words go.

Documents travel once, to their shard. Automata, blocks and shards are bounded;
no document meets the phrases of another shard. Of texts that repeat in a task
one goes to the shard of its key; its copies lose all their words (each of
their windows recurs), so they travel without text, dealt over all shards, as
do texts too short for a window.

Semantics: a word is a run of characters other than space and U+0009-U+000D.
Windows are judged on the input. Repeated rows are each other's copies. Null
and empty texts have no words; texts of fewer than ``size`` words lose none.
Windows are compared by 64 + 56 bits of hash, texts by 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import process_cache, ship_by_value, shuffle_partitions, text_or_empty

ship_by_value(__name__)

WINDOW = 35
GRAM = 16
BLOCK_WORDS = 1_500_000
#: characters of text in a shard; windows in a shuffled row
SHARD_CHARS, ROW_WINDOWS = 6_000_000, 4096
RUN = ["anchor", "seen", "key", "pos", "n", "windows"]
RUN_SCHEMA = "anchor long, seen int, key long, pos int, n int, windows binary"


def words(text: str) -> list[bytes]:
    """Words between the ASCII white space U+0009-U+000D and the space."""
    return text.encode("utf-8", "surrogatepass").split()


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (public splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(ws: list[bytes]) -> list[int]:
    import xxhash

    memo = process_cache("substring").setdefault("substring-words", {})
    if len(memo) > 400_000:
        memo.clear()
    get, out = memo.get, []
    for w in ws:
        h = get(w)
        if h is None:
            h = xxhash.xxh64_intdigest(w)
            if len(w) < 64:
                memo[w] = h
        out.append(h)
    return out


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the concatenation of two hashed stretches."""
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + b)


def gram_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, from runs of powers of two."""
    out, at, power, span = None, 0, mix(h), 1
    while span <= size:
        if size & span:
            n = len(h) - size + 1
            part = power[at:at + n]
            out = part.copy() if out is None else _joined(out[:n], part)
            at += span
        if 2 * span <= size:
            power = _joined(power[:-span], power[span:])
        span *= 2
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (width - span)], x[width - span:]) if width > span else x


def _runs(breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs that begin where ``breaks`` is set, cut at ROW_WINDOWS."""
    start = np.flatnonzero(breaks)
    length = np.diff(np.append(start, len(breaks)))
    if len(length) and int(length.max()) > ROW_WINDOWS:
        parts = -(-length // ROW_WINDOWS)
        k = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        start, length = np.repeat(start, parts) + k * ROW_WINDOWS, np.minimum(ROW_WINDOWS, np.repeat(length, parts) - k * ROW_WINDOWS)
    return start, length


def _windows(hashes: list[list[int]], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All windows of documents (each of at least ``size`` words): document, place, window hash, anchor."""
    h = np.array([x for doc in hashes for x in doc], np.uint64)
    lengths = np.array([len(doc) for doc in hashes], np.int64)
    begin = np.cumsum(lengths) - lengths
    n_win = lengths - size + 1
    doc = np.repeat(np.arange(len(hashes)), n_win)
    pos = np.arange(len(doc)) - np.repeat(np.cumsum(n_win) - n_win, n_win)
    at = begin[doc] + pos
    gram = min(GRAM, size)
    return doc, pos, gram_hashes(h, size)[at], sliding_min(gram_hashes(h, gram), size - gram + 1)[at]


def _block(hashes: list[list[int]], keys: list[int], size: int, shards: int, hot: np.ndarray):
    """The rows of one block of documents."""
    doc, pos, window, anchor = _windows(hashes, size)
    # windows that recur in the block, and the first of each
    order = np.argsort(window, kind="stable")
    ordered = window[order]
    again = np.concatenate([[False], ordered[1:] == ordered[:-1]])
    dup, first = np.zeros(len(window), bool), np.ones(len(window), bool)
    dup[order] = again | np.append(again[1:], False)
    first[order] = ~again
    key = np.array(keys, np.int64)

    # settled here: of equal runs of such windows, one document in every shard names the run
    settled = np.flatnonzero(dup)
    if len(settled):
        start, length = _runs(np.concatenate([[True], (np.diff(settled) != 1) | (doc[settled[1:]] != doc[settled[:-1]])]))
        inside = (np.arange(len(settled)) - np.repeat(start, length)).astype(np.uint64)
        run = np.add.reduceat(mix(window[settled] + inside * np.uint64(0x9E3779B97F4A7C15)), start)
        at = settled[start]
        shard = np.mod(key[doc[at]], shards)
        by = np.lexsort((at, length, run, shard))
        new = np.concatenate([[True], (np.diff(shard[by]) != 0) | (run[by][1:] != run[by][:-1]) | (np.diff(length[by]) != 0)])
        pick = np.sort(by[new])
        own = key[doc[at[pick]]]
        yield _rows(own, np.zeros(len(pick), np.int32), own, pos[at[pick]], length[pick], None, None)
    # to be confirmed: each window of the block once
    sent = np.flatnonzero(first)
    a, d, u = anchor[sent], doc[sent], dup[sent]
    alone = np.isin(a, hot)
    a = np.where(alone, mix(a ^ window[sent]), a)
    start, length = _runs(np.concatenate([[True], (np.diff(sent) != 1) | (d[1:] != d[:-1]) | (a[1:] != a[:-1]) | (u[1:] != u[:-1]) | alone[1:]]))
    raw = window[sent].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()  # 56 bits
    offsets = np.append(start, len(sent)) * 7
    for i in range(0, len(start), 100_000):
        j = min(len(start), i + 100_000)
        yield _rows(a[start[i:j]].view(np.int64), np.where(u[start[i:j]], 2, 1).astype(np.int32), key[d[start[i:j]]], pos[sent[start[i:j]]], length[i:j], offsets[i:j + 1], raw)


def _rows(anchor, seen, key, pos, n, offsets, raw) -> pa.RecordBatch:
    if offsets is None:
        windows = pa.nulls(len(anchor), pa.binary())
    else:
        windows = pa.Array.from_buffers(pa.binary(), len(anchor), [None, pa.py_buffer((offsets - offsets[0]).astype(np.int32).tobytes()), pa.py_buffer(raw[offsets[0]:offsets[-1]])])
    return pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(seen), pa.array(key), pa.array(pos.astype(np.int32)), pa.array(n.astype(np.int32)), windows], names=RUN)


def _hash_windows(size: int, shards: int, hot: np.ndarray):
    def run(batches):
        hashes: list[list[int]] = []
        keys: list[int] = []
        total = 0
        for b in batches:
            for key, text in zip(b.column("key").to_pylist(), b.column("text").to_pylist()):
                ws = words(text)
                if len(ws) >= size:
                    hashes.append(word_hashes(ws))
                    keys.append(key)
                    total += len(ws)
                    if total >= BLOCK_WORDS:
                        yield from _block(hashes, keys, size, shards, hot)
                        hashes, keys, total = [], [], 0
        if keys:
            yield from _block(hashes, keys, size, shards, hot)
    return run


def _sampled_anchors(size: int):
    """Anchors of sampled documents, each once a document."""
    def run(batches):
        for b in batches:
            hashes = [word_hashes(ws) for ws in map(words, b.column("text").to_pylist()) if len(ws) >= size]
            if hashes:
                doc, _, _, anchor = _windows(hashes, size)
                order = np.lexsort((anchor, doc))
                a, d = anchor[order], doc[order]
                own = a[np.concatenate([[True], (a[1:] != a[:-1]) | (d[1:] != d[:-1])])]
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64))], names=["anchor"])
    return run


def hot_anchors(texts: DataFrame, size: int, sample_rows: int = 10_000, share: float = 0.002) -> np.ndarray:
    """Anchors that more than ``share`` of the texts name, found in a sample of about ``sample_rows``.

    Their windows travel each by its own key, so that a passage that stands in
    very many different surroundings is no hot group. The sample decides only
    how rows travel, never what is removed; the list is bounded by the anchors
    of a text over ``share``.
    """
    n = texts.count()
    part = min(1.0, sample_rows / max(1, n))
    picked = texts.where(F.pmod(F.xxhash64(F.lit(2), "key"), F.lit(1 << 20)) < part * (1 << 20))
    least = max(20, int(share * part * n))
    rows = picked.mapInArrow(_sampled_anchors(size), "anchor long").groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") >= least).collect()
    return np.array(sorted(r["anchor"] for r in rows), np.int64).view(np.uint64)


def _confirm(batches):
    """Runs in order of anchor -> runs of confirmed windows (key, pos, n, shared). Holds the rows of about one batch, or one anchor."""
    def settle(t: pa.Table):
        anchor = t.column("anchor").to_numpy()
        seen = t.column("seen").to_numpy()
        key, pos, n = (t.column(c).to_numpy() for c in ("key", "pos", "n"))
        done = seen == 0
        if done.any():
            yield _found(key[done], pos[done], n[done], True)
        group = np.cumsum(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        # only anchors with more than one row can confirm anything
        rows = np.flatnonzero(~done & (np.bincount(group[~done], minlength=int(group[-1]) + 1)[group] > 1))
        if not len(rows):
            return
        column = t.column("windows").combine_chunks()
        picked = column.take(pa.array(rows))
        count = n[rows].astype(np.int64)
        raw = np.frombuffer(b"".join(picked.to_pylist()), np.uint8).reshape(-1, 7)
        w = np.zeros((len(raw), 8), np.uint8)
        w[:, :7] = raw
        w = w.view("<u8").reshape(-1)
        owner = np.repeat(np.arange(len(rows)), count)
        g, weight = group[rows][owner], seen[rows][owner]
        order = np.lexsort((w, g))
        ids = np.cumsum(np.concatenate([[0], (w[order][1:] != w[order][:-1]) | (g[order][1:] != g[order][:-1])]))
        enough = np.bincount(ids, weights=weight[order]) >= 2
        hit = np.zeros(len(w), bool)
        hit[order] = enough[ids]
        hit &= weight == 1  # the others were settled in their block
        at = np.flatnonzero(hit)
        if len(at):
            start, length = _runs(np.concatenate([[True], (np.diff(at) != 1) | (owner[at[1:]] != owner[at[:-1]])]))
            r = owner[at[start]]
            inside = at[start] - (np.cumsum(count) - count)[r]
            yield _found(key[rows[r]], pos[rows[r]] + inside, length, False)

    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        last = b.column("anchor")[b.num_rows - 1].as_py()
        cut = int(np.searchsorted(b.column("anchor").to_numpy(), last, side="left"))
        if cut:  # rows of the last anchor may go on in the next batch
            yield from settle(pa.Table.from_batches([*held, b.slice(0, cut)]))
            held = []
        elif held and held[0].column("anchor")[0].as_py() != last:
            yield from settle(pa.Table.from_batches(held))
            held = []
        held.append(b.slice(cut))
    if held:
        yield from settle(pa.Table.from_batches(held))


def _found(key, pos, n, shared: bool) -> pa.RecordBatch:
    """``shared``: the run also stands for other documents, so its ends are phrases even where it touches another run."""
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(pos.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array([shared] * len(key))],
                                      names=["key", "pos", "n", "shared"])


def cover(runs: list[tuple[int, int]], size: int) -> list[int]:
    """Places of the windows whose union is that of the runs (first window, windows): each merged run's first, last and every size-th."""
    out: list[int] = []
    runs = sorted(runs)
    k = 0
    while k < len(runs):
        a, b = runs[k][0], runs[k][0] + runs[k][1]
        while k + 1 < len(runs) and runs[k + 1][0] <= b:
            k += 1
            b = max(b, runs[k][0] + runs[k][1])
        out += [*range(a, b - 1, size), b - 1]
        k += 1
    return out


def locate(texts: list[list[bytes]], phrases: set[bytes]) -> list[list[tuple[int, int]]]:
    """Word ranges of every text that the phrases cover, by one automaton."""
    import ahocorasick

    if not phrases:
        return [[] for _ in texts]
    automaton = ahocorasick.Automaton()
    for p in phrases:
        s = f" {p.decode('latin-1')} "  # one character a byte; spaces hold phrases to whole words
        automaton.add_word(s, len(s))
    automaton.make_automaton()
    out = []
    for ws in texts:
        spans: list[tuple[int, int]] = []
        line = f" {b' '.join(ws).decode('latin-1')} "
        for end, length in automaton.iter(line):
            begin = end - length + 1
            if spans and begin <= spans[-1][1]:
                spans[-1] = (min(begin, spans[-1][0]), end)
            else:
                spans.append((begin, end))
        if spans:
            merged: list[tuple[int, int]] = []
            for a, b in spans:  # ends rise, so a longer phrase may reach back over earlier spans
                while merged and a <= merged[-1][1]:
                    a = min(a, merged.pop()[0])
                merged.append((a, b))
            starts = np.cumsum([1, *[len(w) + 1 for w in ws]])
            spans = [(int(np.searchsorted(starts, a + 1)), int(np.searchsorted(starts, b + 1))) for a, b in merged]
        out.append(spans)
    return out


#: keys of texts that a task remembers
SEEN = 2_000_000


def _spread(size: int, shards: int, names: list[str]):
    """Rows -> rows with their shard; ``_text`` is null, and ``_n`` the number of words, where all words go."""
    def run(batches):
        seen: set[int] = set()
        turn = TaskContext.get().partitionId()
        for b in batches:
            shard, texts, counts = [], [], []
            for key, text in zip(b.column("_key").to_pylist(), b.column("_text").to_pylist()):
                n = len(words(text))
                again = n >= size and key in seen
                if n < size or again:
                    turn += 1
                    shard.append(turn % shards)
                else:
                    shard.append(key % shards)
                    if len(seen) < SEEN:
                        seen.add(key)
                texts.append(None if again else text)
                counts.append(n)
            cols = {n: b.column(n) for n in names if n != "_text"} | {"_text": pa.array(texts, pa.string()), "_n": pa.array(counts, pa.int64()), "_shard": pa.array(shard, pa.int64())}
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))
    return run


def _dedup_shard(size: int, schema: pa.Schema):
    def run(docs: pa.Table, runs: pa.Table) -> pa.Table:
        keys = docs.column("_key").to_pylist()
        counts = docs.column("_n").to_pylist()
        texts = [words(t or "") for t in docs.column("_text").to_pylist()]
        at = {key: k for k, key in enumerate(keys) if texts[k]}
        own: dict[int, list[tuple[int, int]]] = {}
        places: dict[int, set[int]] = {}
        for key, pos, n, shared in zip(*(runs.column(c).to_pylist() for c in ("key", "pos", "n", "shared"))):
            if shared:
                places.setdefault(key, set()).update(cover([(pos, n)], size))
            else:
                own.setdefault(key, []).append((pos, n))
        for key, found in own.items():
            places.setdefault(key, set()).update(cover(found, size))
        phrases = {b" ".join(texts[at[key]][p:p + size]) for key, found in places.items() for p in found}
        spans = locate(texts, phrases)
        kept, removed = [], []
        for ws, cut in zip(texts, spans):
            out, last = [], 0
            for a, b in cut:
                out += ws[last:a]
                last = b
            out += ws[last:]
            removed.append(counts[len(removed)] - len(out))
            kept.append(b" ".join(out).decode("utf-8", "surrogatepass"))
        cols = {n: docs.column(n) for n in docs.schema.names if n in schema.names}
        cols |= {"n_words": docs.column("_n"), "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.string())}
        return pa.table([cols[n] for n in schema.names], schema=schema)
    return run


def remove_repeats(docs: DataFrame, size: int = WINDOW, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_words``, ``n_removed`` and ``kept`` (the kept words joined by a space)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    tasks = shuffle_partitions(spark)
    full = text_or_empty(text)
    chars = docs.agg(F.sum(F.octet_length(full))).first()[0] or 0
    shards = max(tasks, -(-chars // SHARD_CHARS))
    source = docs.drop("n_words", "n_removed", "kept").withColumns({"_key": F.xxhash64(full), "_text": full}).drop(text)
    texts = source.where(F.col("_text") != "").select(F.col("_key").alias("key"), F.col("_text").alias("text"))
    hot = hot_anchors(texts, size)
    hashed = texts.mapInArrow(_hash_windows(size, shards, hot), RUN_SCHEMA)
    confirmed = hashed.repartition(tasks, "anchor").sortWithinPartitions("anchor").mapInArrow(_confirm, "key long, pos int, n int, shared boolean")
    out = source.drop("_key", "_text").withColumns({"n_words": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "kept": F.lit("")}).schema
    ordered = [c for c in source.columns if c != "_text"]
    spread = source.withColumns({"_n": F.lit(0).cast("long"), "_shard": F.lit(0).cast("long")}).select(*ordered, F.expr("nullif(_text, '')").alias("_text"), "_n", "_shard").schema
    return source.mapInArrow(_spread(size, shards, source.columns), spread).groupBy("_shard") \
        .cogroup(confirmed.withColumn("_shard", F.pmod("key", F.lit(shards))).groupBy("_shard")) \
        .applyInArrow(_dedup_shard(size, to_arrow_schema(out)), out)
