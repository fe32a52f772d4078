"""Token counts without materialising token ids.

SentencePiece's merges never cross the start of a run of spaces (no piece of
the vocabulary has a space after another character) nor a character that is
in no longer piece, so a text's token count is the sum over its pre-tokens: a
run of spaces with the word behind it, cut at line feeds. The plan:

1. a narrow map turns documents into blocks of postings, one row per distinct
   pre-token of a block: (pre-token, block, documents, frequencies). A word
   that is in every document is one row per block, not one per document;
2. one shuffle brings a pre-token's rows together in order. There the library
   counts it once, and a merge join puts the count to its postings (the
   vocabulary side never travels by itself);
3. the products are summed by document within each task and block (one row
   per block and task), then by block;
4. sums join the documents by a 128-bit key of their text.

A pre-token in very many documents of a block is dealt over ``SALTS`` tasks
by block, so that the commonest words do not make one task long.

Semantics: null text counts as empty (0 bytes, 0 tokens). Counts are those of
the library without begin, end or added special tokens; special strings in a
text are ordinary text. Rows that repeat a doc_id with another text are
counted apart. ``over_limit`` is ``n_tokens > limit``.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import materialise, process_cache, ship_by_value, shuffle_partitions, text_key, text_or_empty, tokenizer_file

ship_by_value(__name__)

VOCAB_FILE = "piece_bpe_32k.model"
SPACE = "▁"  # how the library writes a space
PRE_TOKEN = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n+[^{SPACE}\n]*")
#: a block of documents is closed at this many characters or postings
BLOCK_CHARS, BLOCK_POSTINGS = 24_000_000, 2_000_000
#: a pre-token in so many documents of a block is dealt over SALTS tasks
HOT, SALTS = 256, 16
HEAD = "#"
#: the lowest bit of ``block`` tells that its postings are pairs of 16 bits, not 32
COLUMNS = ["token", "block", "postings"]


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a text as the library normalises it (a space goes before it)."""
    return PRE_TOKEN.findall(SPACE + text.replace(" ", SPACE)) if text else []


def count_pieces(tokens: list[str], path: str) -> list[int]:
    """Pieces of each pre-token, by the library."""
    cache = process_cache("token_counts")
    if (key := ("sentencepiece", path)) not in cache:
        import sentencepiece

        cache[key] = sentencepiece.SentencePieceProcessor(model_file=path)
    # the library puts one space before its input: a pre-token that starts with
    # spaces gives up one of them, one that starts with a line feed (which no
    # piece joins) loses the count of that space
    ids = cache[key].encode([t[1:] if t[0] == SPACE else t for t in tokens], num_threads=1)
    return [len(x) - (t[0] != SPACE) if len(t) > 1 or t[0] != SPACE else 1 for t, x in zip(tokens, ids)]


def _binary(offsets: np.ndarray, raw: bytes) -> pa.Array:
    """Binary array of slices of ``raw``; offsets count from the slice's own start."""
    base = offsets[0]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [
        None, pa.py_buffer((offsets - base).astype(np.int32).tobytes()), pa.py_buffer(raw[base:offsets[-1]])])


def _blocks(batches):
    """Postings of blocks of documents: pre-token, block's documents, frequencies (packed little-endian)."""
    at: dict[str, int] = {}
    tok: list[np.ndarray] = []
    freq: list[np.ndarray] = []
    keys: list[tuple[int, int]] = []
    chars = postings = 0
    block = TaskContext.get().partitionId() << 32  # the same again if the task is run again

    def close():
        if not at:
            return
        t, f = np.concatenate(tok), np.concatenate(freq)
        d = np.repeat(np.arange(len(tok)), [len(x) for x in tok])
        order = np.argsort(t, kind="stable")
        uses = np.bincount(t, minlength=len(at))
        small = len(keys) <= 1 << 16 and int(f.max()) < 1 << 16
        width = 4 if small else 8
        raw = np.stack([d[order], f[order]], axis=1).astype("<u2" if small else "<u4").tobytes()
        offsets = np.concatenate([[0], np.cumsum(uses) * width])
        ids = np.array(keys, "<i8")
        names = list(at)
        for i in range(0, len(names), 50_000):
            j = min(len(names), i + 50_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[i:j], pa.string()), pa.array(np.full(j - i, 2 * block + small)), _binary(offsets[i:j + 1], raw)], names=COLUMNS)
        # the block's document keys travel once, under a name that no pre-token has
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{HEAD}{block}"]), pa.array([2 * block + small]), pa.array([ids.tobytes()], pa.binary())], names=COLUMNS)

    for b in batches:
        for k1, k2, text in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "text"))):
            counts = Counter(pre_tokens(text))
            if not counts:
                continue
            ids = [k if (k := at.get(w)) is not None else at.setdefault(w, len(at)) for w in counts]
            tok.append(np.array(ids, np.int64))
            freq.append(np.fromiter(counts.values(), np.int64, len(ids)))
            keys.append((k1, k2))
            chars += len(text)
            postings += len(ids)
            if chars >= BLOCK_CHARS or postings >= BLOCK_POSTINGS:
                yield from close()
                at, tok, freq, keys, chars, postings, block = {}, [], [], [], 0, 0, block + 1
    yield from close()


def _merge(path: str):
    """Rows in order of pre-token -> each counted once, then partial sums by block (flushed at a bound)."""
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        held, last, last_n = 0, None, 0

        def flush():
            for block, s in sums.items():
                d = np.flatnonzero(s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), pa.array([d.astype("<u4").tobytes()], pa.binary()),
                     pa.array([s[d].astype("<u8").tobytes()], pa.binary())], names=["block", "docs", "sums"])

        for b in batches:
            tokens = b.column("token").to_pylist()
            fresh = [t for t, before in zip(tokens, [last, *tokens]) if t != before and t[0] != HEAD]
            counts = iter(count_pieces(fresh, path))
            for t, block, post in zip(tokens, *(b.column(c).to_pylist() for c in ("block", "postings"))):
                if t[0] == HEAD:
                    last = t
                    yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([post], pa.binary()), pa.array([None], pa.binary())],
                                                     names=["block", "docs", "sums"])
                    continue
                if t != last:
                    last, last_n = t, next(counts)
                p = np.frombuffer(post, "<u2" if block & 1 else "<u4").reshape(-1, 2)
                s = sums.get(block)
                top = int(p[-1, 0]) + 1
                if s is None or len(s) < top:
                    grown = np.zeros(max(top, 1024, 0 if s is None else 2 * len(s)), np.int64)
                    if s is not None:
                        grown[:len(s)] = s
                    held += len(grown) - (0 if s is None else len(s))
                    sums[block] = s = grown
                if len(p) == 1:
                    s[top - 1] += int(p[0, 1]) * last_n
                else:
                    s[p[:, 0]] += p[:, 1].astype(np.int64) * last_n
            if held > 8_000_000:
                yield from flush()
                sums, held = {}, 0
        yield from flush()
    return run


def _by_document(pdf):
    """A block's partial sums and its document keys -> (k1, k2, n_tokens)."""
    import pandas as pd

    parts = pdf["sums"].notna()
    keys = np.frombuffer(pdf["docs"][~parts].iloc[0], "<i8").reshape(-1, 2)
    total = np.zeros(len(keys), np.int64)
    for d, s in zip(pdf["docs"][parts], pdf["sums"][parts]):
        total[np.frombuffer(d, "<u4")] += np.frombuffer(s, "<u8").astype(np.int64)
    return pd.DataFrame({"k1": keys[:, 0], "k2": keys[:, 1], "n_tokens": total})


def token_counts(docs: DataFrame, text: str = "text", limit: int = 4096, vocab: str | None = None) -> DataFrame:
    """``docs`` without its text column, with ``n_bytes``, ``n_tokens`` and ``over_limit``."""
    path = vocab or tokenizer_file(VOCAB_FILE)
    partitions = shuffle_partitions(docs.sparkSession)
    full = text_or_empty(text)
    keyed = docs.select(full.alias("text"), *[c.alias(n) for n, c in text_key(text).items()]).where(F.col("text") != "")
    posts = keyed.mapInArrow(_blocks, "token string, block long, postings binary")
    salt = F.when(F.length("postings") >= 4 * HOT, F.pmod(F.col("block") + F.shiftright("block", 33), F.lit(SALTS))).otherwise(0)
    partial = posts.repartition(partitions, "token", salt).sortWithinPartitions("token") \
        .mapInArrow(_merge(path), "block long, docs binary, sums binary")
    counted = partial.groupBy("block").applyInPandas(_by_document, "k1 long, k2 long, n_tokens long") \
        .groupBy("k1", "k2").agg(F.max("n_tokens").alias("_n"))
    counted = materialise(counted, "token-counts")
    rest = docs.drop("n_bytes", "n_tokens", "over_limit")
    sized = rest.withColumns({"_" + n: c for n, c in text_key(text).items()} | {"n_bytes": F.octet_length(full).cast("long")}).drop(text)
    out = sized.join(counted.withColumnsRenamed({"k1": "_k1", "k2": "_k2"}), ["_k1", "_k2"], "left").drop("_k1", "_k2")
    out = out.withColumn("n_tokens", F.coalesce("_n", F.lit(0)).cast("long")).drop("_n")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
