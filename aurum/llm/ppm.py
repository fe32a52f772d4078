"""Language-model scores by prediction by partial matching over bytes.

The message of a text is its lower-cased (A-Z) words joined by one space and
closed by an end byte (U+000A, which no word holds). Every byte is predicted
from the ``order`` bytes before it by a trie of byte contexts counted over all
training texts (pretrained, then fixed). In a context seen t times with u
different next bytes, a byte seen c times has (2c - 1) / 2t and the escape to
the next shorter context u / 2t (escape method D). Bytes of the contexts that
were escaped from are excluded from the counts of the shorter ones. Under the
empty context the bytes never seen share what is left evenly. Texts follow an
end byte repeated ``order`` times, so all contexts are full.

The trie is never in one place and no document meets all of it:

1. Texts are cut into pieces at white space and packed into blocks of a few MB,
   a block being one row. Pieces carry the bytes before them as context.
2. A block emits its distinct (context, byte) windows with their training
   counts, and its distinct words, packed by shard: a shard holds all windows of
   some two-byte contexts, hence whole subtrees. One shuffle by shard adds the
   counts up in a stream; a row per shard is kept. Contexts shorter than two
   bytes are a table of at most 256 x 256 counts, which every task gets.
3. The windows meet their shard's subtrees in a second shuffle (the shard's row
   first, then a stream of blocks), which answers each with a logarithm.
4. Answers and blocks meet by block; sums per piece are added by document.

So tasks hold a block or a shard's subtrees, whatever the size of a text or the
number of its copies, and what is shuffled are distinct windows per block.

Semantics: a null text is empty; an empty message is the end byte alone. Rows
are documents of their own, repeated or null ids included. Without training
texts each byte has probability 1 / 256. Words are told apart by 64 bits of
hash, windows exactly; logarithms travel as 32-bit floats.
"""

from __future__ import annotations

import math
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from aurum.llm.common import materialise, ship_by_value, shuffle_partitions

ship_by_value(__name__)

#: bytes of context (a window must fit 64 bits, so at most 7)
ORDER = 5
#: bytes in a block, in a piece of a text, and positions looked at together
BLOCK, PIECE, CHUNK = 8_000_000, 1_000_000, 1 << 16
#: shards of windows and of words
SHARDS, WORD_SHARDS = 512, 128
#: entries of a shard that wait until they are added up
PENDING = 2_000_000
SYMBOLS = 256
END = b"\n"
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
SPACE = re.compile(rb"[\x20\x09-\x0d]")

U64 = np.uint64


# ------------------------------------------------------------------ packing of numbers

def pack(x: np.ndarray) -> bytes:
    """Integers or floats as planes of bytes: neighbours that are alike then compress well."""
    x = np.ascontiguousarray(x)
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def unpack(raw: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).reshape(-1).view(dtype)


# ------------------------------------------------------------------ texts, pieces, blocks

def slices(text: bytes):
    """Stretches of about PIECE bytes that end at white space."""
    at = 0
    while at < len(text):
        end = SPACE.search(text, at + PIECE) if at + PIECE < len(text) else None
        stop = end.start() if end else len(text)
        yield text[at:stop]
        at = stop


def pieces(text: bytes | None, order: int):
    """(context, message) of the pieces of a text; the last message closes with END."""
    context, begun = END * order, False
    for part in slices((text or b"").translate(LOWER)):
        words = part.split()
        if words:
            message = (b" " if begun else b"") + b" ".join(words)
            if begun or len(part) >= PIECE:
                yield context, message
                context, begun = (context + message)[-order:] if order else b"", True
            else:
                yield context, message + END
                return
    yield context, END


def _blocks(order: int, schema: pa.Schema, extra: list[str]):
    """Documents -> a row per block: its pieces' bytes, places and rows' own columns."""
    import zstandard

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        payload, lengths, keys, train, rest, size = [], [], [], [], [[] for _ in extra], 0
        base, turn = uuid.uuid4().int >> 66, 0  # a row's key: random start and a counter

        def block():
            cols = {"block": [uuid.uuid4().int >> 65], "payload": [squeeze.compress(b"".join(payload))], "lengths": [np.array(lengths, "<i4").tobytes()],
                    "train": [np.array(train, "u1").tobytes()], "keys": [keys]} | {f"x_{n}": [v] for n, v in zip(extra, rest)}
            return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in schema], schema=schema)

        for b in batches:
            for text, learn, *own in zip(b.column("_t"), b.column("_train").to_pylist(), *(b.column(n).to_pylist() for n in extra)):
                turn += 1
                for context, message in pieces(text.as_py(), order):
                    payload += [context, message]
                    lengths.append(len(context) + len(message))
                    keys.append(base + turn)
                    train.append(bool(learn))
                    for held, v in zip(rest, own):
                        held.append(v)
                    size += lengths[-1]
                    if size >= BLOCK:
                        yield block()
                        payload, lengths, keys, train, rest, size = [], [], [], [], [[] for _ in extra], 0
        if lengths:
            yield block()
    return run


class Block:
    """The windows and words of a block, each distinct one once, in an order that rests on the block alone."""

    def __init__(self, payload: bytes, lengths: bytes, train: bytes, order: int):
        import xxhash
        import zstandard

        raw = zstandard.ZstdDecompressor().decompress(payload)
        self.order, self.raw = order, np.frombuffer(raw, np.uint8)
        self.lengths = np.frombuffer(lengths, "<i4").astype(np.int64)
        self.ends = np.cumsum(self.lengths)
        self.train = np.frombuffer(train, "u1").astype(bool)
        index: dict[bytes, int] = {}
        ids, self.tokens, at = [], np.zeros(len(self.lengths), np.int64), 0
        for k, end in enumerate(self.ends.tolist()):
            message = raw[at + order:end]
            found = [index.setdefault(w, len(index)) for w in message.split()]
            if message.endswith(END):
                found.append(index.setdefault(END, len(index)))
            self.tokens[k] = len(found)
            ids.append(np.array(found, np.int32))
            at = end
        self.word_ids = np.concatenate(ids)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in index), U64, len(index))
        n = np.bincount(self.word_ids[np.repeat(self.train, self.tokens)], minlength=len(index))
        order_by = np.argsort(hashes % U64(WORD_SHARDS), kind="stable")
        self.words, self.word_n, self.word_rank = hashes[order_by], n[order_by], np.argsort(order_by)
        self.word_cuts = np.searchsorted(self.words % U64(WORD_SHARDS), np.arange(WORD_SHARDS + 1, dtype=U64))

    def codes(self, a: int, b: int) -> np.ndarray:
        """Windows of the places a..b of the bytes (a window ends with its byte)."""
        out = np.zeros(b - a, U64)
        for i in range(self.order, -1, -1):
            out = (out << U64(8)) | self.raw[a - i:b - i]
        return out

    def places(self):
        """(piece, from, to) stretches of at most CHUNK places that hold bytes of messages."""
        for k, (end, n) in enumerate(zip(self.ends.tolist(), self.lengths.tolist())):
            for a in range(end - n + self.order, end, CHUNK):
                yield k, a, min(end, a + CHUNK)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(distinct windows, their training counts), ascending."""
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for learn in (True, False):
            held, size, total = [], 0, None
            for k, a, b in self.places():
                if self.train[k] == learn:
                    held.append(self.codes(a, b))
                    size += b - a
                    if size >= 2_000_000:
                        total, held, size = _merge(total, held), [], 0
            total = _merge(total, held)
            parts.append((total[0], total[1] if learn else np.zeros(len(total[0]), np.int64)))
        return add_up([p[0] for p in parts], [p[1] for p in parts])


def _merge(total, held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.concatenate([np.zeros(0, U64), *held])
    codes, n = np.unique(codes, return_counts=True)
    return (codes, n) if total is None else add_up([total[0], codes], [total[1], n])


def add_up(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct codes ascending, sum of their counts)."""
    c, n = np.concatenate(codes), np.concatenate(counts).astype(np.int64)
    order = np.argsort(c, kind="stable")
    c = c[order]
    start = np.flatnonzero(np.append(True, c[1:] != c[:-1])) if len(c) else np.zeros(0, np.int64)
    return c[start], np.add.reduceat(n[order], start) if len(c) else n


def shard_of(codes: np.ndarray) -> np.ndarray:
    """Shard of windows: by the two bytes before the last, spread by a multiplication (public constant of Fibonacci hashing)."""
    two = (codes >> U64(8)) & U64(0xFFFF)
    return ((two * U64(0x9E3779B97F4A7C15)) >> U64(48)) % U64(SHARDS)


def _by_shard(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the windows by shard, cut points of the shards)."""
    shard = shard_of(codes).astype(np.uint16)
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(SHARDS + 1))


REQUEST = "shard int, block long, codes binary, counts binary"


def _requests(order: int, counted: bool):
    """Blocks -> their distinct windows (shards from 0) and words (shards from SHARDS), with training counts or without."""
    def run(batches):
        for b in batches:
            for number, payload, lengths, train in zip(*(b.column(c) for c in ("block", "payload", "lengths", "train"))):
                block = Block(payload.as_py(), lengths.as_py(), train.as_py(), order)
                codes, n = block.windows()
                at, cuts = _by_shard(codes)
                codes, n = codes[at], n[at]
                rows: tuple[list, list, list] = ([], [], [])
                for first, x, m, c in ((0, codes, n, cuts), (SHARDS, block.words, block.word_n, block.word_cuts)):
                    for s, (i, j) in enumerate(zip(c[:-1].tolist(), c[1:].tolist())):
                        own, k = x[i:j], m[i:j]
                        if counted:
                            own, k = own[k > 0], k[k > 0]
                        if len(own):
                            rows[0].append(first + s)
                            rows[1].append(pack(own))
                            rows[2].append(pack(k.astype("<u4")) if counted else None)
                yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array([number.as_py()] * len(rows[0]), pa.int64()),
                                                  pa.array(rows[1], pa.binary()), pa.array(rows[2], pa.binary())], names=["shard", "block", "codes", "counts"])
    return run


def _add_shards(batches):
    """Requests sorted by shard -> one (shard, codes, counts) row per shard."""
    now, codes, counts, waiting = None, [], [], 0

    def row():
        c, n = add_up(codes, counts)
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([pack(c)], pa.binary()), pa.array([pack(n)], pa.binary()),
                                           pa.array([int(n.sum())], pa.int64()), pa.array([len(n)], pa.int64())], names=["shard", "codes", "counts", "total", "kinds"])

    for b in batches:
        for shard, c, n in zip(*(b.column(x) for x in ("shard", "codes", "counts"))):
            if shard.as_py() != now:
                if codes:
                    yield row()
                now, codes, counts, waiting = shard.as_py(), [], [], 0
            codes.append(unpack(c.as_py(), "<u8"))
            counts.append(unpack(n.as_py(), "<u4"))
            waiting += len(codes[-1])
            if waiting > PENDING and len(codes) > 1:
                c2, n2 = add_up(codes, counts)
                codes, counts, waiting = [c2], [n2], 0
    if codes:
        yield row()


def _pairs(batches):
    """Shard rows -> counts of (byte before, byte)."""
    total = np.zeros(1 << 16, np.int64)
    for b in batches:
        for c, n in zip(b.column("codes"), b.column("counts")):
            pair = (unpack(c.as_py(), "<u8") & U64(0xFFFF)).astype(np.int64)
            total += np.bincount(pair, weights=unpack(n.as_py(), "<i8").astype(np.float64), minlength=1 << 16).astype(np.int64)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["pair", "n"])


# ------------------------------------------------------------------ the trie

class Level:
    """Contexts of one length: edges (context, byte) with counts, and per context its total and number of bytes.

    ``shorter`` is the level of contexts one byte shorter: its counts without
    the bytes seen here give what an escape from here finds there.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray, shorter: Level | None):
        self.codes, self.counts = codes, counts
        context = codes >> U64(8)
        start = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(codes) else np.zeros(0, np.int64)
        self.contexts = context[start]
        self.total = np.add.reduceat(counts, start) if len(codes) else counts
        self.kinds = np.diff(np.append(start, len(codes)))
        if shorter is not None and len(codes):
            length = int(shorter.length)
            inner = np.searchsorted(shorter.codes, codes & U64((1 << 8 * (length + 1)) - 1))
            own = np.searchsorted(shorter.contexts, self.contexts & U64((1 << 8 * length) - 1))
            self.rest_total = shorter.total[own] - np.add.reduceat(shorter.counts[inner], start)
            self.rest_kinds = shorter.kinds[own] - self.kinds
        else:
            self.rest_total = self.rest_kinds = np.zeros(len(self.contexts), np.int64)
        self.length = 0 if shorter is None else shorter.length + 1


def levels(codes: np.ndarray, counts: np.ndarray, order: int, low: list[Level]) -> list[Level]:
    """Levels 0..order of a shard's windows; ``low`` holds those of less than two bytes, counted over all shards."""
    out = list(low[:order + 1])
    for k in range(len(out), order + 1):
        c, n = add_up([codes & U64((1 << 8 * (k + 1)) - 1)], [counts])
        out.append(Level(c, n, out[-1]))
    return out


def low_levels(pairs: np.ndarray, counts: np.ndarray) -> list[Level]:
    c, n = add_up([pairs.astype(U64) & U64(0xFF)], [counts])
    zero = Level(c, n, None)
    return [zero, Level(pairs.astype(U64), counts.astype(np.int64), zero)]


def _find(table: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, found) of values in an ascending table."""
    if not len(table):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return at, table[at] == x


def log_probability(codes: np.ndarray, trie: list[Level]) -> np.ndarray:
    """Natural logarithm of P(last byte | bytes before) for windows."""
    out = np.zeros(len(codes))
    rows = np.arange(len(codes))  # windows whose byte is still to be found
    above = np.full(len(codes), -1)  # place of the longer context that was escaped from (-1: none)
    for k in range(len(trie) - 1, -1, -1):
        level = trie[k]
        code = codes[rows] & U64((1 << 8 * (k + 1)) - 1)
        context, known = _find(level.contexts, code >> U64(8))
        edge, seen = _find(level.codes, code)
        seen &= known
        total, kinds = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        fresh = known & (above < 0)
        total[fresh], kinds[fresh] = level.total[context[fresh]], level.kinds[context[fresh]]
        after = above >= 0
        if after.any():
            longer = trie[k + 1]
            total[after], kinds[after] = longer.rest_total[above[after]], longer.rest_kinds[above[after]]
        live = total > 0  # nothing is left once all of a context's bytes are excluded: the escape is certain
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.log(np.where(seen, 2 * level.counts[edge] - 1 if len(level.counts) else 1, kinds)) - np.log(2.0 * total)
        out[rows[live]] += gain[live]
        above = np.where(known, context, -1)
        rows, above = rows[~seen], above[~seen]
        if not len(rows):
            return out
    left = SYMBOLS - (len(trie[0].codes) if trie else 0)
    out[rows] -= math.log(left)
    return out


def _answer(order: int, low):
    """Shard rows (first) and requests, sorted by shard -> (block, shard, answers)."""
    def run(batches):
        now, trie, words, short = None, None, None, low_levels(*low.value)
        for b in batches:
            out: tuple[list, list, list] = ([], [], [])
            for shard, block, raw, n in zip(*(b.column(x) for x in ("shard", "block", "codes", "counts"))):
                shard = shard.as_py()
                if shard != now:
                    now, words = shard, (np.zeros(0, U64), np.zeros(0, np.int64))
                    trie = levels(*words, order, short)
                codes = unpack(raw.as_py(), "<u8")
                if n.is_valid:  # the shard's own row comes before its requests
                    words = codes, unpack(n.as_py(), "<i8")
                    trie = levels(*words, order, short) if shard < SHARDS else None
                    continue
                if shard < SHARDS:
                    answer = pack(log_probability(codes, trie).astype("<f4"))
                else:
                    at, found = _find(words[0], codes)
                    answer = pack(np.where(found, words[1][at] if len(words[1]) else 0, 0).astype("<i8"))
                out[0].append(block.as_py())
                out[1].append(shard)
                out[2].append(answer)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary())], names=["block", "shard", "answers"])
    return run


def _finish(order: int, tokens: int, kinds: int, schema: pa.Schema, extra: list[str]):
    """Answers and their block (last), sorted by block -> a row per piece."""
    floor = tokens + 0.5 * (kinds + 1)

    def run(batches):
        answers: dict[int, bytes] = {}
        for b in batches:
            for row in range(b.num_rows):
                shard = b.column("shard")[row].as_py()
                if shard is not None:
                    answers[shard] = b.column("answers")[row].as_py()
                    continue
                block = Block(*(b.column(c)[row].as_py() for c in ("payload", "lengths", "train")), order)
                codes, _ = block.windows()
                at, cuts = _by_shard(codes)
                log_p = np.zeros(len(codes))
                log_p[at] = np.concatenate([unpack(answers[s], "<f4") for s in range(SHARDS) if cuts[s] < cuts[s + 1]])
                count = np.concatenate([unpack(answers[SHARDS + s], "<i8") for s in range(WORD_SHARDS) if block.word_cuts[s] < block.word_cuts[s + 1]])
                answers = {}
                score = np.zeros(len(block.lengths))
                for k, i, j in _together(block):
                    # windows of a chunk ascending, with their place in the low bits, so that the table is read in order
                    x = np.concatenate([block.codes(a, z) for a, z in zip(i, j)])
                    owner = np.repeat(k, np.array(j) - np.array(i))
                    order_by = np.argsort(x)
                    got = log_p[np.searchsorted(codes, x[order_by])]
                    score += np.bincount(owner[order_by], weights=got, minlength=len(score))
                c = count[block.word_rank][block.word_ids]
                piece = np.repeat(np.arange(len(block.lengths)), block.tokens)
                base = np.bincount(piece, weights=np.log10((c + 0.5) / floor), minlength=len(score))
                known = np.bincount(piece, weights=c > 0, minlength=len(score)).astype(np.int64)
                cols = {"key": b.column("keys")[row].as_py(), "n_tokens": block.tokens, "n_known": known, "base_score": base, "score": score / math.log(10)}
                cols |= {f"x_{n}": b.column(f"x_{n}")[row].as_py() for n in extra}
                yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in schema], schema=schema)
    return run


def _together(block: Block):
    """(pieces, starts, ends) of about CHUNK places."""
    k, i, j, size = [], [], [], 0
    for piece, a, b in block.places():
        k.append(piece)
        i.append(a)
        j.append(b)
        size += b - a
        if size >= CHUNK:
            yield k, i, j
            k, i, j, size = [], [], [], 0
    if k:
        yield k, i, j


def score(docs: DataFrame, train: Column, text: str = "text", order: int = ORDER) -> DataFrame:
    """``docs`` without its text, with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Documents for which ``train`` holds are learnt from; all are scored.
    """
    spark = docs.sparkSession
    tasks = shuffle_partitions(spark)
    made = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    source = docs.withColumns({"_train": F.coalesce(train, F.lit(False)), "_t": F.col(text).cast("binary")}).drop(text, *made)
    extra = [c for c in source.columns if c not in ("_train", "_t")]
    own = [source.schema[n] for n in extra]
    block_schema = T.StructType.fromDDL("block long, payload binary, lengths binary, train binary, keys array<long>")
    for f in own:
        block_schema = block_schema.add(f"x_{f.name}", T.ArrayType(f.dataType))
    blocks = materialise(source.mapInArrow(_blocks(order, to_arrow_schema(block_schema), extra), block_schema), "ppm-blocks")
    core = blocks.select("block", "payload", "lengths", "train")
    by_shard = core.mapInArrow(_requests(order, True), REQUEST).repartition(tasks, "shard").sortWithinPartitions("shard")
    shards = materialise(by_shard.mapInArrow(_add_shards, "shard int, codes binary, counts binary, total long, kinds long"), "ppm-shards")
    pairs = shards.where(F.col("shard") < SHARDS).select("codes", "counts").mapInArrow(_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).orderBy("pair").collect()
    low = spark.sparkContext.broadcast((np.array([r["pair"] for r in pairs], np.int64), np.array([r["n"] for r in pairs], np.int64)))  # at most 256 x 256 counts
    words = shards.where(F.col("shard") >= SHARDS).agg(F.sum("total").alias("n"), F.sum("kinds").alias("v")).first()
    tokens, kinds = words["n"] or 0, words["v"] or 0
    asked = shards.select("shard", F.lit(-1).cast("long").alias("block"), "codes", "counts").unionByName(core.mapInArrow(_requests(order, False), REQUEST))
    answers = asked.repartition(tasks, "shard").sortWithinPartitions("shard", F.col("counts").isNull()).mapInArrow(_answer(order, low), "block long, shard int, answers binary")
    out_schema = T.StructType.fromDDL("key long, n_tokens long, n_known long, base_score double, score double")
    for f in own:
        out_schema = out_schema.add(f"x_{f.name}", f.dataType)
    both = blocks.unionByName(answers, allowMissingColumns=True).repartition(tasks, "block").sortWithinPartitions("block", F.col("shard").isNull())
    per_piece = both.mapInArrow(_finish(order, tokens, kinds, to_arrow_schema(out_schema), extra), out_schema)
    by_document = per_piece.groupBy("key").agg(*[F.first(F.col(f"x_{n}")).alias(f"x_{n}") for n in extra], *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return by_document.select(*[F.col(f"x_{n}").alias(n) for n in extra], "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")


def held_out(doc_id: str = "doc_id") -> Column:
    """The fixed fold: crc32 of the id's text, remainder 1 by 5 (a null id is never held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 1, F.lit(False))
