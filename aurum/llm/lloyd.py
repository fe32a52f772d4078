"""Vector codes by Lloyd's iteration that compares only active entries.

A vector becomes integers, floor(scale * x), and is cut into equal consecutive
parts. Each part position has a codebook; a part's code is the index of its
nearest entry (squared Euclidean distance, ties to the lower index). A round
assigns all parts and then moves every entry to floor(sum / count) of its
parts.

An entry is active if its last update moved it. A row keeps the code and the
exact distance of each part. Where the entry of a part stayed fixed, all fixed
entries are where they were when the part chose, so only active entries are
compared with the stored distance; a part whose own entry moved scans the
whole codebook again. Both ways give the result of a full scan.

Rows are a narrow map per round, written as compact integers with their codes
and distances; a task adds up its parts by entry, so (parts x entries x width)
sums per task are shuffled and the codebooks, whose size is a parameter, are
all that reaches the driver. The sums by label are a two-step aggregate and a
join that can be split where one label holds many rows.

Semantics: rows whose vector is null or holds a null or non-finite component
are dropped. Rows that repeat an id are rows of their own, a null id comes
after all others. Shorter vectors and widths that the parts do not divide are
padded with zeros. With fewer rows than entries there are as many entries as
rows; an unused entry stays. Integers beyond +-2^25 are cut there, so that
distances of parts up to 1000 wide fit 63 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import materialise, ship_by_value

ship_by_value(__name__)

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
LARGEST = 1 << 25


def whole(vector: Column) -> Column:
    """True for vectors without null or non-finite components (a null vector: false)."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def padded(column: pa.Array, width: int) -> np.ndarray:
    """List column without nulls -> float64 matrix, short rows filled with zeros."""
    offsets = np.asarray(column.offsets)
    values = np.asarray(column.values, np.float64)[offsets[0]:offsets[-1]]
    lengths = np.diff(offsets)
    if len(lengths) and (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows [n, w] and [m, w]."""
    most = float(max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)))
    if 8 * most * most * max(1, x.shape[1]) < 2.0 ** 53:  # all sums are integers that a double holds
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)


def assign(x: np.ndarray, books: list[np.ndarray], moved: list[np.ndarray] | None, code: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New (code, distance) [n, parts] of rows [n, parts, w]; ``moved`` flags the active entries (None: first round)."""
    code, dist = code.copy(), dist.copy()
    for p, book in enumerate(books):
        part = x[:, p]
        again = np.ones(len(x), bool) if moved is None else moved[p][code[:, p]]
        if again.any():
            d = distances(part[again], book)
            best = d.argmin(1)
            code[again, p], dist[again, p] = best, d[np.arange(len(best)), best]
        active = np.flatnonzero(moved[p]) if moved is not None else []
        if len(active) and not again.all():
            rows = np.flatnonzero(~again)
            d = distances(part[rows], book[active])
            at = d.argmin(1)
            near, entry = d[np.arange(len(at)), at], active[at]
            wins = (near < dist[rows, p]) | ((near == dist[rows, p]) & (entry < code[rows, p]))
            code[rows[wins], p], dist[rows[wins], p] = entry[wins], near[wins]
    return code, dist


def _matrix(col: pa.Array, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype).reshape(len(col), -1)


def _rows(m: np.ndarray, dtype: str) -> pa.Array:
    flat = np.ascontiguousarray(m, dtype)
    size = flat.shape[1] * flat.itemsize
    offsets = np.arange(len(flat) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes())])


def _integers(width: int, scale: int, dtype: str):
    def run(batches):
        for b in batches:
            m = np.clip(np.floor(padded(b.column("_e"), width) * scale), -LARGEST, LARGEST)
            cols = {n: b.column(n) for n in b.schema.names if n != "_e"} | {"_v": _rows(m, dtype)}
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))
    return run


def _step(books, moved, parts: int, dtype: str):
    """Rows with ``_v`` (and the last ``_code``, ``_dist``) -> rows with the new ones."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("_v"), dtype).astype(np.int64).reshape(b.num_rows, parts, -1)
            if moved is None:
                code, dist = np.zeros((len(x), parts), np.int64), np.zeros((len(x), parts), np.int64)
            else:
                code, dist = _matrix(b.column("_code"), "<u2").astype(np.int64), _matrix(b.column("_dist"), "<i8")
            code, dist = assign(x, books, moved, code, dist)
            cols = {n: b.column(n) for n in b.schema.names if n not in ("_code", "_dist")} | {"_code": _rows(code, "<u2"), "_dist": _rows(dist, "<i8")}
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))
    return run


def _sums(shape: tuple[int, int, int], dtype: str):
    """Rows -> one (part, entry, place, sum) row per used entry and place, and (part, entry, -1, count)."""
    parts, entries, w = shape

    def run(batches):
        total, count = np.zeros(shape, np.int64), np.zeros((parts, entries), np.int64)
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column("_v"), dtype).astype(np.int64).reshape(b.num_rows, parts, w)
                code = _matrix(b.column("_code"), "<u2").astype(np.int64)
                for p in range(parts):
                    order = np.argsort(code[:, p], kind="stable")
                    used, at = np.unique(code[order, p], return_index=True)
                    total[p][used] += np.add.reduceat(x[order, p], at, axis=0)
                    count[p] += np.bincount(code[:, p], minlength=entries)
        p, e = np.nonzero(count)
        places = np.tile(np.arange(-1, w), len(p))
        values = np.concatenate([count[p, e][:, None], total[p, e]], axis=1).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(p, w + 1), pa.int32()), pa.array(np.repeat(e, w + 1), pa.int32()), pa.array(places, pa.int32()),
                                          pa.array(values, pa.int64())], names=["part", "entry", "place", "s"])
    return run


def compress(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """((vec_id, label, code binary of little-endian 16-bit indexes, error, label_error), final codebooks [entries, width])."""
    spark = df.sparkSession
    source = df.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).alias("_e")).where(whole(F.col("_e")))
    head = source.agg(F.max(F.size("_e")).alias("w"), F.max(F.array_max(F.transform("_e", lambda x: F.abs(x.cast("double"))))).alias("m")).first()
    width = max(parts, -(-(head["w"] or 0) // parts) * parts)
    dtype = "<i2" if (head["m"] or 0) * scale < 2 ** 15 - 1 else "<i4"
    fields = source.drop("_e")
    plain = fields.withColumn("_v", F.lit(b"")).schema
    state_schema = fields.withColumns({"_v": F.lit(b""), "_code": F.lit(b""), "_dist": F.lit(b"")}).schema
    state = source.mapInArrow(_integers(width, scale, dtype), plain)
    w = width // parts
    # the first rows by id (ties by vector) start the codebooks; their number is a parameter
    first = source.select("vec_id", F.transform("_e", lambda x: x.cast("double")).alias("_e")).orderBy(F.asc_nulls_last("vec_id"), "_e").limit(entries).collect()
    start = np.zeros((len(first), width))
    for k, r in enumerate(first):
        start[k, :len(r["_e"])] = r["_e"]
    start = np.clip(np.floor(start * scale), -LARGEST, LARGEST).astype(np.int64).reshape(len(first), parts, w)
    books = [start[:, p].copy() for p in range(parts)]
    if not first:
        none = fields.withColumns({"code": F.lit(b""), "error": F.lit(0).cast("long"), "label_error": F.lit(0).cast("long")})
        return none, books
    moved = None
    for _ in range(rounds):
        state = materialise(state.mapInArrow(_step(books, moved, parts, dtype), state_schema), "lloyd-state")
        summed = state.select("_v", "_code").mapInArrow(_sums((parts, len(first), w), dtype), "part int, entry int, place int, s long") \
            .groupBy("part", "entry", "place").agg(F.sum("s").alias("s")).collect()
        count = {(r["part"], r["entry"]): r["s"] for r in summed if r["place"] < 0}
        new = [b.copy() for b in books]
        for r in summed:
            if r["place"] >= 0:
                new[r["part"]][r["entry"], r["place"]] = r["s"] // count[r["part"], r["entry"]]
        moved = [(a != b).any(1) for a, b in zip(new, books)]
        books = new
    final = state.mapInArrow(_step(books, moved, parts, dtype), state_schema)

    def total(batches):
        for b in batches:
            error = _matrix(b.column("_dist"), "<i8").sum(1) if b.num_rows else []
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), b.column("_code"), pa.array(error, pa.int64())],
                                             names=["vec_id", "label", "code", "error"])

    rows = materialise(final.mapInArrow(total, fields.withColumns({"code": F.lit(b""), "error": F.lit(0).cast("long")}).schema), "lloyd-codes")
    by_label = materialise(rows.groupBy(F.col("label").alias("_l")).agg(F.sum("error").alias("label_error")), "lloyd-labels")
    return rows.join(by_label, F.col("label").eqNullSafe(F.col("_l"))).drop("_l"), books


def hex_code(code: Column) -> Column:
    """Two lowercase hex digits per index, for at most 256 entries (the low byte of each 16-bit index)."""
    return F.regexp_replace(F.lower(F.hex(code)), "(..)..", "$1")


def books_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
