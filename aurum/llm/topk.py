"""Exact top-k inner-product search over norm buckets.

Vectors become integers, floor(scale * x). They are ordered by length and cut
into buckets of similar length, a few neighbouring buckets to a group; the
queries are cut into blocks. The longest vectors give every query a first
threshold (its k-th score among them). A block meets the groups that are long enough
for the lowest of its thresholds, and no other group is sent to it. Within a
group the buckets follow in falling length, and the k best found so far raise a
query's threshold for the next one. For each query and bucket the threshold is
turned into a local cosine threshold, threshold / (query length x bucket's longest):

* over 1: the bucket holds nothing for this query and is skipped;
* high (``COORDINATE_FROM``): coordinate pruning. In the query's largest
  coordinates a candidate of that cosine must lie in a narrow interval; only
  candidates inside all intervals are verified;
* lower: length pruning. The bucket is read in falling length up to the
  length that could still reach the threshold.

What remains is verified by exact integer products, the best k by query and
group are kept, and a window merges them by query. Blocks and groups travel in
the narrowest integer type that holds them and meet by an equi-join on the
group number. No index is approximate and nothing is capped: ties at the k-th
score are resolved by the smaller id.

Semantics: vectors that are null or hold a null or non-finite component take
no part; a null id takes no part. Every row is a candidate, also of rows that
repeat an id or a vector, but a query meets no row of its own id; query rows of
one id share one list, the best of all of them. Shorter vectors are read as
padded with zeros. Scores are exact integers as long as they fit 63 bits.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aurum.llm.common import materialise, ship_by_value, shuffle_partitions

ship_by_value(__name__)

#: vectors in a bucket, queries in a block, buckets in a group
BUCKET, BLOCK, GROUP = 2048, 512, 4
#: local cosine threshold from which coordinates prune, and how many are looked at
COORDINATE_FROM, FOCUS = 0.7, 3
SLACK = 1e-9

PACKED = "ids binary, dim int, width int, matrix binary, norms binary, longest double, shelf int, place int"


def integer_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 64) -> DataFrame:
    """(vec_id, v array<long>, norm double) of every row that takes part."""
    e = F.col(embedding)
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = df.where(F.col(vec_id).isNotNull() & e.isNotNull() & ~bad)
    v = good.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(e, lambda x: F.floor(x.cast("double") * scale)).alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return v.withColumn("norm", F.sqrt(squares))


def _width(m: np.ndarray) -> int:
    """Bytes of the narrowest integer type that holds a matrix."""
    low, high = int(m.min(initial=0)), int(m.max(initial=0))
    return next(w for w in (1, 2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)


def _pack(rows: int):
    """Rows in falling length -> packed blocks of at most ``rows``; ``shelf`` is the task, ``place`` the block's place in it."""
    def run(batches):
        shelf, place = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        vecs: list[list[int]] = []
        norms: list[float] = []

        def block():
            d = max(map(len, vecs))
            m = np.zeros((len(vecs), d), np.int64)
            for k, v in enumerate(vecs):
                m[k, :len(v)] = v
            w = _width(m)
            return pa.RecordBatch.from_arrays(
                [pa.array([np.array(ids, "<i8").tobytes()], pa.binary()), pa.array([d], pa.int32()), pa.array([w], pa.int32()),
                 pa.array([m.astype(f"<i{w}").tobytes()], pa.binary()), pa.array([np.array(norms, "<f8").tobytes()], pa.binary()),
                 pa.array([float(max(norms))]), pa.array([shelf], pa.int32()), pa.array([place], pa.int32())],
                names=["ids", "dim", "width", "matrix", "norms", "longest", "shelf", "place"])

        for b in batches:
            for i, v, n in zip(*(b.column(c).to_pylist() for c in ("vec_id", "v", "norm"))):
                ids.append(i)
                vecs.append(v)
                norms.append(n)
                if len(ids) == rows:
                    yield block()
                    ids, vecs, norms, place = [], [], [], place + 1
        if ids:
            yield block()
    return run


class Block:
    """Ids, integer matrix and norms."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, norms: np.ndarray):
        self.ids, self.m, self.norms = ids, m, norms

    @classmethod
    def unpacked(cls, ids: bytes, dim: int, width: int, matrix: bytes, norms: bytes) -> Block:
        i = np.frombuffer(ids, "<i8")
        return cls(i, np.frombuffer(matrix, f"<i{width}").reshape(len(i), dim).astype(np.int64), np.frombuffer(norms, "<f8"))

    def part(self, begin: int, end: int) -> Block:
        return Block(self.ids[begin:end], self.m[begin:end], self.norms[begin:end])

    def products(self, other: Block, rows: np.ndarray | slice, cols: np.ndarray | slice) -> np.ndarray:
        """Exact inner products of own rows with the other's."""
        d = min(self.m.shape[1], other.m.shape[1])
        a, b = self.m[rows, :d], other.m[cols, :d]
        bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, d)
        if bound < 2.0 ** 53:  # every partial sum is an integer that a double holds
            return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
        return a @ b.T


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: by score, then smaller id."""
    if len(ids) > 4 * k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= kth)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def search_bucket(q: Block, thresholds: np.ndarray, p: Block, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(row of the query, candidates, scores): each query's best k of a bucket at or over its threshold."""
    out: list[tuple[int, np.ndarray, np.ndarray]] = []
    longest = float(p.norms.max())
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(thresholds > 0, thresholds / (q.norms * longest), -np.inf)  # NaN never: a positive threshold has positive lengths
        needed = np.where(thresholds > 0, thresholds / q.norms, -np.inf)
    local = np.nan_to_num(local, nan=np.inf, posinf=np.inf, neginf=-np.inf)
    by_length = np.flatnonzero(local < COORDINATE_FROM)
    by_coordinate = np.flatnonzero((local >= COORDINATE_FROM) & (local <= 1.0 + SLACK))

    def keep(row: int, ids: np.ndarray, scores: np.ndarray) -> None:
        fit = (scores >= thresholds[row]) & (ids != q.ids[row])
        if not fit.all():
            ids, scores = ids[fit], scores[fit]
        if len(ids):
            x = best(ids, scores, k)
            out.append((int(row), ids[x], scores[x]))

    if len(by_length):
        # norms fall, so the vectors that are long enough are a prefix
        reach = np.searchsorted(-p.norms, -needed[by_length] * (1.0 - SLACK), side="right")
        most = int(reach.max(initial=0))
        if most:
            products = q.products(p, by_length, slice(0, most))
            for r, row in enumerate(by_length):
                if reach[r]:
                    keep(row, p.ids[:reach[r]], products[r, :reach[r]])
    if len(by_coordinate):
        with np.errstate(divide="ignore", invalid="ignore"):
            unit = np.nan_to_num(p.m / p.norms[:, None])
        for row in by_coordinate:
            c = min(1.0, float(local[row]))
            d = min(q.m.shape[1], p.m.shape[1])
            direction = q.m[row] / q.norms[row]
            focus = np.argsort(-np.abs(direction[:d]))[:FOCUS]
            inside = np.ones(len(p.ids), bool)
            for f in focus:
                x = float(direction[f])
                if f >= d:
                    continue
                # a unit vector at cosine c or more lies in this interval of the coordinate
                spread = math.sqrt(max(0.0, 1.0 - c * c)) * math.sqrt(max(0.0, 1.0 - x * x))
                low = -1.0 if x < -c else c * x - spread
                high = 1.0 if x > c else c * x + spread
                inside &= (unit[:, f] >= low - 1e-9) & (unit[:, f] <= high + 1e-9)
            at = np.flatnonzero(inside)
            if len(at):
                keep(row, p.ids[at], q.products(p, slice(row, row + 1), at)[0])
    return out


def search_group(q: Block, thresholds: np.ndarray, p: Block, k: int, bucket: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, candidates, scores): each query's best k of a group, whose buckets raise its threshold one after another."""
    limits = thresholds.copy()
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for begin in range(0, len(p.ids), bucket):
        for row, ids, scores in search_bucket(q, limits, p.part(begin, begin + bucket), k):
            if row in held:
                ids, scores = np.concatenate([held[row][0], ids]), np.concatenate([held[row][1], scores])
                x = best(ids, scores, k)
                ids, scores = ids[x], scores[x]
            held[row] = ids, scores
            if len(ids) == k:
                limits[row] = max(limits[row], float(np.nextafter(float(scores[-1]), -np.inf)) if abs(scores[-1]) >= 2 ** 53 else float(scores[-1]))
    return [(np.full(len(ids), q.ids[row]), ids, scores) for row, (ids, scores) in held.items()]


def _joined(blocks: list[Block]) -> Block:
    """Blocks behind each other, padded with zeros to one width."""
    d = max(x.m.shape[1] for x in blocks)
    wide = [np.pad(x.m, ((0, 0), (0, d - x.m.shape[1]))) for x in blocks]
    return Block(np.concatenate([x.ids for x in blocks]), np.concatenate(wide), np.concatenate([x.norms for x in blocks]))


def _first_thresholds(shared, k: int):
    """Query blocks -> with each query's k-th score among the longest vectors (none: -inf) and the length that the block needs."""
    def run(batches):
        p = _joined([Block.unpacked(*x) for x in shared.value])
        for b in batches:
            found, needed = [], []
            for row in zip(*(b.column(c).to_pylist() for c in ("ids", "dim", "width", "matrix", "norms"))):
                q = Block.unpacked(*row)
                products = q.products(p, slice(None), slice(None))
                limits = np.full(len(q.ids), -np.inf)
                for r in range(len(q.ids)):
                    scores = products[r][p.ids != q.ids[r]]
                    if len(scores) >= k:
                        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                        limits[r] = float(kth) if abs(kth) < 2 ** 53 else np.nextafter(float(kth), -np.inf)
                with np.errstate(divide="ignore", invalid="ignore"):
                    least = np.where(limits > 0, limits / q.norms, -np.inf)
                found.append(limits.astype("<f8").tobytes())
                needed.append(float(least.min()))
            names = list(b.schema.names)
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(found, pa.binary()), pa.array(needed, pa.float64())],
                                             names=[*names, "limits", "needed"])
    return run


def _verify(k: int, bucket: int):
    def run(batches):
        last, p = None, None
        for b in batches:
            for r in range(b.num_rows):
                get = lambda *names: [b.column(c)[r].as_py() for c in names]  # noqa: B023, E731
                raw = get("ids", "dim", "width", "matrix", "norms")
                if raw != last:  # the rows of a group follow each other
                    last, p = raw, Block.unpacked(*raw)
                q = Block.unpacked(*get("q_ids", "q_dim", "q_width", "q_matrix", "q_norms"))
                out = search_group(q, np.frombuffer(get("limits")[0], "<f8"), p, k, bucket)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)], names=["query_id", "vec_id", "score"])
    return run


def _numbered(shelves: list) -> tuple[Column, Column]:
    """The number of a group (0 has the longest vectors), and how many groups hold a vector of the length that a block needs."""
    sizes = np.zeros(shelves[-1]["shelf"] + 1, np.int64)
    for s in shelves:
        sizes[s["shelf"]] = s["groups"]
    ends = np.cumsum(sizes)
    number = F.element_at(F.lit(ends - sizes), F.col("shelf") + 1) + F.col("place")
    # shelves are ranges of falling length, so those that are long enough come first
    long_enough = F.size(F.filter(F.lit(np.array([s["longest"] for s in shelves])), lambda x: x >= F.col("needed") * (1.0 - SLACK)))
    return number, F.element_at(F.lit(np.concatenate([[0], ends[[s["shelf"] for s in shelves]]])), long_enough + 1)


def meetings(vectors: DataFrame, is_query: Column, k: int) -> DataFrame | None:
    """Every query block beside every group that can hold a vector for it (None: there are no vectors)."""
    spark = vectors.sparkSession
    # the row number breaks ties of the range partitioning, so that rows that repeat an id are dealt out too
    vectors = materialise(vectors.withColumn("row", F.monotonically_increasing_id()), "topk-vectors")
    tasks = shuffle_partitions(spark)
    order = [F.desc("norm"), F.col("vec_id"), F.col("row")]
    ordered = vectors.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    groups = materialise(ordered.mapInArrow(_pack(BUCKET * GROUP), PACKED), "topk-groups")
    # a few numbers for each shelf come to the driver, as many shelves as there are shuffle partitions
    shelves = groups.groupBy("shelf").agg(F.count("*").alias("groups"), F.max("longest").alias("longest"), F.sum(F.length("ids") / 8).alias("rows")) \
        .orderBy("shelf").collect()
    if not shelves:
        return None
    # the first thresholds come from about one group of the longest vectors, though shelves may be small: less than two groups
    reached = np.cumsum([min(s["rows"], BUCKET * GROUP) for s in shelves])
    last = shelves[min(int(np.searchsorted(reached, BUCKET * GROUP)), len(shelves) - 1)]["shelf"]
    top = groups.where((F.col("shelf") <= last) & (F.col("place") == 0)).orderBy("shelf").collect()
    shared = spark.sparkContext.broadcast([(bytes(t["ids"]), t["dim"], t["width"], bytes(t["matrix"]), bytes(t["norms"])) for t in top])
    asked = vectors.where(is_query).repartition(tasks, "row").sortWithinPartitions(*order) \
        .mapInArrow(_pack(BLOCK), PACKED).mapInArrow(_first_thresholds(shared, k), PACKED + ", limits binary, needed double")
    number, reach = _numbered(shelves)
    met = asked.withColumn("reach", reach).where("reach > 0").withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("reach") - 1)))
    blocks = met.select("group", *[F.col(c).alias("q_" + c) for c in ("ids", "dim", "width", "matrix", "norms")], "limits")
    return blocks.join(groups.select(number.alias("group"), "ids", "dim", "width", "matrix", "norms"), "group")


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of :func:`integer_vectors` that ``is_query`` holds for."""
    met = meetings(vectors, is_query, k)
    if met is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = met.mapInArrow(_verify(k, BUCKET), "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
