"""Near-duplicate classes with DartMinHash signatures and banded joining.

A text is the weighted set of its five-word shingles (weight: how often the
shingle occurs). DartMinHash throws hashed darts at the plane of (element,
weight) x rank: each unit cell of an element's weight region and a unit of rank
holds a Poisson(1) number of darts that depends on nothing but the cell. The
darts of a text are those inside its elements' weights; every dart falls to one
of ``k`` coordinates, and a coordinate keeps its earliest dart. Two texts agree
in a coordinate with probability equal to their weighted Jaccard similarity.
Only ranks below k (ln k + 2) / weight are looked at, so a signature costs
O(shingles + k log k); the few coordinates left empty look further.

The joining, without a pair list of any group:

1. equal texts collapse to one node (aggregation by a 128-bit text key);
2. nodes are banded (``BANDS`` x ``ROWS`` coordinates). In each band group
   every member is tested against the smallest and the largest node, by exact
   similarity of the shingle sets, and links give components;
3. large groups whose members then lie in different components get further
   star rounds (ends of two different components each time). The members of
   those still open are banded anew, whatever group they came from, with longer
   bands (``FINE_BANDS`` x ``FINE_ROWS`` coordinates of a signature of their
   own), which part texts that only share a very common passage;
4. open groups are cut into blocks of bounded members and bytes, and each pair
   of blocks is one task. Its pairs of different components whose signatures
   agree in ``AGREE`` of the coordinates are tested exactly, and each link joins
   two components at once, so a task gives fewer links than it has members.

No group is dropped or cut short. A pair of similarity 0.8 shares no band with
probability 7e-5, and agrees in fewer than ``AGREE`` coordinates with
probability 8e-5; one that meets in large open groups alone shares no long band
with probability 7e-5 more. The price: a group of m members that is still open
after steps 2 and 3 costs about 2 m / ``SMALL`` copies of each member.

Semantics: words are white-space separated, lower-cased. A text with one to
four words is one shingle. Null and wordless texts are classes of their own
document. A node is a text, so rows that share a doc_id but not a text may lie
in different classes, and rows without an id are compared like all others.
``class_id`` is the smallest doc_id of the class (null if none of its rows has
an id).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import materialise, process_cache, ship_by_value, text_key, text_or_empty, tidy
from aurum.operators.graph import connected_components

ship_by_value(__name__)

SHINGLE = 5
BANDS, ROWS = 24, 5
K = BANDS * ROWS
#: bands of the members of large open groups
FINE_BANDS, FINE_ROWS = 84, 10
#: a task compares up to about this many members and bytes of shingle sets; larger open groups get further star rounds first
SMALL, TASK_BYTES, STAR_ROUNDS = 4000, 64 << 20, 3
#: coordinates of K in which a pair agrees before it is tested exactly
AGREE = 80
RANK_UNIT = 1 << 20  # resolution of a dart's rank
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
#: P(Poisson(1) <= n)
POISSON = np.cumsum([math.exp(-1) / math.factorial(n) for n in range(16)])


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (public splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[str], memo: dict) -> np.ndarray:
    import xxhash

    get = memo.get
    if len(memo) > 400_000:
        memo.clear()
    out = []
    for w in words:
        h = get(w)
        if h is None:
            h = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
            if len(w) < 64:
                memo[w] = h
        out.append(h)
    return np.array(out, np.uint64)


def shingles(text: str, memo: dict) -> np.ndarray:
    """Sorted hashes of the shingle occurrences of a text: the n-th occurrence of a shingle is an element of its own."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(words, memo)
    if len(h) < SHINGLE:
        h = np.concatenate([h, np.arange(1, SHINGLE - len(h) + 1, dtype=np.uint64)])
    n = len(h) - SHINGLE + 1
    s = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        s = mix(s + h[k:k + n] + np.uint64(k))
    s.sort()
    same = np.concatenate([[False], s[1:] == s[:-1]])
    if same.any():
        at = np.arange(n)
        occurrence = at - np.maximum.accumulate(np.where(same, 0, at))
        s = np.sort(np.where(occurrence > 0, mix(s + occurrence.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), s))
    return s


def _throw(elements: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, sig: np.ndarray) -> None:
    """Throw the darts of ranks [low, high) cells of each element; ``sig`` [owner, k] keeps the earliest."""
    cells = high - low
    e = np.repeat(elements, cells)
    o = np.repeat(owner, cells)
    rank = np.arange(len(e)) - np.repeat(np.cumsum(cells) - cells, cells) + np.repeat(low, cells)
    h = mix(e + (rank.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03))
    n = np.searchsorted(POISSON, (h >> np.uint64(11)).astype(np.float64) * 2.0 ** -53, side="right")
    d = mix(np.repeat(h, n) + (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    o, rank = np.repeat(o, n), np.repeat(rank, n)
    # rank (32 bits) above 32 bits of the dart: the smallest value is the earliest dart and names it
    within = (d >> np.uint64(44))  # 20 bits of rank in the cell
    at = np.minimum(rank.astype(np.uint64) * np.uint64(RANK_UNIT) + within, np.uint64(0xFFFFFFFF))
    value = (at << np.uint64(32)) | (mix(d) & np.uint64(0xFFFFFFFF))
    coordinate = ((d & np.uint64(0xFFFFFFFF)) * np.uint64(k)) >> np.uint64(32)
    np.minimum.at(sig.reshape(-1), o * k + coordinate.astype(np.int64), value)


def dart_minhash(sets: list[np.ndarray], k: int = K) -> np.ndarray:
    """Signatures [set, k]; a row of an empty set is all ``NONE``."""
    sig = np.full((len(sets), k), NONE)
    sizes = np.array([len(s) for s in sets], np.int64)
    need = k * (math.log(k) + 2.0)
    todo = np.flatnonzero(sizes)
    done = np.zeros(len(sets), np.int64)
    reach = np.zeros(len(sets), np.int64)
    reach[todo] = np.ceil(need / sizes[todo]).astype(np.int64)
    while len(todo):
        # bounded portions: about four million cells at a time
        work = np.cumsum(sizes[todo] * (reach[todo] - done[todo]))
        for part in np.split(todo, np.searchsorted(work, np.arange(4_000_000, int(work[-1]), 4_000_000))):
            if len(part):
                counts = sizes[part]
                _throw(np.concatenate([sets[i] for i in part]), np.repeat(part, counts),
                       np.repeat(done[part], counts), np.repeat(reach[part], counts), k, sig)
        todo = todo[(sig[todo] == NONE).any(axis=1)]
        done[todo], reach[todo] = reach[todo], 2 * reach[todo]
    return sig


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    keys = np.zeros((len(sig), bands), np.uint64)
    for r in range(rows):
        keys = mix(keys + sig[:, r::rows][:, :bands] + np.uint64(r + 1))
    return keys


def _memo() -> dict:
    return process_cache("neardup").setdefault("word-hashes", {})


def _sign(batches):
    memo = _memo()
    for b in batches:
        for i in range(0, b.num_rows, 1000):
            part = b.slice(i, 1000)
            sets = [shingles(t, memo) for t in part.column("text").to_pylist()]
            keys = band_keys(dart_minhash(sets)).view(np.int64)
            flat = pa.array(keys.reshape(-1))
            bands = pa.ListArray.from_arrays(pa.array(np.arange(0, len(sets) * BANDS + 1, BANDS, dtype=np.int32)), flat)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("doc_id", "k1", "k2")], pa.array([len(s) for s in sets], pa.int64()), bands],
                                             names=["doc_id", "k1", "k2", "n", "bands"])


def _shingle_sets(batches):
    """Shingle sets, and signatures in 32 bits a coordinate."""
    memo = _memo()
    for b in batches:
        for i in range(0, b.num_rows, 500):
            part = b.slice(i, 500)
            sets = [shingles(t, memo) for t in part.column("text").to_pylist()]
            sig = (dart_minhash(sets) & np.uint64(0xFFFFFFFF)).astype("<u4")
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([x.tobytes() for x in sig], pa.binary())],
                                             names=["node", "s", "sig"])


def jaccard(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(x) + len(y) - common)


def _test_pairs(batches):
    for b in batches:
        sims = [jaccard(x, y) for x, y in zip(b.column("sa").to_pylist(), b.column("sb").to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(sims, pa.float64())], names=["a", "b", "sim"])


def links(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of nodes whose exact similarity reaches the threshold."""
    tested = pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b") \
        .mapInArrow(_test_pairs, "a long, b long, sim double")
    return tested.where(F.col("sim") >= threshold).select("a", "b")


def _fine_bands(batches):
    """The long bands of shingle sets: (node, n, band, key), bands numbered behind those of all nodes."""
    for b in batches:
        for i in range(0, b.num_rows, 500):
            part = b.slice(i, 500)
            sets = [np.frombuffer(s, np.uint64) for s in part.column("s").to_pylist()]
            keys = band_keys(dart_minhash(sets, FINE_BANDS * FINE_ROWS), FINE_BANDS, FINE_ROWS).view(np.int64)
            at = np.repeat(np.arange(len(sets)), FINE_BANDS)
            band = np.tile(np.arange(BANDS, BANDS + FINE_BANDS, dtype=np.int32), len(sets))
            yield pa.RecordBatch.from_arrays([part.column("node").take(pa.array(at)), part.column("n").take(pa.array(at)), pa.array(band), pa.array(keys.reshape(-1))],
                                             names=["node", "n", "band", "key"])


def _join_components(threshold: float):
    """One pair of blocks (or one block): links between its components, each of which joins two."""
    def run(group: pa.Table) -> pa.Table:
        node, n, sets = group.column("node").to_pylist(), group.column("n").to_numpy(), group.column("s").to_pylist()
        sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), "<u4").reshape(len(node), -1)
        root = np.unique(group.column("component").to_numpy(), return_inverse=True)[1]
        block = group.column("block").to_numpy()
        one = group.num_rows > 0 and group.column("lo")[0].as_py() == group.column("hi")[0].as_py()
        out = []
        for i in range(len(node) - 1):
            rest = slice(i + 1, len(node))
            # the pairs inside a block are those of its own task
            fits = (root[rest] != root[i]) & (np.minimum(n[rest], n[i]) >= np.maximum(n[rest], n[i]) * threshold - 1e-9) & (one | (block[rest] != block[i]))
            if not fits.any():
                continue
            at = i + 1 + np.flatnonzero(fits)
            for j in at[(sig[at] == sig[i]).sum(axis=1) >= AGREE]:
                if root[j] != root[i] and jaccard(sets[i], sets[j]) >= threshold:
                    out.append((min(node[i], node[j]), max(node[i], node[j])))
                    root[root == root[j]] = root[i]
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})
    return run


def _block_pairs(groups: DataFrame, keys: list[str]) -> DataFrame:
    """Members of open groups, once for each pair (lo, hi) of blocks that their block is part of."""
    half = F.when((F.col("size") <= SMALL) & (F.col("bytes") <= TASK_BYTES), 1) \
        .otherwise(F.ceil(F.greatest(F.col("size") * 2 / SMALL, F.col("bytes") * 2 / TASK_BYTES))).cast("int")
    dealt = groups.withColumn("blocks", half).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return dealt.select(*keys, "node", "n", "component", "block", other) \
        .select(*keys, F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "node", "n", "component", "block")


def _star(groups: DataFrame, keys: list[str], threshold: float, order: list | None = None) -> DataFrame:
    """Pairs of every member with the first and the last node of its group, by ``order`` (by default the node's number)."""
    end = F.struct(*(order or []), "node", "n")
    ends = groups.groupBy(*keys).agg(F.min(end).alias("lo"), F.max(end).alias("hi")) \
        .where(F.col("lo.node") != F.col("hi.node"))
    ends = materialise(ends, "neardup-ends")
    to = groups.join(ends, keys).select("node", "n", F.explode(F.array("lo", "hi")).alias("to")).where(F.col("node") != F.col("to.node"))
    return _pairs(to.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("to.node").alias("y"), F.col("to.n").alias("ny")), threshold)


def _pairs(p: DataFrame, threshold: float) -> DataFrame:
    """Distinct (a < b) whose sizes allow the similarity."""
    fits = F.least("nx", "ny") >= F.greatest("nx", "ny") * threshold - 1e-9
    return p.where(fits).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _open(groups: DataFrame, keys: list[str]) -> DataFrame:
    """Keys and sizes (members, bytes of shingle sets) of the groups that lie in more than one component."""
    return groups.groupBy(*keys).agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("size"), (F.sum("n") * 8).alias("bytes")) \
        .where(F.col("c0") != F.col("c1")).select(*keys, "size", "bytes").transform(lambda df: materialise(df, "neardup-unsettled"))


def _components(members: DataFrame, edges: DataFrame) -> DataFrame:
    found = connected_components(members.select("node"), edges.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    return materialise(found, "neardup-components")


def text_classes(docs: DataFrame, threshold: float = 0.8, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per distinct text: its key (k1, k2), smallest doc_id, number of shingles n, component and class_id."""
    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"), *[c.alias(n) for n, c in text_key(text).items()])
    signed = materialise(keyed.mapInArrow(tidy(_sign, "neardup"), "doc_id long, k1 long, k2 long, n long, bands array<long>"), "neardup-signatures")
    by_text = signed.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.max("bands").alias("bands"))
    # written once, so a text keeps its number
    nodes = materialise(by_text.withColumn("node", F.monotonically_increasing_id()), "neardup-nodes")
    banded = nodes.where("n > 0").select("node", "n", F.posexplode("bands").alias("band", "key"))
    keys = ["band", "key"]
    shared = materialise(banded.groupBy(*keys).agg(F.count("*").alias("size")).where("size > 1").drop("size"), "neardup-shared")
    groups = materialise(banded.join(shared, keys), "neardup-groups")

    # texts and group members meet by a sort-merge join at every size: the members grow with the corpus
    members = materialise(groups.select("node").distinct().join(nodes.select("node", "k1", "k2"), "node"), "neardup-members")
    text = keyed.join(members.hint("merge"), ["k1", "k2"]).select("node", "text")
    # repeated rows of one node are equal
    sets = materialise(text.mapInArrow(tidy(_shingle_sets), "node long, s binary, sig binary").groupBy("node").agg(F.first("s").alias("s"), F.first("sig").alias("sig")), "neardup-sets")
    linked = materialise(links(_star(groups, keys, threshold), sets, threshold), "neardup-links")
    component = _components(members, linked)

    def still_open(members_of: DataFrame) -> DataFrame:
        labelled = members_of.select(*keys, "node", "n").join(component, "node")
        return materialise(labelled.join(_open(labelled, keys), keys), "neardup-open")

    def starred(of: DataFrame, order: list | None = None) -> None:
        nonlocal linked, component
        linked = materialise(linked.unionByName(links(_star(of, keys, threshold, order), sets, threshold)).distinct(), "neardup-links")
        component = _components(members, linked)

    rest = still_open(groups)
    large = rest.where(F.col("size") > SMALL)
    for k in range(STAR_ROUNDS):
        if large.isEmpty():
            break
        starred(large, [F.xxhash64("component", F.lit(k)), F.xxhash64("node", F.lit(k))])
        rest = still_open(rest)
        large = rest.where(F.col("size") > SMALL)
    if not large.isEmpty():
        hot = materialise(large.select("node").distinct().join(nodes.select("node", "n"), "node"), "neardup-hot")
        fine = materialise(hot.join(sets.select("node", "s"), "node").mapInArrow(_fine_bands, "node long, n long, band int, key long"), "neardup-fine")
        shared = materialise(fine.groupBy(*keys).agg(F.count("*").alias("size")).where("size > 1").drop("size"), "neardup-shared")
        fine = materialise(fine.join(shared, keys), "neardup-groups")
        starred(fine)
        small = rest.where(F.col("size") <= SMALL)
        rest = still_open(small.select(*keys, "node", "n").unionByName(fine.select(*keys, "node", "n")))
    more = _block_pairs(rest, keys).join(sets, "node").groupBy(*keys, "lo", "hi").applyInArrow(_join_components(threshold), "a long, b long")
    more = materialise(more.distinct(), "neardup-links")
    if not more.isEmpty():
        component = _components(members, linked.unionByName(more))

    named = nodes.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = materialise(named.groupBy("component").agg(F.min("doc_id").alias("class_id")), "neardup-smallest")
    return materialise(named.join(smallest, "component").select("k1", "k2", "doc_id", "n", "component", "class_id"), "neardup-classes")


def near_duplicates(docs: DataFrame, threshold: float = 0.8, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, class_id), one row per row of ``docs``."""
    classes = text_classes(docs, threshold, text, doc_id)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), *[c.alias(n) for n, c in text_key(text).items()])
    # a wordless text is no copy of another: its document is its own class
    return rows.join(classes.select("k1", "k2", "class_id", "n"), ["k1", "k2"]) \
        .select("doc_id", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"))


def one_of_each(docs: DataFrame, threshold: float = 0.8, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` reduced to one row per class: of the text with the smallest doc_id (ids before none), its smallest row.

    Rows of a wordless text stay, one per doc_id.
    """
    classes = text_classes(docs, threshold, text, doc_id)
    first = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "k1", "k2")
    kept = classes.where("n > 0").groupBy("component").agg(F.min(first).alias("of")).select(F.col("of.k1").alias("_k1"), F.col("of.k2").alias("_k2"), F.lit(True).alias("_worded"))
    empty = classes.where("n = 0").select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.lit(False).alias("_worded"))
    chosen = materialise(kept.unionByName(empty), "neardup-kept")
    keyed = docs.withColumns({f"_{n}": c for n, c in text_key(text).items()}).join(chosen, ["_k1", "_k2"])
    row = F.struct(F.col(doc_id).isNull().alias("_nameless"), F.col(doc_id), *[F.col(c) for c in docs.columns if c != doc_id])
    own = F.when(F.col("_worded"), F.lit(None)).otherwise(F.col(doc_id))
    return keyed.groupBy("_k1", "_k2", "_worded", own.alias("_own")).agg(F.min(row).alias("_row")).select(*[F.col("_row")[c].alias(c) for c in docs.columns])
