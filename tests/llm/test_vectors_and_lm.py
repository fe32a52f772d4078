"""Vector codes, whitening and language-model scores against brute force."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from aurum.llm import lloyd, ppm, queries, whitening
from tests.llm.conftest import prose

VECTORS = "vec_id long, embedding array<float>, label int, code string, error string, component int, _l int"


def frame(spark, vectors, ids=None, labels=None, parts=3):
    ids = list(range(len(vectors))) if ids is None else ids
    labels = [i % 3 if i % 7 else None for i in range(len(vectors))] if labels is None else labels
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], k, "c", "e", 9, 1) for i, v, k in zip(ids, vectors, labels)]
    return spark.createDataFrame(rows, VECTORS).repartition(parts)


AWKWARD = [None, [float("nan"), 1, 2, 3], [1, None, 2, 3], [float("inf"), 0, 0, 0]]


# --- vector codes

def brute_codes(ids, vectors, parts, entries, rounds, scale):
    """Lloyd by full scans on Python integers: (codes, errors, books) in the order given."""
    width = -(-max(map(len, vectors)) // parts) * parts
    x = [[math.floor(scale * float(np.float32(c))) for c in v] + [0] * (width - len(v)) for v in vectors]
    order = sorted(range(len(x)), key=lambda k: (ids[k] is None, ids[k] or 0, [float(np.float32(c)) for c in vectors[k]]))
    w = width // parts
    books = [[x[k][p * w:(p + 1) * w] for k in order[:entries]] for p in range(parts)]
    nearest = lambda v, book: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = [v[p * w:(p + 1) * w] for v in x]
            groups = defaultdict(list)
            for v in own:
                groups[nearest(v, books[p])[1]].append(v)
            books[p] = [[sum(c) // len(groups[j]) for c in zip(*groups[j])] if j in groups else c0 for j, c0 in enumerate(books[p])]
    found = [[nearest(v[p * w:(p + 1) * w], books[p]) for p in range(parts)] for v in x]
    return [tuple(j for _, j in f) for f in found], [sum(d for d, _ in f) for f in found], books


def check_codes(spark, vectors, ids=None, labels=None, parts=4, entries=8, rounds=4, scale=64):
    ids = list(range(len(vectors))) if ids is None else ids
    labels = [i % 3 if i % 7 else None for i in range(len(vectors))] if labels is None else labels
    rows, books = lloyd.compress(frame(spark, vectors, ids, labels), parts=parts, entries=entries, rounds=rounds, scale=scale)
    whole = [k for k, v in enumerate(vectors) if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    codes, errors, want = brute_codes([ids[k] for k in whole], [vectors[k] for k in whole], parts, entries, rounds, scale)
    by_label = Counter()
    for k, e in zip(whole, errors):
        by_label[labels[k]] += e
    got = sorted((repr((r["vec_id"], r["label"], tuple(np.frombuffer(bytes(r["code"]), "<u2").tolist()), r["error"], r["label_error"])) for r in rows.collect()))
    assert got == sorted(repr((ids[k], labels[k], c, e, by_label[labels[k]])) for k, c, e in zip(whole, codes, errors))
    assert [b.tolist() for b in books] == want


def test_codes_equal_full_scans(spark):
    rng = np.random.default_rng(0)
    check_codes(spark, rng.standard_normal((90, 8)).tolist())
    # a coarse grid: ties everywhere, repeated rows, entries that equal each other
    check_codes(spark, rng.integers(-2, 3, (120, 4)).tolist(), scale=1, entries=16)


def test_codes_of_awkward_rows(spark):
    rng = np.random.default_rng(1)
    vectors = [*AWKWARD, *rng.standard_normal((20, 5)).tolist(), [1.0], [], [0.5, 0.25], *rng.standard_normal((3, 5)).tolist()]
    ids = [None if k in (8, 9) else k // 2 for k in range(len(vectors))]  # null and repeated ids
    check_codes(spark, vectors, ids)
    check_codes(spark, [[1.0, 2.0, 3.0, 4.0]] * 5)
    check_codes(spark, [[3.0e4, -3.0e4, 1, 2], [2.0e4, 7, 1, 2], [1, 2, 3, 4]], scale=1)


def test_codes_of_nothing(spark):
    rows, books = lloyd.compress(frame(spark, AWKWARD))
    assert rows.count() == 0 and rows.columns == ["vec_id", "label", "code", "error", "label_error"] and lloyd.books_digest(books) == hashlib.sha256(b"").hexdigest()
    assert lloyd.compress(frame(spark, AWKWARD).limit(0))[0].count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_active_entries_give_a_full_scan(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-3, 4, (300, 2, 3))
    books = [rng.integers(-3, 4, (12, 3)) for _ in range(2)]
    zero = np.zeros((300, 2), np.int64)
    code, dist = lloyd.assign(x, books, None, zero, zero)
    for _ in range(4):
        moved = [rng.random(12) < 0.3 for _ in range(2)]
        books = [np.where(m[:, None], rng.integers(-3, 4, b.shape), b) for b, m in zip(books, moved)]
        code, dist = lloyd.assign(x, books, moved, code, dist)
        full = lloyd.assign(x, books, None, zero, zero)
        assert (code == full[0]).all() and (dist == full[1]).all()


def test_distances_are_exact_beyond_doubles():
    big = 1 << 25
    x, c = np.array([[big, -big, 1]]), np.array([[-big, big, 0], [big, -big, 1]])
    assert lloyd.distances(x, c).tolist() == [[8 * big * big + 1, 0]]


# --- whitening

@pytest.mark.parametrize("kind", ["gauss", "clusters", "equal", "wilkinson", "low rank", "graded", "one column", "diagonal"])
def test_solver(kind):
    rng = np.random.default_rng(4)
    q = lambda n: np.linalg.qr(rng.standard_normal((n, n)))[0]
    a = {"gauss": lambda: rng.standard_normal((400, 48)), "one column": lambda: rng.standard_normal((9, 1)), "diagonal": lambda: np.diag([5.0, 5, 5, 2, 2, 1e-3]),
         "clusters": lambda: rng.standard_normal((10, 40))[rng.integers(0, 10, 900)] + 0.02 * rng.standard_normal((900, 40)),
         "equal": lambda: q(40) * np.r_[np.full(15, 3.0), np.ones(25)] @ q(40), "wilkinson": lambda: np.diag(np.abs(np.arange(21) - 10.0)) + np.diag(np.ones(20), 1),
         "low rank": lambda: rng.standard_normal((10, 30)), "graded": lambda: rng.standard_normal((300, 20)) * 10.0 ** (-np.arange(20) / 4)}[kind]()
    r = np.linalg.qr(a, mode="r")
    r = np.vstack([r, np.zeros((a.shape[1] - len(r), a.shape[1]))])
    values, vectors = whitening.principal(r, a.shape[1])
    truth = np.linalg.svd(a, compute_uv=False)[:len(values)] ** 2
    assert len(values) == (np.linalg.svd(a, compute_uv=False) ** 2 > 1e-13 * truth[0]).sum()
    assert np.allclose(values, truth, rtol=1e-12, atol=0)
    assert np.abs(a.T @ (a @ vectors) - vectors * values).max() < 1e-7 * values[0]
    white = a @ (vectors / np.sqrt(values))
    assert np.abs(white.T @ white - np.eye(len(values))).max() < 1e-6


def check_whitening(spark, vectors, ids=None, components=32):
    ids = list(range(len(vectors))) if ids is None else ids
    whole = [k for k, v in enumerate(vectors) if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max(len(vectors[k]) for k in whole)
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in vectors[k]] + [1000000] * (width - len(vectors[k])) for k in whole], object)
    n, s = len(whole), x.sum(0)
    deviation = Counter((ids[k], int(((n * row - s) ** 2).sum())) for k, row in zip(whole, x))
    centred = ((n * x - s) / n).astype(float)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > 1e-12 * max(values[0], 1e-300)).sum()))
    got = whitening.whiten(frame(spark, vectors, ids), components=components).collect()
    assert len(got) == n * k and {r["n"] for r in got} <= {n}
    assert all(r["identity_error"] < 1e-9 for r in got) and len({r["identity_error"] for r in got}) <= 1
    by = defaultdict(list)
    for r in got:
        by[r["component"]].append(r)
    assert sorted(by) == list(range(1, k + 1))
    trace = values.sum()
    for c, rows in by.items():
        assert Counter((r["vec_id"], r["deviation"]) for r in rows) == deviation
        assert all(math.isclose(r["explained"], values[c - 1] / trace, rel_tol=1e-9) for r in rows)
        gap = min([abs(values[c - 1] - v) for j, v in enumerate(values) if j != c - 1], default=1.0)
        if gap > 1e-6 * values[0]:  # the direction is settled up to its sign
            want = centred @ axes[:, c - 1] / math.sqrt(values[c - 1])
            a = sorted((repr(r["vec_id"]), r["whitened"]) for r in rows)
            fit = [sorted((repr(ids[j]), y) for j, y in zip(whole, sign * want)) for sign in (1, -1)]
            assert any(all(p[0] == q[0] and abs(p[1] - q[1]) < 1e-6 for p, q in zip(a, f)) for f in fit)


def test_whitening(spark):
    rng = np.random.default_rng(2)
    check_whitening(spark, rng.standard_normal((200, 12)).tolist(), components=5)
    check_whitening(spark, (rng.standard_normal((60, 40)) * 3 + 50).tolist())
    ids = [None if k == 4 else k // 2 for k in range(44)]
    check_whitening(spark, [*AWKWARD, *rng.standard_normal((38, 4)).tolist(), [1.0], []], ids)


def test_whitening_of_few_and_equal_rows(spark):
    check_whitening(spark, [[1.0, 2.0, 3.0], [4.0, 2.0, 1.0]])
    for vectors in ([[1.0, 2.0]], [[1.0, 2.0]] * 6, AWKWARD, [[], []]):
        assert whitening.whiten(frame(spark, vectors)).collect() == []
    assert whitening.whiten(frame(spark, AWKWARD).limit(0)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_triangles_are_reduced_in_levels(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)
    check_whitening(spark, np.random.default_rng(5).standard_normal((90, 6)).tolist())


# --- language-model scores

def message(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()
    return b" ".join(low.split()) + b"\n"


def brute_scores(texts, train, order):
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    words: Counter = Counter()
    for t, learn in zip(texts, train):
        if learn:
            m = message(t)
            words.update([*m.split(), b"\n"])
            m = b"\n" * order + m
            for i in range(order, len(m)):
                for k in range(order + 1):
                    counts[k][m[i - k:i]][m[i]] += 1
    n, v, out = sum(words.values()), len(words), []
    for t in texts:
        m = message(t)
        tokens = [*m.split(), b"\n"]
        base = sum(math.log10((words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        m, total = b"\n" * order + m, 0.0
        for i in range(order, len(m)):
            excluded: set = set()
            for k in range(order, -1, -1):
                left = {b: c for b, c in counts[k].get(m[i - k:i], {}).items() if b not in excluded}
                if left:
                    size = 2 * sum(left.values())
                    if m[i] in left:
                        total += math.log10((2 * left[m[i]] - 1) / size)
                        break
                    total += math.log10(len(left) / size)
                    excluded |= set(left)
            else:
                total -= math.log10(256 - len(excluded))
        out.append((len(tokens), sum(words[w] > 0 for w in tokens), n, base, total))
    return out


def check_scores(spark, texts, train, order=5, parts=3):
    d = spark.createDataFrame([(i, t, bool(x), "a", "b") for i, (t, x) in enumerate(zip(texts, train))], "doc_id long, text string, learn boolean, block string, score string").repartition(parts)
    got = {r["doc_id"]: r for r in ppm.score(d.withColumnRenamed("score", "key"), F.col("learn"), order=order).collect()}
    assert len(got) == len(texts)
    for i, (tokens, known, n, base, score) in enumerate(brute_scores(texts, train, order)):
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["block"], r["key"]) == (tokens, known, n, "a", "b")
        assert math.isclose(r["base_score"], base, rel_tol=1e-9, abs_tol=1e-9) and math.isclose(r["score"], score, rel_tol=1e-5, abs_tol=1e-5), (i, r["score"], score)


def test_scores(spark, awkward):
    texts = [t if t is None or len(t) < 9000 else t[:9000] for t in awkward]
    check_scores(spark, texts, [i % 3 != 1 for i in range(len(texts))])


@pytest.mark.parametrize("order", [0, 1, 2, 7])
def test_scores_of_other_orders(spark, order):
    check_scores(spark, [prose(i, 30, ["aab", "Aba", "b", "abab", "é", "ba"]) for i in range(6)] + ["", "zz \x85 zz"], [True] * 4 + [False] * 4, order)


def test_pieces_and_blocks_do_not_change_scores(spark, monkeypatch):
    for name, value in (("BLOCK", 300), ("PIECE", 40), ("CHUNK", 16), ("PENDING", 50)):
        monkeypatch.setattr(ppm, name, value)
    texts = [prose(i, 50) for i in range(5)] + [" " * 200 + "x" * 300 + "\n" * 90 + prose(7, 20) + "  ", "a" * 41, "b " * 60]
    check_scores(spark, texts, [True, False] * 4)


def test_scores_without_training_or_rows(spark, no_docs):
    check_scores(spark, ["one two", "", None], [False] * 3)
    assert ppm.score(no_docs, F.lit(True)).count() == 0


def test_repeated_rows_are_documents(spark, docs):
    out = ppm.score(docs, ~ppm.held_out())
    assert out.count() == docs.count()
    again = [r for r in out.collect() if r["doc_id"] == 5]
    assert len(again) == 3 and len({(r["score"], r["base_score"]) for r in again}) == 1
    assert {c for c in docs.columns if c != "text"} <= set(out.columns)


def test_queries_on_the_small_tables(spark):
    sf = "/root/testdata/sf0.001"
    scores = queries.QUERIES["op13_lm_scores"](spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1) for r in scores)
    rows = queries.QUERIES["op12_whitening"](spark, sf)
    assert rows.count() == 32 * spark.read.parquet(f"{sf}/embeddings.parquet").count()
    assert queries.QUERIES["op11_vector_codes"](spark, sf).where("length(code) <> 8").count() == 0
