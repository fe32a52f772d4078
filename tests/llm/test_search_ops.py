"""PII, substring dedup, top-k, decontamination and near-duplicates against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from aurum.llm import decontam, neardup, pii, substring, topk
from aurum.llm.common import replace_spans
from tests.llm.conftest import prose

# --- PII

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def valid(kind, m):
    digits = re.sub(r"[^0-9]", "", m)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.split(".")),
            "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def brute_pii(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m[0])]


PII = ["mail a@b.c_d@e.f-@x.y, é😀 q.w+e@mail.example.com.", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 9.9.9", "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111",
       "x4111111111111111y 41111111111111111111111 5500005555555559", "+1 (988) 555-2485 +12 +1((((( +49.30.1234567-", "a@b @c.d a@.b x@y..z @", "7 7 7 7 " * 3000,
       "a@b.cc" * 2000, "a" * 100_000 + "@", "+1" * 5000, "1." * 20_000, "٣٣٣ ١٢٣"]


def test_pii_base_spans(spark, docs, awkward, no_docs):
    d = docs.unionByName(spark.createDataFrame([(700 + i, t) for i, t in enumerate(PII)], "doc_id long, text string"), allowMissingColumns=True)
    texts = dict(enumerate(awkward)) | {700 + i: t for i, t in enumerate(PII)}
    out = pii.report(d).where("doc_id is not null").collect()
    assert len(out) == d.count() - 1
    for r in out:
        want = brute_pii(texts[r["doc_id"]] or "")
        assert [(pii.KINDS[s["kind"]], s["start"], s["end"]) for s in r["base"]] == want, texts[r["doc_id"]][:60]
        assert set(r["base"]) <= set(r["spans"])
    assert pii.report(no_docs).count() == 0 and pii.mask(no_docs).count() == 0


def test_bootstrapping_discovers_unseen_identifiers(spark):
    rows = [(i, f"{prose(i, 8)} please call +1 (555) 010-{1000 + i} {prose(i + 90, 5)}") for i in range(12)]
    rows += [(50, "so please call 555-010-7777, or not"), (51, "we sold 555-010-7778 of them"), (52, "please call back 12 times")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.report(d).collect()}
    assert [(pii.KINDS[s["kind"]], s["start"], s["end"]) for s in got[50]["spans"]] == [("phone", 15, 27)] and got[50]["base"] == []
    assert got[51]["spans"] == [] and got[52]["spans"] == []
    masked = {r["doc_id"]: r["text"] for r in pii.mask(d).collect()}
    assert masked[50] == "so please call [PII], or not" and masked[51] == rows[13][1] and "+1" not in masked[3]


@pytest.mark.parametrize("unseen_rows, least", [(36, 0.8), (150, 0.8), (150, 0.6)])
def test_recall_and_precision_of_discovered_identifiers(spark, unseen_rows, least):
    """A labelled table: identifiers that no fixed pattern takes, behind words that 300 seeds stand behind, and as many like strings elsewhere.

    A pattern needs a share ``least`` of seeds or accepted instances: at 0.8 nothing is found where a third of what follows the words is unseen.
    """
    rng = random.Random(4)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    cues = {"phone": ["please call", "ring me on", "phone number"], "email": ["write to", "mail address"], "ip": ["from host", "server at"]}
    seeds = {"phone": lambda: f"+1 ({digits(3)}) 555-{digits(4)}", "email": lambda: f"u{digits(5)}@mail{digits(2)}.example.com",
             "ip": lambda: f"10.{rng.randint(0, 255)}.{rng.randint(0, 255)}.{rng.randint(0, 255)}"}
    unseen = {"phone": lambda: f"{digits(3)}-{digits(3)}-{digits(4)}", "email": lambda: f"u{digits(5)}@intranet", "ip": lambda: f"10:{rng.randint(0, 255)}:{rng.randint(0, 255)}:7"}
    other = ["order", "part number", "we sold", "page", "score of", "chapter", "ratio"]
    kinds = list(cues)
    rows = [f"{prose(i, 6)} {rng.choice(cues[k])} {seeds[k]()} {prose(i + 1, 4)}" for i, k in ((i, kinds[i % 3]) for i in range(300))]
    want = {}
    for i in range(2 * unseen_rows):
        k, cue = kinds[i // 2 % 3], i % 2
        x = unseen[k]()
        lead = f"{prose(i + 2, 6)} {rng.choice(cues[k] if cue else other)} "
        if cue:
            want[len(rows)] = (k, len(lead), len(lead) + len(x))
        rows.append(f"{lead}{x} {prose(i + 3, 4)}")
    d = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {(r["doc_id"], pii.KINDS[s["kind"]], s["start"], s["end"]) for r in pii.report(d, least=least).collect() for s in r["spans"] if s not in r["base"]}
    true = {(i, *x) for i, x in want.items()}
    recall, precision = len(found & true) / len(true), len(found & true) / max(1, len(found))
    print("discovered identifiers:", unseen_rows, least, "recall", recall, "precision", precision)
    if (unseen_rows, least) == (150, 0.8):
        assert not found
    else:  # measured: 1.0 and 0.92, then 0.87 and 0.91 ("part number" shares its last word with "phone number")
        assert recall >= 0.85 and precision >= 0.9


def test_pii_plan_is_native(spark, docs, capsys):
    pii.report(docs).explain()
    plan = capsys.readouterr().out
    assert not re.search("Python|Pandas|Arrow", plan)


def test_replace_spans(spark):
    d = spark.createDataFrame([("a😀bcdefgh", [(1, 3), (2, 4), (4, 4), (6, 8)]), ("x", []), (None, None)], "t string, s array<struct<start:int,end:int>>")
    got = [r[0] for r in d.select(replace_spans(F.col("t"), F.col("s"), "#")).collect()]
    assert got == ["a##de#h", "x", None]


# --- substring dedup

def brute_repeats(texts, size):
    ws = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    count = Counter(tuple(w[i:i + size]) for w in ws for i in range(len(w) - size + 1))
    out = []
    for w in ws:
        gone = set()
        for i in range(len(w) - size + 1):
            if count[tuple(w[i:i + size])] > 1:
                gone.update(range(i, i + size))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def _check_repeats(spark, texts, size=35, parts=3):
    d = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, kept string").repartition(parts)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring.remove_repeats(d, size).collect()}
    assert [got[i] for i in range(len(texts))] == brute_repeats(texts, size)


def test_repeats(spark, awkward, docs, no_docs):
    _check_repeats(spark, awkward)
    assert substring.remove_repeats(docs).count() == docs.count()
    assert substring.remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_random_repeats(spark, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(substring, "BLOCK_WORDS", 400)
    monkeypatch.setattr(substring, "SHARD_CHARS", 500)
    monkeypatch.setattr(substring, "ROW_WINDOWS", 7)
    few = ["a", "b"] if seed % 2 else None  # many repeats inside a document
    passages = [prose(1000 + k, rng.randint(30, 120), few) for k in range(6)]
    texts = []
    for k in range(60):
        parts = [prose(seed * 100 + k, rng.randint(0, 40), few)]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages).split()
            i = rng.randint(0, 20)
            parts += [" ".join(p[i:rng.randint(i, len(p))]), prose(rng.random(), rng.randint(0, 9))]
        texts.append(" ".join(parts))
    _check_repeats(spark, texts + texts[:3], size=35 if seed < 2 else 20)


def test_a_hot_passage_travels_by_window(spark, monkeypatch):
    monkeypatch.setattr(substring, "BLOCK_WORDS", 300)
    common = prose(1, 45)
    texts = [f"{prose(10 + i, 40)} {common} {prose(500 + i, 40)}" for i in range(60)]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "key long, text string")
    assert len(substring.hot_anchors(d, 35)) > 0
    _check_repeats(spark, texts)


# --- top-k

def brute_top(rows, k=20, every=20):
    """Rows are (id, vector); every row of another id is a candidate, rows of one id share a list."""
    out = []
    for q in {i for i, _ in rows if i % every == 0}:
        scores = sorted((-sum(a * b for a, b in zip(v, w)), c) for i, v in rows if i == q for c, w in rows if c != q)
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("kind", ["gauss", "ties", "long", "aligned", "few", "large", "repeated"])
def test_top_k(spark, kind, monkeypatch):
    monkeypatch.setattr(topk, "BUCKET", 16)
    monkeypatch.setattr(topk, "BLOCK", 4)
    monkeypatch.setattr(topk, "GROUP", 2)
    rng = np.random.default_rng(5)
    n = 12 if kind == "few" else 200
    m = rng.normal(size=(n, 8))
    if kind == "ties":
        m = rng.integers(-1, 2, size=(n, 8)).astype(float)
        m[50:120] = m[50]
    if kind == "long":
        m *= np.exp(2 * rng.normal(size=(n, 1)))
    if kind == "aligned":  # close to one direction: high cosines, so coordinates prune
        m = (np.eye(8)[rng.integers(0, 8, n)] + 0.02 * m) * rng.uniform(1, 3, (n, 1))
    if kind == "large":
        m *= 1e7
    rows = [(i, m[i].tolist(), 0) for i in range(n)]
    if kind == "repeated":  # a third of all rows has one id, some of them one vector; a query's id repeats too
        rows += [(7, (m[7] * (1 + i % 30)).tolist(), 0) for i in range(100)] + [(40, (-m[40]).tolist(), 0), (0, m[0].tolist(), 0)]
    odd = [(1000, None, 0), (1020, [1.0, None], 0), (1040, [float("nan")] * 8, 0), (1060, [float("inf")] + [0.0] * 7, 0), (None, [1.0] * 8, 0)]
    d = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, score int")
    got = topk.top_k(topk.integer_vectors(d), F.col("vec_id") % 20 == 0)
    ints = [(i, [int(np.floor(x * 64)) for x in v]) for i, v, _ in rows]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect()) == brute_top(ints)


def test_top_k_of_nothing(spark):
    d = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(topk.integer_vectors(d), F.col("vec_id") % 20 == 0).count() == 0
    one = spark.createDataFrame([(20, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(topk.integer_vectors(one), F.col("vec_id") % 20 == 0).count() == 0


def test_short_groups_are_not_sent(spark, monkeypatch):
    monkeypatch.setattr(topk, "BUCKET", 16)
    monkeypatch.setattr(topk, "GROUP", 2)
    rng = np.random.default_rng(6)
    m = rng.normal(size=(1000, 8)) * np.where(np.arange(1000) % 10 == 3, 50, 0.5)[:, None]
    d = spark.createDataFrame([(i, m[i].tolist()) for i in range(1000)], "vec_id long, embedding array<double>")
    vectors, asked = topk.integer_vectors(d), F.col("vec_id") % 20 == 0
    ints = [(i, [int(np.floor(x * 64)) for x in v]) for i, v in enumerate(m)]
    assert sorted(map(tuple, topk.top_k(vectors, asked, 3).collect())) == brute_top(ints, 3)
    # 100 vectors are long; the 900 short ones fill 28 groups or more and cannot be among the best
    assert max(r["group"] for r in topk.meetings(vectors, asked, 3).select("group").collect()) < 16


# --- decontamination

def brute_hits(texts, items, size=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            # the passages of an item without an id are hit, though there is no id to list
            windows.setdefault(tuple(w[k:k + size]), set()).update({i} - {None})
    out = []
    for t in texts:
        w = words(t)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k:k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[x]
        out.append((len(w), len(hit), sorted(found)))
    return out


def test_suffix_array_and_wavelet_tree():
    rng = np.random.default_rng(1)
    seq = np.append(rng.integers(0, 4, 300), 0)
    sa = decontam.suffix_array(seq)
    seps = np.flatnonzero(seq == 0)
    named = seq + len(seps)
    named[seps] = np.arange(len(seps))
    assert sa.tolist() == sorted(range(len(seq)), key=lambda i: named[i:].tolist())
    tree = decontam.WaveletTree(seq, 3)
    for c in range(4):
        ends = np.arange(len(seq) + 1)
        assert tree.rank(np.full_like(ends, c), ends).tolist() == [int((seq[:e] == c).sum()) for e in ends]
    assert tree.access(np.arange(len(seq))).tolist() == seq.tolist()


@pytest.mark.parametrize("shard", [1 << 18, 60])
def test_decontamination(spark, awkward, monkeypatch, shard):
    monkeypatch.setattr(decontam, "SHARD", shard)
    few = ["a", "b", "c", "é", "X"]
    items = [(1, prose(1, 14, few)), (2, prose(2, 30)), (3, "Short Item"), (4, None), (None, "a b"), (5, ""), (2, prose(2, 30)), (6, prose(6, 10, few)), (7, "漢字")]
    texts = [*awkward, prose(2, 30), "x " + prose(2, 30).upper() + " y", prose(9, 400, few), "it is a short-item, no?", prose(2, 30)[5:], "short", "a 漢字 b"]
    d = spark.createDataFrame([(i, t, 3, "q") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, items string")
    b = spark.createDataFrame(items, "item_id long, text string")
    for part_chars in (16_000_000, 60):  # one pass, or many
        got = {r["doc_id"]: r for r in decontam.find(d, b, part_chars=part_chars).withColumn("hit", decontam.n_hit()).collect()}
        assert [(got[i]["n_words"], got[i]["hit"], got[i]["items"]) for i in range(len(texts))] == brute_hits(texts, items)
    named = decontam.find(d, b.select(F.concat(F.lit("i"), F.col("item_id").cast("string")).alias("item_id"), "text")).select("doc_id", "items").collect()
    assert {r["doc_id"]: r["items"] for r in named} == {i: [f"i{x}" for x in want[2]] for i, want in enumerate(brute_hits(texts, items))}
    assert decontam.find(d.limit(0), b).count() == 0
    assert decontam.find(d, b.limit(0)).where("size(spans) > 0").count() == 0


def test_hits_are_cut_out(spark):
    item = prose(2, 12)
    d = spark.createDataFrame([(1, f"é Before, {item.title()}! after"), (2, "clean Text."), (3, None)], "doc_id long, text string")
    found = decontam.find(d, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {r["doc_id"]: r["text"] for r in decontam.remove_hits(found).collect()} == {1: "é Before, ! after", 2: "clean Text.", 3: None}


# --- near-duplicates

def shingle_counts(t):
    w = (t or "").lower().split()
    return Counter([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def brute_classes(rows, threshold=0.8):
    ids = [i for i, _ in rows]
    sets = [shingle_counts(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = sum((sets[a] & sets[b]).values())
            union = sum(sets[a].values()) + sum(sets[b].values()) - common
            if union and common / union >= threshold:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    smallest = {}
    for k, i in enumerate(ids):
        smallest[find(k)] = min(smallest.get(find(k), i), i)
    return {i: smallest[find(k)] for k, i in enumerate(ids)}


def test_signature_agreement_is_the_weighted_similarity():
    rng = random.Random(2)
    a = [f"w{rng.randint(0, 60)}" for _ in range(300)]
    b = list(a)
    for k in rng.sample(range(300), 12):
        b[k] = "other"
    ta, tb = " ".join(a), " ".join(b)
    x, y = shingle_counts(ta), shingle_counts(tb)
    common = sum((x & y).values())
    true = common / (sum(x.values()) + sum(y.values()) - common)
    sa, sb = neardup.shingles(ta, {}), neardup.shingles(tb, {})
    assert neardup.jaccard(sa.tobytes(), sb.tobytes()) == pytest.approx(true)
    k = 4000
    sig = neardup.dart_minhash([sa, sb, sa[:1], np.zeros(0, np.uint64)], k)
    assert abs(float((sig[0] == sig[1]).mean()) - true) < 0.04
    assert (sig[2] != neardup.NONE).all() and (sig[3] == neardup.NONE).all()


def test_signature_does_not_depend_on_its_batch():
    sets = [neardup.shingles(prose(i, 5 + 40 * i), {}) for i in range(12)]
    together = neardup.dart_minhash(sets)
    for k, s in enumerate(sets):
        assert (neardup.dart_minhash([s])[0] == together[k]).all()


@pytest.mark.parametrize("small", [True, False])
def test_near_duplicates(spark, awkward, no_docs, monkeypatch, small):
    monkeypatch.setattr(neardup, "SMALL", 3 if small else 500)
    rng = random.Random(4)
    texts = list(awkward)
    for g in range(12):  # groups of near copies around the threshold, chains included
        base = prose(100 + g, rng.randint(20, 200)).split()
        for _ in range(rng.randint(2, 9)):
            texts.append(" ".join(base))
            if rng.random() < 0.3:
                texts.append(" ".join(base))
            base = list(base)
            for k in rng.sample(range(len(base)), max(1, len(base) // rng.choice([40, 60, 150]))):
                base[k] = f"new{rng.random()}"
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    d = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, class_id string").repartition(5)
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(d).collect()}
    assert got == brute_classes(sorted(rows))
    assert neardup.near_duplicates(no_docs).count() == 0


def test_nameless_and_repeated_rows(spark):
    t = prose(1, 80)
    d = spark.createDataFrame([(7, t), (7, t), (3, t), (None, t), (None, None), (5, None), (6, "")], "doc_id long, text string")
    got = [(r["doc_id"], r["class_id"]) for r in neardup.near_duplicates(d).collect()]
    assert sorted(got, key=str) == sorted([(7, 3), (7, 3), (3, 3), (None, 3), (None, None), (5, 5), (6, 6)], key=str)


def test_rows_that_share_an_id_or_have_none(spark):
    a, b = prose(1, 80), prose(2, 80)
    near = a.split()
    near[40] = "changed"
    rows = [(7, a), (7, b), (3, " ".join(near)), (None, b + " more"), (None, prose(3, 80)), (None, prose(4, 80)), (None, prose(3, 80) + " x"), (5, None), (5, ""), (6, "")]
    d = spark.createDataFrame([(i, t, k, "y") for k, (i, t) in enumerate(rows)], "doc_id long, text string, n int, k1 string")
    got = sorted(((r["doc_id"], r["class_id"]) for r in neardup.near_duplicates(d).collect()), key=str)
    assert got == sorted([(7, 3), (7, 7), (3, 3), (None, 7), (None, None), (None, None), (None, None), (5, 5), (5, 5), (6, 6)], key=str)
    # one row of each class, whatever ids its rows share or lack; wordless rows stay by id
    kept = neardup.one_of_each(d).select("n", *[c for c in d.columns if c != "n"]).collect()
    assert sorted(r["n"] for r in kept if r["n"] not in (4, 6)) == [1, 2, 5, 7, 9] and len([r for r in kept if r["n"] in (4, 6)]) == 1
    assert neardup.one_of_each(d).columns == d.columns and neardup.one_of_each(d.limit(0)).count() == 0


def test_a_pair_that_meets_in_one_large_open_group_alone(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 3)
    rng = random.Random(11)

    def changed(words, n, tag):
        words = list(words)
        for k in rng.sample(range(len(words)), n):
            words[k] = f"{tag}{rng.random()}"
        return words

    def look(texts):
        sets = [neardup.shingles(" ".join(t), {}) for t in texts]
        return sets, neardup.band_keys(neardup.dart_minhash(sets))

    def alike(a, b):
        return neardup.jaccard(a.tobytes(), b.tobytes())

    pair = None
    for seed in range(200):
        x = prose(seed, 150, [f"v{i}" for i in range(5000)]).split()
        others = [changed(x, 3, "y") for _ in range(40)]
        sets, bands = look([x, *others])
        shared = (bands[1:] == bands[0]).sum(axis=1)
        for k in np.flatnonzero(shared == 1):
            if alike(sets[0], sets[k + 1]) >= 0.8:
                pair = x, others[k], int(np.flatnonzero(bands[k + 1] == bands[0])[0]), bands[0], sets[0], sets[k + 1]
        if pair:
            break
    x, y, band, key, sx, sy = pair
    beside = []  # members of the pair's only common group that are copies of neither, nor of each other
    while len(beside) < 8:
        tried = [changed(x, 10, "z") for _ in range(200)]
        sets, bands = look(tried)
        for k in np.flatnonzero(bands[:, band] == key[band]):
            if max(alike(sets[k], o) for o in [sx, sy, *[s for _, s in beside]]) < 0.8:
                beside.append((tried[k], sets[k]))
    texts = [t for t, _ in beside[:4]] + [x, y] + [t for t, _ in beside[4:8]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows)
    assert got[5] == 4


def test_no_task_holds_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 40)
    monkeypatch.setattr(neardup, "TASK_BYTES", 8000)
    for n, size in ((10, 500), (50, 300)):
        members = spark.range(size).select(F.lit(0).alias("band"), F.lit(7).alias("key"), F.col("id").alias("node"), F.lit(n).alias("n"), F.col("id").alias("component"))
        groups = members.withColumns({"size": F.lit(size), "bytes": F.lit(size * n * 8)})
        dealt = neardup._block_pairs(groups, ["band", "key"])
        tasks = [(r["m"], r["b"]) for r in dealt.groupBy("lo", "hi").agg(F.count("*").alias("m"), (F.sum("n") * 8).alias("b")).collect()]
        assert max(m for m, _ in tasks) <= 2 * 40 and max(b for _, b in tasks) <= 2 * 8000
        # every pair meets in one task
        block = {r["node"]: r["block"] for r in dealt.select("node", "block").distinct().collect()}
        lots = {(r["lo"], r["hi"]) for r in dealt.select("lo", "hi").distinct().collect()}
        assert {tuple(sorted((block[a], block[b]))) for a in block for b in block} <= lots


# --- queries against their SQL

@pytest.mark.parametrize("name", ["op6_substring_dedup", "op7_topk", "op8_decontaminate"])
def test_query_matches_sql(spark, name):
    import duckdb
    from aurum.llm.queries import QUERIES, SQL
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    got = QUERIES[name](spark, "/root/testdata/sf0.001")
    want = con.execute(SQL[name])
    cols = [c[0] for c in want.description]
    assert sorted(cols) == sorted(got.columns)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(want.fetchall())


def test_digests_of_nothing(spark):
    empty = hashlib.sha256(b"").hexdigest()
    from aurum.llm.queries import QUERIES
    assert {r["items_sha256"] for r in QUERIES["op8_decontaminate"](spark, "/root/testdata/sf0.001").where("n_items = 0").collect()} == {empty}
