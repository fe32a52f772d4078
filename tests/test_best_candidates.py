"""The best-first search of fuzzy names against all pairs."""

import random

import pytest

from aurum.functions.similarity import jaro_winkler_py
from aurum.plans import ssn_first


def _names(rng, n, letters):
    return sorted({("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))), "".join(rng.choice(letters) for _ in range(rng.randint(2, 8)))) for _ in range(n)})


def _score(a, b):
    return (sum(1.0 if x == y else jaro_winkler_py(x, y) for x, y in zip(a, b)) / 2.0) * 100.0


@pytest.mark.parametrize("letters", ["abc", "abcdefghijklmnoØ"])
def test_best_candidates_equal_all_pairs(spark, monkeypatch, letters):
    rng = random.Random(len(letters))
    q, c = _names(rng, 60, letters), _names(rng, 90, letters)
    q += [c[5], (c[7][0], c[7][1] + "x"), (c[9][0], "zzzz"), ("zzz", "yyy")]
    cand = [(f, s, f"{i:04d}", f"{i + 1000:04d}") for i, (f, s) in enumerate(c)]
    formed = []
    real = ssn_first._scored

    def scored(q, cand, bound):
        out = real(q, cand, bound).checkpoint()
        formed.append(out.count())
        return out

    monkeypatch.setattr(ssn_first, "_scored", scored)
    best, near = ssn_first.best_candidates(spark.createDataFrame(q, "qf string, ql string"), spark.createDataFrame(cand, "cf string, cl string, ssn_min string, ssn_max string"), 92.0)
    got_best = {(r["qf"], r["ql"]): (round(r["best_score"], 6), r["best_ssn"]) for r in best.collect()}
    got_near = {(r["qf"], r["ql"]): (round(r["near_score"], 6), r["near_ssn"]) for r in near.collect()}
    want_best, want_near = {}, {}
    for n in q:
        scores = [(_score(n, x[:2]), x) for x in cand]
        top = max(s for s, _ in scores)
        at = [x for s, x in scores if s == top]
        if top >= 92.0:
            want_best[n] = round(top, 6), min(x[2] for x in at)
        else:
            want_near[n] = round(top, 6), max(x[3] for x in at)
    assert got_best == want_best and got_near == want_near
    assert sum(formed) < 0.25 * len(q) * len(cand)


def test_no_names_and_no_candidates(spark):
    cand = spark.createDataFrame([("ole", "berg", "1", "2")], "cf string, cl string, ssn_min string, ssn_max string")
    q = spark.createDataFrame([("ole", "dahl")], "qf string, ql string")
    for names, among, found in ((q.limit(0), cand, 0), (q, cand.limit(0), 0), (q, cand, 1)):
        best, near = ssn_first.best_candidates(names, among, 92.0)
        assert best.count() == 0 and near.count() == found
