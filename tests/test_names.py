"""Name rules: capitals, nordic soundex, vectorised Jaro-Winkler, signature search, the guard of the match graph."""

import random

import pytest
from pyspark.sql import functions as F

from aurum import rules
from aurum.functions import capitalise, soundex_nordic
from aurum.functions.similarity import jaro_winkler_many, jaro_winkler_py
from aurum.operators.fuzzy import candidates, similar_values
from aurum.sources.derived import FIRST_NAMES, LAST_NAMES


def test_capitals_after_every_non_letter(spark):
    words = ["anne-marie", " o'brien ", "ØDEGÅRD", "per olav", "é-á", "", None, "4th st."]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(capitalise("w")).collect()]
    assert got == ["Anne-Marie", "O'Brien", "Ødegård", "Per Olav", "É-Á", "", None, "4Th St."]


def test_nordic_names_share_a_block(spark):
    got = spark.createDataFrame([("Ødegård", "Odegard")], "a string, b string").select(soundex_nordic("a") == soundex_nordic("b")).first()[0]
    assert got


def test_vectorised_scores_equal_the_pairwise_ones():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcØ ") for _ in range(rng.randint(0, 12)))
    a, b = [word() for _ in range(2000)], [word() for _ in range(2000)]
    b[:200] = a[:200]
    # the array keeps no trailing NUL; the score of an empty side is 0
    assert jaro_winkler_many(a, b).tolist() == pytest.approx([jaro_winkler_py(x, y) if x and y else 0.0 for x, y in zip(a, b)])


@pytest.mark.parametrize("threshold", [0.92, 0.85, 0.5, 0.0])
def test_search_finds_every_pair(spark, threshold):
    rng = random.Random(2)
    names = sorted({"".join(rng.choice("abcdeØ") for _ in range(rng.randint(1, 9))) for _ in range(60)})
    df = spark.createDataFrame([(n,) for n in names], "value string")
    got = {(r["left_value"], r["right_value"]) for r in similar_values(df, df, threshold).collect()}
    assert got == {(x, y) for x in names for y in names if jaro_winkler_py(x, y) >= threshold and jaro_winkler_py(x, y) > 0}


def test_search_forms_few_candidates(spark):
    full = [f"{f} {last}" for f in FIRST_NAMES for last in LAST_NAMES]
    df = spark.createDataFrame([(n,) for n in full], "value string")
    assert len(full) == 400
    assert candidates(df, df, 0.85).select(F.count("*")).first()[0] < 60_000


def test_a_threshold_outside_the_graph_is_an_error(monkeypatch):
    rules.check_match_graph()
    for bad in (0.05, 0.60, 0.75, 0.99):
        monkeypatch.setattr(rules, "MATCH_THRESHOLD", bad)
        with pytest.raises(ValueError):
            rules.check_match_graph()


def test_blocks_of_any_size_find_every_pair_without_a_broadcast(spark):
    """The sides of the search grow by signatures that size estimates don't know, so neither may be broadcast."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeØ") for _ in range(rng.randint(1, 9)))
    blocks = {"few": {word() for _ in range(5)}, "many": {word() for _ in range(90)}, "one": {"abc"}}
    df = spark.createDataFrame([(k, v) for k, vs in blocks.items() for v in vs] + [(None, "abc"), ("few", None), ("few", "")], "k string, value string")
    found = similar_values(df, df, 0.85, keys=["k"])
    got = sorted((r["k"], r["left_value"], r["right_value"]) for r in found.collect())
    assert got == sorted((k, x, y) for k, vs in blocks.items() for x in vs for y in vs if jaro_winkler_py(x, y) >= 0.85)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_small_blocks_meet_without_signatures(spark):
    df = spark.createDataFrame([(f"k{i}", v) for i in range(50) for v in ("Per Hansen", "Petter Hansen")], "k string, value string")
    found = candidates(df, df, 0.85, keys=["k"])
    assert found.count() == 200
    assert found.where("left_value = right_value").count() == 100
