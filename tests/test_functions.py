"""Literal fixtures of the reference's mapper / function unit tests, as DataFrame rows."""

import json

from pyspark.sql import functions as F

from aurum import functions as AF
from aurum.functions.similarity import jaro_winkler_py
from aurum.sources.events import map_events


def _one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_title_case(spark):
    assert _one(spark, AF.title_case("v"), "  john  ") == "John"
    assert _one(spark, AF.title_case("v"), "WILLIAM") == "William"
    assert _one(spark, AF.title_case("v"), "   ") is None
    assert _one(spark, AF.title_case("v"), None) is None


def test_phone_and_suffix(spark):
    assert _one(spark, AF.norm_phone("v"), "+1 (104) 332-1819") == "+11043321819"
    assert _one(spark, AF.norm_phone("v"), "abc") is None
    assert _one(spark, AF.phone_suffix("v", 4), "+11043321819") == "1819"
    assert _one(spark, AF.phone_suffix("v", 4), "123") is None


def test_soundex_and_domain(spark):
    assert _one(spark, AF.soundex_nordic("v"), "Smith") == "S530"
    assert _one(spark, AF.soundex_nordic("v"), "Smth") == "S530"
    assert _one(spark, AF.soundex_nordic("v"), None) is None
    assert _one(spark, AF.soundex_nordic("v"), "Ødegård") == "O326"
    assert _one(spark, AF.email_domain("v"), "bill@acme.com") == "@acme.com"
    assert _one(spark, AF.email_domain("v"), "noatsign") is None


def test_ssn_checks(spark):
    # 01010112345-style ids: compute a valid one from the weights
    w1, w2 = [3, 7, 6, 1, 8, 9, 4, 5, 2], [5, 4, 3, 2, 7, 6, 5, 4, 3, 2]
    d = [0, 1, 0, 1, 8, 0, 1, 2, 3]
    r1 = sum(a * b for a, b in zip(w1, d)) % 11
    k1 = 0 if r1 == 0 else 11 - r1
    d2 = d + [k1]
    r2 = sum(a * b for a, b in zip(w2, d2)) % 11
    k2 = 0 if r2 == 0 else 11 - r2
    if k1 < 10 and k2 < 10:
        ok = "".join(map(str, d2)) + str(k2)
        assert _one(spark, AF.ssn_mod11_valid("v"), ok) is True
        bad = ok[:-1] + str((int(ok[-1]) + 1) % 10)
        assert _one(spark, AF.ssn_mod11_valid("v"), bad) is False
    assert _one(spark, AF.ssn_mod11_valid("v"), "123") is False
    assert _one(spark, AF.ssn_mod11_valid("v"), None) is False
    assert _one(spark, AF.ssn_date_valid("v"), "31129912345") is True
    assert _one(spark, AF.ssn_date_valid("v"), "32129912345") is False


def test_jaro_winkler_values(spark):
    assert abs(jaro_winkler_py("MARTHA", "MARHTA") - 0.961111) < 1e-5
    assert abs(jaro_winkler_py("DIXON", "DICKSONX") - 0.813333) < 1e-5
    assert jaro_winkler_py("", "") == 0.0
    df = spark.createDataFrame([("MARTHA", "MARHTA"), ("A", None)], "a string, b string")
    got = [r["j"] for r in df.select(AF.jaro_winkler("a", "b").alias("j")).collect()]
    assert abs(got[0] - 0.961111) < 1e-5 and got[1] is None


def _events(spark, rows):
    return spark.createDataFrame(
        [(i, i, t, None, p) for i, (t, p) in enumerate(rows)],
        "event_id long, arrival_seq long, topic string, event_ts timestamp, payload string")


def test_full_name_split_and_rejects(spark):
    rows = [
        ("topic.crm.b", json.dumps({"customer_key": "B1", "name": "William Smith"})),
        ("topic.crm.b", json.dumps({"customer_key": "B2", "name": "Madonna"})),
        ("topic.crm.c", json.dumps({"ticket_customer_id": "C1", "caller_name": ""})),
        ("topic.crm.a", '{"src_customer_id": "A1", "first_na'),
        ("topic.unknown", json.dumps({"x": 1})),
        ("topic.crm.a", json.dumps({"first_name": "no key"})),
    ]
    recs, rej = map_events(_events(spark, rows))
    got = {r["source_key"]: (r["first_name"], r["last_name"]) for r in recs.collect()}
    assert got == {"B1": ("William", "Smith"), "B2": ("Madonna", None), "C1": (None, None)}
    reasons = sorted(r["reject_reason"] for r in rej.collect())
    assert reasons == ["MALFORMED_OR_NO_KEY", "MALFORMED_OR_NO_KEY", "UNKNOWN_TOPIC"]


def test_dq_tier(spark):
    df = spark.createDataFrame([(95,), (90,), (75,), (50,), (10,)], "s int")
    assert [r[0] for r in df.select(AF.dq_tier("s")).collect()] == ["Excellent", "Excellent", "Good", "Fair", "Poor"]
