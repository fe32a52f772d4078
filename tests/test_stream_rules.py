"""Stream scoring, survivorship and quality: the reference's literal unit cases."""

from datetime import datetime

from pyspark.sql import functions as F

from aurum.operators.quality import customer_rules_stream, score_quality
from aurum.operators.scoring import stream_rules, stream_total
from aurum.plans import nrt

COLS = ["canonical_first_name", "last_name", "email", "phone", "block_soundex"]


def _score(spark, a, b):
    row = {**{c + "_a": a.get(c) for c in COLS}, **{c + "_b": b.get(c) for c in COLS}}
    schema = ", ".join(f"{k} string" for k in row)
    df = spark.createDataFrame([tuple(row.values())], schema)
    return df.select(stream_total(stream_rules()).alias("t")).first()["t"]


def test_email_match(spark):
    assert _score(spark, {"email": "x@a.no", "canonical_first_name": "Ann"}, {"email": "x@a.no", "canonical_first_name": "Bob"}) >= 1.0


def test_phone_match(spark):
    assert _score(spark, {"phone": "+11043321819"}, {"phone": "1043321819"}) >= 0.95


def test_canonical_name(spark):
    a = {"canonical_first_name": "William", "last_name": "Smith", "email": "a@x.no"}
    b = {"canonical_first_name": "william", "last_name": "SMITH", "email": "b@y.no"}
    assert _score(spark, a, b) >= 0.80


def test_soundex_only(spark):
    a = {"canonical_first_name": "Alice", "last_name": "Smith", "block_soundex": "S530"}
    b = {"canonical_first_name": "Zed", "last_name": "Smyth", "block_soundex": "S530"}
    s = _score(spark, a, b)
    assert 0.20 <= s < 0.70


def test_no_match_and_nulls(spark):
    a = {"canonical_first_name": "Alice", "last_name": "Johnson"}
    b = {"canonical_first_name": "Bob", "last_name": "Zhang"}
    assert _score(spark, a, b) < 0.70
    assert _score(spark, {}, {}) == 0.0


def _state(spark, rows):
    schema = ("source_system string, source_key string, first_name string, last_name string, email string, phone string, "
              "event_ts timestamp, cluster_id string")
    return spark.createDataFrame(rows, schema)


def test_survivorship_rules(spark):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [
        ("CRM_A", "A1", "J", "Hansen", "bad-email", "12", t2, "c"),       # invalid values, best priority
        ("CRM_C", "C1", "Jon", "Hansen", "jon@x.no", "+4790000001", t1, "c"),  # valid, worst priority
        ("CRM_B", "B1", "Jonas", None, "jonas@x.no", "+4790000002", t1, "c"),
    ]
    g = nrt.golden(_state(spark, rows)).first()
    assert g["first_name"] == "Jonas"          # valid beats priority; priority breaks the tie (B before C)
    assert g["email"] == "jonas@x.no"
    assert g["phone"] == "+4790000002"
    assert g["last_name"] == "Hansen"
    empty = nrt.golden(_state(spark, [("CRM_A", "A9", None, None, None, None, t1, "z")])).first()
    assert empty["first_name"] is None and empty["email"] is None


def _dq(spark, first, last, email, phone):
    df = spark.createDataFrame([(first, last, email, phone)], "first_name string, last_name string, email string, phone string")
    return score_quality(df, customer_rules_stream()).first()["dq_score"]


def test_quality_rules(spark):
    assert _dq(spark, "Zed", "Hansen", "zz@mailinator.com", "+4790000001") == 95
    assert _dq(spark, "Per", "Hansen", "per@x.no", "1111111111") == 85
    assert _dq(spark, "Per", "Hansen", "per@x.no", "+4790000001") == 100
    assert _dq(spark, "Per", "Hansen", None, None) <= 60
    assert _dq(spark, None, None, "a@x.no", "+4790000001") <= 40
