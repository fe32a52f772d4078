"""Steps that queries take once, not once for each part of their result."""

import datetime as dt

from aurum.plans import nrt, ssn_first
from aurum.streaming import pipeline
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_match_groups_read_records_with_and_without_id_once(spark):
    cols = "row_key string, ssn string, first_name string, last_name string, canonical_first_name string, birth_date date, citizenship string, phone string, " \
        "email string, organization string, record_date date, source_system string, trust_score int, ssn_valid boolean, _source_file string"

    def row(key, ssn, first, last, valid):
        return (key, ssn, first, last, first.upper(), None, None, None, None, "BANK", dt.date(2024, 1, 1), "BS", 2, valid, "f")

    enr = spark.createDataFrame([row("a", "1", "Kari", "Hansen", True), row("b", "2", "Ole", "Berg", False), row("c", None, "Kari", "Hansen", False),
                                 row("d", None, "Xutu", "Qwz", False)], cols)
    found = ssn_first.groups(enr.checkpoint())
    got = {r["row_key"]: (r["match_id"], r["match_confidence"], r["match_method"], r["steward_queue_flag"]) for r in found.collect()}
    assert got == {"a": ("1", 100, "SSN_EXACT", False), "b": (None, 0, "INVALID_SSN", True), "c": ("1", 85, "FUZZY_JW", False), "d": (None, 0, "UNMATCHED", True)}
    union = found._jdf.queryExecution().optimizedPlan()
    assert union.nodeName() == "Union" and union.children().size() == 2


def test_new_records_meet_their_stored_version_once(spark):
    assert "LeftOuter" not in _plan(nrt.q_cand_incr(spark, SF_SMALL))


def test_lags_share_one_histogram(spark):
    at = [dt.datetime(2024, 1, 1, 0, 0, s) for s in (0, 10, 20)]
    df = spark.createDataFrame([(t, "INSERT", "x") for t in at], "event_ts timestamp, event_type string, closed string")
    found = pipeline._metrics(df, df, df, df, df, df, df)
    r = found.first()
    assert (r["lag_p50_s"], r["lag_p95_s"]) == (10.0, 19.0) and abs(r["lag_p99_s"] - 19.8) < 1e-9
    assert _plan(found.select(*[c for c in found.columns if c.startswith("lag")])).count("percentile(us") == 1
