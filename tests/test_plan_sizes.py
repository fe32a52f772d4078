"""The plans of the match graph stay small: what several steps read is written once, not derived again in each of them."""

import datetime as dt

import pytest

from aurum.operators import fuzzy, graph, partners
from aurum.plans import pairwise, reports
from aurum.plans.catalog import load_all
from aurum.session import written
from tests.conftest import SF_SMALL
from tests.test_join_sizes import ENRICHED, _row


def _exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


@pytest.mark.parametrize("mode", ["one_hop", "transitive"])
def test_no_plan_of_the_match_graph_holds_many_exchanges(spark, monkeypatch, mode):
    seen = []

    def noted(df):
        seen.append(_exchanges(df))
        return written(df)

    for module in (fuzzy, graph, pairwise, partners):
        monkeypatch.setattr(module, "written", noted, raising=False)
    born = dt.date(1990, 1, 1)
    enr = written(spark.createDataFrame([_row("FREG", "1", "1", "Kari", "Hansen", born), _row("BS", "1", "1", "Kari", "Hansen", born),
                                         _row("FREG", "2", "2", "Karin", "Hansen", born), _row("NICE", "x", None, "Kari", "Hansen", born)], ENRICHED))
    overrides = spark.createDataFrame([("1", "x")], "source_key_a string, source_key_b string")
    cl = pairwise.clusters(pairwise.MatchGraph(enr, "parity", overrides), mode)
    seen.append(_exchanges(cl))
    assert max(seen) <= 20
    got = {(r["source_system"], r["source_key"]): r["cluster_id"] for r in cl.collect()}
    # x is parted from both records of key 1, but a similar name ties it to record 2
    assert got[("FREG", "1")] == got[("BS", "1")] == "BANK|BS|1"
    assert got[("NICE", "x")] == ("BANK|FREG|2" if mode == "one_hop" else "BANK|BS|1")


def test_gates_derive_golden_addresses_and_history_once(spark):
    assert _exchanges(reports.q_checks(spark, SF_SMALL)) <= 55


#: queries over the clusters of the golden chain that failed by driver memory
GOLDEN_CHAIN = ["address_history", "address_winners", "cluster_numbering", "cluster_one_hop", "cluster_stats", "cross_org", "customer_360", "customer_360_flat",
                "search_golden", "search_with_address", "source_count_share", "steward_list_by_org", "golden_diff", "golden_v2", "history_point_in_time",
                "steward_queue_by_org", "steward_queue_v2"]


@pytest.mark.parametrize("name", GOLDEN_CHAIN)
def test_queries_of_the_golden_chain_are_small_plans_without_planned_broadcasts(spark, name):
    df = load_all()[name].build(spark, SF_SMALL)
    assert _exchanges(df) <= 12
    planned = df._jdf.queryExecution().sparkPlan().toString()
    # the numbering joins its offsets, a row for each partition, by an explicit broadcast
    assert planned.count("BroadcastHashJoin") == (1 if name == "cluster_numbering" else 0)
    assert "BroadcastNestedLoopJoin" not in planned
