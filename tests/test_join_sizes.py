"""Joins of tables that grow with the input build nothing in the driver."""

import datetime as dt

from aurum.operators import aliases
from aurum.plans import pairwise
from aurum.session import written

ENRICHED = ("source_system string, source_key string, ssn string, first_name string, last_name string, birth_date date, citizenship string, phone string, "
            "email string, record_date date, organization string, _source_file string, ssn_valid boolean, canonical_first_name string, is_fake_name boolean")


def _row(system, key, ssn, first, last, born=None):
    return (system, key, ssn, first, last, born, None, None, None, dt.date(2024, 1, 1), "BANK", "f", True, first, False)


def _plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def test_written_tables_join_by_sort_merge(spark):
    a = written(spark.range(10).withColumnRenamed("id", "k"))
    b = spark.range(5).withColumnRenamed("id", "k")
    assert "Broadcast" in _plan(a.checkpoint().join(b.checkpoint(), "k"))
    for x, y in ((a, b), (b, a), (a.groupBy("k").count(), b.distinct())):
        plan = _plan(x.join(y, "k"))
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_clusters_and_addresses_join_by_sort_merge(spark):
    enr = spark.createDataFrame([_row("FREG", "1", "1", "Kari", "Hansen", dt.date(1990, 1, 1)), _row("BS", "1", "1", "Kari", "Hansen"),
                                 _row("FREG", "2", "2", "Ole", "Berg", dt.date(1990, 1, 1))], ENRICHED)
    overrides = spark.createDataFrame([("1", "2")], "source_key_a string, source_key_b string")
    cl = written(pairwise.clusters(pairwise.MatchGraph(written(enr), "parity", overrides), "transitive"))
    addr = spark.createDataFrame([("BS", "A1", "1", "Storgata 1", "0150", "Oslo", "NO", "BANK", "initial/2024-01-01_crm_bs_addresses.csv", dt.date(2024, 1, 1))],
                                 "source_system string, source_key string, source_customer_key string, gate string, postnummer string, by string, land string, "
                                 "organization string, _source_file string, file_date date")
    linked = aliases.link_addresses(addr, spark.createDataFrame([], "source_system string, source_key string, owner_key string"))
    for df in (pairwise.golden(written(enr), cl), pairwise.history(written(enr), cl), pairwise.address_golden(linked, cl), pairwise.address_history(linked, cl)):
        plan = _plan(df)
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_overrides_between_records_that_never_meet_add_no_partners(spark):
    born = dt.date(1990, 1, 1)
    rows = [_row("FREG", str(i), str(i), "Kari", "Hansen", born) for i in range(8)] + [_row("NICE", "x", None, "Kari", "Hansen")]
    overrides = spark.createDataFrame([("x", str(i)) for i in range(6)] + [("1", "0")], "source_key_a string, source_key_b string")
    g = pairwise.MatchGraph(written(spark.createDataFrame(rows, ENRICHED)), "parity", overrides)
    # x has no id and no year of birth, so it's in no block: its six overrides part it from nobody
    assert g.most_banned() == 1
    assert sorted(r["node"] for r in g.unmerged().collect()) == ["BANK|FREG|0", "BANK|FREG|1"]
    got = {r["source_key"]: r["cluster_id"] for r in pairwise.clusters(g, "transitive").collect()}
    assert got == {str(i): "BANK|FREG|0" for i in range(8)} | {"x": "BANK|NICE|x"}
