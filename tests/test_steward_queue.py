"""The steward's queue by organisation lists every queued record, newest first."""

import datetime as dt

from aurum.plans import pairwise
from aurum.session import written
from tests.test_join_sizes import ENRICHED


def _row(org, system, key, ssn, first, last, date, phone=None):
    return (system, key, ssn, first, last, dt.date(1990, 1, 1), None, phone, None, date, org, "f", True, first, False)


def test_queue_by_org_lists_its_records_newest_first(spark, monkeypatch):
    d1, d2, d3 = (dt.date(2024, m, 1) for m in (1, 2, 3))
    rows = [
        _row("BANK", "NICE", "old", None, "Uvuzela", "Ptakowiczyk", d1, "+4790000001"),
        _row("BANK", "NICE", "new", None, "Izquib", "Cvetkqumzov", d3),
        _row("BANK", "NICE", "new", None, "Izquib", "Cvetkqumzov", d3),  # comes twice
        _row("BANK", "NICE", "new", None, "Izquib", "Cvetkqumzov", d2),  # the same record in an older file
        _row("BANK", "NICE", "undated", None, "Quwanxi", "Zbigovtzuk", None),
        _row("INS", "NICE", "new", None, "Izquib", "Cvetkqumzov", d2),
        _row("INS", "BS", "1", "1", "Kari", "Hansen", d3),  # has an id
        _row("BANK", "FREG", "2", "2", "Ole", "Berg", d3),
        _row("BANK", "NICE", "x", None, "Ole", "Berg", d3),  # matches the record above
    ]
    enr = written(spark.createDataFrame(rows, ENRICHED))
    cl = written(pairwise.clusters(pairwise.MatchGraph(enr), "transitive"))
    monkeypatch.setattr(pairwise, "clusters_for", lambda *_: (enr, cl))
    found = pairwise.q_steward_by_org(spark, "")
    assert found.columns == ["organization", "queued", "newest", "oldest", "record_date", "source_system", "source_key", "first_name", "last_name", "phone", "email"]
    got = [tuple(r)[:7] for r in found.collect()]
    bank = ("BANK", 5, d3, d1)
    assert got == [
        (*bank, d3, "NICE", "new"),
        (*bank, d3, "NICE", "new"),
        (*bank, d2, "NICE", "new"),
        (*bank, d1, "NICE", "old"),
        (*bank, None, "NICE", "undated"),
        ("INS", 1, d2, d2, d2, "NICE", "new"),
    ]
    first = found.where("source_key = 'old'").first()
    assert (first["first_name"], first["last_name"], first["phone"], first["email"]) == ("Uvuzela", "Ptakowiczyk", "+4790000001", None)
