"""From CSV files to golden records by the public pipeline."""

import datetime as dt
from pathlib import Path

import pytest

from aurum import pipeline

FREG = "SSN,First_Name,Last_Name,Birth_Date,Citizenship,Record_Date"
CRM = "SSN,First_Name,Last_Name,Phone,Email,Record_Date,Organization"
ADDR = "SRC_ADDRESS_ID,SRC_CUSTOMER_ID,GATE,POSTNUMMER,BY,LAND"
PER, KARI = "01019012345", "02029054321"


def _file(root: Path, phase: str, day: str, source: str, kind: str, *lines: str) -> None:
    folder = root / phase
    folder.mkdir(exist_ok=True)
    (folder / f"{day}_crm_{source}_{kind}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")


@pytest.fixture
def landing(tmp_path):
    _file(tmp_path, "initial", "2024-01-01", "freg", "customers", FREG, f"{PER},PER,hansen,1990-01-01,NO,2024-01-01",
          "NULL,Jon,Berg,1990-01-01,NO,2024-01-01")
    _file(tmp_path, "update", "2024-02-01", "freg", "customers", FREG, f"{PER},Per,Hagen,1990-01-01,NO,2024-02-01")
    _file(tmp_path, "initial", "2024-01-01", "bs", "customers", CRM, f"{PER},Per,Hansen,+47 90000001,per@post.no,2024-01-01,BANK",
          f"{KARI},Kari,Lund,+4790000002,KARI@post.no,yesterday,BANK", f"{KARI},Kari,Lund,+4790000002,KARI@post.no,2024-01-01,INS")
    _file(tmp_path, "initial", "2024-01-01", "nice", "customers", CRM, "N/A,Liv,Dahl,+4790000003,liv@post.no,2024-01-01,BANK")
    _file(tmp_path, "update", "2024-03-01", "nice", "customers", CRM, "N/A,Liv,Quist,+4790000003,liv@post.no,2024-03-01,BANK")
    for source, key in (("freg", PER), ("bs", KARI)):
        _file(tmp_path, "initial", "2024-01-01", source, "addresses", ADDR, f'{source}-1,{key},"storgata 1",0150,oslo,no')
    # the CRM knows the address by the hash of the old name
    import hashlib
    old = hashlib.md5(b"LivDahl+4790000003").hexdigest()
    _file(tmp_path, "initial", "2024-01-01", "nice", "addresses", ADDR, f"n-1,{old},nygata 2,5003,bergen,no")
    return str(tmp_path)


def test_files_to_golden(spark, landing):
    sources = pipeline.read_sources(spark, landing)
    assert {(r["source"], x["field"], x["reason"]) for r in sources.rejects.collect() for x in r["_rejects"]} == {
        ("freg", "ssn", "missing"), ("bs", "record_date", "type")}
    out = pipeline.run(sources, blocks="parity", as_of="2024-06-01 00:00:00")
    golden = {(r["organization"], r["first_name"], r["last_name"]): r for r in out["golden"].collect()}
    # the registry goes to both organisations and its newest name wins; both names of Liv are customers of their own
    assert set(golden) == {("BANK", "Per", "Hagen"), ("INS", "Per", "Hagen"), ("INS", "Kari", "Lund"),
                           ("BANK", "Liv", "Dahl"), ("BANK", "Liv", "Quist")}
    assert golden["BANK", "Per", "Hagen"]["email"] == "per@post.no" and golden["BANK", "Per", "Hagen"]["source_count"] == 2
    assert {r["mdm_processed_date"] for r in golden.values()} == {dt.datetime(2024, 6, 1)}
    # every customer has one address, the renamed one by its alias
    addresses = out["address_golden"].collect()
    assert {(r["cluster_id"], r["organization"]) for r in addresses} == {(r["cluster_id"], r["organization"]) for r in golden.values()}
    assert len(addresses) == len(golden)
    liv = golden["BANK", "Liv", "Quist"]["cluster_id"]
    assert [r["gate"] for r in addresses if r["cluster_id"] == liv] == ["Nygata 2"]
    assert out["customer_360"].count() == len(golden) and out["history"].count() >= len(golden)
    assert out["clusters"].count() == out["xref"].count()
    # the extended blocks meet her two names by the phone
    merged = pipeline.run(sources, blocks="extended")["golden"].where("first_name = 'Liv'").collect()
    assert [r["last_name"] for r in merged] == ["Quist"]


def test_without_addresses(spark, landing):
    sources = pipeline.read_sources(spark, landing, addresses=False)
    out = pipeline.run(sources, blocks="parity", mode="one_hop")
    assert "address_golden" not in out and out["golden"].count() >= 4
    first = pipeline.run_ssn_first(sources)
    assert {r["match_method"] for r in first["groups"].select("match_method").distinct().collect()} <= {
        "SSN_EXACT", "INVALID_SSN", "FUZZY_JW", "UNMATCHED"}
    assert first["golden"].count() >= 0 and first["history"].count() >= 0 and first["steward_queue"].count() >= 2


def test_empty_feeds(spark, tmp_path):
    for source, head in (("freg", FREG), ("bs", CRM), ("nice", CRM)):
        _file(tmp_path, "initial", "2024-01-01", source, "customers", head)
        _file(tmp_path, "initial", "2024-01-01", source, "addresses", ADDR)
    out = pipeline.run(pipeline.read_sources(spark, str(tmp_path)))
    assert [out[x].count() for x in ("golden", "history", "address_golden", "customer_360", "steward_queue")] == [0] * 5


def test_a_missing_feed_is_an_error(spark, tmp_path):
    _file(tmp_path, "initial", "2024-01-01", "freg", "customers", FREG)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        pipeline.read_sources(spark, str(tmp_path))
