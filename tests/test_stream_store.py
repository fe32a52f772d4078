"""The delta log: a killed batch, what a batch writes, and which versions stay."""

import json

import pytest
from pyspark.sql import functions as F

from aurum.streaming import store as st
from aurum.streaming.pipeline import RAW_SCHEMA, process_batch
from aurum.streaming.store import KEYS, StateStore


def message(seq, key, first, last, email, phone, day):
    body = {"src_customer_id": key, "first_name": first, "last_name": last, "email": email, "phone": phone}
    return (seq, seq, "topic.crm.a", day, json.dumps(body))


def frame(spark, rows):
    raw = spark.createDataFrame(rows, "event_id long, arrival_seq long, topic string, day string, payload string")
    return raw.withColumn("event_ts", F.col("day").cast("timestamp_ntz")).select(*RAW_SCHEMA.names)


def first_load(n=40):
    return [message(i, f"A{i}", f"Kari{chr(97 + i % 26)}", f"Berg{chr(97 + i // 26)}", f"m{i}@x.no", f"+47900000{i:02d}", "2024-01-01") for i in range(n)]


def rows_of(store, name):
    df = store.read(name, store.committed())
    return sorted(map(str, (r.asDict() for r in df.select(*sorted(df.columns)).collect())))


def test_a_batch_killed_between_two_tables_runs_again(spark, tmp_path, monkeypatch):
    second = frame(spark, [message(100, "A3", "New", "Name", "m4@x.no", "+4799999999", "2024-01-05"), message(101, "A900", "Ny", "Kunde", None, None, "2024-01-05"),
                           message(102, "A5", "Old", "Event", None, None, "2023-01-01"), (103, 103, "topic.crm.a", "2024-01-05", "not json")])
    clean, killed = StateStore(spark, f"{tmp_path}/clean"), StateStore(spark, f"{tmp_path}/killed")
    for s in (clean, killed):
        process_batch(s, frame(spark, first_load()), 0)
    process_batch(clean, second, 1)
    before = {name: rows_of(killed, name) for name in KEYS}
    log = st.Batch.log

    def dies(self, table, df):
        if table == "cdc_xref":
            raise RuntimeError("executor lost")
        log(self, table, df)
    monkeypatch.setattr(st.Batch, "log", dies)
    with pytest.raises(RuntimeError):
        process_batch(killed, second, 1)
    monkeypatch.setattr(st.Batch, "log", log)
    # clusters and golden records of the batch are on disk, but nothing of it is seen
    assert killed.committed() == 0 and {name: rows_of(killed, name) for name in KEYS} == before
    process_batch(killed, second, 1)
    assert killed.committed() == 1 and all(rows_of(killed, name) == rows_of(clean, name) for name in KEYS)
    events = [sorted(map(str, s.table("cdc_golden").collect())) for s in (clean, killed)]
    assert events[0] == events[1] and len(events[0]) > 0
    assert len([f for f in killed.folders("cdc_golden") if f.startswith("000000000001")]) == 1  # the dead attempt's is gone
    process_batch(killed, second, 1)  # a finished batch again
    assert killed.committed() == 1

    # what a batch writes follows the batch: A3 moves to A4's cluster, A900 is new, A5's message is late
    written = clean.manifest(1)["written"]
    assert written["clusters"] <= 4 and written["golden"] <= 4 and clean.manifest(0)["written"]["clusters"] == 40
    m = clean.table("metrics").where("batch_id = 1").first()
    assert (m["processed"], m["rejected"], m["state_changes"], m["cluster_merges"]) == (3, 1, 2, 1)
    own = {r["source_key"]: r["cluster_id"] for r in clean.read("clusters", 1).collect()}
    assert own["A3"] == own["A4"] == "CRM_A|A3" and len(own) == 41


def test_deltas_are_folded_and_old_versions_go(spark, tmp_path):
    s = StateStore(spark, str(tmp_path / "fold"))
    for k in range(5):
        tx = s.begin(k)
        rows = [(f"c{i}", k) for i in range(8 if k == 0 else 2)]
        gone = spark.createDataFrame([("c7",)], "cluster_id string") if k == 2 else None
        tx.put("golden", spark.createDataFrame(rows, "cluster_id string, v int"), gone)
        tx.commit()
        want = {"c0": k, "c1": k} | {f"c{i}": 0 for i in range(2, 7 if k >= 2 else 8)}
        assert {r["cluster_id"]: r["v"] for r in s.read("golden", k).collect()} == want
        named = {f for m in (s.manifest(k), s.manifest(k - 1)) if m for f, _ in [m["state"]["golden"]["base"], *m["state"]["golden"]["deltas"]]}
        assert set(s.folders("golden")) == named
    assert any(f.endswith("-base") for f in s.folders("golden"))
    with pytest.raises(RuntimeError):  # the same batch committed twice
        tx = s.begin(4)
        tx.commit()
    with pytest.raises(LookupError):
        s.table("metrics")
