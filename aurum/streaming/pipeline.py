"""Micro-batch resolution of CRM topics with ``foreachBatch`` (RT-02).

Every micro-batch runs the batch operators set-wise on the new messages:
map -> upsert latest state -> incremental clusters (never split) -> golden of
the touched clusters -> quality -> CDC events (golden + xref) -> dead letters
-> metrics. Tables are a delta log under a commit manifest
(:mod:`aurum.streaming.store`): a batch writes the rows it changes, and all of
its writes appear at once, so a replayed batch id (at-least-once delivery, lost
executor, restart) is a no-op, and a half-written one is run again (RT-04).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from aurum.plans import nrt
from aurum.sources.events import map_addresses, map_events
from aurum.streaming.store import Batch, StateStore

RAW_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("arrival_seq", T.LongType()),
    T.StructField("topic", T.StringType()), T.StructField("event_ts", T.TimestampNTZType()),
    T.StructField("payload", T.StringType()),
])


#: event times keep their microseconds in the JSON messages
TIME_FORMAT = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


KEY = ["source_system", "source_key"]


def process_batch(store: StateStore, batch: DataFrame, batch_id: int) -> None:
    """One micro-batch, set-wise (RT-02)."""
    if batch_id <= store.committed():
        return  # already committed: a replay of a finished batch is a no-op
    tx = store.begin(batch_id)
    recs, rejects = map_events(batch)
    recs, rejects = recs.checkpoint(), rejects.checkpoint()
    latest = nrt.upsert_latest(recs)
    old = tx.read("clusters")
    if old is None:
        changed = latest.checkpoint()
        delta = nrt.resolve(changed)
        old = delta.limit(0)
    else:
        # records whose stored version changes (out-of-order events are skipped)
        held = old.join(latest.select(*KEY), KEY, "left_semi")
        known = held.select(*KEY, F.col("event_ts").alias("_ts"), F.col("arrival_seq").alias("_seq"))
        changed = nrt.upsert_latest(latest, held).join(known, KEY, "left") \
            .where(F.col("_ts").isNull() | (F.col("event_ts") != F.col("_ts")) | (F.col("arrival_seq") != F.col("_seq"))).drop("_ts", "_seq").checkpoint()
        delta = nrt.assign_delta(old, changed)
    delta = delta.checkpoint()
    before_rows = old.join(delta.select(*KEY), KEY, "left_semi").checkpoint()
    tx.put("clusters", delta)
    clusters = tx.read("clusters")
    # a change is valid from the newest touched event of its cluster; an absorbed cluster closes with the one that took it
    touched = delta.join(changed.select(*KEY), KEY, "left_semi")
    changed_at = touched.groupBy("cluster_id").agg(F.max("event_ts").alias("changed_at")).checkpoint()
    moves = before_rows.select(*KEY, F.col("cluster_id").alias("closed")).join(delta.select(*KEY, "cluster_id"), KEY) \
        .where(F.col("closed") != F.col("cluster_id")).select("closed", "cluster_id").distinct().checkpoint()
    closed_at = moves.join(changed_at, "cluster_id").groupBy(F.col("closed").alias("cluster_id")).agg(F.max("changed_at").alias("changed_at"))
    all_at = changed_at.unionByName(closed_at).groupBy("cluster_id").agg(F.max("changed_at").alias("changed_at"))
    affected = changed_at.select("cluster_id").unionByName(moves.select(F.col("closed").alias("cluster_id"))).distinct().checkpoint()
    fresh = nrt.golden(clusters.join(affected, "cluster_id", "left_semi")).checkpoint()
    golden = tx.read("golden")
    before = (fresh.limit(0) if golden is None else golden.join(affected, "cluster_id", "left_semi")).checkpoint()
    events = nrt.golden_events(before, fresh, "1970-01-01 00:00:00").drop("valid_from") \
        .join(all_at.select(F.col("cluster_id").alias("customer_id"), F.col("changed_at").cast("timestamp").alias("valid_from")), "customer_id", "left").checkpoint()
    same = before.select("cluster_id", "row_hash")
    tx.put("golden", fresh.join(same, ["cluster_id", "row_hash"], "left_anti").select(*fresh.columns), before.join(fresh.select("cluster_id"), "cluster_id", "left_anti"))
    _addresses(tx, batch, clusters, affected)
    tx.log("cdc_golden", events)
    tx.log("cdc_xref", nrt.xref_events(before_rows, delta))
    tx.log("dead_letter", rejects)
    tx.log("metrics", _metrics(batch, recs, rejects, changed, events, fresh, moves))
    tx.commit()


def _addresses(tx: Batch, batch: DataFrame, clusters: DataFrame, affected: DataFrame) -> None:
    """Address stream (RT-08): keyed address state from its own topic; addresses of changed clusters and of
    clusters with a changed address are linked, survived and scored."""
    new = nrt.upsert_addresses(map_addresses(batch)).checkpoint()
    held = tx.read("addresses")
    if held is not None:
        new = nrt.upsert_addresses(new, held.join(new.select(*KEY), KEY, "left_semi")).checkpoint()
    tx.put("addresses", new)
    customer = new.select("source_system", F.col("source_customer_key").alias("source_key")).distinct()
    touched = affected.unionByName(clusters.join(customer, KEY, "left_semi").select("cluster_id")).distinct().checkpoint()
    fresh = nrt.address_golden(tx.read("addresses"), clusters.join(touched, "cluster_id", "left_semi")).checkpoint()
    tx.put("address_golden", fresh, touched.join(fresh.select("cluster_id"), "cluster_id", "left_anti"))


def _metrics(batch: DataFrame, recs: DataFrame, rejects: DataFrame, changed: DataFrame, events: DataFrame, fresh: DataFrame, moves: DataFrame) -> DataFrame:
    """Counters of a batch (RT-06): messages, state changes, golden changes and no-ops, merged clusters, and how far
    messages lie behind the newest of their batch (percentiles in seconds of event time)."""
    n = lambda df: df.agg(F.count("*")).scalar()
    end = recs.agg(F.max("event_ts").alias("end"))
    behind = recs.join(F.broadcast(end)).select((F.unix_micros(F.col("end").cast("timestamp")) - F.unix_micros(F.col("event_ts").cast("timestamp"))).alias("us"))
    shares = (0.5, 0.95, 0.99)
    # one histogram of the lags for all percentiles
    lag = behind.agg(F.percentile("us", list(shares)).alias("us")) \
        .select(*[(F.col("us")[i] / 1e6).alias(f"lag_p{round(100 * p)}_s") for i, p in enumerate(shares)])
    made = events.where(F.col("event_type") != "CLOSE")
    return lag.select(
        n(recs).alias("processed"), n(rejects).alias("rejected"), n(changed).alias("state_changes"), n(events).alias("golden_events"),
        (n(fresh) - n(made)).alias("golden_noops"), n(moves.select("closed").distinct()).alias("cluster_merges"), "lag_p50_s", "lag_p95_s", "lag_p99_s")


def run_stream(spark: SparkSession, in_dir: str, state_dir: str, checkpoint: str, files_per_batch: int | None = None) -> StreamingQuery:
    """Start the stream on folders of JSON message files; availableNow drains them and stops."""
    store = StateStore(spark, state_dir)
    limit = {} if files_per_batch is None else {"maxFilesPerTrigger": files_per_batch}
    src = spark.readStream.schema(RAW_SCHEMA).options(**limit, **TIME_FORMAT).json(in_dir)
    return (src.writeStream.foreachBatch(lambda df, bid: process_batch(store, df, bid))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def replay(spark: SparkSession, raw: DataFrame, base: str, ends: list[str]) -> StateStore:
    """A message log through a stream, in time order (RT-05): each event-time window becomes a folder of files,
    as many as its messages call for, and one micro-batch."""
    raw = raw.checkpoint()
    lo = None
    for k, end in enumerate(ends):
        part = raw.where(F.col("event_ts") < F.lit(end).cast("timestamp"))
        if lo is not None:
            part = part.where(F.col("event_ts") >= F.lit(lo).cast("timestamp"))
        part.write.options(**TIME_FORMAT).json(f"{base}/in/w{k}")
        run_stream(spark, f"{base}/in/*", f"{base}/state", f"{base}/ckpt").awaitTermination()
        lo = end
    return StateStore(spark, f"{base}/state")
