"""Streaming queries: the micro-batch pipeline end to end (RT-02, RT-04, RT-05,
RT-06, SNK-03, HS-06) and the layered batch run (SNK-05)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from aurum.plans import nrt, pairwise
from aurum.plans import nrt_sql as NS
from aurum.plans.catalog import register
from aurum.plans.layers import _MEMO
from aurum.session import shared_dir
from aurum.sources.events import raw_address_events, raw_events
from aurum.streaming.pipeline import RAW_SCHEMA, TIME_FORMAT, process_batch, replay

ENDS = nrt.BATCH_ENDS


def _run(spark, sf_dir, replay_last: bool = False):
    key = (spark.sparkContext.applicationId, "stream", sf_dir, replay_last)
    if key in _MEMO:
        return _MEMO[key]
    base = shared_dir(spark, f"stream/{uuid.uuid4().hex[:8]}")
    store = replay(spark, raw_events(spark, sf_dir).unionByName(raw_address_events(spark, sf_dir)), base, ENDS)
    if replay_last:
        # at-least-once delivery: the last batch arrives again under its id -> no-op
        last = store.committed()
        files = spark.read.schema(RAW_SCHEMA).options(**TIME_FORMAT) \
            .json(base + "/in/*").where(F.col("event_ts") >= F.lit(ENDS[-2]).cast("timestamp"))
        process_batch(store, files, last)
    _MEMO[key] = (store, store.committed())
    return _MEMO[key]


def _stream_sql() -> str:
    """The stream replayed in SQL: state, never-split clusters and golden records after every batch (suffix ``_b<i>``)."""
    out = [NS.events()]
    for i, end in enumerate(ENDS):
        out.append(NS.chain(f"_{i}", f"event_ts < TIMESTAMP '{end}'"))
        if i:
            out.append(f""",
touched_{i} AS (SELECT DISTINCT source_system || '|' || source_key AS node FROM nrt_recs
  WHERE event_ts >= TIMESTAMP '{ENDS[i - 1]}' AND event_ts < TIMESTAMP '{end}')""")
        edges = ["SELECT node_a AS s, node_b AS d FROM nrt_pairs_0"]
        for j in range(1, i + 1):
            edges.append(f"SELECT node_a, node_b FROM nrt_pairs_{j} WHERE node_a IN (SELECT node FROM touched_{j}) "
                         f"OR node_b IN (SELECT node FROM touched_{j})")
        out.append(f""",
e_b{i} AS ({' UNION '.join(edges)}),
u_b{i} AS (SELECT s, d FROM e_b{i} UNION SELECT d, s FROM e_b{i}),
reach_b{i}(s, d) AS (SELECT node, node FROM nrt_state_{i} UNION SELECT r.s, u.d FROM reach_b{i} r JOIN u_b{i} u ON r.d = u.s),
cl_b{i} AS (SELECT st.*, c.cluster_id FROM nrt_state_{i} st JOIN (SELECT s AS node, min(d) AS cluster_id FROM reach_b{i} GROUP BY s) c USING (node)),
{NS.gold(f'_b{i}', f'cl_b{i}')}""")
    last = len(ENDS) - 1
    return "".join(out) + f""",
st_cl AS (SELECT * FROM cl_b{last}),
nrt_gold_st AS (SELECT * FROM nrt_gold_b{last})"""


def _stream_events_sql() -> str:
    """Golden change events of every batch with their event time."""
    parts = []
    for i in range(len(ENDS)):
        old = f"nrt_gold_b{i - 1}" if i else "(SELECT * FROM nrt_gold_b0 WHERE FALSE)"
        since = f"WHERE event_ts >= TIMESTAMP '{ENDS[i - 1]}'" if i else ""
        closed = f"""UNION ALL SELECT o.cluster_id, a.ts_at FROM cl_b{i - 1} o JOIN cl_b{i} n USING (node)
    JOIN (SELECT cluster_id, max(event_ts) AS ts_at FROM cl_b{i} {since} GROUP BY 1) a ON a.cluster_id = n.cluster_id
    WHERE o.cluster_id <> n.cluster_id""" if i else ""
        parts.append(f"""SELECT COALESCE(n.cluster_id, o.cluster_id) AS customer_id,
  CASE WHEN n.row_hash IS NULL THEN 'CLOSE' WHEN o.row_hash IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS event_type,
  n.row_hash, o.row_hash AS previous_hash, t.ts_at AS valid_from
FROM nrt_gold_b{i} n FULL OUTER JOIN (SELECT cluster_id, row_hash FROM {old}) o ON n.cluster_id = o.cluster_id
LEFT JOIN (SELECT cluster_id, max(ts_at) AS ts_at FROM (SELECT cluster_id, event_ts AS ts_at FROM cl_b{i} {since} {closed}) GROUP BY 1) t
  ON t.cluster_id = COALESCE(n.cluster_id, o.cluster_id)
WHERE n.row_hash IS NULL OR o.row_hash IS NULL OR n.row_hash <> o.row_hash""")
    return _stream_sql() + ",\nst_events AS (" + "\nUNION ALL\n".join(parts) + ")"


@register("nrt_pipeline", _stream_sql() + "\nSELECT * FROM nrt_gold_st", "RT-02, CL-06, GD-03, RT-03")
def q_pipeline(spark, sf_dir):
    store, v = _run(spark, sf_dir)
    return store.read("golden", v)


@register("nrt_replay_idempotent", _stream_sql() + "\nSELECT * FROM nrt_gold_st", "RT-04")
def q_replay(spark, sf_dir):
    store, v = _run(spark, sf_dir, replay_last=True)
    return store.read("golden", v)


@register("nrt_dead_letter", NS.events() + "\nSELECT event_id, topic, reject_reason FROM nrt_rejects", "SNK-03, SRC-07")
def q_dlq(spark, sf_dir):
    store, _ = _run(spark, sf_dir)
    return store.table("dead_letter").select("event_id", "topic", "reject_reason")


def _metrics_sql() -> str:
    """Counters after every batch, from the replay in SQL."""
    parts = []
    for i, end in enumerate(ENDS):
        since = f"event_ts >= TIMESTAMP '{ENDS[i - 1]}' AND " if i else ""
        win = f"{since}event_ts < TIMESTAMP '{end}'"
        merges = f"(SELECT count(DISTINCT o.cluster_id) FROM cl_b{i - 1} o JOIN cl_b{i} n USING (node) WHERE o.cluster_id <> n.cluster_id)" if i else "0"
        noops = f"""(SELECT count(DISTINCT c.cluster_id) FROM cl_b{i} c JOIN nrt_gold_b{i} n USING (cluster_id) JOIN nrt_gold_b{i - 1} o USING (cluster_id)
    WHERE c.{since.replace(' AND ', '')} AND n.row_hash = o.row_hash)""" if i else "0"
        parts.append(f"""SELECT {i} AS batch_id, count(*) AS processed, (SELECT count(*) FROM nrt_rejects WHERE {win}) AS rejected,
  count(DISTINCT source_system || '|' || source_key) AS state_changes,
  (SELECT count(*) FROM st_events_b WHERE b = {i}) AS golden_events, {noops} AS golden_noops, {merges} AS cluster_merges,
  """ + ", ".join(f"quantile_cont(epoch_us((SELECT max(event_ts) FROM nrt_recs WHERE {win})) - epoch_us(event_ts), {p}) / 1e6 AS lag_p{round(100 * p)}_s"
                  for p in (0.5, 0.95, 0.99)) + f"\nFROM nrt_recs WHERE {win}")
    counts = [f"""SELECT {i} AS b FROM nrt_gold_b{i} n FULL OUTER JOIN {f'nrt_gold_b{i - 1}' if i else '(SELECT * FROM nrt_gold_b0 WHERE FALSE)'} o
  ON n.cluster_id = o.cluster_id WHERE n.row_hash IS NULL OR o.row_hash IS NULL OR n.row_hash <> o.row_hash""" for i in range(len(ENDS))]
    return _stream_sql() + ",\nst_events_b AS (" + " UNION ALL ".join(counts) + ")\n" + "\nUNION ALL\n".join(parts)


@register("nrt_metrics", _metrics_sql(), "RT-06, AG-17")
def q_metrics(spark, sf_dir):
    store, _ = _run(spark, sf_dir)
    return store.table("metrics").select("batch_id", "processed", "rejected", "state_changes", "golden_events", "golden_noops", "cluster_merges",
                                         "lag_p50_s", "lag_p95_s", "lag_p99_s")


@register("nrt_xref_mirror", _stream_sql() + "\nSELECT source_system, source_key, cluster_id AS customer_id FROM st_cl", "SNK-04, SNK-02, HS-09")
def q_xref_mirror(spark, sf_dir):
    """The cross-reference folded from the stream's ASSIGN / REASSIGN events."""
    store, _ = _run(spark, sf_dir)
    return nrt.apply_xref(store.table("cdc_xref"))


@register("nrt_stream_events", _stream_events_sql() + "\nSELECT * FROM st_events", "RT-03, SNK-01")
def q_stream_events(spark, sf_dir):
    """Golden change events as the stream wrote them, valid from the newest touched event."""
    store, _ = _run(spark, sf_dir)
    return store.table("cdc_golden").select("customer_id", "event_type", "row_hash", "previous_hash", "valid_from")


@register("history_stream_apply", _stream_events_sql() + """
SELECT customer_id, event_type, row_hash, previous_hash, valid_from, valid_to, valid_to IS NULL AS is_current
FROM (SELECT *, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS valid_to FROM st_events)
WHERE event_type <> 'CLOSE'""", "HS-06, SNK-04")
def q_hist_stream(spark, sf_dir):
    """SCD2 history folded from the stream's golden change events; a CLOSE ends the version before it."""
    from pyspark.sql import Window
    w = Window.partitionBy("customer_id").orderBy("valid_from")
    return q_stream_events(spark, sf_dir).withColumn("valid_to", F.lead("valid_from").over(w)) \
        .where(F.col("event_type") != "CLOSE").withColumn("is_current", F.col("valid_to").isNull()) \
        .select("customer_id", "event_type", "row_hash", "previous_hash", "valid_from", "valid_to", "is_current")


@register("nrt_replay", NS.events() + NS.chain("", "TRUE") + "\nSELECT * FROM nrt_gold", "RT-05, SRC-06")
def q_nrt_replay(spark, sf_dir):
    """Stored source state replayed as events in time order through a fresh stream."""
    state = nrt.state_all(spark, sf_dir)
    base = shared_dir(spark, f"replay/{uuid.uuid4().hex[:8]}")
    msgs = state.select(F.monotonically_increasing_id().alias("event_id"), F.col("arrival_seq"),
                        F.when(F.col("source_system") == "CRM_A", "topic.crm.a").when(F.col("source_system") == "CRM_B", "topic.crm.b")
                        .otherwise("topic.crm.c").alias("topic"), "event_ts",
                        F.to_json(F.struct(F.col("source_key").alias("src_customer_id"), F.col("source_key").alias("customer_key"),
                                           F.col("source_key").alias("ticket_customer_id"), "first_name", "last_name",
                                           F.concat_ws(" ", "first_name", "last_name").alias("name"),
                                           F.concat_ws(" ", "first_name", "last_name").alias("caller_name"),
                                           "email", F.col("email").alias("email_address"), F.col("email").alias("callback_email"),
                                           "phone", F.col("phone").alias("mobile"), F.col("phone").alias("callback_phone"))).alias("payload"))
    store = replay(spark, msgs, base, ENDS)
    return store.read("golden", store.committed())


@register("pipeline_run", pairwise.GOLD_SQL + """
SELECT 'raw_enriched' AS layer, count(*) AS row_count FROM v2_enriched UNION ALL SELECT 'agg_clusters', count(*) FROM v2_clusters
UNION ALL SELECT 'agg_golden', count(*) FROM v2_golden UNION ALL SELECT 'srv_customer_360', count(*) FROM v2_golden""", "SNK-05")
def q_pipeline_run(spark, sf_dir):
    """Layered refresh RAW -> AGG -> SRV written as Parquet tables under the shared folder."""
    base = shared_dir(spark, f"layers/{uuid.uuid4().hex[:8]}")
    enr, cl, gold, addr = pairwise.v2_chain(spark, sf_dir)
    out = []
    for name, df in [("raw_enriched", enr), ("agg_clusters", cl), ("agg_golden", gold),
                     ("srv_customer_360", pairwise.serving.customer_360(gold, pairwise.address_golden(addr, cl)))]:
        df.write.mode("overwrite").parquet(f"{base}/{name}")
        out.append(spark.read.parquet(f"{base}/{name}").agg(F.lit(name).alias("layer"), F.count("*").alias("row_count")))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


def _addr_sql() -> str:
    from aurum.sources.derived import CITIES
    k = "CAST(substr(source_key, 2) AS BIGINT)"
    return f""",
st_addr AS (
  SELECT cluster_id, source_system, 'ADDR-' || source_key AS source_key, event_ts,
    CASE WHEN source_system = 'CRM_C' AND {k} % 3 = 0 THEN 'Storg. ' ELSE 'Storgata ' END || CAST(1 + {k} % 120 AS VARCHAR) AS gate,
    lpad(CAST(({k} * 37) % 10000 AS VARCHAR), 4, '0') AS postnummer,
    CASE WHEN {k} % 30 = 7 THEN NULL ELSE {NS.lst(CITIES)}[{k} % 4 + 1] END AS "by", 'NO' AS land,
    CASE source_system WHEN 'CRM_A' THEN 1 WHEN 'CRM_B' THEN 2 WHEN 'CRM_C' THEN 3 ELSE 99 END AS p
  FROM st_cl
),
st_ag AS (
  SELECT cluster_id,
    first(gate ORDER BY CASE WHEN length(trim(COALESCE(gate, ''))) >= 3 THEN 0 ELSE 1 END, p, event_ts DESC, source_system, source_key) AS gate,
    first(postnummer ORDER BY CASE WHEN postnummer IS NOT NULL THEN 0 ELSE 1 END, p, event_ts DESC, source_system, source_key) AS postnummer,
    first("by" ORDER BY CASE WHEN "by" IS NOT NULL THEN 0 ELSE 1 END, p, event_ts DESC, source_system, source_key) AS "by",
    first(land ORDER BY CASE WHEN land IS NOT NULL THEN 0 ELSE 1 END, p, event_ts DESC, source_system, source_key) AS land
  FROM st_addr GROUP BY cluster_id
)
SELECT *, {NS.dq_score(NS.dq_address_terms())} AS dq_score FROM st_ag"""


@register("nrt_address_stream", _stream_sql() + _addr_sql(), "RT-08, RT-02")
def q_address_stream(spark, sf_dir):
    store, v = _run(spark, sf_dir)
    return store.read("address_golden", v).select("cluster_id", "gate", "postnummer", "by", "land", "dq_score")
