"""DuckDB oracle SQL of the stream rule set (explicit candidate pairs, recursive closure)."""

from __future__ import annotations

from aurum import rules
from aurum.plans.sqlfrag import dq_address_terms, dq_fired, dq_score, dq_stream_terms, lst, row_hash, s, soundex
from aurum.sources.derived import FIRST_NAMES, LAST_NAMES, MAIL_DOMAINS

DIG = lambda c: f"regexp_replace({c}, '[^0-9]', '', 'g')"


def events() -> str:
    first = f"{lst(FIRST_NAMES)}[k % 16 + 1]"
    last = f"{lst(LAST_NAMES)}[(k // 16) % 25 + 1]"
    dom = f"{lst(MAIL_DOMAINS)}[(k // 5) % 5 + 1]"
    phone = "(CASE WHEN event_id % 13 = 0 THEN '+478' ELSE '+479' END || lpad(CAST(k % 10000000 AS VARCHAR), 7, '0'))"
    return f"""
nrt_ev AS (
  SELECT event_id, ((event_id // 10) * 10) + 9 - event_id % 10 AS arrival_seq, ts AS event_ts,
    CASE event_type WHEN 'signup' THEN 'CRM_A' WHEN 'purchase' THEN 'CRM_B' WHEN 'click' THEN 'CRM_B'
                    WHEN 'view' THEN 'CRM_C' WHEN 'error' THEN 'CRM_C' END AS source_system,
    CASE event_type WHEN 'signup' THEN 'topic.crm.a' WHEN 'purchase' THEN 'topic.crm.b' WHEN 'click' THEN 'topic.crm.b'
                    WHEN 'view' THEN 'topic.crm.c' WHEN 'error' THEN 'topic.crm.c' END AS topic,
    user_id % (SELECT count(*) FROM customer) AS k
  FROM events
),
nrt_recs AS (
  SELECT event_id, arrival_seq, source_system, substr(source_system, 5, 1) || CAST(k AS VARCHAR) AS source_key,
    {first} AS first_name, {last} AS last_name,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE lower({first}) || '.' || lower({last}) || CAST(k % 97 AS VARCHAR) || '@' || {dom} END AS email,
    {phone} AS phone, event_ts, {first} AS canonical_first_name, {soundex(last)} AS block_soundex,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE '@' || {dom} END AS block_email_domain,
    right({DIG(phone)}, 4) AS block_phone_suffix
  FROM nrt_ev WHERE event_id % 97 <> 0 AND source_system IS NOT NULL
),
nrt_rejects AS (
  SELECT event_id, topic, event_ts, 'MALFORMED_OR_NO_KEY' AS reject_reason FROM nrt_ev WHERE event_id % 97 = 0
)"""


def _pair_scores(a: str, b: str) -> str:
    have = (f"{a}.canonical_first_name IS NOT NULL AND {b}.canonical_first_name IS NOT NULL AND {a}.last_name IS NOT NULL "
            f"AND {b}.last_name IS NOT NULL")
    jw = f"jaro_winkler_similarity({a}.canonical_first_name || ' ' || {a}.last_name, {b}.canonical_first_name || ' ' || {b}.last_name)"
    jwf = f"jaro_winkler_similarity(lower({a}.canonical_first_name), lower({b}.canonical_first_name))"
    pa, pb = f"replace({a}.phone, '+', '')", f"replace({b}.phone, '+', '')"
    w, least = rules.STREAM_SCORES, rules.FUZZY_NAME_LEAST
    return f"""
      CASE WHEN {a}.email IS NOT NULL AND {a}.email = {b}.email THEN {w["D01"]} ELSE 0.0 END AS score_d01,
      CASE WHEN {a}.phone IS NOT NULL AND {b}.phone IS NOT NULL AND length({pa}) >= 10 AND length({pb}) >= 10
                AND right({pa}, 10) = right({pb}, 10) THEN {w["D02"]} ELSE 0.0 END AS score_d02,
      CASE WHEN {have} AND lower({a}.canonical_first_name) = lower({b}.canonical_first_name)
                AND lower({a}.last_name) = lower({b}.last_name) THEN {w["C01"]} ELSE 0.0 END AS score_c01,
      CASE WHEN {have} AND {jw} >= {least} THEN {jw} * {w["P01"]} ELSE 0.0 END AS score_p01,
      CASE WHEN {a}.block_soundex IS NOT NULL AND {a}.block_soundex = {b}.block_soundex THEN {w["P03"]} ELSE 0.0 END AS score_p03,
      CASE WHEN strpos({a}.email, '@') > 0 AND strpos({b}.email, '@') > 0
                AND substr({a}.email, strpos({a}.email, '@')) = substr({b}.email, strpos({b}.email, '@'))
                AND {a}.canonical_first_name IS NOT NULL AND {b}.canonical_first_name IS NOT NULL AND {jwf} >= {rules.STREAM_FIRST_NAME_LEAST}
           THEN {w["P04"]} ELSE 0.0 END AS score_p04"""


TOTAL = "greatest(score_d01, score_d02, score_c01) + score_p01 + score_p03 + score_p04"


def chain(sfx: str, where: str) -> str:
    """State, matched pairs, closure, clusters and golden for the events passing ``where``."""
    return f""",
nrt_state{sfx} AS (
  SELECT * EXCLUDE (rn), source_system || '|' || source_key AS node FROM (
    SELECT *, row_number() OVER (PARTITION BY source_system, source_key ORDER BY event_ts DESC, arrival_seq DESC) AS rn
    FROM nrt_recs WHERE {where}) WHERE rn = 1
),
nrt_pairs{sfx} AS (
  SELECT node_a, node_b, {TOTAL} AS total_score, * EXCLUDE (node_a, node_b) FROM (
    SELECT a.node AS node_a, b.node AS node_b, {_pair_scores('a', 'b')}
    FROM nrt_state{sfx} a JOIN nrt_state{sfx} b ON a.node < b.node
     AND ((a.block_soundex IS NOT NULL AND a.block_soundex = b.block_soundex)
       OR (a.block_email_domain IS NOT NULL AND a.block_email_domain = b.block_email_domain)
       OR (a.block_phone_suffix IS NOT NULL AND a.block_phone_suffix = b.block_phone_suffix)))
  WHERE {TOTAL} >= {rules.MATCH_THRESHOLD}
),
nrt_und{sfx} AS (SELECT node_a AS s, node_b AS d FROM nrt_pairs{sfx} UNION SELECT node_b, node_a FROM nrt_pairs{sfx}),
nrt_reach{sfx}(s, d) AS (
  SELECT node, node FROM nrt_state{sfx}
  UNION SELECT r.s, u.d FROM nrt_reach{sfx} r JOIN nrt_und{sfx} u ON r.d = u.s
),
nrt_cl{sfx} AS (
  SELECT st.*, c.cluster_id FROM nrt_state{sfx} st JOIN (SELECT s AS node, min(d) AS cluster_id FROM nrt_reach{sfx} GROUP BY s) c USING (node)
),
{gold(sfx, f"nrt_cl{sfx}")}"""


def gold(sfx: str, cl: str) -> str:
    """Golden + quality + hash over a clustered state CTE ``cl``."""
    prio = "CASE source_system WHEN 'CRM_A' THEN 1 WHEN 'CRM_B' THEN 2 WHEN 'CRM_C' THEN 3 ELSE 99 END"

    def pick(col, valid):
        return (f"first({col} ORDER BY CASE WHEN {valid} THEN 0 ELSE 1 END, CASE WHEN {valid} THEN {prio} ELSE 0 END, "
                f"event_ts DESC, source_system, source_key) FILTER (WHERE {col} IS NOT NULL AND length({col}) > 0) AS {col}")

    terms = dq_stream_terms()
    return f"""nrt_g0{sfx} AS (
  SELECT cluster_id,
    {pick('first_name', 'length(trim(first_name)) > 1')},
    {pick('last_name', 'length(trim(last_name)) > 1')},
    {pick('email', "strpos(email, '@') > 0")},
    {pick('phone', f"length({DIG('phone')}) >= 7")},
    count(DISTINCT source_system) AS source_count
  FROM {cl} GROUP BY cluster_id
),
nrt_gold{sfx} AS (
  SELECT cluster_id, first_name, last_name, email, phone, dq_score, source_count,
         {row_hash(['first_name', 'last_name', 'email', 'phone', 'dq_score', 'source_count'], '|')} AS row_hash
  FROM (SELECT *, {dq_score(terms)} AS dq_score FROM nrt_g0{sfx})
)"""


def golden_events_sql(old: str, new: str, as_of: str) -> str:
    return f"""SELECT COALESCE(n.cluster_id, o.cluster_id) AS customer_id,
  CASE WHEN n.row_hash IS NULL THEN 'CLOSE' WHEN o.row_hash IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS event_type,
  n.first_name, n.last_name, n.email, n.phone, n.dq_score, n.source_count, n.row_hash, o.row_hash AS previous_hash,
  TIMESTAMP '{as_of}' AS valid_from
FROM {new} n FULL OUTER JOIN (SELECT cluster_id, row_hash FROM {old}) o ON n.cluster_id = o.cluster_id
WHERE n.row_hash IS NULL OR o.row_hash IS NULL OR n.row_hash <> o.row_hash"""


__all__ = ["events", "chain", "golden_events_sql", "dq_fired", "s", "lst", "dq_score", "dq_address_terms"]
