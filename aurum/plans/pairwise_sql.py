"""DuckDB oracle SQL of the pairwise rule set: literal blocked self-join with
OR-blocking, explicit pair scoring, recursive transitive closure."""

from __future__ import annotations

from aurum import rules
from aurum.plans.sqlfrag import date_valid, dq_address_terms, dq_bulk_terms, dq_fired, dq_score, initcap_word, s, soundex, values_table

D = dict(rules.PAIR_SCORES)
IC = lambda c: initcap_word(f"trim({c})")
DIG = lambda c: f"regexp_replace({c}, '[^0-9]', '', 'g')"


def _enrichment(canonical: str) -> str:
    """Columns and source of ``v2_enriched``: initcap names, or nicknames with the fake-name flag."""
    if canonical == "initcap":
        return f"{IC('first_name')} AS canonical_first_name, FALSE AS is_fake_name FROM v2_union"
    fake = ", ".join(s(t) for t in rules.FAKE_TOKENS)
    return f"""CASE WHEN length(trim(first_name)) > 1 THEN {IC('COALESCE(n.canonical, trim(first_name))')} ELSE first_name END AS canonical_first_name,
         COALESCE(upper(trim(first_name)) IN ({fake}), FALSE) OR COALESCE(upper(trim(last_name)) IN ({fake}), FALSE)
         OR COALESCE(regexp_matches(concat_ws(' ', first_name, last_name), '[0-9]'), FALSE) AS is_fake_name
  FROM v2_union LEFT JOIN {values_table(rules.NICKNAMES, ['nickname', 'canonical'], 'n')} ON upper(trim(first_name)) = n.nickname"""


def base(canonical: str = "initcap") -> str:
    return f"""
v2_union AS (
  SELECT 'FREG' AS source_system, ssn AS source_key, ssn, {IC('first_name')} AS first_name, {IC('last_name')} AS last_name,
         birth_date, citizenship, CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS email, record_date, o.organization, _source_file
  FROM freg CROSS JOIN (VALUES ('BANK'), ('INS')) AS o(organization)
  UNION ALL
  SELECT 'BS', ssn, ssn, {IC('first_name')}, {IC('last_name')}, CAST(NULL AS DATE), CAST(NULL AS VARCHAR),
         regexp_replace(phone, '[^0-9+]', '', 'g'), lower(trim(email)), record_date, organization, _source_file FROM bs
  UNION ALL
  SELECT 'NICE', COALESCE(ssn, md5(COALESCE(trim(first_name), '') || COALESCE(trim(last_name), '')
                                   || COALESCE(regexp_replace(phone, '[^0-9+]', '', 'g'), ''))),
         ssn, {IC('first_name')}, {IC('last_name')}, CAST(NULL AS DATE), CAST(NULL AS VARCHAR),
         regexp_replace(phone, '[^0-9+]', '', 'g'), lower(trim(email)), record_date, organization, _source_file FROM nice
),
v2_enriched AS (
  SELECT v2_union.*, {date_valid('ssn')} AS ssn_valid, {_enrichment(canonical)}
),
v2_base AS (
  SELECT *, concat_ws('|', organization, source_system, source_key) AS node, {soundex('last_name')} AS sdx,
         substr(CAST(birth_date AS VARCHAR), 1, 4) AS yr,
         CASE WHEN phone IS NOT NULL AND length({DIG('phone')}) >= 8 THEN right({DIG('phone')}, 8) END AS ph8
  FROM (SELECT DISTINCT organization, source_system, source_key, ssn, first_name, last_name, birth_date,
                        canonical_first_name, phone, email FROM v2_enriched)
)"""


def _score_cols(a: str, b: str) -> str:
    names_eq = (f"lower(trim(COALESCE({a}.canonical_first_name, ''))) = lower(trim(COALESCE({b}.canonical_first_name, ''))) "
                f"AND lower(trim(COALESCE({a}.last_name, ''))) = lower(trim(COALESCE({b}.last_name, '')))")
    have = (f"{a}.canonical_first_name IS NOT NULL AND {b}.canonical_first_name IS NOT NULL "
            f"AND {a}.last_name IS NOT NULL AND {b}.last_name IS NOT NULL")
    jw = (f"jaro_winkler_similarity({a}.canonical_first_name || ' ' || {a}.last_name, "
          f"{b}.canonical_first_name || ' ' || {b}.last_name)")
    return f"""
    CASE WHEN {a}.ssn IS NOT NULL AND {a}.ssn = {b}.ssn AND {names_eq} THEN {D["D01"]} ELSE 0.0 END AS score_d01,
    CASE WHEN {a}.ssn IS NOT NULL AND {a}.ssn = {b}.ssn AND NOT ({names_eq}) THEN {D["D01b"]} ELSE 0.0 END AS score_d01b,
    CASE WHEN {a}.phone IS NOT NULL AND {b}.phone IS NOT NULL AND length({DIG(a + '.phone')}) >= 8 AND length({DIG(b + '.phone')}) >= 8
              AND right({DIG(a + '.phone')}, 8) = right({DIG(b + '.phone')}, 8) THEN {D["D02"]} ELSE 0.0 END AS score_d02,
    CASE WHEN {have} AND {jw} >= {rules.FUZZY_NAME_LEAST} THEN {jw} * {rules.FUZZY_NAME_WEIGHT} ELSE 0.0 END AS score_fuzzy_name,
    CASE WHEN {a}.sdx IS NOT NULL AND {a}.sdx = {b}.sdx THEN {rules.SOUNDEX_BONUS} ELSE 0.0 END AS score_soundex"""


TOTAL = "greatest(score_d01, score_d01b, score_d02) + score_fuzzy_name + score_soundex"
MTYPE = ("CASE " + " ".join(f"WHEN score_{name.lower()} >= {score} THEN '{name}'" for name, score in rules.PAIR_SCORES)
         + " WHEN score_fuzzy_name > 0.0 THEN 'FUZZY' ELSE 'OTHER' END")


def clusters(blocks: str = "parity", mode: str = "one_hop", canonical: str = "initcap") -> str:
    cond = ("(a.ssn IS NOT NULL AND b.ssn IS NOT NULL AND a.ssn = b.ssn) "
            "OR (a.sdx IS NOT NULL AND a.sdx = b.sdx AND a.yr IS NOT NULL AND a.yr = b.yr)")
    if blocks == "extended":
        cond += " OR (a.sdx IS NOT NULL AND a.sdx = b.sdx) OR (a.ph8 IS NOT NULL AND a.ph8 = b.ph8)"
    sql = base(canonical) + f""",
v2_scored AS (
  SELECT a.node AS node_a, b.node AS node_b, a.source_key AS key_a, b.source_key AS key_b, {_score_cols('a', 'b')}
  FROM v2_base a JOIN v2_base b ON a.organization = b.organization
   AND (a.source_system < b.source_system OR (a.source_system = b.source_system AND a.source_key < b.source_key))
   AND ({cond})
),
v2_over AS (
  SELECT *, {TOTAL} AS total_score, {MTYPE} AS match_type,
         EXISTS (SELECT 1 FROM overrides o WHERE (o.source_key_a = key_a AND o.source_key_b = key_b)
                                              OR (o.source_key_a = key_b AND o.source_key_b = key_a)) AS parted
  FROM v2_scored WHERE {TOTAL} >= {rules.MATCH_THRESHOLD}
),
v2_matches AS (SELECT * EXCLUDE (parted) FROM v2_over WHERE NOT parted),
v2_parted AS (SELECT node_a AS node FROM v2_over WHERE parted UNION SELECT node_b FROM v2_over WHERE parted),
v2_und AS (
  SELECT DISTINCT node_a AS s, node_b AS d FROM v2_matches UNION SELECT node_b, node_a FROM v2_matches
),
v2_nodes AS (
  SELECT DISTINCT node, organization, source_system, source_key, ssn FROM v2_base
),
v2_onehop AS (
  SELECT n.*, min(u.d) AS best_neighbor FROM v2_nodes n LEFT JOIN v2_und u ON u.s = n.node
  GROUP BY ALL
),"""
    if mode == "transitive":
        sql += """
v2_reach(s, d) AS (
  SELECT node, node FROM v2_nodes
  UNION
  SELECT r.s, u.d FROM v2_reach r JOIN v2_und u ON r.d = u.s
),
v2_cid AS (SELECT s AS node, min(d) AS cluster_id FROM v2_reach GROUP BY s),"""
    else:
        sql += """
v2_cid AS (SELECT node, least(node, COALESCE(best_neighbor, node)) AS cluster_id FROM v2_onehop),"""
    sql += f"""
v2_best AS (
  SELECT node, first(match_type ORDER BY total_score DESC, match_type) AS match_type, max(total_score) AS total_score
  FROM (SELECT node_a AS node, match_type, total_score FROM v2_matches UNION ALL SELECT node_b, match_type, total_score FROM v2_matches)
  GROUP BY node
),
v2_clusters AS (
  SELECT n.source_system, n.source_key, n.organization, c.cluster_id,
         COALESCE(b.match_type, 'SINGLETON') AS match_type, round(b.total_score, 6) AS match_score,
         CASE WHEN p.node IS NOT NULL THEN 'UNMERGE' WHEN b.match_type IS NULL AND n.ssn IS NULL THEN 'STEWARD_QUEUE' ELSE 'MATCHED' END AS match_status
  FROM v2_nodes n JOIN v2_cid c ON c.node = n.node LEFT JOIN v2_best b ON b.node = n.node LEFT JOIN v2_parted p ON p.node = n.node
)"""
    return sql


def _rank(table: dict[str, int]) -> str:
    return "(CASE source_system " + " ".join(f"WHEN '{name}' THEN {rank}" for name, rank in table.items()) + " ELSE 3 END)"


def _priority(bank: dict[str, int], ins: dict[str, int]) -> str:
    return f"CASE WHEN organization = 'BANK' THEN {_rank(bank)} ELSE {_rank(ins)} END"


def golden() -> str:
    tie = "record_date DESC, source_system, source_key, _source_file"
    prio = _priority(rules.PRIORITY_BANK, rules.PRIORITY_INS)
    cprio = _priority(rules.CITIZENSHIP_PRIORITY_BANK, rules.CITIZENSHIP_PRIORITY_INS)

    def f(col, valid, p="prio"):
        return f"first({col} ORDER BY CASE WHEN {valid} THEN 0 ELSE 1 END, {p}, {tie}) AS {col}"

    terms = dq_bulk_terms()
    return f""",
v2_grouped AS (
  SELECT e.*, c.cluster_id, {prio} AS prio, {cprio} AS cprio
  FROM v2_enriched e JOIN v2_clusters c USING (source_system, source_key, organization)
),
v2_gold0 AS (
  SELECT cluster_id, organization,
    {f('ssn', 'ssn IS NOT NULL')},
    {f('first_name', "length(trim(COALESCE(first_name, ''))) > 1")},
    {f('last_name', "length(trim(COALESCE(last_name, ''))) > 1")},
    {f('birth_date', 'birth_date IS NOT NULL')},
    {f('citizenship', 'citizenship IS NOT NULL', 'cprio')},
    {f('phone', "phone IS NOT NULL AND length(regexp_replace(phone, '[^0-9]', '', 'g')) >= 8")},
    {f('email', "email LIKE '%@%'")},
    first(record_date ORDER BY prio, {tie}) AS record_date,
    count(DISTINCT source_system) AS source_count, bool_or(is_fake_name) AS is_fake_name, bool_or(ssn_valid) AS ssn_valid
  FROM v2_grouped GROUP BY cluster_id, organization
),
v2_golden AS (
  SELECT cluster_id, organization, ssn, first_name, last_name, birth_date, citizenship, phone, email, record_date,
         source_count, is_fake_name, ssn_valid, {dq_score(terms)} AS dq_score, {dq_fired(terms)} AS dq_fired_rules
  FROM v2_gold0
)"""


def addresses() -> str:
    def one(src, tbl):
        return (f"SELECT '{src}' AS source_system, src_address_id AS source_key, src_customer_id AS source_customer_key, "
                f"{IC('gate')} AS gate, trim(postnummer) AS postnummer, {IC('\"by\"')} AS \"by\", upper(trim(land)) AS land, "
                f"o.organization, _source_file, CAST(regexp_extract(_source_file, '(\\d{{4}}-\\d{{2}}-\\d{{2}})_crm_', 1) AS DATE) AS file_date "
                f"FROM {tbl} CROSS JOIN (VALUES ('BANK'), ('INS')) AS o(organization)")
    priority = " ".join(f"WHEN '{k}' THEN {v}" for k, v in rules.ADDRESS_PRIORITY.items())
    return f""",
a2_union AS (
  {one('FREG', 'addr_freg')}
  UNION ALL {one('BS', 'addr_bs')}
  UNION ALL {one('NICE', 'addr_nice')}
),
a2_contact AS (
  SELECT DISTINCT source_system, source_key, lower(trim(first_name)) AS first, phone, email FROM v2_enriched
  WHERE ssn IS NULL AND length(trim(first_name)) > 0
),
a2_pair AS (
  SELECT DISTINCT a.source_system, a.source_key AS x, b.source_key AS y FROM a2_contact a
  JOIN a2_contact b ON a.source_system = b.source_system AND a.first = b.first
  WHERE (a.phone = b.phone AND length(trim(a.phone)) > 0) OR (a.email = b.email AND length(trim(a.email)) > 0)
),
a2_reach AS (
  SELECT source_system, x, y FROM a2_pair
  UNION SELECT r.source_system, r.x, p.y FROM a2_reach r JOIN a2_pair p ON p.source_system = r.source_system AND p.x = r.y
),
a2_own AS (SELECT source_system, source_customer_key AS owner, max(file_date) AS newest FROM a2_union GROUP BY 1, 2),
a2_link AS (
  SELECT r.source_system, r.x AS source_key, first(o.owner ORDER BY o.newest DESC, o.owner) AS owner_key
  FROM a2_reach r JOIN a2_own o ON o.source_system = r.source_system AND o.owner = r.y
  WHERE NOT EXISTS (SELECT 1 FROM a2_own n WHERE n.source_system = r.source_system AND n.owner = r.x)
  GROUP BY 1, 2
),
a2_known AS (
  SELECT * FROM a2_union
  UNION ALL SELECT u.* REPLACE (l.source_key AS source_customer_key) FROM a2_union u
  JOIN a2_link l ON l.source_system = u.source_system AND l.owner_key = u.source_customer_key
),
a2_grouped AS (
  SELECT a.*, c.cluster_id, CASE a.source_system {priority} END AS prio
  FROM a2_known a JOIN v2_clusters c ON c.source_system = a.source_system AND c.source_key = a.source_customer_key
   AND c.organization = a.organization
)"""


def address_golden() -> str:
    tie = "file_date DESC, source_system, source_key, _source_file"
    terms = dq_address_terms()
    return addresses() + f""",
a2_gold0 AS (
  SELECT cluster_id, organization,
    first(gate ORDER BY CASE WHEN length(trim(COALESCE(gate, ''))) >= 3 THEN 0 ELSE 1 END, prio, {tie}) AS gate,
    first(postnummer ORDER BY CASE WHEN postnummer IS NOT NULL THEN 0 ELSE 1 END, prio, {tie}) AS postnummer,
    first("by" ORDER BY CASE WHEN "by" IS NOT NULL THEN 0 ELSE 1 END, prio, {tie}) AS "by",
    first(land ORDER BY CASE WHEN land IS NOT NULL THEN prio ELSE 99 END, {tie}) AS land,
    max(file_date) AS last_updated, count(*) AS source_rows
  FROM a2_grouped GROUP BY cluster_id, organization
),
a2_golden AS (
  SELECT cluster_id, organization, 'PRIMARY' AS address_type, gate, postnummer, "by", land, TRUE AS is_primary,
         last_updated, {dq_score(terms)} AS dq_score, {dq_fired(terms)} AS dq_fired_rules
  FROM a2_gold0
)"""


def history() -> str:
    """Snapshots at every record date by the literal triangular join (oracle only)."""
    tie = "g.record_date DESC, g.source_system, g.source_key, g._source_file"

    def f(col, valid, p="g.prio"):
        return f"first(g.{col} ORDER BY CASE WHEN {valid} THEN 0 ELSE 1 END, {p}, {tie}) AS {col}"

    terms = dq_bulk_terms()
    from aurum.plans.sqlfrag import row_hash
    tracked = ["ssn", "first_name", "last_name", "birth_date", "citizenship", "phone", "email", "dq_score"]
    return f""",
h2_b AS (SELECT DISTINCT cluster_id, organization, record_date AS snapshot_date FROM v2_grouped),
h2_s0 AS (
  SELECT b.cluster_id, b.organization, b.snapshot_date,
    {f('ssn', 'g.ssn IS NOT NULL')},
    {f('first_name', "length(trim(COALESCE(g.first_name, ''))) > 1")},
    {f('last_name', "length(trim(COALESCE(g.last_name, ''))) > 1")},
    {f('birth_date', 'g.birth_date IS NOT NULL')},
    {f('citizenship', 'g.citizenship IS NOT NULL', 'g.cprio')},
    {f('phone', "g.phone IS NOT NULL AND length(regexp_replace(g.phone, '[^0-9]', '', 'g')) >= 8")},
    {f('email', "g.email LIKE '%@%'")},
    count(DISTINCT g.source_system) AS source_count, bool_or(g.is_fake_name) AS is_fake_name, bool_or(g.ssn_valid) AS ssn_valid
  FROM h2_b b JOIN v2_grouped g ON g.cluster_id = b.cluster_id AND g.organization = b.organization AND g.record_date <= b.snapshot_date
  GROUP BY 1, 2, 3
),
h2_s AS (SELECT *, {dq_score(terms)} AS dq_score FROM h2_s0),
h2_h AS (SELECT *, {row_hash(tracked, '|')} AS row_hash FROM h2_s),
h2_kept AS (
  SELECT * FROM (SELECT *, lag(row_hash) OVER (PARTITION BY cluster_id, organization ORDER BY snapshot_date) AS prev FROM h2_h)
  WHERE row_hash <> COALESCE(prev, '')
),
v2_history AS (
  SELECT cluster_id, organization, ssn, first_name, last_name, birth_date, citizenship, phone, email, dq_score, source_count,
         snapshot_date AS valid_from, COALESCE(lead(snapshot_date) OVER w, DATE '9999-12-31') AS valid_to,
         lead(snapshot_date) OVER w IS NULL AS is_valid, row_hash
  FROM h2_kept WINDOW w AS (PARTITION BY cluster_id, organization ORDER BY snapshot_date)
)"""


def address_history() -> str:
    tie = "g.file_date DESC, g.source_system, g.source_key, g._source_file"
    terms = dq_address_terms()
    from aurum.plans.sqlfrag import row_hash
    tracked = ["address_type", "gate", "postnummer", '"by"', "land", "is_primary", "dq_score"]
    return f""",
ah_b AS (SELECT DISTINCT cluster_id, organization, file_date AS snapshot_date FROM a2_grouped),
ah_s0 AS (
  SELECT b.cluster_id, b.organization, b.snapshot_date,
    first(g.gate ORDER BY CASE WHEN length(trim(COALESCE(g.gate, ''))) >= 3 THEN 0 ELSE 1 END, g.prio, {tie}) AS gate,
    first(g.postnummer ORDER BY CASE WHEN g.postnummer IS NOT NULL THEN 0 ELSE 1 END, g.prio, {tie}) AS postnummer,
    first(g."by" ORDER BY CASE WHEN g."by" IS NOT NULL THEN 0 ELSE 1 END, g.prio, {tie}) AS "by",
    first(g.land ORDER BY CASE WHEN g.land IS NOT NULL THEN g.prio ELSE 99 END, {tie}) AS land
  FROM ah_b b JOIN a2_grouped g ON g.cluster_id = b.cluster_id AND g.organization = b.organization AND g.file_date <= b.snapshot_date
  GROUP BY 1, 2, 3
),
ah_s AS (SELECT *, 'PRIMARY' AS address_type, TRUE AS is_primary, {dq_score(terms)} AS dq_score FROM ah_s0),
ah_h AS (SELECT *, {row_hash(tracked, '|').replace('CAST(is_primary AS VARCHAR)', "CASE WHEN is_primary THEN 'true' ELSE 'false' END")} AS row_hash FROM ah_s),
ah_kept AS (
  SELECT * FROM (SELECT *, lag(row_hash) OVER (PARTITION BY cluster_id, organization ORDER BY snapshot_date) AS prev FROM ah_h)
  WHERE row_hash <> COALESCE(prev, '')
),
a2_history AS (
  SELECT cluster_id, organization, address_type, gate, postnummer, "by", land, is_primary, dq_score,
         snapshot_date AS valid_from, COALESCE(lead(snapshot_date) OVER w, DATE '9999-12-31') AS valid_to,
         lead(snapshot_date) OVER w IS NULL AS is_valid, row_hash
  FROM ah_kept WINDOW w AS (PARTITION BY cluster_id, organization ORDER BY snapshot_date)
)"""
