"""DuckDB SQL of the derived sources (the oracle side of :mod:`aurum.sources.derived`).

Used only by the correctness check: each oracle query is ``WITH`` these CTEs
followed by its own SQL over the driver's pre-registered tables.
"""

from __future__ import annotations

from aurum.sources.derived import CITIES, FIRST_NAMES, LAST_NAMES, MAIL_DOMAINS, STEWARD_NAMES, UPDATE_SHIFT_DAYS


def _lst(values) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def _ctl(expr: str) -> str:
    return f"(CASE WHEN ({expr}) % 11 <= 1 THEN 0 ELSE 11 - ({expr}) % 11 END)"


def source_ctes() -> str:
    d = ["(dd // 10)", "(dd % 10)", "(mm // 10)", "(mm % 10)", "(yy // 10)", "(yy % 10)",
         "(iii // 100)", "((iii // 10) % 10)", "(iii % 10)"]
    w1 = [3, 7, 6, 1, 8, 9, 4, 5, 2]
    w2 = [5, 4, 3, 2, 7, 6, 5, 4, 3]
    s1 = " + ".join(f"{w}*{x}" for w, x in zip(w1, d))
    c1 = _ctl(s1)
    s2 = " + ".join(f"{w}*{x}" for w, x in zip(w2, d)) + f" + 2*{c1}"
    c2 = _ctl(s2)
    sh = UPDATE_SHIFT_DAYS
    sf = _lst([s[0] for s in STEWARD_NAMES])
    sl = _lst([s[1] for s in STEWARD_NAMES])
    return f"""
p0 AS (
  SELECT c_custkey AS k,
         1 + (7*c_custkey) % 28 AS dd, 1 + (5*c_custkey) % 12 AS mm,
         40 + (11*c_custkey) % 60 AS yy, 1 + c_custkey % 499 AS iii
  FROM customer
),
persons AS (
  SELECT k,
    {_lst(FIRST_NAMES)}[k % 16 + 1] AS first,
    {_lst(LAST_NAMES)}[(k // 16) % 25 + 1] AS last,
    lpad(CAST(dd AS VARCHAR), 2, '0') || lpad(CAST(mm AS VARCHAR), 2, '0') || lpad(CAST(yy AS VARCHAR), 2, '0')
      || lpad(CAST(iii AS VARCHAR), 3, '0') || CAST({c1} AS VARCHAR) || CAST({c2} AS VARCHAR) AS ssn,
    make_date(1900 + yy, mm, dd) AS birth_date,
    CASE WHEN k % 10 = 8 THEN 'SE' WHEN k % 10 = 9 THEN 'PL' ELSE 'NO' END AS citizenship,
    '+47' || CAST(90000000 + k AS VARCHAR) AS phone,
    {_lst(MAIL_DOMAINS)}[(k // 5) % 5 + 1] AS domain,
    {_lst(LAST_NAMES)}[((k // 16) + 1) % 25 + 1] AS next_last
  FROM p0
),
freg_i AS (
  SELECT k, ssn, first AS first_name, last AS last_name, birth_date, citizenship,
         DATE '2023-01-01' + CAST(k % 365 AS INTEGER) AS record_date, next_last, 'initial' AS phase
  FROM persons WHERE k % 5 <= 2
),
freg_u AS (
  SELECT k, ssn, first_name, CASE WHEN k % 50 = 2 THEN next_last ELSE last_name END AS last_name,
         birth_date, citizenship, record_date + {sh} AS record_date, next_last, 'update' AS phase
  FROM freg_i WHERE k % 50 <= 2
),
freg AS (
  SELECT k, ssn, first_name, last_name, birth_date, citizenship, record_date,
         phase || '/' || strftime(record_date, '%Y-%m-%d') || '_crm_freg_customers.csv' AS _source_file
  FROM (SELECT * FROM freg_i UNION ALL SELECT * FROM freg_u)
),
bs_i AS (
  SELECT k, ssn, first AS first_name, last AS last_name, phone,
         lower(first) || '.' || lower(last) || CAST(k % 97 AS VARCHAR) || '@' || domain AS email,
         DATE '2023-06-01' + CAST(k % 365 AS INTEGER) AS record_date,
         unnest(CASE WHEN k % 15 = 0 THEN ['BANK', 'INS'] ELSE [CASE WHEN k % 2 = 0 THEN 'BANK' ELSE 'INS' END] END) AS organization,
         'initial' AS phase
  FROM persons WHERE k % 5 IN (0, 1, 3)
),
bs_u AS (
  SELECT k, ssn, first_name, last_name,
         CASE WHEN k % 50 = 0 THEN '+47' || CAST(80000000 + k AS VARCHAR) ELSE phone END AS phone,
         email, record_date + {sh} AS record_date, organization, 'update' AS phase
  FROM bs_i WHERE k % 50 <= 2
),
bs AS (
  SELECT k, ssn, first_name, last_name, phone, email, record_date, organization,
         phase || '/' || strftime(record_date, '%Y-%m-%d') || '_crm_bs_customers.csv' AS _source_file
  FROM (SELECT * FROM bs_i UNION ALL SELECT * FROM bs_u)
),
nice_i AS (
  SELECT k,
    CASE WHEN (k % 10 BETWEEN 2 AND 4) OR k % 100 = 4 THEN NULL ELSE ssn END AS ssn,
    CASE WHEN k % 100 = 4 THEN {sf}[(k // 100) % 5 + 1]
         WHEN k % 20 = 2 THEN substr(first, 1, 2) || substr(first, 4, 100)
         WHEN k % 9 = 0 THEN upper(first) ELSE first END AS first_name,
    CASE WHEN k % 100 = 4 THEN {sl}[(k // 100) % 5 + 1] ELSE last END AS last_name,
    CASE WHEN k % 7 = 0 THEN NULL ELSE '+47 ' || CAST(90000000 + k AS VARCHAR) END AS phone,
    CASE WHEN k % 11 = 0 THEN NULL
         ELSE lower(CASE WHEN k % 100 = 4 THEN {sf}[(k // 100) % 5 + 1] ELSE first END) || '.'
              || lower(CASE WHEN k % 100 = 4 THEN {sl}[(k // 100) % 5 + 1] ELSE last END)
              || CAST(k % 97 AS VARCHAR) || '@' || domain END AS email,
    DATE '2023-03-01' + CAST(k % 365 AS INTEGER) AS record_date,
    unnest(CASE WHEN k % 15 = 0 THEN ['BANK', 'INS'] ELSE [CASE WHEN k % 2 = 0 THEN 'BANK' ELSE 'INS' END] END) AS organization,
    next_last, 'initial' AS phase
  FROM persons WHERE k % 5 <> 1
),
nice_u AS (
  SELECT k, ssn, first_name, CASE WHEN k % 50 = 2 THEN next_last ELSE last_name END AS last_name,
         CASE WHEN k % 50 = 0 THEN '+47 ' || CAST(80000000 + k AS VARCHAR) ELSE phone END AS phone,
         email, record_date + {sh} AS record_date, organization, next_last, 'update' AS phase
  FROM nice_i WHERE k % 50 <= 2
),
nice AS (
  SELECT k, ssn, first_name, last_name, phone, email, record_date, organization,
         phase || '/' || strftime(record_date, '%Y-%m-%d') || '_crm_nice_customers.csv' AS _source_file
  FROM (SELECT * FROM nice_i UNION ALL SELECT * FROM nice_u)
),
{_addr_cte('FREG', 'freg', 'ssn')},
{_addr_cte('BS', 'bs', 'ssn')},
{_addr_cte('NICE', 'nice', "COALESCE(ssn, md5(COALESCE(trim(first_name), '') || COALESCE(trim(last_name), '') || COALESCE(regexp_replace(phone, '[^0-9+]', '', 'g'), '')))")},
overrides AS (
  SELECT
    CASE WHEN (n.k // 100) % 2 = 1 THEN n.nk ELSE p.ssn END AS source_key_a,
    CASE WHEN (n.k // 100) % 2 = 1 THEN p.ssn ELSE n.nk END AS source_key_b,
    'STEWARD_SPLIT' AS reason,
    'steward' AS created_by
  FROM (SELECT DISTINCT k, md5(COALESCE(trim(first_name), '') || COALESCE(trim(last_name), '')
                               || COALESCE(regexp_replace(phone, '[^0-9+]', '', 'g'), '')) AS nk
        FROM nice WHERE k % 100 = 3 AND _source_file LIKE 'initial/%') n
  JOIN persons p ON p.k = n.k
)"""


def _addr_cte(src: str, table: str, key_expr: str) -> str:
    low = src.lower()
    return f"""addr_{low}_i AS (
  SELECT k, record_date, '{src}-A-' || CAST(k AS VARCHAR) AS src_address_id, cust_key AS src_customer_id,
    'Storgata ' || CAST(1 + k % 120 AS VARCHAR) AS gate,
    CASE WHEN k % 40 = 1 THEN CAST(100 + k % 900 AS VARCHAR) ELSE lpad(CAST((k * 37) % 10000 AS VARCHAR), 4, '0') END AS postnummer,
    CASE WHEN k % 30 = 7 THEN NULL ELSE {_lst(CITIES)}[k % 4 + 1] END AS "by",
    'NO' AS land, 'initial' AS phase
  FROM (SELECT DISTINCT k, record_date, {key_expr} AS cust_key FROM {table} WHERE _source_file LIKE 'initial/%')
),
addr_{low} AS (
  SELECT k, src_address_id, src_customer_id, gate, postnummer, "by", land,
         phase || '/' || strftime(record_date, '%Y-%m-%d') || '_crm_{low}_addresses.csv' AS _source_file
  FROM (SELECT * FROM addr_{low}_i
        UNION ALL
        SELECT k, record_date + {UPDATE_SHIFT_DAYS}, src_address_id, src_customer_id,
               'Nygata ' || CAST(1 + k % 120 AS VARCHAR), postnummer, "by", land, 'update'
        FROM addr_{low}_i WHERE k % 50 = 0)
)"""
