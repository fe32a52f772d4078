"""Rules on damaged records (DQ-*, SC-*, FN-09) and raw-format gates on all feeds (CK-06).

The derived feeds are clean, so many rules never fire on them. Here every record of a table is damaged in one of a few
ways, chosen by a hash of its key, and the engine of the rules scores it. The damage is a fixture: expressions that Spark
and DuckDB read alike. The rules themselves are stated once for each engine, as elsewhere.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum import functions as AF
from aurum import rules
from aurum.operators import checks as C
from aurum.operators.quality import address_rules, customer_rules_bulk, customer_rules_stream, score_quality
from aurum.operators.scoring import pairwise_rules, pairwise_total, stream_rules, stream_total
from aurum.plans import inputs, nrt, pairwise
from aurum.plans import nrt_sql as NS
from aurum.plans import pairwise_sql as PS
from aurum.plans.catalog import register
from aurum.plans.sqlfrag import date_valid, dq_address_terms, dq_bulk_terms, dq_fired, dq_score, dq_stream_terms, s, soundex

WAYS = 16  # a key is damaged in way md5 % WAYS; ways that a table doesn't name leave the record as it is

CUSTOMER_DAMAGE = {
    "email": {0: "NULL", 1: "'not-an-address'", 2: "'x@Mailinator.com'", 3: "''", 12: "NULL"},
    "first_name": {4: "'A'", 5: "'P3r'", 6: "NULL", 11: "'  '"},
    "last_name": {7: "NULL", 8: "'Ols#n'", 11: "''"},
    "phone": {9: "'+4712'", 10: "'11111111111'", 13: "'1234567890'", 12: "'12'", 3: "''"},
}
BULK_DAMAGE = CUSTOMER_DAMAGE | {"ssn_valid": {14: "FALSE"}, "is_fake_name": {15: "TRUE"}}
ADDRESS_DAMAGE = {
    "gate": {0: "NULL", 1: "'ab'", 2: "'  a  '", 3: "''"},
    "postnummer": {4: "'12'", 5: "NULL", 6: "'12-34'", 1: "NULL"},
    '"by"': {7: "NULL", 2: "NULL"},
}
# the second record of a pair; the first is the record itself
PAIR_DAMAGE = {
    "ssn": {1: "NULL", 2: "NULL", 3: "NULL", 6: "NULL", 8: "NULL"},
    "canonical_first_name": {1: "'Zbigniew'", 2: "substr(canonical_first_name, 1, 2) || substr(canonical_first_name, 4)", 4: "NULL",
                             5: "upper(canonical_first_name)", 6: "canonical_first_name || 'a'", 8: "'Q'", 9: "NULL"},
    "last_name": {0: "last_name || 'sen'", 1: "'Qvist'", 4: "NULL", 5: "lower(last_name)", 8: "'X'", 10: "substr(last_name, 2)"},
    "phone": {2: "NULL", 3: "NULL", 6: "'12' || substr(phone, 4)", 8: "NULL", 10: "'123'"},
    "email": {2: "NULL", 6: "'other@' || split_part(email, '@', 2)", 7: "'none'", 8: "NULL"},
}
SSN_DAMAGE = {"ssn": {0: "'32' || substr(ssn, 3)", 1: "'00' || substr(ssn, 3)", 2: "substr(ssn, 1, 2) || '13' || substr(ssn, 5)",
                      3: "'3102' || substr(ssn, 5)", 4: "substr(ssn, 1, 10)", 5: "'a' || substr(ssn, 2)", 6: "ssn || '0'",
                      7: "'290200' || substr(ssn, 7)", 8: "'290201' || substr(ssn, 7)", 9: "''", 10: "NULL"}}


def _damaged(columns: dict, ddl: bool) -> dict[str, str]:
    q = (lambda c: c.replace('"', "`")) if ddl else (lambda c: c)
    return {q(c): f"CASE way {' '.join(f'WHEN {w} THEN {v}' for w, v in ways.items())} ELSE {q(c)} END" for c, ways in columns.items()}


def damage_sql(table: str, key: str, columns: dict) -> str:
    new = ", ".join(f"{v} AS {c}" for c, v in _damaged(columns, False).items())
    return f"(SELECT * REPLACE ({new}) FROM (SELECT *, CAST('0x' || substr(md5({key}), 1, 4) AS INTEGER) % {WAYS} AS way FROM {table}))"


def damage(df: DataFrame, key: str, columns: dict) -> DataFrame:
    way = F.conv(F.substring(F.md5(F.expr(key)), 1, 4), 16, 10).cast("int") % WAYS
    df = df.withColumn("way", way)
    # all columns at once: one that is damaged already must not feed another
    return df.withColumns({c.strip("`"): F.expr(v).cast(df.schema[c.strip("`")].dataType) for c, v in _damaged(columns, True).items()}).drop("way")


def _scored(terms, table: str, keys: str) -> str:
    return f"SELECT {keys}, {dq_score(terms)} AS dq_score, {dq_fired(terms)} AS dq_fired_rules FROM {table}"


@register("dq_damaged_bulk", PS.clusters("parity", "transitive") + PS.golden() + "\n" + _scored(
    dq_bulk_terms(), damage_sql("v2_golden", "cluster_id", BULK_DAMAGE), "cluster_id, organization"),
    "DQ-001, DQ-002, DQ-003, DQ-004, DQ-005, DQ-006, DQ-007, DQ-008, DQ-N03, DQ-AI01, DQ-X03")
def q_dq_damaged_bulk(spark, sf_dir):
    gold = pairwise.v2_chain(spark, sf_dir)[2].drop("dq_score", "dq_fired_rules")
    return score_quality(damage(gold, "cluster_id", BULK_DAMAGE), customer_rules_bulk(), fired="dq_fired_rules") \
        .select("cluster_id", "organization", "dq_score", "dq_fired_rules")


@register("dq_damaged_nrt", NS.events() + NS.chain("", "TRUE") + "\n" + _scored(
    dq_stream_terms(), damage_sql("nrt_gold", "cluster_id", CUSTOMER_DAMAGE), "cluster_id"),
    "DQ-001, DQ-002, DQ-003, DQ-004, DQ-005, DQ-006, DQ-007, DQ-008, DQ-C01, DQ-C02, DQ-X03")
def q_dq_damaged_nrt(spark, sf_dir):
    gold = nrt.golden(nrt.clusters_all(spark, sf_dir)).drop("dq_score")
    return score_quality(damage(gold, "cluster_id", CUSTOMER_DAMAGE), customer_rules_stream(), fired="dq_fired_rules") \
        .select("cluster_id", "dq_score", "dq_fired_rules")


@register("dq_damaged_address", pairwise.V2_SQL + "\n" + _scored(
    dq_address_terms(), damage_sql("a2_golden", "cluster_id || organization", ADDRESS_DAMAGE), "cluster_id, organization"),
    "DQ-011, DQ-012, DQ-X04, DQ-N02")
def q_dq_damaged_address(spark, sf_dir):
    _, cl, _, addr = pairwise.v2_chain(spark, sf_dir)
    golden = pairwise.address_golden(addr, cl).drop("dq_score", "dq_fired_rules")
    return score_quality(damage(golden, "cluster_id || organization", ADDRESS_DAMAGE), address_rules(), fired="dq_fired_rules") \
        .select("cluster_id", "organization", "dq_score", "dq_fired_rules")


@register("fn_ssn_date_damaged", f"SELECT DISTINCT ssn, {date_valid('ssn')} AS valid FROM " + damage_sql(
    "(SELECT ssn FROM freg UNION ALL SELECT ssn FROM bs UNION ALL SELECT ssn FROM nice)", "ssn", SSN_DAMAGE), "FN-09")
def q_ssn_date_damaged(spark, sf_dir):
    feeds = [f(spark, sf_dir).select("ssn") for f in (inputs.freg, inputs.bs, inputs.nice)]
    ids = damage(reduce(DataFrame.unionByName, feeds), "ssn", SSN_DAMAGE)
    return ids.select("ssn", AF.ssn_date_valid("ssn").alias("valid")).distinct()


def _against_damaged(rows: DataFrame, columns: list[str], damaged: dict) -> DataFrame:
    """Every row beside its damaged copy: (node, <column>_a, <column>_b); a projection, no join."""
    as_a = rows.select("node", *columns, *[F.col(c).alias(c + "_a") for c in columns])
    return damage(as_a, "node", damaged).withColumnsRenamed({c: c + "_b" for c in columns})


def _doubles(columns: list[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


BULK_SCORES = ["score_d01", "score_d01b", "score_d02", "score_fuzzy_name", "score_soundex"]
PAIR_ATTRS = ["ssn", "canonical_first_name", "last_name", "phone"]
BULK_PAIR_DAMAGE = {c: PAIR_DAMAGE[c] for c in PAIR_ATTRS}


@register("score_damaged_bulk", PS.base() + f""",
pair AS (
  SELECT a.node, {', '.join(f'a.{c}_a, a.{c} AS {c}_b' for c in PAIR_ATTRS)}
  FROM {damage_sql('(SELECT node, ' + ', '.join(f'{c}, {c} AS {c}_a' for c in PAIR_ATTRS) + ' FROM v2_base)', 'node', BULK_PAIR_DAMAGE)} a
),
sides AS (
  SELECT node, {{ {', '.join(f"'{c}': {c}_a" for c in PAIR_ATTRS)}, 'sdx': {soundex('last_name_a')} }} AS a,
         {{ {', '.join(f"'{c}': {c}_b" for c in PAIR_ATTRS)}, 'sdx': {soundex('last_name_b')} }} AS b FROM pair
),
scores AS (SELECT node, {PS._score_cols('a', 'b')} FROM sides)
SELECT node, {_doubles(BULK_SCORES)}, CAST({PS.TOTAL} AS DOUBLE) AS total_score, {PS.MTYPE} AS match_type FROM scores""",
          "SC-01, SC-02, SC-03, SC-04, SC-05, SC-06")
def q_score_damaged_bulk(spark, sf_dir):
    pairs = _against_damaged(pairwise.base_rows(pairwise.enriched(spark, sf_dir)), PAIR_ATTRS, BULK_PAIR_DAMAGE)
    scored = pairs.withColumns(pairwise_rules())
    total, label = pairwise_total()
    return scored.select("node", *BULK_SCORES, total.alias("total_score"), label.alias("match_type"))


STREAM_COLS = ["score_d01", "score_d02", "score_c01", "score_p01", "score_p03", "score_p04"]
STREAM_ATTRS = ["canonical_first_name", "last_name", "phone", "email", "block_soundex"]
STREAM_PAIR_DAMAGE = {c: PAIR_DAMAGE[c] for c in STREAM_ATTRS if c in PAIR_DAMAGE} | {"block_soundex": {1: "'Q123'", 4: "NULL", 8: "'X000'"}}


@register("score_damaged_nrt", NS.events() + NS.chain("", "TRUE") + f""",
sides AS (
  SELECT node, {{ {', '.join(f"'{c}': {c}_a" for c in STREAM_ATTRS)} }} AS a, {{ {', '.join(f"'{c}': {c}" for c in STREAM_ATTRS)} }} AS b
  FROM {damage_sql('(SELECT node, ' + ', '.join(f'{c}, {c} AS {c}_a' for c in STREAM_ATTRS) + ' FROM nrt_state)', 'node', STREAM_PAIR_DAMAGE)}
),
scores AS (SELECT node, {NS._pair_scores('a', 'b')} FROM sides)
SELECT node, {_doubles(STREAM_COLS)}, CAST({NS.TOTAL} AS DOUBLE) AS total_score FROM scores""", "SC-07, SC-08, SC-09, SC-10, SC-11, SC-12, SC-13")
def q_score_damaged_nrt(spark, sf_dir):
    state = nrt.clusters_all(spark, sf_dir).withColumn("node", F.concat_ws("|", "source_system", "source_key"))
    scored = _against_damaged(state, STREAM_ATTRS, STREAM_PAIR_DAMAGE).withColumns(stream_rules())
    return scored.select("node", *STREAM_COLS, stream_total().alias("total_score"))


# Formats of the raw feeds: (column, pattern, what is cut before the match). Nulls are no violation.
RAW_FORMATS = {
    "freg": [("ssn", rules.SSN_PATTERN, "")],
    "bs": [("ssn", rules.SSN_PATTERN, ""), ("phone", rules.PHONE_PATTERN_NO, "[^0-9+]")],
    "nice": [("ssn", rules.SSN_PATTERN, ""), ("phone", rules.PHONE_PATTERN_NO, "[^0-9+]")],
    "addr_freg": [("postnummer", rules.POSTCODE_PATTERN_NO, "")],
    "addr_bs": [("postnummer", rules.POSTCODE_PATTERN_NO, "")],
    "addr_nice": [("postnummer", rules.POSTCODE_PATTERN_NO, "")],
}


def _raw_sql() -> str:
    one = []
    for table, formats in RAW_FORMATS.items():
        for c, pattern, cut in formats:
            value = f"regexp_replace({c}, {s(cut)}, '', 'g')" if cut else c
            one.append(f"SELECT 'chk_raw_{table}_{c}' AS check_name, count(*) FILTER (WHERE {c} IS NOT NULL "
                       f"AND NOT regexp_matches({value}, {s(pattern)})) AS violations FROM {table}")
    return "chk AS (" + " UNION ALL ".join(one) + ")\nSELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS result FROM chk"


@register("quality_gates_raw", _raw_sql(), "CK-06")
def q_gates_raw(spark, sf_dir):
    """Formats of ids, phones and postcodes in every raw feed, a row for each feed and column."""
    parts = []
    for table, formats in RAW_FORMATS.items():
        feed = inputs.table(spark, sf_dir, table)
        for c, pattern, cut in formats:
            value = F.regexp_replace(c, cut, "") if cut else F.col(c)
            parts.append(C.check(f"chk_raw_{table}_{c}", feed.where(F.col(c).isNotNull() & ~value.rlike(pattern))))
    return C.union_checks(parts)
