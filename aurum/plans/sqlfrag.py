"""Reusable DuckDB SQL fragments for the oracle queries."""

from __future__ import annotations

from aurum import rules


def lst(values) -> str:
    return "[" + ", ".join(s(v) for v in values) + "]"


def values_table(rows, cols, alias: str = "t") -> str:
    body = ", ".join("(" + ", ".join("'" + str(v) + "'" for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS {alias}({', '.join(cols)})"


def mod11_valid(c: str) -> str:
    """SQL twin of :func:`aurum.functions.ssn.ssn_mod11_valid`."""
    d = [f"CAST(substr({c}, {i}, 1) AS INTEGER)" for i in range(1, 12)]
    s1 = " + ".join(f"{w}*{d[i]}" for i, w in enumerate(rules.SSN_WEIGHTS_1))
    s2 = " + ".join(f"{w}*{d[i]}" for i, w in enumerate(rules.SSN_WEIGHTS_2))

    def ctl(s):
        return f"(CASE WHEN ({s}) % 11 = 0 THEN 0 WHEN ({s}) % 11 = 1 THEN NULL ELSE 11 - ({s}) % 11 END)"

    return (f"(CASE WHEN {c} IS NULL OR NOT regexp_full_match({c}, '[0-9]{{11}}') THEN FALSE "
            f"ELSE COALESCE({ctl(s1)} = {d[9]} AND {ctl(s2)} = {d[10]}, FALSE) END)")


def date_valid(c: str) -> str:
    return (f"(CASE WHEN {c} IS NOT NULL AND regexp_full_match({c}, '[0-9]{{11}}') "
            f"AND try_strptime(substr({c}, 1, 6), '%d%m%y') IS NOT NULL THEN TRUE ELSE FALSE END)")


def soundex(c: str) -> str:
    """Spark's SOUNDEX in DuckDB SQL (ASCII letters; first letter kept, H/W
    transparent, vowels and other characters separate equal codes)."""
    u = f"upper({c})"
    rest = f"regexp_replace(substr({u}, 2), '[HW]', '', 'g')"
    codes = f"regexp_replace(translate({rest}, 'ABCDEFGIJKLMNOPQRSTUVXYZ', '012301202245501262301202'), '[^0-9]', '0', 'g')"
    first_code = (f"(CASE WHEN substr({u}, 1, 1) IN ('H', 'W') THEN '9' ELSE "
                  f"translate(substr({u}, 1, 1), 'ABCDEFGIJKLMNOPQRSTUVXYZ', '012301202245501262301202') END)")
    s = f"({first_code} || {codes})"
    for dgt in "0123456":
        s = f"regexp_replace({s}, '{dgt}+', '{dgt}', 'g')"
    tail = f"replace(substr({s}, 2), '0', '')"
    return (f"(CASE WHEN {c} IS NULL THEN NULL WHEN length(trim({c})) = 0 THEN NULL "
            f"ELSE substr({u}, 1, 1) || substr({tail} || '000', 1, 3) END)")


def initcap_word(c: str) -> str:
    """A capital at the start and after every non-letter, the rest lower case."""
    return (f"array_to_string(list_transform(regexp_extract_all({c}, '[A-Za-zÀ-ÖØ-öø-ÿ]+|[^A-Za-zÀ-ÖØ-öø-ÿ]+'), "
            f"lambda w: upper(w[1]) || lower(w[2:])), '')")


def row_hash(cols, sep: str) -> str:
    parts = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in cols)
    return f"sha256(concat_ws('{sep}', {parts}))"


def tier(c: str) -> str:
    parts = " ".join(f"WHEN {c} >= {b} THEN '{label}'" for b, label in rules.DQ_TIERS)
    return f"(CASE {parts} ELSE '{rules.DQ_TIER_FLOOR}' END)"


def s(v: str) -> str:
    """SQL string literal."""
    return "'" + v.replace("'", "''") + "'"


def dq_bulk_terms(prefix: str = "") -> list[tuple[str, str, int]]:
    """(rule id, predicate, points) of the bulk customer rules, SQL twin of
    :func:`aurum.operators.quality.customer_rules_bulk`."""
    p = prefix
    email, fn, ln, ph = f"{p}email", f"{p}first_name", f"{p}last_name", f"{p}phone"
    dom = "|".join(d.replace(".", r"\.") for d in rules.DISPOSABLE_DOMAINS_BULK)
    ok = lambda c: f"({c} IS NOT NULL AND length(trim({c})) > 1)"
    ph_list = ", ".join(s(x) for x in rules.PLACEHOLDER_PHONES_BULK)
    return [
        ("DQ-001", f"({email} IS NULL OR NOT regexp_matches({email}, {s(rules.EMAIL_PATTERN)}))", -20),
        ("DQ-002", f"({email} IS NOT NULL AND regexp_matches(lower({email}), {s('@(' + dom + ')$')}))", -5),
        ("DQ-003", f"(NOT {ok(fn)})", -20),
        ("DQ-004", f"({ok(fn)} AND NOT regexp_matches({fn}, {s(rules.NAME_PATTERN_BULK)}))", -5),
        ("DQ-005", f"(NOT {ok(ln)})", -20),
        ("DQ-006", f"({ok(ln)} AND NOT regexp_matches({ln}, {s(rules.NAME_PATTERN_BULK)}))", -5),
        ("DQ-N01", f"({ph} IS NOT NULL AND NOT regexp_matches(regexp_replace({ph}, '[^0-9+]', '', 'g'), {s(rules.PHONE_PATTERN_NO)}))", -5),
        ("DQ-008", f"({ph} IS NOT NULL AND regexp_replace({ph}, '[^0-9]', '', 'g') IN ({ph_list}))", -20),
        ("DQ-N03", f"({p}ssn IS NOT NULL AND NOT {p}ssn_valid)", -20),
        ("DQ-AI01", f"({p}is_fake_name)", -20),
        ("DQ-X03", f"({ok(fn)} AND {email} IS NOT NULL AND strpos(lower({email}), lower(trim({fn}))) > 0)", 5),
    ]


def dq_stream_terms(prefix: str = "") -> list[tuple[str, str, int]]:
    p = prefix
    email, fn, ln, ph = f"{p}email", f"{p}first_name", f"{p}last_name", f"{p}phone"
    ok = lambda c: f"({c} IS NOT NULL AND length(trim({c})) > 1)"
    valid_email = f"COALESCE({email} IS NOT NULL AND regexp_matches({email}, {s(rules.EMAIL_PATTERN)}), FALSE)"
    valid_phone = f"COALESCE({ph} IS NOT NULL AND length(regexp_replace({ph}, '[^0-9]', '', 'g')) >= 7, FALSE)"
    doms = ", ".join(s(x) for x in rules.DISPOSABLE_DOMAINS_STREAM)
    phs = ", ".join(s(x) for x in rules.PLACEHOLDER_PHONES_STREAM)
    return [
        ("DQ-001", f"(NOT {valid_email})", -20),
        ("DQ-002", f"({email} IS NOT NULL AND strpos({email}, '@') > 0 AND lower(split_part({email}, '@', 2)) IN ({doms}))", -5),
        ("DQ-003", f"(NOT {ok(fn)})", -20),
        ("DQ-004", f"({ok(fn)} AND NOT regexp_matches({fn}, {s(rules.NAME_PATTERN_STREAM)}))", -5),
        ("DQ-005", f"(NOT {ok(ln)})", -20),
        ("DQ-006", f"({ok(ln)} AND NOT regexp_matches({ln}, {s(rules.NAME_PATTERN_STREAM)}))", -5),
        ("DQ-007", f"({ph} IS NOT NULL AND length({ph}) > 0 AND NOT regexp_matches(regexp_replace({ph}, '[^0-9+]', '', 'g'), {s(rules.PHONE_PATTERN_INTL)}))", -5),
        ("DQ-008", f"({ph} IS NOT NULL AND length({ph}) > 0 AND regexp_replace({ph}, '[^0-9]', '', 'g') IN ({phs}))", -20),
        ("DQ-C01", f"(NOT {valid_email} AND NOT {valid_phone})", -20),
        ("DQ-C02", f"(NOT {ok(fn)} AND NOT {ok(ln)})", -20),
        ("DQ-X03", f"({ok(fn)} AND {email} IS NOT NULL AND strpos(lower({email}), lower(trim({fn}))) > 0)", 5),
    ]


def dq_address_terms(prefix: str = "") -> list[tuple[str, str, int]]:
    p = prefix
    gate_ok = f"({p}gate IS NOT NULL AND length(trim({p}gate)) >= 3)"
    return [
        ("DQ-011", f"(NOT {gate_ok})", -5),
        ("DQ-012", f"({p}\"by\" IS NULL)", -20),
        ("DQ-X04", f"({gate_ok} AND {p}postnummer IS NOT NULL AND {p}\"by\" IS NOT NULL)", 10),
        ("DQ-N02", f"({p}postnummer IS NOT NULL AND NOT regexp_matches({p}postnummer, {s(rules.POSTCODE_PATTERN_NO)}))", -5),
    ]


def dq_score(terms) -> str:
    body = " + ".join(f"(CASE WHEN COALESCE({pred}, FALSE) THEN {pts} ELSE 0 END)" for _, pred, pts in terms)
    return f"CAST(greatest(0, least(100, 100 + {body})) AS BIGINT)"


def dq_fired(terms) -> str:
    items = ", ".join(f"CASE WHEN COALESCE({pred}, FALSE) THEN {s(rid)} END" for rid, pred, _ in terms)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"
