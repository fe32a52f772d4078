"""Pair scoring rule sets as Column expressions over an a/b pair (SC-*).

Pairs arrive with columns suffixed ``_a`` / ``_b``. Each rule is one Catalyst
expression; the total is max(deterministic) + sum(probabilistic).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aurum import rules
from aurum.functions import digits, soundex_nordic
from aurum.functions.similarity import jaro_winkler


D = dict(rules.PAIR_SCORES)


def _a(c): return F.col(c + "_a")  # noqa: E704
def _b(c): return F.col(c + "_b")  # noqa: E704


def _norm(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit(""))))


def pairwise_rules(jw_full: Column | None = None) -> dict[str, Column]:
    """Bulk pairwise rules D01 / D01b / D02 / FUZZY / SOUNDEX (SC-01..06).

    ``jw_full`` is the full-name Jaro-Winkler column when it was already
    computed once (R3); otherwise the UDF is called here.
    """
    ssn_eq = _a("ssn").isNotNull() & (_a("ssn") == _b("ssn"))
    names_eq = (_norm(_a("canonical_first_name")) == _norm(_b("canonical_first_name"))) & \
               (_norm(_a("last_name")) == _norm(_b("last_name")))
    da, db = digits(_a("phone")), digits(_b("phone"))
    d02 = _a("phone").isNotNull() & _b("phone").isNotNull() & (F.length(da) >= 8) & (F.length(db) >= 8) & \
        (F.substring(da, -8, 8) == F.substring(db, -8, 8))
    have_names = _a("canonical_first_name").isNotNull() & _b("canonical_first_name").isNotNull() & \
        _a("last_name").isNotNull() & _b("last_name").isNotNull()
    if jw_full is None:
        jw_full = jaro_winkler(F.concat(_a("canonical_first_name"), F.lit(" "), _a("last_name")),
                               F.concat(_b("canonical_first_name"), F.lit(" "), _b("last_name")))
    sa, sb = soundex_nordic(_a("last_name")), soundex_nordic(_b("last_name"))
    s = {
        "score_d01": F.when(ssn_eq & names_eq, D["D01"]).otherwise(0.0),
        "score_d01b": F.when(ssn_eq & ~names_eq, D["D01b"]).otherwise(0.0),
        "score_d02": F.when(F.coalesce(d02, F.lit(False)), D["D02"]).otherwise(0.0),
        "score_fuzzy_name": F.when(have_names & (jw_full >= rules.FUZZY_NAME_LEAST), jw_full * rules.FUZZY_NAME_WEIGHT).otherwise(0.0),
        "score_soundex": F.when(sa.isNotNull() & (sa == sb), rules.SOUNDEX_BONUS).otherwise(0.0),
    }
    return s


def pairwise_total(s: dict[str, Column] | None = None) -> tuple[Column, Column]:
    """Total and match-type label; without ``s`` it reads the score columns by name."""
    if s is None:
        s = {k: F.col(k) for k in ["score_d01", "score_d01b", "score_d02", "score_fuzzy_name", "score_soundex"]}
    total = F.greatest(s["score_d01"], s["score_d01b"], s["score_d02"]) + s["score_fuzzy_name"] + s["score_soundex"]
    mtype = (F.when(s["score_d01"] >= D["D01"], "D01").when(s["score_d01b"] >= D["D01b"], "D01b")
             .when(s["score_d02"] >= D["D02"], "D02").when(s["score_fuzzy_name"] > 0.0, "FUZZY").otherwise("OTHER"))
    return total, mtype


def stream_rules(jw_full: Column | None = None, jw_first: Column | None = None) -> dict[str, Column]:
    """Stream rules D01 e-mail / D02 phone-10 / C01 canonical name / P01 / P03 / P04 (SC-07..13)."""
    email_eq = _a("email").isNotNull() & _b("email").isNotNull() & (_a("email") == _b("email"))
    pa, pb = F.regexp_replace(_a("phone"), r"\+", ""), F.regexp_replace(_b("phone"), r"\+", "")
    phone_eq = _a("phone").isNotNull() & _b("phone").isNotNull() & (F.length(pa) >= 10) & (F.length(pb) >= 10) & \
        (F.substring(pa, -10, 10) == F.substring(pb, -10, 10))
    have = _a("canonical_first_name").isNotNull() & _b("canonical_first_name").isNotNull() & \
        _a("last_name").isNotNull() & _b("last_name").isNotNull()
    canon_eq = have & (F.lower(_a("canonical_first_name")) == F.lower(_b("canonical_first_name"))) & \
        (F.lower(_a("last_name")) == F.lower(_b("last_name")))
    if jw_full is None:
        jw_full = jaro_winkler(F.concat(_a("canonical_first_name"), F.lit(" "), _a("last_name")),
                               F.concat(_b("canonical_first_name"), F.lit(" "), _b("last_name")))
    if jw_first is None:
        jw_first = jaro_winkler(F.lower(_a("canonical_first_name")), F.lower(_b("canonical_first_name")))
    dom_a = F.when(F.instr(_a("email"), "@") > 0, F.substr(_a("email"), F.instr(_a("email"), "@")))
    dom_b = F.when(F.instr(_b("email"), "@") > 0, F.substr(_b("email"), F.instr(_b("email"), "@")))
    p04 = dom_a.isNotNull() & dom_b.isNotNull() & (dom_a == dom_b) & _a("canonical_first_name").isNotNull() & \
        _b("canonical_first_name").isNotNull() & (jw_first >= rules.STREAM_FIRST_NAME_LEAST)
    w = rules.STREAM_SCORES
    return {
        "score_d01": F.when(F.coalesce(email_eq, F.lit(False)), w["D01"]).otherwise(0.0),
        "score_d02": F.when(F.coalesce(phone_eq, F.lit(False)), w["D02"]).otherwise(0.0),
        "score_c01": F.when(F.coalesce(canon_eq, F.lit(False)), w["C01"]).otherwise(0.0),
        "score_p01": F.when(have & (jw_full >= rules.FUZZY_NAME_LEAST), jw_full * w["P01"]).otherwise(0.0),
        "score_p03": F.when(_a("block_soundex").isNotNull() & (_a("block_soundex") == _b("block_soundex")), w["P03"]).otherwise(0.0),
        "score_p04": F.when(F.coalesce(p04, F.lit(False)), w["P04"]).otherwise(0.0),
    }


def stream_total(s: dict[str, Column] | None = None) -> Column:
    if s is None:
        s = {k: F.col(k) for k in ["score_d01", "score_d02", "score_c01", "score_p01", "score_p03", "score_p04"]}
    return F.greatest(s["score_d01"], s["score_d02"], s["score_c01"]) + s["score_p01"] + s["score_p03"] + s["score_p04"]


__all__ = ["pairwise_rules", "pairwise_total", "stream_rules", "stream_total"]
