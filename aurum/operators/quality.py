"""Data-quality rule engine: score = clamp(base + sum of fired points) (DQ-*).

A rule is (id, predicate, points). The engine emits the score and the array
of fired rule ids in one projection; no UDF, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum import rules as R
from aurum.functions import digits


@dataclass
class DQRule:
    rule_id: str
    predicate: Column
    points: int


def score_quality(df: DataFrame, rule_list: list[DQRule], base: int = 100, out: str = "dq_score",
                  fired: str | None = None) -> DataFrame:
    raw = F.lit(base)
    for r in rule_list:
        raw = raw + F.when(F.coalesce(r.predicate, F.lit(False)), F.lit(r.points)).otherwise(F.lit(0))
    df = df.withColumn(out, F.greatest(F.lit(0), F.least(F.lit(100), raw)).cast("long"))
    if fired:
        arr = F.array(*[F.when(F.coalesce(r.predicate, F.lit(False)), F.lit(r.rule_id)) for r in rule_list])
        df = df.withColumn(fired, F.filter(arr, lambda x: x.isNotNull()))
    return df


def _name_ok(c: str) -> Column:
    return F.col(c).isNotNull() & (F.length(F.trim(c)) > 1)


def customer_rules_bulk() -> list[DQRule]:
    """Bulk customer rules (pairwise variant)."""
    email = F.col("email")
    return [
        DQRule("DQ-001", email.isNull() | ~email.rlike(R.EMAIL_PATTERN), -20),
        DQRule("DQ-002", email.isNotNull() & F.lower(email).rlike(
            "@(" + "|".join(d.replace(".", r"\.") for d in R.DISPOSABLE_DOMAINS_BULK) + ")$"), -5),
        DQRule("DQ-003", ~_name_ok("first_name"), -20),
        DQRule("DQ-004", _name_ok("first_name") & ~F.col("first_name").rlike(R.NAME_PATTERN_BULK), -5),
        DQRule("DQ-005", ~_name_ok("last_name"), -20),
        DQRule("DQ-006", _name_ok("last_name") & ~F.col("last_name").rlike(R.NAME_PATTERN_BULK), -5),
        DQRule("DQ-N01", F.col("phone").isNotNull() & ~F.regexp_replace("phone", r"[^0-9+]", "").rlike(R.PHONE_PATTERN_NO), -5),
        DQRule("DQ-008", F.col("phone").isNotNull() & digits("phone").isin(*R.PLACEHOLDER_PHONES_BULK), -20),
        DQRule("DQ-N03", F.col("ssn").isNotNull() & ~F.col("ssn_valid"), -20),
        DQRule("DQ-AI01", F.col("is_fake_name"), -20),
        DQRule("DQ-X03", _name_ok("first_name") & email.isNotNull()
               & (F.instr(F.lower(email), F.lower(F.trim("first_name"))) > 0), 5),
    ]


def customer_rules_stream() -> list[DQRule]:
    """Stream customer rules (11 rules, no SSN / fake-name rule)."""
    email = F.col("email")
    valid_email = email.isNotNull() & email.rlike(R.EMAIL_PATTERN)
    has_at = F.instr(email, "@") > 0
    # the domain is the text after the first '@' up to a second '@' if any
    dom = F.lower(F.split(email, "@").getItem(1))
    valid_phone = F.col("phone").isNotNull() & (F.length(digits("phone")) >= 7)
    return [
        DQRule("DQ-001", ~F.coalesce(valid_email, F.lit(False)), -20),
        DQRule("DQ-002", email.isNotNull() & has_at & dom.isin(*R.DISPOSABLE_DOMAINS_STREAM), -5),
        DQRule("DQ-003", ~_name_ok("first_name"), -20),
        DQRule("DQ-004", _name_ok("first_name") & ~F.col("first_name").rlike(R.NAME_PATTERN_STREAM), -5),
        DQRule("DQ-005", ~_name_ok("last_name"), -20),
        DQRule("DQ-006", _name_ok("last_name") & ~F.col("last_name").rlike(R.NAME_PATTERN_STREAM), -5),
        DQRule("DQ-007", F.col("phone").isNotNull() & (F.length("phone") > 0)
               & ~F.regexp_replace("phone", r"[^0-9+]", "").rlike(R.PHONE_PATTERN_INTL), -5),
        DQRule("DQ-008", F.col("phone").isNotNull() & (F.length("phone") > 0) & digits("phone").isin(*R.PLACEHOLDER_PHONES_STREAM), -20),
        DQRule("DQ-C01", ~F.coalesce(valid_email, F.lit(False)) & ~F.coalesce(valid_phone, F.lit(False)), -20),
        DQRule("DQ-C02", ~_name_ok("first_name") & ~_name_ok("last_name"), -20),
        DQRule("DQ-X03", _name_ok("first_name") & email.isNotNull()
               & (F.instr(F.lower(email), F.lower(F.trim("first_name"))) > 0), 5),
    ]


def address_rules() -> list[DQRule]:
    gate_ok = F.col("gate").isNotNull() & (F.length(F.trim("gate")) >= 3)
    return [
        DQRule("DQ-011", ~gate_ok, -5),
        DQRule("DQ-012", F.col("by").isNull(), -20),
        DQRule("DQ-X04", gate_ok & F.col("postnummer").isNotNull() & F.col("by").isNotNull(), 10),
        DQRule("DQ-N02", F.col("postnummer").isNotNull() & ~F.col("postnummer").rlike(R.POSTCODE_PATTERN_NO), -5),
    ]
