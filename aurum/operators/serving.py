"""Serving views over golden records (SV-*, HS-07/08/10/12)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aurum.functions import dq_tier


def point_in_time(history: DataFrame, d: str) -> DataFrame:
    """State valid at date d; half-open [valid_from, valid_to) (HS-07)."""
    day = F.lit(d).cast("date")
    return history.where((F.col("valid_from") <= day) & (day < F.col("valid_to")))


def golden_diff(history: DataFrame, key: list[str], order: str, fields: list[str]) -> DataFrame:
    """Field-level before/after rows between consecutive versions (HS-12)."""
    w = Window.partitionBy(*key).orderBy(order)
    h = history.select(*key, F.col(order).alias("changed_at"), *[F.col(f).cast("string").alias(f) for f in fields],
                       *[F.lag(F.col(f).cast("string")).over(w).alias("o_" + f) for f in fields],
                       F.row_number().over(w).alias("rn")).where(F.col("rn") > 1)
    stacked = h.select(*key, "changed_at", F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col("o_" + f).alias("old_value"), F.col(f).alias("new_value")) for f in fields])).alias("d"))
    return stacked.select(*key, "changed_at", "d.*").where(~F.col("old_value").eqNullSafe(F.col("new_value")))


def _addr_rollup(addr: DataFrame) -> DataFrame:
    p = F.col("is_primary")
    entry = F.struct(
        F.concat_ws("|", "cluster_id", "organization", "address_type").alias("address_id"),
        F.col("address_type").alias("type"), "gate", "by", "postnummer", "land", "is_primary", "dq_score")
    return addr.groupBy("cluster_id", "organization").agg(
        F.count("*").alias("address_count"),
        F.max(F.when(p, F.col("gate"))).alias("primary_gate"), F.max(F.when(p, F.col("by"))).alias("primary_by"),
        F.max(F.when(p, F.col("postnummer"))).alias("primary_postnummer"), F.max(F.when(p, F.col("land"))).alias("primary_land"),
        F.max(F.when(p, F.col("dq_score"))).alias("primary_address_dq_score"),
        F.to_json(F.sort_array(F.collect_list(F.struct(F.col("address_type").alias("_o1"), F.col("gate").alias("_o2"), entry.alias("e"))))
                  .getField("e"), {"ignoreNullFields": "false"}).alias("all_addresses"))


def customer_360(gold: DataFrame, addr: DataFrame) -> DataFrame:
    """Nested profile: golden customer + address roll-up as a JSON array (SV-01)."""
    a = _addr_rollup(addr)
    return gold.join(a.hint("merge"), ["cluster_id", "organization"], "left").select(
        "cluster_id", "first_name", "last_name", F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email", "phone", "dq_score", dq_tier("dq_score").alias("dq_tier"), "source_count",
        F.col("record_date").alias("last_updated"), "ssn", "birth_date", "citizenship", "organization",
        F.coalesce("address_count", F.lit(0)).alias("address_count"), "primary_gate", "primary_by", "primary_postnummer",
        "primary_land", F.concat_ws(", ", "primary_gate", "primary_by", "primary_postnummer", "primary_land").alias("primary_address_full"),
        "all_addresses", "primary_address_dq_score")


def customer_360_flat(gold: DataFrame, addr: DataFrame) -> DataFrame:
    a = addr.select("cluster_id", "organization",
                    F.concat_ws("|", "cluster_id", "organization", "address_type").alias("address_id"), "address_type",
                    "gate", F.col("by").alias("city"), "postnummer", "land", "is_primary", F.col("dq_score").alias("address_dq_score"))
    return gold.join(a.hint("merge"), ["cluster_id", "organization"], "left").select(
        "cluster_id", "first_name", "last_name", "email", "phone", "dq_score", dq_tier("dq_score").alias("dq_tier"),
        "source_count", F.col("record_date").alias("last_updated"), "ssn", "birth_date", "citizenship", "organization",
        "address_id", "address_type", "gate", "city", "postnummer", "land", "is_primary", "address_dq_score")


def cross_org(gold: DataFrame) -> DataFrame:
    """Customers present in both organisations, linked by national id (SV-03)."""
    b = gold.where(F.col("organization") == "BANK").select(
        "ssn", *[F.col(c).alias("bank_" + c) for c in ["first_name", "last_name", "email", "phone"]], "citizenship", "birth_date")
    i = gold.where(F.col("organization") == "INS").select(
        "ssn", *[F.col(c).alias("ins_" + c) for c in ["first_name", "last_name", "email", "phone"]])
    return b.join(i.hint("merge"), "ssn").select("ssn", "bank_first_name", "bank_last_name", "bank_email", "bank_phone",
                                   "ins_first_name", "ins_last_name", "ins_email", "ins_phone", "citizenship", "birth_date")


def _contains(c: str, q: str):
    return F.lower(c).contains(q.lower())


def search(gold: DataFrame, q: str, limit: int = 20) -> DataFrame:
    """Case-insensitive search by id / name / e-mail; top-k by id (SV-04)."""
    pred = reduce(lambda a, b: a | b, [_contains(c, q) for c in ["cluster_id", "first_name", "last_name", "email"]])
    return gold.where(pred).orderBy("cluster_id", "organization").limit(limit) \
        .select("cluster_id", "organization", "first_name", "last_name", "email", "dq_score")


def search_with_address(gold: DataFrame, addr: DataFrame, q: str, min_score: int, limit: int) -> DataFrame:
    j = gold.join(addr.select("cluster_id", "organization", "gate", "by"), ["cluster_id", "organization"])
    pred = (_contains("by", q) | _contains("gate", q) | _contains("last_name", q)) & (F.col("dq_score") >= min_score)
    return j.where(pred).orderBy("cluster_id", "organization").limit(limit) \
        .select("cluster_id", "organization", "first_name", "last_name", "dq_score", "gate", "by")


def top_golden(gold: DataFrame, addr: DataFrame, n: int) -> DataFrame:
    top = gold.orderBy(F.col("dq_score").desc(), F.col("source_count").desc(), "cluster_id", "organization").limit(n)
    return top.join(addr.select("cluster_id", "organization", "gate", "by", "postnummer"), ["cluster_id", "organization"], "left") \
        .select("cluster_id", "organization", "first_name", "last_name", "dq_score", "source_count", "gate", "by", "postnummer")


def lineage(enr: DataFrame, cl: DataFrame, gold: DataFrame) -> DataFrame:
    """Every source row with the golden record it feeds (HS-10)."""
    g = gold.select("cluster_id", "organization", F.col("first_name").alias("golden_first_name"), F.col("email").alias("golden_email"))
    return enr.join(cl.select("source_system", "source_key", "organization", "cluster_id"), ["source_system", "source_key", "organization"]) \
        .join(g, ["cluster_id", "organization"]).select(
            "source_system", "source_key", "organization", "record_date", "_source_file", "cluster_id",
            F.col("first_name").alias("source_first_name"), "golden_first_name", F.col("email").alias("source_email"), "golden_email")


def customer_card(enr: DataFrame, cl: DataFrame, gold: DataFrame, org: str) -> DataFrame:
    """Source rows + golden values of one customer: the lowest id among the
    best-covered golden records of ``org`` (SV-08). Picked by aggregation,
    never by collecting to the driver."""
    g = gold.where(F.col("organization") == org)
    best = g.agg(F.max("source_count").alias("mx"))
    pick = g.join(F.broadcast(best), F.col("source_count") == F.col("mx")).agg(F.min("cluster_id").alias("cluster_id"))
    c = cl.where(F.col("organization") == org).join(F.broadcast(pick), "cluster_id")
    gg = g.select("cluster_id", "organization", F.col("first_name").alias("golden_first_name"),
                  F.col("last_name").alias("golden_last_name"), "dq_score")
    return c.select("cluster_id", "organization", "source_system", "source_key") \
        .join(enr.select("source_system", "source_key", "organization", "first_name", "last_name", "email", "record_date"),
              ["source_system", "source_key", "organization"]) \
        .join(gg, ["cluster_id", "organization"]) \
        .select("cluster_id", "organization", "source_system", "source_key", "first_name", "last_name", "email", "record_date",
                "golden_first_name", "golden_last_name", "dq_score")
