"""Identity sources derived from the given test tables.

The driver's tables carry no person data, so the three customer systems
(FREG registry, BS bank system, NICE CRM), their address feeds, daily
updates, unmerge overrides and the CRM event topics are derived from
``customer.c_custkey`` (person k) and ``events`` by integer arithmetic.
Every table grows with the input tables. The same recipe is written as
DuckDB SQL in :mod:`aurum.plans.oracle_sources` for the correctness check.

Fixed values of the recipe (first names, last names, steward names, mail
domains, cities) are listed below in natural order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Name lists and domains of the derived fixtures.
FIRST_NAMES = ["Per", "Petter", "Ole", "Olav", "Kari", "Karen", "Marie", "Maria",
               "Jon", "Jonas", "Anne", "Anna", "Lars", "Lise", "Elisabeth", "Erik"]
LAST_NAMES = ["Hansen", "Johansen", "Olsen", "Larsen", "Andersen", "Pedersen", "Nilsen",
              "Kristiansen", "Jensen", "Karlsen", "Johnsen", "Pettersen", "Eriksen", "Berg",
              "Haugen", "Hagen", "Johannessen", "Andreassen", "Jacobsen", "Dahl", "Halvorsen",
              "Henriksen", "Lund", "Sorensen", "Jakobsen"]
STEWARD_NAMES = [("Quwanxi", "Zbigovtzuk"), ("Uvuzela", "Ptakowiczyk"),
                 ("Yxtabqua", "Fuzzumiwoq"), ("Izquib", "Cvetkqumzov"),
                 ("Test", "Xutuwumqi")]
MAIL_DOMAINS = ["example.no", "post.no", "online.no", "mail.no", "mailinator.com"]
CITIES = ["Oslo", "Bergen", "Trondheim", "Stavanger"]
UPDATE_SHIFT_DAYS = 200


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _control(weighted: Column) -> Column:
    r = weighted % 11
    # remainder 0 -> 0; remainder 1 would need digit 10: written as 0 (invalid id)
    return F.when(r <= 1, F.lit(0)).otherwise(11 - r)


_PERSONS_OVERRIDE: dict[tuple, DataFrame] = {}


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per person k with the attributes every source copies from."""
    landed = _PERSONS_OVERRIDE.get((spark.sparkContext.applicationId, sf_dir))
    if landed is not None:
        return landed
    return _persons(spark, sf_dir)


def _persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    dd, mm, yy, iii = 1 + (7 * k) % 28, 1 + (5 * k) % 12, 40 + (11 * k) % 60, 1 + k % 499
    d = [dd / 10, dd % 10, mm / 10, mm % 10, yy / 10, yy % 10, iii / 100, (iii / 10) % 10, iii % 10]
    d = [F.floor(x).cast("int") if i in (0, 2, 4, 6, 7) else x.cast("int") for i, x in enumerate(d)]
    c1 = _control(3 * d[0] + 7 * d[1] + 6 * d[2] + 1 * d[3] + 8 * d[4] + 9 * d[5] + 4 * d[6] + 5 * d[7] + 2 * d[8])
    c2 = _control(5 * d[0] + 4 * d[1] + 3 * d[2] + 2 * d[3] + 7 * d[4] + 6 * d[5] + 5 * d[6] + 4 * d[7] + 3 * d[8] + 2 * c1)
    first = _pick(FIRST_NAMES, k % 16)
    last = _pick(LAST_NAMES, F.floor(k / 16) % 25)
    return (
        spark.read.parquet(f"{sf_dir}/customer.parquet")
        .select(F.col("c_custkey").alias("k"))
        .select(
            "k",
            first.alias("first"),
            last.alias("last"),
            F.concat(_pad(dd, 2), _pad(mm, 2), _pad(yy, 2), _pad(iii, 3), c1.cast("string"), c2.cast("string")).alias("ssn"),
            F.make_date(1900 + yy, mm, dd).alias("birth_date"),
            F.when(k % 10 == 8, "SE").when(k % 10 == 9, "PL").otherwise("NO").alias("citizenship"),
            F.concat(F.lit("+47"), (90000000 + k).cast("string")).alias("phone"),
            _pick(MAIL_DOMAINS, F.floor(k / 5) % 5).alias("domain"),
            _pick(LAST_NAMES, (F.floor(k / 16) + 1) % 25).alias("next_last"),
        )
    )


def _orgs(k: Column) -> Column:
    return F.when(k % 15 == 0, F.array(F.lit("BANK"), F.lit("INS"))) \
        .otherwise(F.array(F.when(k % 2 == 0, "BANK").otherwise("INS")))


def _with_updates(initial: DataFrame, src: str, update_cols: dict[str, Column]) -> DataFrame:
    """Initial rows plus the update rows (k%50 in 0,1,2) dated 200 days later."""
    upd = initial.filter(F.col("k") % 50 <= 2)
    for name, expr in update_cols.items():
        upd = upd.withColumn(name, expr)
    upd = upd.withColumn("record_date", F.date_add("record_date", UPDATE_SHIFT_DAYS)).withColumn("phase", F.lit("update"))
    both = initial.withColumn("phase", F.lit("initial")).unionByName(upd)
    return both.withColumn(
        "_source_file",
        F.concat(F.col("phase"), F.lit("/"), F.date_format("record_date", "yyyy-MM-dd"), F.lit(f"_crm_{src.lower()}_customers.csv")),
    ).drop("phase")


def freg_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = persons(spark, sf_dir).filter(F.col("k") % 5 <= 2)
    k = F.col("k")
    init = p.select(
        "k", "ssn", F.col("first").alias("first_name"), F.col("last").alias("last_name"),
        "birth_date", "citizenship",
        F.date_add(F.lit("2023-01-01").cast("date"), (k % 365).cast("int")).alias("record_date"),
        "next_last",
    )
    out = _with_updates(init, "FREG", {"last_name": F.when(k % 50 == 2, F.col("next_last")).otherwise(F.col("last_name"))})
    return out.select("k", "ssn", "first_name", "last_name", "birth_date", "citizenship", "record_date", "_source_file")


def _contact_email(first: Column, last: Column, k: Column, domain: Column) -> Column:
    return F.concat(F.lower(first), F.lit("."), F.lower(last), (k % 97).cast("string"), F.lit("@"), domain)


def bs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    p = persons(spark, sf_dir).filter((k % 5 == 0) | (k % 5 == 1) | (k % 5 == 3))
    init = p.select(
        "k", "ssn", F.col("first").alias("first_name"), F.col("last").alias("last_name"), "phone",
        _contact_email(F.col("first"), F.col("last"), k, F.col("domain")).alias("email"),
        F.date_add(F.lit("2023-06-01").cast("date"), (k % 365).cast("int")).alias("record_date"),
        F.explode(_orgs(k)).alias("organization"),
    )
    out = _with_updates(init, "BS", {
        "phone": F.when(k % 50 == 0, F.concat(F.lit("+47"), (80000000 + k).cast("string"))).otherwise(F.col("phone")),
    })
    return out.select("k", "ssn", "first_name", "last_name", "phone", "email", "record_date", "organization", "_source_file")


def nice_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    p = persons(spark, sf_dir).filter(k % 5 != 1)
    steward = k % 100 == 4
    sidx = F.floor(k / 100) % 5
    first = F.when(steward, _pick([s[0] for s in STEWARD_NAMES], sidx)) \
        .when(k % 20 == 2, F.concat(F.substring("first", 1, 2), F.substring("first", 4, 100))) \
        .when(k % 9 == 0, F.upper("first")).otherwise(F.col("first"))
    last = F.when(steward, _pick([s[1] for s in STEWARD_NAMES], sidx)).otherwise(F.col("last"))
    mail_first = F.when(steward, _pick([s[0] for s in STEWARD_NAMES], sidx)).otherwise(F.col("first"))
    init = p.select(
        "k",
        F.when(((k % 10 >= 2) & (k % 10 <= 4)) | steward, F.lit(None).cast("string")).otherwise(F.col("ssn")).alias("ssn"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("+47 "), (90000000 + k).cast("string"))).alias("phone"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(_contact_email(mail_first, last, k, F.col("domain"))).alias("email"),
        F.date_add(F.lit("2023-03-01").cast("date"), (k % 365).cast("int")).alias("record_date"),
        F.explode(_orgs(k)).alias("organization"),
        "next_last",
    )
    out = _with_updates(init, "NICE", {
        "phone": F.when(k % 50 == 0, F.concat(F.lit("+47 "), (80000000 + k).cast("string"))).otherwise(F.col("phone")),
        "last_name": F.when(k % 50 == 2, F.col("next_last")).otherwise(F.col("last_name")),
    })
    return out.select("k", "ssn", "first_name", "last_name", "phone", "email", "record_date", "organization", "_source_file")


def nice_surrogate_key(first: Column, last: Column, phone: Column) -> Column:
    """Source key of an SSN-less NICE row: MD5(first + last + phone digits)."""
    return F.md5(F.concat(
        F.coalesce(F.trim(first), F.lit("")),
        F.coalesce(F.trim(last), F.lit("")),
        F.coalesce(F.regexp_replace(phone, r"[^0-9+]", ""), F.lit("")),
    ))


def addresses_raw(spark: SparkSession, sf_dir: str, src: str) -> DataFrame:
    """One address per initial source row, plus a moved address for k%50=0."""
    k = F.col("k")
    if src == "FREG":
        base = freg_raw(spark, sf_dir).select("k", "ssn", "record_date", F.col("ssn").alias("cust_key"), "_source_file")
    elif src == "BS":
        base = bs_raw(spark, sf_dir).select("k", "ssn", "record_date", F.col("ssn").alias("cust_key"), "_source_file")
    else:
        n = nice_raw(spark, sf_dir)
        base = n.select("k", "ssn", "record_date",
                        F.coalesce("ssn", nice_surrogate_key(F.col("first_name"), F.col("last_name"), F.col("phone"))).alias("cust_key"),
                        "_source_file")
    base = base.filter(F.col("_source_file").startswith("initial/")).dropDuplicates(["k"])
    rows = base.select(
        "k", "record_date",
        F.concat(F.lit(f"{src}-A-"), k.cast("string")).alias("src_address_id"),
        F.col("cust_key").alias("src_customer_id"),
        F.concat(F.lit("Storgata "), (1 + k % 120).cast("string")).alias("gate"),
        F.when(k % 40 == 1, (100 + k % 900).cast("string")).otherwise(F.lpad(((k * 37) % 10000).cast("string"), 4, "0")).alias("postnummer"),
        F.when(k % 30 == 7, F.lit(None).cast("string")).otherwise(_pick(CITIES, k % 4)).alias("by"),
        F.lit("NO").alias("land"),
    )
    moved = rows.filter(k % 50 == 0).withColumn("gate", F.concat(F.lit("Nygata "), (1 + k % 120).cast("string"))) \
        .withColumn("record_date", F.date_add("record_date", UPDATE_SHIFT_DAYS))
    both = rows.withColumn("phase", F.lit("initial")).unionByName(moved.withColumn("phase", F.lit("update")))
    return both.select(
        "k", "src_address_id", "src_customer_id", "gate", "postnummer", "by", "land",
        F.concat(F.col("phase"), F.lit("/"), F.date_format("record_date", "yyyy-MM-dd"),
                 F.lit(f"_crm_{src.lower()}_addresses.csv")).alias("_source_file"),
    )


def unmerge_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steward split pairs: BS row k against its SSN-less NICE twin, k%100=3.

    Half of them are written in reverse order to exercise the symmetric test.
    """
    k = F.col("k")
    twins = (
        nice_raw(spark, sf_dir)
        .filter((k % 100 == 3) & F.col("_source_file").startswith("initial/"))
        .select("k", nice_surrogate_key(F.col("first_name"), F.col("last_name"), F.col("phone")).alias("nice_key"))
        .dropDuplicates(["k"])
        .join(persons(spark, sf_dir).select("k", F.col("ssn").alias("bs_key")), "k")
    )
    rev = F.floor(k / 100) % 2 == 1
    return twins.select(
        F.when(rev, F.col("nice_key")).otherwise(F.col("bs_key")).alias("source_key_a"),
        F.when(rev, F.col("bs_key")).otherwise(F.col("nice_key")).alias("source_key_b"),
        F.lit("STEWARD_SPLIT").alias("reason"),
        F.timestamp_seconds(F.lit(1704067200) + k).alias("created_at"),
        F.lit("steward").alias("created_by"),
    )
