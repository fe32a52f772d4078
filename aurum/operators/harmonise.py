"""Source harmonisation: common schemas, org broadcast, enrichment (PRJ-*, FN-10/11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum import rules
from aurum.functions import capitalise, ssn_date_valid, ssn_mod11_valid


def org_fanout() -> Column:
    """One output row per organisation (generator, no join): registry rows
    carry no organisation and feed both organisations' golden records."""
    return F.explode(F.array(*[F.lit(o) for o in rules.ORGANIZATIONS]))


def nickname_table(spark: SparkSession) -> DataFrame:
    """Nickname dictionary (fixed, 35 rows: broadcast is size-safe)."""
    return spark.createDataFrame(rules.NICKNAMES, "nickname string, canonical string")


def union_customers_v1(freg: DataFrame, bs: DataFrame, nice: DataFrame, broadcast: bool = True) -> DataFrame:
    """Three systems -> the 12-column common schema with trust 3/2/1 (PRJ-01).

    ``broadcast=True`` sends registry rows to every organisation (the pairwise
    variant's behaviour); ``False`` keeps them with a NULL organisation.
    """
    s = T.StringType()
    f = freg.select(
        "ssn", "first_name", "last_name", "birth_date", "citizenship",
        F.lit(None).cast(s).alias("phone"), F.lit(None).cast(s).alias("email"),
        F.lit(None).cast(s).alias("organization"), "record_date",
        F.lit("FREG").alias("source_system"), F.lit(rules.TRUST_V1["FREG"]).alias("trust_score"), "_source_file",
    )
    if broadcast:
        f = f.withColumn("organization", org_fanout())

    def crm(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            "ssn", "first_name", "last_name",
            F.lit(None).cast("date").alias("birth_date"), F.lit(None).cast(s).alias("citizenship"),
            "phone", "email", "organization", "record_date",
            F.lit(name).alias("source_system"), F.lit(rules.TRUST_V1[name]).alias("trust_score"), "_source_file",
        )

    return f.select(*_V1_COLS).unionByName(crm(bs, "BS")).unionByName(crm(nice, "NICE"))


_V1_COLS = ["ssn", "first_name", "last_name", "birth_date", "citizenship", "phone", "email",
            "organization", "record_date", "source_system", "trust_score", "_source_file"]


def enrich_v1(union: DataFrame) -> DataFrame:
    """+ ssn_valid (modulus 11), canonical first name (nickname map), row key."""
    nick = F.broadcast(nickname_table(union.sparkSession))
    out = (
        union.withColumn("ssn_valid", ssn_mod11_valid("ssn"))
        .join(nick, F.upper(F.col("first_name")) == F.col("nickname"), "left")
        .withColumn("canonical_first_name", F.coalesce(F.col("canonical"), F.upper("first_name")))
        .drop("nickname", "canonical")
    )
    return out.withColumn("row_key", row_key_v1())


def row_key_v1() -> Column:
    """MD5 over source|ssn|first|last|date|org|file (file added: the bare key is not unique)."""
    parts = ["source_system", "ssn", "first_name", "last_name", "record_date", "organization", "_source_file"]
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts]))


def union_customers_v2(freg: DataFrame, bs: DataFrame, nice: DataFrame) -> DataFrame:
    """Harmonised union with org broadcast of registry rows (PRJ-02, PRJ-04).

    Names INITCAP(TRIM), phone digits and '+', e-mail lower/trim; NICE rows
    without SSN get the MD5(first+last+phone) surrogate key.
    """
    s = T.StringType()
    f = freg.withColumn("organization", org_fanout()).select(
        F.lit("FREG").alias("source_system"), F.col("ssn").alias("source_key"), "ssn",
        capitalise("first_name").alias("first_name"), capitalise("last_name").alias("last_name"),
        "birth_date", "citizenship", F.lit(None).cast(s).alias("phone"), F.lit(None).cast(s).alias("email"),
        "record_date", "organization", "_source_file",
    )

    def crm(df: DataFrame, name: str, key: Column) -> DataFrame:
        return df.select(
            F.lit(name).alias("source_system"), key.alias("source_key"), "ssn",
            capitalise("first_name").alias("first_name"), capitalise("last_name").alias("last_name"),
            F.lit(None).cast("date").alias("birth_date"), F.lit(None).cast(s).alias("citizenship"),
            F.regexp_replace("phone", r"[^0-9+]", "").alias("phone"), F.lower(F.trim("email")).alias("email"),
            "record_date", "organization", "_source_file",
        )

    surrogate = F.md5(F.concat(
        F.coalesce(F.trim("first_name"), F.lit("")), F.coalesce(F.trim("last_name"), F.lit("")),
        F.coalesce(F.regexp_replace("phone", r"[^0-9+]", ""), F.lit("")),
    ))
    return f.unionByName(crm(bs, "BS", F.col("ssn"))).unionByName(crm(nice, "NICE", F.coalesce(F.col("ssn"), surrogate)))


def union_addresses(a_freg: DataFrame, a_bs: DataFrame, a_nice: DataFrame) -> DataFrame:
    """Address union; every feed is broadcast to both organisations (PRJ-03).

    Recency comes from the file date in the lineage file name (SRC-03).
    """
    def one(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn("organization", org_fanout()).select(
            F.lit(name).alias("source_system"), F.col("src_address_id").alias("source_key"),
            F.col("src_customer_id").alias("source_customer_key"),
            capitalise("gate").alias("gate"), F.trim("postnummer").alias("postnummer"),
            capitalise("by").alias("by"), F.upper(F.trim("land")).alias("land"),
            "organization", "_source_file", file_date(F.col("_source_file")).alias("file_date"),
        )

    return one(a_freg, "FREG").unionByName(one(a_bs, "BS")).unionByName(one(a_nice, "NICE"))


def file_date(path: Column) -> Column:
    """Business date from a ``YYYY-MM-DD_crm_*.csv`` file name (SRC-03)."""
    return F.to_date(F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})_crm_", 1), "yyyy-MM-dd")


def enrich_v2(union: DataFrame, canonical: str = "initcap", nicknames: DataFrame | None = None) -> DataFrame:
    """Pairwise-variant enrichment: canonical first name, fake-name flag, SSN date validity.

    ``canonical='initcap'`` is the classical variant; ``'nickname'`` maps via
    the dictionary (the re-aimed LLM variant), INITCAP of the canonical form.
    """
    out = union.withColumn("ssn_valid", ssn_date_valid("ssn"))
    if canonical == "nickname":
        nick = nicknames if nicknames is not None else F.broadcast(nickname_table(union.sparkSession))
        out = (
            out.join(nick, F.upper(F.trim("first_name")) == F.col("nickname"), "left")
            .withColumn("canonical_first_name",
                        F.when(F.length(F.trim("first_name")) > 1,
                               capitalise(F.coalesce(F.col("canonical"), F.trim("first_name"))))
                        .otherwise(F.col("first_name")))
            .drop("nickname", "canonical")
        )
    else:
        out = out.withColumn("canonical_first_name", capitalise("first_name"))
    return out.withColumn("is_fake_name", F.lit(False))


def fake_name_flag(df: DataFrame, tokens: DataFrame) -> DataFrame:
    """Rule-based fake/test-name flag (FN-11 re-aimed): any name token in the
    token table or a digit in the name."""
    tok = tokens.select(F.upper("token").alias("token")).distinct()
    names = df.select("source_system", "source_key", "organization",
                      F.explode(F.array(F.upper(F.trim("first_name")), F.upper(F.trim("last_name")))).alias("token"))
    hits = names.join(tok, "token", "left_semi").select("source_system", "source_key", "organization").distinct() \
        .withColumn("_hit", F.lit(True))
    return (
        df.join(hits.hint("merge"), ["source_system", "source_key", "organization"], "left")
        .withColumn("is_fake_name", F.coalesce(F.col("_hit"), F.lit(False))
                    | F.coalesce(F.concat_ws(" ", "first_name", "last_name").rlike("[0-9]"), F.lit(False)))
        .drop("_hit")
    )


__all__ = ["union_customers_v1", "enrich_v1", "union_customers_v2", "union_addresses", "enrich_v2",
           "file_date", "nickname_table", "fake_name_flag", "org_fanout"]
