"""CRM event topics derived from the ``events`` table, and their parsing.

Person k = user_id mod N (N = customers); topic by event type
(signup -> CRM_A, purchase/click -> CRM_B, view/error -> CRM_C); event
time = ``ts``; arrival order = event_id reversed in blocks of 10 (out of
order); every 97th payload is cut short (malformed JSON).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum.functions import email_domain, norm_email, norm_phone, phone_suffix, soundex_nordic, title_case
from aurum.sources.derived import CITIES, FIRST_NAMES, LAST_NAMES, MAIL_DOMAINS, _pick

# Topic names and their source systems.
TOPIC_OF_EVENT = {"signup": "topic.crm.a", "purchase": "topic.crm.b", "click": "topic.crm.b",
                  "view": "topic.crm.c", "error": "topic.crm.c"}

SCHEMA_A = T.StructType([T.StructField(n, T.StringType()) for n in ["src_customer_id", "first_name", "last_name", "email", "phone"]])
SCHEMA_B = T.StructType([T.StructField(n, T.StringType()) for n in ["customer_key", "name", "email_address", "mobile"]])
SCHEMA_C = T.StructType([T.StructField(n, T.StringType()) for n in ["ticket_customer_id", "caller_name", "callback_email", "callback_phone"]])
SCHEMA_ALL = T.StructType(SCHEMA_A.fields + SCHEMA_B.fields + SCHEMA_C.fields)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, arrival_seq, topic, event_ts, payload) — the message log."""
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet")
    n = cust.select(F.count("*")).scalar()
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type")
    k = (F.col("user_id") % n)
    eid = F.col("event_id")
    first = _pick(FIRST_NAMES, k % 16)
    last = _pick(LAST_NAMES, F.floor(k / 16) % 25)
    phone = F.when(eid % 13 == 0, F.concat(F.lit("+47 8"), F.lpad((k % 10000000).cast("string"), 7, "0"))) \
        .otherwise(F.concat(F.lit("+47 9"), F.lpad((k % 10000000).cast("string"), 7, "0")))
    email = F.when(eid % 17 == 0, F.lit("")).otherwise(
        F.concat(F.lower(first), F.lit("."), F.lower(last), (k % 97).cast("string"), F.lit("@"), _pick(MAIL_DOMAINS, F.floor(k / 5) % 5)))
    name = F.when(eid % 5 == 0, F.lower(F.concat_ws(" ", first, last))).otherwise(F.concat_ws(" ", first, last))
    topic = F.coalesce(*[F.when(F.col("event_type") == et, F.lit(tp)) for et, tp in TOPIC_OF_EVENT.items()])
    pa = F.to_json(F.struct(F.concat(F.lit("A"), k.cast("string")).alias("src_customer_id"), first.alias("first_name"),
                            last.alias("last_name"), email.alias("email"), phone.alias("phone")))
    pb = F.to_json(F.struct(F.concat(F.lit("B"), k.cast("string")).alias("customer_key"), name.alias("name"),
                            email.alias("email_address"), phone.alias("mobile")))
    pc = F.to_json(F.struct(F.concat(F.lit("C"), k.cast("string")).alias("ticket_customer_id"), name.alias("caller_name"),
                            email.alias("callback_email"), phone.alias("callback_phone")))
    payload = F.when(topic == "topic.crm.a", pa).when(topic == "topic.crm.b", pb).otherwise(pc)
    payload = F.when(eid % 97 == 0, F.substring(payload, 1, 25)).otherwise(payload)
    return ev.select(
        "event_id", ((F.floor(eid / 10) * 10) + 9 - eid % 10).alias("arrival_seq"), topic.alias("topic"),
        F.col("ts").alias("event_ts"), payload.alias("payload"))


#: address messages of all systems share one topic; the payload names its system
ADDRESS_TOPIC = "topic.address"
SCHEMA_ADDRESS = T.StructType([T.StructField(n, T.StringType()) for n in
                               ["source_system", "src_address_id", "src_customer_id", "gate", "postnummer", "by", "land"]])
ADDRESS_COLS = ["source_system", "source_key", "source_customer_key", "gate", "postnummer", "by", "land", "event_ts", "arrival_seq"]


def raw_address_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address messages: every readable CRM event is followed by its customer's address
    (person k lives at number 1 + k % 120; CRM_C abbreviates the street for k % 3 = 0, no city for k % 30 = 7)."""
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet")
    n = cust.select(F.count("*")).scalar()
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type").where("event_id % 97 <> 0")
    k, eid = F.col("user_id") % n, F.col("event_id")
    letter = F.when(F.col("event_type") == "signup", "A").when(F.col("event_type").isin("purchase", "click"), "B") \
        .when(F.col("event_type").isin("view", "error"), "C")
    street = F.when((letter == "C") & (k % 3 == 0), "Storg. ").otherwise("Storgata ")
    key = F.concat(letter, k.cast("string"))
    payload = F.to_json(F.struct(
        F.concat(F.lit("CRM_"), letter).alias("source_system"), F.concat(F.lit("ADDR-"), key).alias("src_address_id"), key.alias("src_customer_id"),
        F.concat(street, (1 + k % 120).cast("string")).alias("gate"), F.lpad(((k * 37) % 10000).cast("string"), 4, "0").alias("postnummer"),
        F.when(k % 30 == 7, F.lit(None).cast("string")).otherwise(_pick(CITIES, k % 4)).alias("by"), F.lit("NO").alias("land")))
    return ev.where(letter.isNotNull()).select(
        "event_id", ((F.floor(eid / 10) * 10) + 9 - eid % 10).alias("arrival_seq"), F.lit(ADDRESS_TOPIC).alias("topic"),
        F.col("ts").alias("event_ts"), payload.alias("payload"))


def map_addresses(raw: DataFrame) -> DataFrame:
    """Address records of the address topic; payloads without keys are left to the caller's rejects."""
    j = F.from_json("payload", SCHEMA_ADDRESS)
    a = raw.where(F.col("topic") == ADDRESS_TOPIC).select("event_ts", "arrival_seq", j.alias("j")).select(
        "j.source_system", F.col("j.src_address_id").alias("source_key"), F.col("j.src_customer_id").alias("source_customer_key"),
        "j.gate", "j.postnummer", "j.by", "j.land", "event_ts", "arrival_seq")
    return a.where("source_system is not null and source_key is not null and source_customer_key is not null").select(*ADDRESS_COLS)


def _split_name(c: Column) -> tuple[Column, Column]:
    parts = F.split(F.coalesce(c, F.lit("")), " ", 2)
    first = F.when(F.length(parts.getItem(0)) > 0, title_case(parts.getItem(0)))
    last = F.when(F.size(parts) > 1, title_case(parts.getItem(1)))
    return first, last


def map_events(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Topic dispatch + field mapping (PRJ-06..08, SRC-07).

    Returns (records, rejects). Rejects are malformed JSON, unknown topics and
    payloads without their business key; they carry a reason.
    """
    # well-formed address messages are mapped by map_addresses; the others are rejected here
    address = F.from_json("payload", SCHEMA_ADDRESS)
    keyed = address["source_system"].isNotNull() & address["src_address_id"].isNotNull() & address["src_customer_id"].isNotNull()
    raw = raw.where((F.col("topic") != ADDRESS_TOPIC) | F.col("topic").isNull() | ~F.coalesce(keyed, F.lit(False)))
    # one parse per message with the union of the three topic schemas
    j = F.col("_j")
    a = b = c = j
    raw = raw.withColumn("_j", F.from_json("payload", SCHEMA_ALL))
    t = F.col("topic")
    bf, bl = _split_name(b["name"])
    cf, cl = _split_name(c["caller_name"])
    sys_ = F.when(t == "topic.crm.a", "CRM_A").when(t == "topic.crm.b", "CRM_B").when(t == "topic.crm.c", "CRM_C")
    key = F.when(t == "topic.crm.a", a["src_customer_id"]).when(t == "topic.crm.b", b["customer_key"]) \
        .when(t == "topic.crm.c", c["ticket_customer_id"])
    first = F.when(t == "topic.crm.a", title_case(a["first_name"])).when(t == "topic.crm.b", bf).otherwise(cf)
    last = F.when(t == "topic.crm.a", title_case(a["last_name"])).when(t == "topic.crm.b", bl).otherwise(cl)
    email = norm_email(F.when(t == "topic.crm.a", a["email"]).when(t == "topic.crm.b", b["email_address"]).otherwise(c["callback_email"]))
    phone = norm_phone(F.when(t == "topic.crm.a", a["phone"]).when(t == "topic.crm.b", b["mobile"]).otherwise(c["callback_phone"]))
    m = raw.select("event_id", "arrival_seq", "topic", "event_ts", "payload",
                   sys_.alias("source_system"), key.alias("source_key"), first.alias("first_name"), last.alias("last_name"),
                   email.alias("email"), phone.alias("phone"))
    m = m.withColumn("reject_reason", F.when(F.col("topic") == ADDRESS_TOPIC, "MALFORMED_OR_NO_KEY")
                     .when(F.col("source_system").isNull(), "UNKNOWN_TOPIC")
                     .when(F.col("payload").isNull(), "NULL_PAYLOAD")
                     .when(F.col("source_key").isNull(), "MALFORMED_OR_NO_KEY"))
    rejects = m.where(F.col("reject_reason").isNotNull()).select("event_id", "topic", "event_ts", "payload", "reject_reason")
    recs = m.where(F.col("reject_reason").isNull()).select(
        "event_id", "arrival_seq", "source_system", "source_key", "first_name", "last_name", "email", "phone", "event_ts",
        title_case("first_name").alias("canonical_first_name"),
        soundex_nordic("last_name").alias("block_soundex"),
        email_domain("email").alias("block_email_domain"),
        phone_suffix("phone", 4).alias("block_phone_suffix"))
    return recs, rejects
