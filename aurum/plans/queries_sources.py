"""Source, harmonisation and scalar-function queries (SRC-*, PRJ-*, FN-*)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum import functions as AF
from aurum.operators.harmonise import enrich_v1, fake_name_flag, union_addresses, union_customers_v1, union_customers_v2
from aurum.plans import inputs
from aurum.plans.catalog import register
from aurum.plans.sqlfrag import date_valid, initcap_word, mod11_valid, row_hash, s, soundex
from aurum.session import shared_dir
from aurum.sources.files import ingest_stream, lineage_columns, read_ingested, read_source_csv

NICE_SCHEMA = T.StructType([T.StructField("ssn", T.StringType()), T.StructField("first_name", T.StringType()),
                            T.StructField("last_name", T.StringType()), T.StructField("phone", T.StringType()),
                            T.StructField("email", T.StringType()), T.StructField("record_date", T.DateType()),
                            T.StructField("organization", T.StringType()), T.StructField("_source_file", T.StringType())])
NICE_NULLS = ("", "NULL", "null", "N/A")


def _landing_csv(spark, sf_dir, name, df, partition_by=None):
    """Write a derived feed as CSV files once per session (the raw landing folder)."""
    from aurum.plans.layers import _MEMO
    key = (spark.sparkContext.applicationId, "csv", sf_dir, name)
    if key not in _MEMO:
        path = shared_dir(spark, f"csv/{uuid.uuid4().hex[:8]}/{name}")
        w = df.write.option("header", True).mode("overwrite")
        if partition_by:
            w = w.partitionBy(partition_by)
        w.csv(path)
        _MEMO[key] = path
    return _MEMO[key]


def _nice_csv(spark, sf_dir):
    n = inputs.nice(spark, sf_dir)
    # null tokens as different systems write them: 'N/A', 'NULL', 'null', empty
    tok = F.when(F.length(F.col("_source_file")) % 3 == 0, "N/A").when(F.length(F.col("_source_file")) % 3 == 1, "NULL").otherwise("null")
    out = n.select(F.coalesce("ssn", tok).alias("ssn"), "first_name", "last_name", F.coalesce("phone", F.lit("N/A")).alias("phone"),
                   F.coalesce("email", F.lit("null")).alias("email"), F.col("record_date").cast("string").alias("record_date"),
                   "organization", "_source_file")
    return _landing_csv(spark, sf_dir, "nice", out)


@register("src_csv_nulls", "SELECT ssn, first_name, last_name, phone, email, record_date, organization, _source_file FROM nice", "SRC-01, SRC-04")
def q_src_csv(spark, sf_dir):
    rows, _ = read_source_csv(spark, _nice_csv(spark, sf_dir), NICE_SCHEMA, NICE_NULLS)
    return rows.drop("_source_path")


@register("src_typed_load", "SELECT count(*) AS loaded, 0 AS rejected FROM nice", "SRC-04")
def q_src_typed(spark, sf_dir):
    rows, rej = read_source_csv(spark, _nice_csv(spark, sf_dir), NICE_SCHEMA, NICE_NULLS)
    flags = rows.select(F.lit(1).alias("o")).unionByName(rej.select(F.lit(0).alias("o")))
    return flags.agg(F.sum("o").cast("long").alias("loaded"), (F.count("*") - F.sum("o")).cast("int").alias("rejected"))


@register("src_lineage", "SELECT record_date AS file_date, count(*) AS rows FROM (SELECT record_date FROM freg UNION ALL SELECT record_date FROM bs UNION ALL SELECT record_date FROM nice) GROUP BY 1", "SRC-03")
def q_src_lineage(spark, sf_dir):
    f = _all_feeds(spark, sf_dir).select("ssn", "first_name", F.col("record_date").cast("string").alias("record_date"))
    path = _landing_csv(spark, sf_dir, "customers_by_date", f.withColumn("file_date", F.col("record_date")), partition_by="file_date")
    schema = T.StructType([T.StructField("ssn", T.StringType()), T.StructField("first_name", T.StringType()),
                           T.StructField("record_date", T.StringType())])
    raw = spark.read.option("header", True).schema(schema).csv(path).select("ssn", F.col("_metadata.file_path").alias("_source_path"))
    return lineage_columns(raw).groupBy(F.col("_file_date").alias("file_date")).agg(F.count("*").alias("rows"))


@register("src_initial_plus_updates", """SELECT split_part(_source_file, '/', 1) AS phase, 'FREG' AS source, count(*) AS rows FROM freg GROUP BY 1
UNION ALL SELECT split_part(_source_file, '/', 1), 'BS', count(*) FROM bs GROUP BY 1
UNION ALL SELECT split_part(_source_file, '/', 1), 'NICE', count(*) FROM nice GROUP BY 1""", "SRC-05")
def q_src_phases(spark, sf_dir):
    parts = [inputs.freg(spark, sf_dir).withColumn("source", F.lit("FREG")),
             inputs.bs(spark, sf_dir).withColumn("source", F.lit("BS")),
             inputs.nice(spark, sf_dir).withColumn("source", F.lit("NICE"))]
    u = parts[0].select("_source_file", "source")
    for p in parts[1:]:
        u = u.unionByName(p.select("_source_file", "source"))
    return u.groupBy(F.split("_source_file", "/").getItem(0).alias("phase"), "source").agg(F.count("*").alias("rows"))


@register("src_incremental", "SELECT ssn, first_name, last_name, phone, email, record_date, organization, _source_file FROM nice", "SRC-02")
def q_src_incremental(spark, sf_dir):
    """New-files-only ingestion: two drops of files, two availableNow runs on one checkpoint."""
    base = shared_dir(spark, f"incremental/{uuid.uuid4().hex[:8]}")
    n = inputs.nice(spark, sf_dir).select(*[F.col(c).cast("string") for c in NICE_SCHEMA.fieldNames()])
    n.where(F.col("_source_file").startswith("initial/")).write.option("header", True).mode("append").csv(base + "/in")
    q = ingest_stream(spark, base + "/in", NICE_SCHEMA, base + "/table", base + "/ckpt", NICE_NULLS)
    q.awaitTermination()
    n.where(F.col("_source_file").startswith("update/")).write.option("header", True).mode("append").csv(base + "/in")
    q = ingest_stream(spark, base + "/in", NICE_SCHEMA, base + "/table", base + "/ckpt", NICE_NULLS)
    q.awaitTermination()
    return read_ingested(spark, base + "/table")[0].drop("_source_path")


# The three customer files as lines of text, with records that can't be loaded: a date that is none, an id that is a
# NULL token where the file requires one, a line without its last field. (source, schema, NULL tokens)
FREG_SCHEMA = T.StructType([T.StructField("ssn", T.StringType(), False), T.StructField("first_name", T.StringType()),
                            T.StructField("last_name", T.StringType()), T.StructField("birth_date", T.DateType()),
                            T.StructField("citizenship", T.StringType()), T.StructField("record_date", T.DateType()),
                            T.StructField("_source_file", T.StringType())])
BS_SCHEMA = T.StructType([T.StructField("ssn", T.StringType(), False)] + NICE_SCHEMA.fields[1:])
FILES = {"FREG": (FREG_SCHEMA, ("", "NULL", "null")), "BS": (BS_SCHEMA, ("", "NULL", "null")), "NICE": (NICE_SCHEMA, NICE_NULLS)}
BAD_DATE = {"record_date": (13, 4, "2023-13-01"), "birth_date": (17, 6, "unknown")}  # k % modulus = remainder -> value
NO_ID = (19, 7, "NULL")
SHORT_LINE = (23, 2)


def _file_lines(spark, sf_dir, source):
    """(phase, line) of a customer file; the damage is a function of the person number."""
    def hit(modulus, remainder):
        return F.col("k") % modulus == remainder

    cols = []
    for f in FILES[source][0].fields:
        c = F.coalesce(F.col(f.name).cast("string"), F.lit(""))
        if f.name in BAD_DATE:
            c = F.when(hit(*BAD_DATE[f.name][:2]), BAD_DATE[f.name][2]).otherwise(c)
        if f.name == "ssn":
            c = F.when(hit(*NO_ID[:2]), NO_ID[2]).otherwise(c)
        cols.append(c)
    return inputs.table(spark, sf_dir, source.lower()).select(
        F.split_part("_source_file", F.lit("/"), F.lit(1)).alias("phase"),
        F.when(hit(*SHORT_LINE), F.concat_ws(",", *cols[:-1])).otherwise(F.concat_ws(",", *cols)).alias("line"))


def _files_sql() -> str:
    """CTE ``files``: the same lines, with the fields and the damage stated again."""
    def one(source):
        schema, _ = FILES[source]
        vals = {f.name: f"COALESCE(CAST({f.name} AS VARCHAR), '')" for f in schema.fields}
        for name, (m, r, v) in BAD_DATE.items():
            if name in vals:
                vals[name] = f"CASE WHEN k % {m} = {r} THEN '{v}' ELSE {vals[name]} END"
        vals["ssn"] = f"CASE WHEN k % {NO_ID[0]} = {NO_ID[1]} THEN '{NO_ID[2]}' ELSE {vals['ssn']} END"
        line = list(vals.values())
        birth = f"k % {BAD_DATE['birth_date'][0]} = {BAD_DATE['birth_date'][1]}" if "birth_date" in vals else "FALSE"
        no_id = f"(ssn IS NULL OR k % {NO_ID[0]} = {NO_ID[1]})" if source != "NICE" else "FALSE"
        return f"""SELECT '{source}' AS source, split_part(_source_file, '/', 1) AS phase, {line[0]} AS raw_ssn, first_name,
  CASE WHEN k % {SHORT_LINE[0]} = {SHORT_LINE[1]} THEN concat_ws(',', {', '.join(line[:-1])}) END AS short_line,
  k % {BAD_DATE['record_date'][0]} = {BAD_DATE['record_date'][1]} AS bad_record, {birth} AS bad_birth, {no_id} AS no_id, k FROM {source.lower()}"""
    return "files AS (" + " UNION ALL ".join(one(x) for x in FILES) + """),
rejected AS (
  SELECT source, phase, first_name, NULL AS field, 'columns' AS reason, short_line AS value, k FROM files WHERE short_line IS NOT NULL
  UNION ALL SELECT source, phase, first_name, 'record_date', 'type', '""" + BAD_DATE["record_date"][2] + """', k FROM files WHERE bad_record
  UNION ALL SELECT source, phase, first_name, 'birth_date', 'type', '""" + BAD_DATE["birth_date"][2] + """', k FROM files WHERE bad_birth
  UNION ALL SELECT source, phase, first_name, 'ssn', 'missing', raw_ssn, k FROM files WHERE no_id
)"""


def _reasons(rejects):
    return rejects.select("first_name", F.explode("_rejects").alias("r")).select("first_name", "r.field", "r.reason", "r.value")


@register("src_load_rejects", _files_sql() + """
SELECT source, 'accepted' AS reason, NULL AS field, count(*) AS rows FROM files
WHERE short_line IS NULL AND NOT bad_record AND NOT bad_birth AND NOT no_id GROUP BY 1
UNION ALL SELECT source, reason, field, count(*) FROM rejected GROUP BY ALL""", "SRC-01, SRC-04")
def q_src_load_rejects(spark, sf_dir):
    """All three files: accepted records, and the reasons of the others."""
    out = []
    for source, (schema, nulls) in FILES.items():
        path = shared_dir(spark, f"files/{uuid.uuid4().hex[:8]}")
        _file_lines(spark, sf_dir, source).select("line").write.text(path)
        rows, rejects = read_source_csv(spark, path, schema, nulls, header=False)
        one = rows.select(F.lit("accepted").alias("reason"), F.lit(None).cast("string").alias("field")) \
            .unionByName(_reasons(rejects).select("reason", "field"))
        out.append(one.groupBy("reason", "field").agg(F.count("*").alias("rows")).withColumn("source", F.lit(source)))
    return reduce(DataFrame.unionByName, out).select("source", "reason", "field", "rows")


def _ingested(spark, sf_dir, source):
    """Two drops of files, two runs on one checkpoint, one table of rows and rejects."""
    schema, nulls = FILES[source]
    base = shared_dir(spark, f"incremental/{uuid.uuid4().hex[:8]}")
    lines = _file_lines(spark, sf_dir, source)
    for phase in ("initial", "update"):
        lines.where(F.col("phase") == phase).select("line").write.mode("append").text(base + "/in")
        ingest_stream(spark, base + "/in", schema, base + "/table", base + "/ckpt", nulls, header=False).awaitTermination()
    return read_ingested(spark, base + "/table")


@register("src_ingest_accepted", _files_sql() + """
SELECT f.ssn, f.first_name, f.last_name, f.birth_date, f.citizenship, f.record_date, f._source_file
FROM freg f WHERE NOT EXISTS (SELECT 1 FROM rejected r WHERE r.source = 'FREG' AND r.k = f.k)""", "SRC-02, SRC-04")
def q_src_ingest_accepted(spark, sf_dir):
    return _ingested(spark, sf_dir, "FREG")[0].drop("_source_path")


@register("src_ingest_rejects", _files_sql() + """
SELECT source, first_name, field, reason, value FROM rejected""", "SRC-02, SRC-04")
def q_src_ingest_rejects(spark, sf_dir):
    """Reasons and values of every rejected record of the three incremental loads."""
    out = [_reasons(_ingested(spark, sf_dir, x)[1]).withColumn("source", F.lit(x)) for x in FILES]
    return reduce(DataFrame.unionByName, out).select("source", "first_name", "field", "reason", "value")


V1U = """SELECT ssn, first_name, last_name, birth_date, citizenship, CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS email,
       o.organization, record_date, 'FREG' AS source_system, 3 AS trust_score, _source_file
FROM freg CROSS JOIN (VALUES ('BANK'), ('INS')) AS o(organization)
UNION ALL SELECT ssn, first_name, last_name, NULL, NULL, phone, email, organization, record_date, 'BS', 2, _source_file FROM bs
UNION ALL SELECT ssn, first_name, last_name, NULL, NULL, phone, email, organization, record_date, 'NICE', 1, _source_file FROM nice"""


@register("customer_union", V1U, "PRJ-01, ST-01")
def q_union(spark, sf_dir):
    return union_customers_v1(inputs.freg(spark, sf_dir), inputs.bs(spark, sf_dir), inputs.nice(spark, sf_dir), True)


from aurum.plans import pairwise_sql as PS  # noqa: E402


@register("customer_union_broadcast", PS.base() + "\nSELECT source_system, source_key, ssn, first_name, last_name, birth_date, "
          "citizenship, phone, email, record_date, organization, _source_file FROM v2_union", "PRJ-02, FN-01..03")
def q_union_b(spark, sf_dir):
    return union_customers_v2(inputs.freg(spark, sf_dir), inputs.bs(spark, sf_dir), inputs.nice(spark, sf_dir))


@register("address_union", PS.clusters("parity", "transitive") + PS.addresses() + "\nSELECT * EXCLUDE (_source_file) FROM a2_union", "PRJ-03, SRC-03")
def q_addr_union(spark, sf_dir):
    return union_addresses(inputs.addresses(spark, sf_dir, "FREG"), inputs.addresses(spark, sf_dir, "BS"),
                           inputs.addresses(spark, sf_dir, "NICE")).drop("_source_file")


@register("source_key_surrogate", PS.base() + "\nSELECT source_key, first_name, last_name, phone FROM v2_union WHERE source_system = 'NICE' AND ssn IS NULL", "PRJ-04")
def q_surrogate(spark, sf_dir):
    u = union_customers_v2(inputs.freg(spark, sf_dir), inputs.bs(spark, sf_dir), inputs.nice(spark, sf_dir))
    return u.where((F.col("source_system") == "NICE") & F.col("ssn").isNull()).select("source_key", "first_name", "last_name", "phone")


@register("row_key", f"""SELECT source_system, ssn, record_date, organization,
  md5(concat_ws('|', source_system, COALESCE(ssn, ''), COALESCE(first_name, ''), COALESCE(last_name, ''), CAST(record_date AS VARCHAR),
                COALESCE(organization, ''), COALESCE(_source_file, ''))) AS row_key FROM ({V1U})""", "PRJ-05")
def q_row_key(spark, sf_dir):
    u = enrich_v1(union_customers_v1(inputs.freg(spark, sf_dir), inputs.bs(spark, sf_dir), inputs.nice(spark, sf_dir), True))
    return u.select("source_system", "ssn", "record_date", "organization", "row_key")


PROFILE_COLS = ["ssn", "first_name", "last_name", "birth_date", "citizenship", "phone", "email"]


@register("profile_completeness", PS.base() + ",\nprof AS (SELECT * FROM v2_union)\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) AS total FROM prof" for c in PROFILE_COLS),
    "PRJ-10")
def q_profile(spark, sf_dir):
    u = union_customers_v2(inputs.freg(spark, sf_dir), inputs.bs(spark, sf_dir), inputs.nice(spark, sf_dir))
    agg = u.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in PROFILE_COLS], F.count("*").alias("_total"))
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in PROFILE_COLS]))
    return agg.select(stack.alias("p"), "_total").select("p.column_name", "p.nulls", F.col("_total").alias("total"))


# ------------------------------------------------------------------------- scalar functions

FEED_COLS = ["ssn", "first_name", "last_name", "phone", "email", "record_date"]
ALL_FEEDS = "(SELECT " + "\nUNION ALL SELECT ".join([
    "ssn, first_name, last_name, CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS email, record_date FROM freg",
    ", ".join(FEED_COLS) + " FROM bs", ", ".join(FEED_COLS) + " FROM nice"]) + ")"


def _all_feeds(spark, sf_dir):
    """The common columns of the three customer feeds; the registry has no contact data."""
    return inputs.freg(spark, sf_dir).select(*FEED_COLS[:3], F.lit(None).cast("string").alias("phone"), F.lit(None).cast("string").alias("email"), "record_date") \
        .unionByName(inputs.bs(spark, sf_dir).select(*FEED_COLS)).unionByName(inputs.nice(spark, sf_dir).select(*FEED_COLS))


@register("fn_initcap", f"SELECT first_name, {initcap_word('trim(first_name)')} AS title_name FROM {ALL_FEEDS}", "FN-01")
def q_fn_initcap(spark, sf_dir):
    return _all_feeds(spark, sf_dir).select("first_name", AF.title_case("first_name").alias("title_name"))


@register("fn_normalise_email", f"SELECT email, lower(trim(email)) AS email_norm FROM {ALL_FEEDS}", "FN-02")
def q_fn_email(spark, sf_dir):
    return _all_feeds(spark, sf_dir).select("email", AF.norm_email("email").alias("email_norm"))


@register("fn_normalise_phone", f"SELECT phone, NULLIF(regexp_replace(phone, '[^0-9+]', '', 'g'), '') AS phone_norm FROM {ALL_FEEDS}", "FN-03")
def q_fn_phone(spark, sf_dir):
    return _all_feeds(spark, sf_dir).select("phone", AF.norm_phone("phone").alias("phone_norm"))


def _suffix_sql(n):
    d = "regexp_replace(phone, '[^0-9]', '', 'g')"
    return f"CASE WHEN length({d}) >= {n} THEN right({d}, {n}) END"


@register("fn_phone_suffix", f"SELECT phone, {_suffix_sql(4)} AS suffix4, {_suffix_sql(8)} AS suffix8, {_suffix_sql(10)} AS suffix10 FROM {ALL_FEEDS}", "FN-04")
def q_fn_suffix(spark, sf_dir):
    n = _all_feeds(spark, sf_dir)
    return n.select("phone", AF.phone_suffix("phone", 4).alias("suffix4"), AF.phone_suffix("phone", 8).alias("suffix8"),
                    AF.phone_suffix("phone", 10).alias("suffix10"))


@register("fn_email_domain", f"SELECT email, CASE WHEN strpos(email, '@') > 0 THEN substr(email, strpos(email, '@')) END AS domain FROM {ALL_FEEDS}", "FN-05")
def q_fn_domain(spark, sf_dir):
    return _all_feeds(spark, sf_dir).select("email", AF.email_domain("email").alias("domain"))


@register("fn_soundex", f"SELECT DISTINCT last_name, {soundex('last_name')} AS code FROM {ALL_FEEDS}", "FN-06")
def q_fn_soundex(spark, sf_dir):
    return _all_feeds(spark, sf_dir).select("last_name", AF.soundex_nordic("last_name").alias("code")).distinct()


@register("fn_jaro_winkler", """SELECT n.k, n.organization, upper(n.first_name) AS a, upper(f.first_name) AS b,
  round(jaro_winkler_similarity(upper(n.first_name), upper(f.first_name)), 6) AS jw
FROM nice n JOIN freg f ON f.k = n.k""", "FN-07")
def q_fn_jw(spark, sf_dir):
    """Each CRM row's first name against the registry's for the same person (a person has at most an initial row and an update)."""
    n = inputs.table(spark, sf_dir, "nice")
    f = inputs.table(spark, sf_dir, "freg").select("k", F.col("first_name").alias("f_first"))
    j = n.join(f, "k")
    return j.select("k", "organization", F.upper("first_name").alias("a"), F.upper("f_first").alias("b")) \
        .withColumn("jw", F.round(AF.jaro_winkler("a", "b"), 6))


@register("fn_ssn_mod11", f"SELECT DISTINCT ssn, {mod11_valid('ssn')} AS valid FROM (SELECT ssn FROM freg UNION ALL SELECT ssn FROM bs UNION ALL SELECT ssn FROM nice)", "FN-08")
def q_fn_mod11(spark, sf_dir):
    u = inputs.freg(spark, sf_dir).select("ssn").unionByName(inputs.bs(spark, sf_dir).select("ssn")).unionByName(inputs.nice(spark, sf_dir).select("ssn"))
    return u.select("ssn", AF.ssn_mod11_valid("ssn").alias("valid")).distinct()


@register("fn_ssn_date_valid", f"SELECT DISTINCT ssn, {date_valid('ssn')} AS valid FROM {ALL_FEEDS}", "FN-09")
def q_fn_date(spark, sf_dir):
    return _all_feeds(spark, sf_dir).select("ssn", AF.ssn_date_valid("ssn").alias("valid")).distinct()


from aurum import rules  # noqa: E402
from aurum.plans.sqlfrag import values_table  # noqa: E402


@register("enrich_nickname", f"""SELECT DISTINCT first_name, COALESCE(n.canonical, upper(first_name)) AS canonical_first_name
FROM (SELECT first_name FROM freg UNION ALL SELECT first_name FROM bs UNION ALL SELECT first_name FROM nice) u
LEFT JOIN {values_table(rules.NICKNAMES, ['nickname', 'canonical'], 'n')} ON upper(u.first_name) = n.nickname""", "FN-10")
def q_nickname(spark, sf_dir):
    e = enrich_v1(union_customers_v1(inputs.freg(spark, sf_dir), inputs.bs(spark, sf_dir), inputs.nice(spark, sf_dir), True))
    return e.select("first_name", "canonical_first_name").distinct()


FAKE_TOKENS = rules.FAKE_TOKENS


@register("enrich_fake_name", PS.base() + f"""
SELECT source_system, source_key, organization,
  (upper(trim(first_name)) IN ({', '.join(s(t) for t in FAKE_TOKENS)}) OR upper(trim(last_name)) IN ({', '.join(s(t) for t in FAKE_TOKENS)})
   OR COALESCE(regexp_matches(concat_ws(' ', first_name, last_name), '[0-9]'), FALSE)) AS is_fake_name
FROM v2_union""", "FN-11")
def q_fake(spark, sf_dir):
    u = union_customers_v2(inputs.freg(spark, sf_dir), inputs.bs(spark, sf_dir), inputs.nice(spark, sf_dir))
    tokens = spark.createDataFrame([(t,) for t in FAKE_TOKENS], "token string")
    return fake_name_flag(u, tokens).select("source_system", "source_key", "organization", "is_fake_name")


@register("fn_row_hash", f"SELECT ssn, first_name, record_date, {row_hash(['ssn', 'first_name', 'last_name', 'phone', 'email', 'record_date'], '|')} AS row_hash FROM {ALL_FEEDS}", "FN-12")
def q_row_hash(spark, sf_dir):
    n = _all_feeds(spark, sf_dir)
    return n.select("ssn", "first_name", "record_date", AF.row_hash("ssn", "first_name", "last_name", "phone", "email", "record_date").alias("row_hash"))


@register("fn_validators", f"""SELECT email, first_name, phone,
  COALESCE(regexp_matches(email, {s(rules.EMAIL_PATTERN)}), FALSE) AS email_ok,
  COALESCE(regexp_matches(first_name, {s(rules.NAME_PATTERN_BULK)}), FALSE) AS name_ok,
  COALESCE(regexp_matches(regexp_replace(phone, '[^0-9+]', '', 'g'), {s(rules.PHONE_PATTERN_NO)}), FALSE) AS phone_no_ok,
  COALESCE(regexp_matches(regexp_replace(phone, '[^0-9+]', '', 'g'), {s(rules.PHONE_PATTERN_INTL)}), FALSE) AS phone_intl_ok
FROM {ALL_FEEDS}""", "FN-16")
def q_validators(spark, sf_dir):
    n = _all_feeds(spark, sf_dir)
    p = F.regexp_replace("phone", r"[^0-9+]", "")
    return n.select("email", "first_name", "phone",
                    F.coalesce(F.col("email").rlike(rules.EMAIL_PATTERN), F.lit(False)).alias("email_ok"),
                    F.coalesce(F.col("first_name").rlike(rules.NAME_PATTERN_BULK), F.lit(False)).alias("name_ok"),
                    F.coalesce(p.rlike(rules.PHONE_PATTERN_NO), F.lit(False)).alias("phone_no_ok"),
                    F.coalesce(p.rlike(rules.PHONE_PATTERN_INTL), F.lit(False)).alias("phone_intl_ok"))


@register("fn_postcode", f"""SELECT src_address_id, postnummer, COALESCE(regexp_matches(postnummer, {s(rules.POSTCODE_PATTERN_NO)}), FALSE) AS postcode_ok,
  CASE WHEN length(postnummer) >= 3 THEN left(postnummer, 3) END AS postal_block
FROM (SELECT * FROM addr_freg UNION ALL SELECT * FROM addr_bs UNION ALL SELECT * FROM addr_nice)""", "FN-16, BLK-06")
def q_postcode(spark, sf_dir):
    a = reduce(DataFrame.unionByName, [inputs.addresses(spark, sf_dir, x) for x in ("FREG", "BS", "NICE")])
    return a.select("src_address_id", "postnummer", F.coalesce(F.col("postnummer").rlike(rules.POSTCODE_PATTERN_NO), F.lit(False)).alias("postcode_ok"),
                    F.when(F.length("postnummer") >= 3, F.substring("postnummer", 1, 3)).alias("postal_block"))
