"""SSN-first rule set (bulk V1): enrich -> groups -> golden -> current/history/queue.

Identity = checksum-valid national id; SSN-less records are matched by
Jaro-Winkler on (canonical first, last) name against the names of known ids
(average >= 92 of 100), else they go to the steward queue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum import rules
from aurum.functions import row_hash
from aurum.operators.fuzzy import similar_values
from aurum.operators.harmonise import enrich_v1, union_customers_v1
from aurum.operators.survivorship import Rule, desc_date, survive
from aurum.plans import inputs
from aurum.plans.catalog import register
from aurum.plans.sqlfrag import mod11_valid, row_hash as sql_row_hash, values_table

NEAR_MISS = 0.84  # scored pairs are reported from this average on

GROUP_COLS = ["row_key", "ssn", "first_name", "last_name", "canonical_first_name", "birth_date", "citizenship",
              "phone", "email", "organization", "record_date", "source_system", "trust_score", "ssn_valid",
              "_source_file", "match_id", "match_confidence", "match_method", "steward_queue_flag",
              "fuzzy_score", "candidate_ssn"]


def enriched(spark: SparkSession, sf_dir: str, broadcast: bool = True) -> DataFrame:
    u = union_customers_v1(inputs.freg(spark, sf_dir), inputs.bs(spark, sf_dir), inputs.nice(spark, sf_dir), broadcast)
    return enrich_v1(u)


#: average scores (0-1) down to which names without a match are searched for their best rejected candidate
NEAR_STEPS = (0.8, 0.65, 0.0)
#: from this score of the weaker part on, few values are similar and both parts are looked up before candidates are
BOTH_FROM = 0.55
SLACK = 1e-9


def _name_sets(enr: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidate names with their smallest and largest valid id, and the SSN-less names."""
    cand = (enr.where("ssn_valid").select(F.col("canonical_first_name").alias("cf"), F.upper("last_name").alias("cl"), "ssn")
            .groupBy("cf", "cl").agg(F.min("ssn").alias("ssn_min"), F.max("ssn").alias("ssn_max")))
    q = (enr.where(F.col("ssn").isNull())
         .select(F.col("canonical_first_name").alias("qf"), F.upper("last_name").alias("ql"))
         .where(F.col("qf").isNotNull() & F.col("ql").isNotNull()).distinct())
    return cand, q


def _hits(q: DataFrame, cand: DataFrame, qcol: str, ccol: str, threshold: float, score: str) -> DataFrame:
    """Similar values (qcol, ccol, score) of one part of the names."""
    return similar_values(q.select(F.col(qcol).alias("value")), cand.select(F.col(ccol).alias("value")), threshold) \
        .select(F.col("left_value").alias(qcol), F.col("right_value").alias(ccol), F.col("jw").alias(score))


def _scored(q: DataFrame, cand: DataFrame, bound: float) -> DataFrame:
    """Names (qf, ql and perhaps need) with every candidate whose average score is at least ``bound`` and the name's own ``need``.

    An average of ``bound`` needs one part at least ``bound`` and the other at
    least 2 ``bound`` - 1. Where that is high, a name meets the pairs of its
    similar first and last names, whose number doesn't depend on how many
    candidates share a name, and candidates are looked up last. Else each search
    starts from the stronger part, so the candidate names prune its hits before
    the weaker part is looked up; the weaker part has to make up what the
    stronger one leaves of ``need``.
    """
    if "need" not in q.columns:
        q = q.withColumn("need", F.lit(0.0))
    weak = max(0.0, 2.0 * bound - 1.0 - SLACK)
    enough = lambda s: s >= F.col("need") * 100.0
    if weak >= BOTH_FROM:
        both = q.join(_hits(q, cand, "qf", "cf", weak, "jf"), "qf").join(_hits(q, cand, "ql", "cl", weak, "jl"), "ql") \
            .withColumn("score", (F.col("jf") + F.col("jl")) / 2.0 * 100.0).where(enough(F.col("score")))
        return both.join(cand, ["cf", "cl"]).select("qf", "ql", "cf", "cl", "ssn_min", "ssn_max", "score")
    out = None
    for strong, other in ((("qf", "cf"), ("ql", "cl")), (("ql", "cl"), ("qf", "cf"))):
        met = q.join(_hits(q, cand, *strong, bound, "jw_strong"), strong[0]).where(F.col("jw_strong") >= F.col("need")).join(cand, strong[1])
        rest = _hits(met, met, *other, weak, "jw_other")
        # a weak part without any common character scores 0
        one = met.join(rest, list(other), "left" if weak == 0.0 else "inner") \
            .withColumn("score", (F.col("jw_strong") + F.coalesce("jw_other", F.lit(0.0))) / 2.0 * 100.0).where(enough(F.col("score")))
        one = one.select("qf", "ql", "cf", "cl", "ssn_min", "ssn_max", "score")
        out = one if out is None else out.unionByName(one)
    return out.groupBy("qf", "ql", "cf", "cl").agg(F.min("ssn_min").alias("ssn_min"), F.max("ssn_max").alias("ssn_max"), F.max("score").alias("score"))


def fuzzy_candidates(enr: DataFrame, threshold: float = rules.FUZZY_THRESHOLD_V1) -> tuple[DataFrame, DataFrame]:
    """Best candidate id per SSN-less *name* (not per record) (JN-01/02, AG-03).

    Returns (best, near): ``best`` holds names whose best average score is >=
    threshold with the winning id (ties -> smallest id); ``near`` holds the best
    score of every other name, with the largest id at that score. It is exact,
    a best-first search in steps: a name is settled at the first step whose
    bound its best score reaches. An open name keeps the best score seen so far
    and only meets candidates that can reach it; no step goes below the lowest
    of these scores.
    """
    cand, q = _name_sets(enr)
    return best_candidates(q.checkpoint(), cand.checkpoint(), threshold)


def best_candidates(q: DataFrame, cand: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """:func:`fuzzy_candidates` of names (qf, ql) among candidate names (cf, cl, ssn_min, ssn_max)."""
    names = ["qf", "ql"]
    top = [F.max_by(F.struct("score", "ssn_max"), F.struct("score", "ssn_max")).alias("n")]
    first = _scored(q, cand, threshold / 100.0).groupBy(*names).agg(
        F.min_by(F.struct("ssn_min", "score"), F.struct(-F.col("score"), F.col("ssn_min"))).alias("b")).select(*names, "b.ssn_min", "b.score").checkpoint()
    best = first.where(F.col("score") >= threshold).select(*names, F.col("ssn_min").alias("best_ssn"), F.col("score").alias("best_score"))
    left = q.join(best, names, "left_anti").join(first, names, "left").select(*names, F.coalesce(F.col("score") / 100.0 - SLACK, F.lit(0.0)).alias("need")).checkpoint()
    near = None
    for step in NEAR_STEPS:
        lowest = left.agg(F.min("need")).first()[0]  # one number
        if lowest is None:
            break
        bound = max(step, lowest)
        hit = _scored(left, cand, bound).groupBy(*names).agg(*top).select(*names, F.col("n.score").alias("near_score"), F.col("n.ssn_max").alias("near_ssn")).checkpoint()
        done = hit.where(F.col("near_score") >= bound * 100.0)
        near = done if near is None else near.unionByName(done)
        left = left.join(done, names, "left_anti").join(hit, names, "left").select(
            *names, F.greatest("need", F.coalesce(F.col("near_score") / 100.0 - SLACK, F.lit(0.0))).alias("need")).checkpoint()
    if near is None:
        return best, left.select("qf", "ql", F.lit(None).cast("double").alias("near_score"), F.lit(None).cast("string").alias("near_ssn"))
    # no candidate shares a character with the names still open: every candidate scores 0
    last = cand.select(F.max("ssn_max")).scalar()
    return best, near.unionByName(left.select("qf", "ql", F.lit(0.0).alias("near_score"), last.alias("near_ssn")).where(F.col("near_ssn").isNotNull()))


def groups(enr: DataFrame) -> DataFrame:
    """Four match paths: SSN_EXACT / INVALID_SSN / FUZZY_JW / UNMATCHED (SC-14)."""
    valid, text, dec = F.col("ssn_valid"), F.lit(None).cast("string"), F.lit(None).cast(T.DoubleType())
    # records with an id in one pass, those without in another
    with_id = enr.where(valid | (F.col("ssn").isNotNull() & ~valid)).select(
        "*", F.when(valid, F.col("ssn")).alias("match_id"), F.when(valid, 100).otherwise(0).alias("match_confidence"),
        F.when(valid, "SSN_EXACT").otherwise("INVALID_SSN").alias("match_method"), (~valid).alias("steward_queue_flag"),
        dec.alias("fuzzy_score"), text.alias("candidate_ssn"))
    best, near = fuzzy_candidates(enr)
    hit = F.col("best_ssn").isNotNull()
    no_ssn = (enr.where(F.col("ssn").isNull())
              .withColumn("qf", F.col("canonical_first_name")).withColumn("ql", F.upper("last_name"))
              .join(best, ["qf", "ql"], "left").join(near, ["qf", "ql"], "left"))
    by_name = no_ssn.select(
        *enr.columns, F.col("best_ssn").alias("match_id"), F.when(hit, 85).otherwise(0).alias("match_confidence"),
        F.when(hit, "FUZZY_JW").otherwise("UNMATCHED").alias("match_method"), (~hit).alias("steward_queue_flag"),
        F.when(hit, F.col("best_score")).otherwise(F.col("near_score")).alias("fuzzy_score"),
        F.when(hit, F.col("best_ssn")).otherwise(F.col("near_ssn")).alias("candidate_ssn"))
    return with_id.unionByName(by_name).select(*GROUP_COLS)


def _matched(g: DataFrame) -> DataFrame:
    return g.where(F.col("match_id").isNotNull() & F.col("organization").isNotNull() & ~F.col("steward_queue_flag"))


def golden(g: DataFrame) -> DataFrame:
    """V1 survivorship per (match_id, organization) in one aggregation (GD-01)."""
    m = _matched(g)
    trust_key = [-F.col("trust_score"), desc_date("record_date"), F.col("row_key")]
    contact_key = [-F.when(F.col("source_system") == "FREG", 0).otherwise(F.col("trust_score")),
                   desc_date("record_date"), F.col("row_key")]
    out = survive(m, ["match_id", "organization"], [
        Rule("first_name", F.col("first_name"), trust_key, F.col("first_name").isNotNull()),
        Rule("last_name", F.col("last_name"), trust_key, F.col("last_name").isNotNull()),
        Rule("phone", F.col("phone"), contact_key, F.col("phone").isNotNull()),
        Rule("email", F.col("email"), contact_key, F.col("email").isNotNull()),
    ], [
        F.max(F.when(F.col("source_system") == "FREG", F.col("birth_date"))).alias("birth_date"),
        F.max(F.when(F.col("source_system") == "FREG", F.col("citizenship"))).alias("citizenship"),
        F.size(F.collect_set("source_system")).cast("long").alias("source_count"),
        F.max("record_date").alias("last_seen_date"),
    ])
    return out.select(
        F.md5(F.concat_ws("::", "match_id", "organization")).alias("customer_id"),
        "match_id", "organization", "first_name", "last_name", "birth_date", "citizenship", "phone", "email",
        "source_count", "last_seen_date", _completeness().alias("dq_score"))


def _completeness():
    return ((F.when(F.col("first_name").isNotNull(), 30).otherwise(0) + F.when(F.col("last_name").isNotNull(), 30).otherwise(0)
             + F.when(F.col("phone").isNotNull(), 20).otherwise(0) + F.when(F.col("email").isNotNull(), 20).otherwise(0))
            .cast("long"))


TRACKED_V1 = ["first_name", "last_name", "phone", "email", "birth_date", "citizenship"]


def current(gold: DataFrame) -> DataFrame:
    """Current state with SHA-256 row hash and version tag (GD-06)."""
    return gold.withColumn("row_hash", row_hash(*TRACKED_V1, sep="::")).withColumn("pipeline_version", F.lit("v001"))


def snapshots(g: DataFrame) -> DataFrame:
    """Golden state of every (id, org) at each of its record dates (HS-01/02, R5)."""
    return _snapshots(g)


def history(g: DataFrame) -> DataFrame:
    """SCD2 history without the triangular join (HS-01..03, R5).

    Records are first reduced to one row per (id, org, date) with the per-date
    best candidate of each attribute (map-side partial aggregation), then a
    running minimum over the distinct dates gives the snapshot at every
    boundary. Versions equal to their predecessor are dropped *before* the
    validity end is taken, so intervals are contiguous.
    """
    snap = _snapshots(g)
    key = ["match_id", "organization"]
    return scd2(snap, key, "snapshot_date", TRACKED_V1, "::").select(
        F.md5(F.concat_ws("::", "match_id", "organization")).alias("customer_id"),
        "match_id", "organization", "first_name", "last_name", "birth_date", "citizenship", "phone", "email",
        "source_count", "row_hash", "valid_from", "valid_to", "is_valid")


def _snapshots(g: DataFrame) -> DataFrame:
    m = _matched(g)
    key = ["match_id", "organization"]
    tk = lambda c: F.when(F.col(c).isNotNull(), F.struct(
        (-F.col("trust_score")).alias("t"), desc_date("record_date").alias("d"), F.col("row_key").alias("r"), F.col(c).alias("v")))
    ck = lambda c: F.when(F.col(c).isNotNull(), F.struct(
        (-F.when(F.col("source_system") == "FREG", 0).otherwise(F.col("trust_score"))).alias("t"),
        desc_date("record_date").alias("d"), F.col("row_key").alias("r"), F.col(c).alias("v")))
    per_date = m.groupBy(*key, "record_date").agg(
        F.min(tk("first_name")).alias("fn"), F.min(tk("last_name")).alias("ln"),
        F.min(ck("phone")).alias("ph"), F.min(ck("email")).alias("em"),
        F.max(F.when(F.col("source_system") == "FREG", F.col("birth_date"))).alias("bd"),
        F.max(F.when(F.col("source_system") == "FREG", F.col("citizenship"))).alias("cz"))
    first_seen = m.groupBy(*key, "source_system").agg(F.min("record_date").alias("record_date")) \
        .groupBy(*key, "record_date").agg(F.count("*").alias("new_sources"))
    w = Window.partitionBy(*key).orderBy("record_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    snap = (per_date.join(first_seen.hint("merge"), key + ["record_date"], "left")
            .select(*key, F.col("record_date").alias("snapshot_date"),
                    F.min("fn").over(w)["v"].alias("first_name"), F.min("ln").over(w)["v"].alias("last_name"),
                    F.max("bd").over(w).alias("birth_date"), F.max("cz").over(w).alias("citizenship"),
                    F.min("ph").over(w)["v"].alias("phone"), F.min("em").over(w)["v"].alias("email"),
                    F.sum(F.coalesce("new_sources", F.lit(0))).over(w).cast("long").alias("source_count")))
    return snap


def scd2(snap: DataFrame, key: list[str], date_col: str, tracked: list[str], sep: str) -> DataFrame:
    """Collapse unchanged versions, then validity = [date, next kept date) (WN-05/06)."""
    w = Window.partitionBy(*key).orderBy(date_col)
    h = snap.withColumn("row_hash", row_hash(*tracked, sep=sep))
    kept = h.withColumn("_prev", F.lag("row_hash").over(w)).where(F.col("row_hash") != F.coalesce("_prev", F.lit("")))
    nxt = F.lead(date_col).over(w)
    return (kept.withColumn("valid_from", F.col(date_col))
            .withColumn("_next", nxt)
            .withColumn("valid_to", F.coalesce(F.col("_next"), F.lit(rules.OPEN_END).cast("date")))
            .withColumn("is_valid", F.col("_next").isNull())
            .drop("_prev", "_next"))


def steward_queue(g: DataFrame) -> DataFrame:
    """Unresolved records with reason, best attempted score and candidate (HS-11)."""
    return g.where("steward_queue_flag").select(
        "row_key", "source_system", "ssn", "first_name", "last_name", "phone", "email", "organization",
        "record_date", "_source_file",
        F.when(F.col("match_method") == "INVALID_SSN", "INVALID_SSN_CHECKSUM")
        .otherwise("NO_SSN_NO_FUZZY_MATCH").alias("queue_reason"),
        F.round("fuzzy_score", 6).alias("fuzzy_score"), "candidate_ssn", F.lit(False).alias("reviewed"))


# --------------------------------------------------------------------------- oracle SQL

def _nick_sql() -> str:
    return values_table(rules.NICKNAMES, ["nickname", "canonical"], "n")


V1_BASE = f"""
v1_union AS (
  SELECT ssn, first_name, last_name, birth_date, citizenship, CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS email,
         o.organization, record_date, 'FREG' AS source_system, 3 AS trust_score, _source_file
  FROM freg CROSS JOIN (VALUES ('BANK'), ('INS')) AS o(organization)
  UNION ALL
  SELECT ssn, first_name, last_name, CAST(NULL AS DATE), CAST(NULL AS VARCHAR), phone, email, organization, record_date, 'BS', 2, _source_file FROM bs
  UNION ALL
  SELECT ssn, first_name, last_name, CAST(NULL AS DATE), CAST(NULL AS VARCHAR), phone, email, organization, record_date, 'NICE', 1, _source_file FROM nice
),
v1_enriched AS (
  SELECT u.*, {mod11_valid('u.ssn')} AS ssn_valid,
         COALESCE(n.canonical, upper(u.first_name)) AS canonical_first_name,
         md5(concat_ws('|', u.source_system, COALESCE(u.ssn, ''), COALESCE(u.first_name, ''), COALESCE(u.last_name, ''),
                       CAST(u.record_date AS VARCHAR), COALESCE(u.organization, ''), COALESCE(u._source_file, ''))) AS row_key
  FROM v1_union u LEFT JOIN {_nick_sql()} ON upper(u.first_name) = n.nickname
),
v1_cand AS (
  SELECT canonical_first_name AS cf, upper(last_name) AS cl, min(ssn) AS ssn_min, max(ssn) AS ssn_max
  FROM v1_enriched WHERE ssn_valid GROUP BY 1, 2
),
v1_q AS (
  SELECT DISTINCT canonical_first_name AS qf, upper(last_name) AS ql FROM v1_enriched
  WHERE ssn IS NULL AND canonical_first_name IS NOT NULL AND last_name IS NOT NULL
),
v1_sc AS (
  SELECT qf, ql, ssn_min, ssn_max, (jwf + jwl) / 2.0 * 100.0 AS score FROM (
    SELECT q.qf, q.ql, c.ssn_min, c.ssn_max,
           jaro_winkler_similarity(q.qf, c.cf) AS jwf, jaro_winkler_similarity(q.ql, c.cl) AS jwl
    FROM v1_q q, v1_cand c)
),
v1_best AS (
  SELECT qf, ql, ssn_min AS best_ssn, score AS best_score FROM (
    SELECT *, row_number() OVER (PARTITION BY qf, ql ORDER BY score DESC, ssn_min) AS rn FROM v1_sc WHERE score >= 92)
  WHERE rn = 1
),
v1_near AS (
  SELECT qf, ql, max(score) AS near_score, max(CASE WHEN score = mx THEN ssn_max END) AS near_ssn
  FROM (SELECT *, max(score) OVER (PARTITION BY qf, ql) AS mx FROM v1_sc) GROUP BY qf, ql
),
v1_groups AS (
  SELECT *, ssn AS match_id, 100 AS match_confidence, 'SSN_EXACT' AS match_method, FALSE AS steward_queue_flag,
         CAST(NULL AS DOUBLE) AS fuzzy_score, CAST(NULL AS VARCHAR) AS candidate_ssn FROM v1_enriched WHERE ssn_valid
  UNION ALL
  SELECT *, NULL, 0, 'INVALID_SSN', TRUE, NULL, NULL FROM v1_enriched WHERE ssn IS NOT NULL AND NOT ssn_valid
  UNION ALL
  SELECT e.*, b.best_ssn, 85, 'FUZZY_JW', FALSE, b.best_score, b.best_ssn
  FROM v1_enriched e JOIN v1_best b ON b.qf = e.canonical_first_name AND b.ql = upper(e.last_name) WHERE e.ssn IS NULL
  UNION ALL
  SELECT e.*, NULL, 0, 'UNMATCHED', TRUE, n.near_score, n.near_ssn
  FROM v1_enriched e LEFT JOIN v1_near n ON n.qf = e.canonical_first_name AND n.ql = upper(e.last_name)
  WHERE e.ssn IS NULL AND NOT EXISTS (SELECT 1 FROM v1_best b WHERE b.qf = e.canonical_first_name AND b.ql = upper(e.last_name))
),
v1_m AS (
  SELECT * FROM v1_groups WHERE match_id IS NOT NULL AND organization IS NOT NULL AND NOT steward_queue_flag
),
v1_golden AS (
  SELECT md5(match_id || '::' || organization) AS customer_id, match_id, organization, first_name, last_name,
         birth_date, citizenship, phone, email, source_count, last_seen_date,
         CAST((CASE WHEN first_name IS NOT NULL THEN 30 ELSE 0 END) + (CASE WHEN last_name IS NOT NULL THEN 30 ELSE 0 END)
            + (CASE WHEN phone IS NOT NULL THEN 20 ELSE 0 END) + (CASE WHEN email IS NOT NULL THEN 20 ELSE 0 END) AS BIGINT) AS dq_score
  FROM (
    SELECT match_id, organization,
      first(first_name ORDER BY trust_score DESC, record_date DESC, row_key) FILTER (WHERE first_name IS NOT NULL) AS first_name,
      first(last_name ORDER BY trust_score DESC, record_date DESC, row_key) FILTER (WHERE last_name IS NOT NULL) AS last_name,
      max(CASE WHEN source_system = 'FREG' THEN birth_date END) AS birth_date,
      max(CASE WHEN source_system = 'FREG' THEN citizenship END) AS citizenship,
      first(phone ORDER BY CASE WHEN source_system = 'FREG' THEN 0 ELSE trust_score END DESC, record_date DESC, row_key)
        FILTER (WHERE phone IS NOT NULL) AS phone,
      first(email ORDER BY CASE WHEN source_system = 'FREG' THEN 0 ELSE trust_score END DESC, record_date DESC, row_key)
        FILTER (WHERE email IS NOT NULL) AS email,
      count(DISTINCT source_system) AS source_count, max(record_date) AS last_seen_date
    FROM v1_m GROUP BY match_id, organization)
)"""

SQL_GROUPS = V1_BASE + """
SELECT row_key, source_system, organization, match_id, match_confidence, match_method, steward_queue_flag,
       round(fuzzy_score, 6) AS fuzzy_score, candidate_ssn FROM v1_groups"""

SQL_GOLDEN = V1_BASE + "\nSELECT * FROM v1_golden"

SQL_CURRENT = V1_BASE + f"""
SELECT *, {sql_row_hash(TRACKED_V1, '::')} AS row_hash, 'v001' AS pipeline_version FROM v1_golden"""

SQL_HISTORY = V1_BASE + f""",
v1_b AS (SELECT DISTINCT match_id, organization, record_date AS snapshot_date FROM v1_m),
v1_snap AS (
  SELECT b.match_id, b.organization, b.snapshot_date,
    first(g.first_name ORDER BY g.trust_score DESC, g.record_date DESC, g.row_key) FILTER (WHERE g.first_name IS NOT NULL) AS first_name,
    first(g.last_name ORDER BY g.trust_score DESC, g.record_date DESC, g.row_key) FILTER (WHERE g.last_name IS NOT NULL) AS last_name,
    max(CASE WHEN g.source_system = 'FREG' THEN g.birth_date END) AS birth_date,
    max(CASE WHEN g.source_system = 'FREG' THEN g.citizenship END) AS citizenship,
    first(g.phone ORDER BY CASE WHEN g.source_system = 'FREG' THEN 0 ELSE g.trust_score END DESC, g.record_date DESC, g.row_key)
      FILTER (WHERE g.phone IS NOT NULL) AS phone,
    first(g.email ORDER BY CASE WHEN g.source_system = 'FREG' THEN 0 ELSE g.trust_score END DESC, g.record_date DESC, g.row_key)
      FILTER (WHERE g.email IS NOT NULL) AS email,
    count(DISTINCT g.source_system) AS source_count
  FROM v1_b b JOIN v1_m g ON g.match_id = b.match_id AND g.organization = b.organization AND g.record_date <= b.snapshot_date
  GROUP BY 1, 2, 3
),
v1_h AS (
  SELECT *, {sql_row_hash(TRACKED_V1, '::')} AS row_hash FROM v1_snap
),
v1_kept AS (
  SELECT * FROM (SELECT *, lag(row_hash) OVER (PARTITION BY match_id, organization ORDER BY snapshot_date) AS prev FROM v1_h)
  WHERE row_hash <> COALESCE(prev, '')
),
v1_history AS (
  SELECT md5(match_id || '::' || organization) AS customer_id, match_id, organization, first_name, last_name, birth_date,
         citizenship, phone, email, source_count, row_hash, snapshot_date AS valid_from,
         COALESCE(lead(snapshot_date) OVER w, DATE '9999-12-31') AS valid_to, lead(snapshot_date) OVER w IS NULL AS is_valid
  FROM v1_kept WINDOW w AS (PARTITION BY match_id, organization ORDER BY snapshot_date)
)"""

SQL_HISTORY_Q = SQL_HISTORY + "\nSELECT * FROM v1_history"

SQL_QUEUE = V1_BASE + """
SELECT row_key, source_system, ssn, first_name, last_name, phone, email, organization, record_date, _source_file,
       CASE WHEN match_method = 'INVALID_SSN' THEN 'INVALID_SSN_CHECKSUM' ELSE 'NO_SSN_NO_FUZZY_MATCH' END AS queue_reason,
       round(fuzzy_score, 6) AS fuzzy_score, candidate_ssn, FALSE AS reviewed
FROM v1_groups WHERE steward_queue_flag"""

SQL_FUZZY_BEST = V1_BASE + """
SELECT e.row_key, b.best_ssn AS candidate_ssn, round(b.best_score, 6) AS fuzzy_score
FROM v1_enriched e JOIN v1_best b ON b.qf = e.canonical_first_name AND b.ql = upper(e.last_name) WHERE e.ssn IS NULL"""

SQL_FUZZY_UNMATCHED = V1_BASE + """
SELECT row_key, first_name, last_name, round(fuzzy_score, 6) AS fuzzy_score, candidate_ssn
FROM v1_groups WHERE match_method = 'UNMATCHED'"""

SQL_FUZZY_SCORES = V1_BASE + """
SELECT qf AS canonical_first_name, ql AS last_name_upper, ssn_min AS candidate_ssn, round(score, 6) AS jw_combined,
       round(max(score) OVER (PARTITION BY qf, ql), 6) AS max_jw_per_name
FROM v1_sc WHERE score >= """ + str(NEAR_MISS * 100.0)


# --------------------------------------------------------------------------- registered queries

def _groups(spark, sf_dir):
    from aurum.plans.layers import layer
    return layer(spark, ("v1_groups", sf_dir), lambda: groups(enriched(spark, sf_dir)))


@register("groups_v1", SQL_GROUPS, "SC-14, PRJ-01, PRJ-05, FN-08, FN-10")
def q_groups_v1(spark, sf_dir):
    return _groups(spark, sf_dir).select("row_key", "source_system", "organization", "match_id", "match_confidence",
                                         "match_method", "steward_queue_flag", F.round("fuzzy_score", 6).alias("fuzzy_score"),
                                         "candidate_ssn")


@register("golden_v1", SQL_GOLDEN, "GD-01, WN-01, AG-01, AG-02, FN-13, DQ-CMP, PRJ-09, ST-02")
def q_golden_v1(spark, sf_dir):
    return golden(_groups(spark, sf_dir))


@register("customer_current", SQL_CURRENT, "GD-06, FN-12")
def q_current(spark, sf_dir):
    return current(golden(_groups(spark, sf_dir)))


@register("history_v1", SQL_HISTORY_Q, "HS-01, HS-02, HS-03, JN-06, WN-05, WN-06")
def q_history_v1(spark, sf_dir):
    return history(_groups(spark, sf_dir))


@register("steward_queue_v1", SQL_QUEUE, "HS-11")
def q_queue_v1(spark, sf_dir):
    return steward_queue(_groups(spark, sf_dir))


@register("fuzzy_best", SQL_FUZZY_BEST, "JN-02")
def q_fuzzy_best(spark, sf_dir):
    g = _groups(spark, sf_dir)
    return g.where(F.col("match_method") == "FUZZY_JW").select("row_key", "candidate_ssn", F.round("fuzzy_score", 6).alias("fuzzy_score"))


@register("fuzzy_unmatched", SQL_FUZZY_UNMATCHED, "JN-03, AG-03")
def q_fuzzy_unmatched(spark, sf_dir):
    g = _groups(spark, sf_dir)
    return g.where(F.col("match_method") == "UNMATCHED").select("row_key", "first_name", "last_name",
                                                                 F.round("fuzzy_score", 6).alias("fuzzy_score"), "candidate_ssn")


@register("fuzzy_scores", SQL_FUZZY_SCORES, "JN-01, WN-04, FN-07")
def q_fuzzy_scores(spark, sf_dir):
    """Scored (name, candidate-name) pairs from ``NEAR_MISS`` on, with
    the per-name maximum (the SSN-less side's distinct names, not records)."""
    cand, q = _name_sets(enriched(spark, sf_dir))
    s = _scored(q.checkpoint(), cand.checkpoint(), NEAR_MISS)
    s = s.where(F.col("score") >= NEAR_MISS * 100.0)
    w = Window.partitionBy("qf", "ql")
    return s.select(F.col("qf").alias("canonical_first_name"), F.col("ql").alias("last_name_upper"),
                    F.col("ssn_min").alias("candidate_ssn"), F.round("score", 6).alias("jw_combined"),
                    F.round(F.max("score").over(w), 6).alias("max_jw_per_name"))


@register("history_boundaries", V1_BASE + "\nSELECT DISTINCT match_id, organization, record_date AS snapshot_date FROM v1_m", "HS-01")
def q_boundaries(spark, sf_dir):
    return _matched(_groups(spark, sf_dir)).select("match_id", "organization", F.col("record_date").alias("snapshot_date")).distinct()


@register("history_snapshots", SQL_HISTORY + "\nSELECT * FROM v1_snap", "HS-02, JN-06")
def q_snapshots(spark, sf_dir):
    return snapshots(_groups(spark, sf_dir))
