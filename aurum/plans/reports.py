"""Metrics, quality reports, audits and quality gates (AG-*, DQ reports, CK-*, BLK stats)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from aurum import rules
from aurum.functions import dq_tier
from aurum.operators import checks as C
from aurum.plans import nrt, pairwise, ssn_first
from aurum.plans import nrt_sql as NS
from aurum.plans import pairwise_sql as PS
from aurum.plans.catalog import register
from aurum.plans.pairwise import V2_SQL, GOLD_SQL, address_golden, clusters_for, golden, v2_chain
from aurum.plans.sqlfrag import tier
from aurum.session import written

GOLD_ONLY = GOLD_SQL


def _gold(spark, sf_dir):
    return v2_chain(spark, sf_dir)[2]


@register("dq_score_bulk", GOLD_ONLY + "\nSELECT cluster_id, organization, dq_score FROM v2_golden", "DQ-001, DQ-002, DQ-003, DQ-004, DQ-005, DQ-006, DQ-007, DQ-008, DQ-N03, DQ-AI01, DQ-X03, DQ-ENG")
def q_dq_bulk(spark, sf_dir):
    return _gold(spark, sf_dir).select("cluster_id", "organization", "dq_score")


@register("dq_score_nrt", NS.events() + NS.chain("", "TRUE") + "\nSELECT cluster_id, dq_score FROM nrt_gold", "DQ-001, DQ-002, DQ-003, DQ-004, DQ-005, DQ-006, DQ-007, DQ-008, DQ-C01, DQ-C02, DQ-X03")
def q_dq_nrt(spark, sf_dir):
    return nrt.golden(nrt.clusters_all(spark, sf_dir)).select("cluster_id", "dq_score")


@register("dq_score_address", V2_SQL + "\nSELECT cluster_id, organization, dq_score FROM a2_golden", "DQ-011, DQ-012, DQ-X04, DQ-N02")
def q_dq_addr(spark, sf_dir):
    enr, cl, gold, addr = v2_chain(spark, sf_dir)
    return address_golden(addr, cl).select("cluster_id", "organization", "dq_score")


@register("dq_tier", GOLD_ONLY + f"\nSELECT cluster_id, organization, dq_score, {tier('dq_score')} AS dq_tier FROM v2_golden", "FN-14")
def q_tier(spark, sf_dir):
    return _gold(spark, sf_dir).select("cluster_id", "organization", "dq_score", dq_tier("dq_score").alias("dq_tier"))


@register("dq_distribution", GOLD_ONLY + f"""
SELECT {tier('dq_score')} AS dq_tier, count(*) AS customers, min(dq_score) AS min_score, max(dq_score) AS max_score,
       round(avg(dq_score), 6) AS avg_score FROM v2_golden GROUP BY 1""", "AG-06")
def q_dq_dist(spark, sf_dir):
    return _gold(spark, sf_dir).groupBy(dq_tier("dq_score").alias("dq_tier")).agg(
        F.count("*").alias("customers"), F.min("dq_score").alias("min_score"), F.max("dq_score").alias("max_score"),
        F.round(F.avg("dq_score"), 6).alias("avg_score"))


@register("dq_histogram", GOLD_ONLY + "\nSELECT dq_score, count(*) AS customers FROM v2_golden GROUP BY 1", "AG-11")
def q_dq_hist(spark, sf_dir):
    return _gold(spark, sf_dir).groupBy("dq_score").agg(F.count("*").alias("customers"))


@register("dq_low", GOLD_ONLY + "\nSELECT cluster_id, organization, first_name, last_name, dq_score FROM v2_golden WHERE dq_score < 50", "AG-11")
def q_dq_low(spark, sf_dir):
    return _gold(spark, sf_dir).where(F.col("dq_score") < 50).select("cluster_id", "organization", "first_name", "last_name", "dq_score")


@register("dq_rule_hits", GOLD_ONLY + """
SELECT rule_id, count(*) AS affected, round(avg(dq_score), 6) AS avg_score
FROM (SELECT unnest(dq_fired_rules) AS rule_id, dq_score FROM v2_golden) GROUP BY 1""", "AG-12")
def q_rule_hits(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return g.select(F.explode("dq_fired_rules").alias("rule_id"), "dq_score").groupBy("rule_id").agg(
        F.count("*").alias("affected"), F.round(F.avg("dq_score"), 6).alias("avg_score"))


@register("metrics_pipeline", GOLD_ONLY + """
SELECT 'source_records' AS metric, CAST(count(*) AS DOUBLE) AS value FROM v2_enriched
UNION ALL SELECT 'golden_customers', CAST(count(*) AS DOUBLE) FROM v2_golden
UNION ALL SELECT 'merged_customers', CAST(count(*) FILTER (WHERE source_count >= 2) AS DOUBLE) FROM v2_golden
UNION ALL SELECT 'merge_rate_pct', round(100.0 * count(*) FILTER (WHERE source_count >= 2) / count(*), 6) FROM v2_golden
UNION ALL SELECT 'avg_quality', round(avg(dq_score), 6) FROM v2_golden""", "AG-05")
def q_metrics(spark, sf_dir):
    enr, cl, gold, addr = v2_chain(spark, sf_dir)
    g = gold.agg(F.count("*").alias("g"), F.count_if(F.col("source_count") >= 2).alias("m"), F.avg("dq_score").alias("a"))
    e = enr.agg(F.count("*").alias("n"))
    sr = e.select(F.lit("source_records").alias("metric"), F.col("n").cast("double").alias("value"))
    gm = g.select(F.explode(F.array(
        F.struct(F.lit("golden_customers").alias("metric"), F.col("g").cast("double").alias("value")),
        F.struct(F.lit("merged_customers").alias("metric"), F.col("m").cast("double").alias("value")),
        F.struct(F.lit("merge_rate_pct").alias("metric"), F.round(100.0 * F.col("m") / F.col("g"), 6).alias("value")),
        F.struct(F.lit("avg_quality").alias("metric"), F.round(F.col("a"), 6).alias("value")))).alias("x")).select("x.*")
    return sr.unionByName(gm)


@register("source_count_share", GOLD_ONLY + """
SELECT source_count, count(*) AS customers, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS share_pct
FROM v2_golden GROUP BY 1""", "AG-07")
def q_share(spark, sf_dir):
    c = _gold(spark, sf_dir).groupBy("source_count").agg(F.count("*").alias("customers"))
    # the window runs over the aggregated rows only (one per source count, <= 3)
    return c.withColumn("share_pct", F.round(100.0 * F.col("customers") / F.sum("customers").over(Window.partitionBy()), 6))


@register("er_stats", GOLD_ONLY + """
SELECT count(*) AS golden, count(*) FILTER (WHERE source_count > 1) AS merged, count(*) FILTER (WHERE source_count = 1) AS unique_records,
       round(avg(dq_score), 6) AS avg_dq FROM v2_golden""", "AG-08")
def q_er_stats(spark, sf_dir):
    return _gold(spark, sf_dir).agg(F.count("*").alias("golden"), F.count_if(F.col("source_count") > 1).alias("merged"),
                                    F.count_if(F.col("source_count") == 1).alias("unique_records"), F.round(F.avg("dq_score"), 6).alias("avg_dq"))


@register("source_counts", PS.base() + "\nSELECT source_system, count(*) AS records FROM v2_union GROUP BY 1", "AG-09")
def q_source_counts(spark, sf_dir):
    return pairwise.enriched(spark, sf_dir).groupBy("source_system").agg(F.count("*").alias("records"))


@register("address_stats", V2_SQL + """
SELECT count(*) AS addresses, count(DISTINCT cluster_id || '|' || organization) AS customers_with_address,
       count(DISTINCT land) AS countries FROM a2_grouped""", "AG-10")
def q_addr_stats(spark, sf_dir):
    enr, cl, gold, addr = v2_chain(spark, sf_dir)
    c = cl.select("source_system", F.col("source_key").alias("source_customer_key"), "organization", "cluster_id")
    g = addr.join(c, ["source_system", "source_customer_key", "organization"])
    return g.agg(F.count("*").alias("addresses"), F.countDistinct(F.concat_ws("|", "cluster_id", "organization")).alias("customers_with_address"),
                 F.countDistinct("land").alias("countries"))


@register("address_by_country", V2_SQL + "\nSELECT land, count(*) AS addresses FROM a2_golden GROUP BY 1", "AG-10")
def q_addr_country(spark, sf_dir):
    enr, cl, gold, addr = v2_chain(spark, sf_dir)
    return address_golden(addr, cl).groupBy("land").agg(F.count("*").alias("addresses"))


WIN_FIELDS = ["first_name", "last_name", "phone", "email", "birth_date", "citizenship"]


@register("survivorship_winners", GOLD_ONLY + ",\nwin AS (\n" + "\nUNION ALL\n".join(
    f"SELECT '{f}' AS field, e.source_system FROM v2_grouped e JOIN v2_golden g ON g.cluster_id = e.cluster_id "
    f"AND g.organization = e.organization WHERE e.{f} IS NOT NULL AND CAST(e.{f} AS VARCHAR) = CAST(g.{f} AS VARCHAR)"
    for f in WIN_FIELDS) + ")\nSELECT field, source_system, count(*) AS rows_matching_golden FROM win GROUP BY 1, 2", "AG-13, GD-08")
def q_winners(spark, sf_dir):
    enr, cl, gold, addr = v2_chain(spark, sf_dir)
    e = enr.join(cl.select("source_system", "source_key", "organization", "cluster_id"), ["source_system", "source_key", "organization"])
    g = gold.select("cluster_id", "organization", *[F.col(f).cast("string").alias("g_" + f) for f in WIN_FIELDS])
    j = e.join(g, ["cluster_id", "organization"])
    st = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), (F.col(f).isNotNull() & (F.col(f).cast("string") == F.col("g_" + f))).alias("hit"))
                             for f in WIN_FIELDS]))
    return j.select("source_system", st.alias("x")).where("x.hit").groupBy(F.col("x.field").alias("field"), "source_system") \
        .agg(F.count("*").alias("rows_matching_golden"))


@register("history_versions", V2_SQL + PS.history() + """
SELECT cluster_id, organization, count(*) AS versions, min(valid_from) AS first_seen, max(valid_from) AS last_changed
FROM v2_history GROUP BY 1, 2 HAVING count(*) > 1""", "AG-14")
def q_versions(spark, sf_dir):
    h = pairwise.q_history_v2(spark, sf_dir)
    return h.groupBy("cluster_id", "organization").agg(F.count("*").alias("versions"), F.min("valid_from").alias("first_seen"),
                                                       F.max("valid_from").alias("last_changed")).where(F.col("versions") > 1)


def _variant_sql(name: str, golden_cte: str) -> str:
    return f"""SELECT '{name}' AS variant, count(*) AS golden, count(*) FILTER (WHERE source_count >= 2) AS merged,
  round(avg(dq_score), 6) AS avg_score, count(*) FILTER (WHERE is_fake_name) AS fake_names FROM {golden_cte}"""


@register("compare_variants", GOLD_ONLY + "," + (PS.clusters("parity", "transitive", "nickname") + PS.golden()).replace("v2_", "v3_")
          + "\n" + _variant_sql("initcap", "v2_golden") + " UNION ALL " + _variant_sql("nickname", "v3_golden"), "AG-15, FN-10, FN-11, DQ-AI01")
def q_compare(spark, sf_dir):
    """The two pairwise variants end to end: names as they are, and dictionary names with the fake-name flag."""
    enr, cl = clusters_for(spark, sf_dir, "parity", "transitive", "nickname")
    out = None
    for name, g in (("initcap", _gold(spark, sf_dir)), ("nickname", golden(enr, cl))):
        row = g.agg(F.lit(name).alias("variant"), F.count("*").alias("golden"), F.count_if(F.col("source_count") >= 2).alias("merged"),
                    F.round(F.avg("dq_score"), 6).alias("avg_score"), F.count_if("is_fake_name").alias("fake_names"))
        out = row if out is None else out.unionByName(row)
    return out


@register("layer_volumes", GOLD_ONLY + PS.address_golden() + """
SELECT 'raw_freg' AS layer, count(*) AS row_count FROM freg UNION ALL SELECT 'raw_bs', count(*) FROM bs
UNION ALL SELECT 'raw_nice', count(*) FROM nice UNION ALL SELECT 'enriched', count(*) FROM v2_enriched
UNION ALL SELECT 'clusters', count(*) FROM v2_clusters UNION ALL SELECT 'golden', count(*) FROM v2_golden
UNION ALL SELECT 'address_golden', count(*) FROM a2_golden""", "AG-16")
def q_layers(spark, sf_dir):
    from aurum.plans import inputs
    enr, cl, gold, addr = v2_chain(spark, sf_dir)
    parts = [("raw_freg", inputs.freg(spark, sf_dir)), ("raw_bs", inputs.bs(spark, sf_dir)), ("raw_nice", inputs.nice(spark, sf_dir)),
             ("enriched", enr), ("clusters", cl), ("golden", gold), ("address_golden", address_golden(addr, cl))]
    out = None
    for name, df in parts:
        r = df.agg(F.lit(name).alias("layer"), F.count("*").alias("row_count"))
        out = r if out is None else out.unionByName(r)
    return out


@register("latency_percentiles", NS.events() + """
SELECT count(*) AS events, quantile_disc(lateness_s, 0.5) AS p50_s, quantile_disc(lateness_s, 0.95) AS p95_s,
       quantile_disc(lateness_s, 0.99) AS p99_s, max(lateness_s) AS max_s
FROM (SELECT CAST(floor(epoch(max(event_ts) OVER (PARTITION BY event_id // 10))) - floor(epoch(event_ts)) AS BIGINT) AS lateness_s FROM nrt_ev)""",
          "AG-17, RT-06")
def q_latency(spark, sf_dir):
    """Out-of-orderness of the event log: how far each event's time lags the
    newest event of its arrival block; exact percentiles."""
    from aurum.sources.events import raw_events
    ev = raw_events(spark, sf_dir)
    w = Window.partitionBy(F.floor(F.col("event_id") / 10))
    late = ev.select((F.unix_seconds(F.max(F.col("event_ts").cast("timestamp")).over(w)) -
                      F.unix_seconds(F.col("event_ts").cast("timestamp"))).cast("long").alias("lateness_s"))
    # exact discrete quantiles from the histogram of distinct lateness values
    # (its size is bounded by the number of distinct values, not by the rows)
    hist = late.groupBy("lateness_s").agg(F.count("*").alias("c"))
    cum = hist.withColumn("cum", F.sum("c").over(Window.orderBy("lateness_s").rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("n", F.sum("c").over(Window.partitionBy()))

    def q(p):
        return F.min(F.when(F.col("cum") >= F.ceil(F.round(F.col("n") * p, 6)), F.col("lateness_s")))
    return cum.agg(F.max("n").alias("events"), q(0.5).alias("p50_s"), q(0.95).alias("p95_s"), q(0.99).alias("p99_s"),
                   F.max("lateness_s").alias("max_s"))


@register("proof_by_source", GOLD_ONLY + """
SELECT e.source_system, count(*) AS source_rows, round(avg(g.dq_score), 6) AS avg_golden_dq
FROM v2_grouped e JOIN v2_golden g ON g.cluster_id = e.cluster_id AND g.organization = e.organization GROUP BY 1""", "AG-18")
def q_proof(spark, sf_dir):
    enr, cl, gold, addr = v2_chain(spark, sf_dir)
    e = enr.join(cl.select("source_system", "source_key", "organization", "cluster_id"), ["source_system", "source_key", "organization"])
    return e.join(gold.select("cluster_id", "organization", "dq_score"), ["cluster_id", "organization"]) \
        .groupBy("source_system").agg(F.count("*").alias("source_rows"), F.round(F.avg("dq_score"), 6).alias("avg_golden_dq"))


@register("match_audit", PS.clusters("parity", "transitive") + """
SELECT node, best_neighbor, round(CAST(score_d01 AS DOUBLE), 6) AS score_d01, round(CAST(score_d01b AS DOUBLE), 6) AS score_d01b,
       round(CAST(score_d02 AS DOUBLE), 6) AS score_d02, round(CAST(score_fuzzy_name AS DOUBLE), 6) AS score_fuzzy_name,
       round(CAST(score_soundex AS DOUBLE), 6) AS score_soundex, round(CAST(total_score AS DOUBLE), 6) AS total_score, match_type
FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY total_score DESC, match_type, best_neighbor, score_d01 DESC, score_d01b DESC, score_d02 DESC,
                                   score_fuzzy_name DESC, score_soundex DESC) AS rn
      FROM (SELECT node_a AS node, node_b AS best_neighbor, * EXCLUDE (node_a, node_b) FROM v2_matches
            UNION ALL SELECT node_b, node_a, * EXCLUDE (node_a, node_b) FROM v2_matches))
WHERE rn = 1""", "SC-16, SC-01..06")
def q_audit(spark, sf_dir):
    """Every record's best edge with the score of each rule."""
    enr = pairwise.enriched(spark, sf_dir)
    from aurum.plans import inputs
    g = pairwise.MatchGraph(enr, "parity", inputs.overrides(spark, sf_dir))
    sc = g.edge_scores(g.best_edges().select("node", "other"))
    cols = ["score_d01", "score_d01b", "score_d02", "score_fuzzy_name", "score_soundex", "total_score"]
    return sc.select("node", F.col("other").alias("best_neighbor"), *[F.round(c, 6).alias(c) for c in cols], "match_type")


@register("unmerge_status", PS.clusters("extended", "transitive") + """
SELECT source_system, source_key, organization, cluster_id, match_type, match_score FROM v2_clusters WHERE match_status = 'UNMERGE'""", "CL-08, JN-04")
def q_unmerge_status(spark, sf_dir):
    """Records that an override parts from a match, with the cluster and the best edge that are left."""
    cl = pairwise.clusters_for(spark, sf_dir, "extended", "transitive")[1]
    return cl.where(F.col("match_status") == "UNMERGE").select("source_system", "source_key", "organization", "cluster_id", "match_type", "match_score")


@register("apply_unmerge", PS.clusters("extended", "one_hop") + """
SELECT DISTINCT least(node_a, node_b) AS node_a, greatest(node_a, node_b) AS node_b FROM v2_matches
WHERE key_a IN (SELECT source_key_a FROM overrides UNION SELECT source_key_b FROM overrides)
   OR key_b IN (SELECT source_key_a FROM overrides UNION SELECT source_key_b FROM overrides)""", "JN-04, CL-08")
def q_unmerge(spark, sf_dir):
    """Matched pairs touching an override-named record after the overrides are removed."""
    from aurum.plans import inputs
    g = pairwise.MatchGraph(pairwise.enriched(spark, sf_dir), "extended", inputs.overrides(spark, sf_dir))
    # here the pairs themselves are the result: endpoints meet all members of their groups
    held = g.members.join(g.endpoints, "node", "left_semi")
    all_of = held.select("gid", "node").unionByName(held.join(g.links, "gid").select(F.col("gid2").alias("gid"), "node")) \
        .join(g.members.withColumnRenamed("node", "other"), "gid").where(F.col("node") != F.col("other"))
    # a pair counts either way round and so do bans: pairs are put in order first and shuffled once
    ordered = [F.least("node", "other").alias("node_a"), F.greatest("node", "other").alias("node_b")]
    return all_of.select(*ordered).distinct().join(g.banned().select(*ordered).distinct(), ["node_a", "node_b"], "left_anti")


def _bstats(df, key_cols, name):
    return df.where(F.greatest(*[F.col(c).isNull() for c in key_cols]) == False).groupBy(  # noqa: E712
        F.concat_ws("|", *key_cols).alias("block_key")).agg(F.countDistinct("node").alias("records")) \
        .withColumn("candidate_pairs", F.shiftright(F.col("records") * (F.col("records") - 1), 1))


@register("block_ssn", PS.base() + """
SELECT organization || '|' || ssn AS block_key, count(DISTINCT node) AS records,
       CAST(count(DISTINCT node) * (count(DISTINCT node) - 1) / 2 AS BIGINT) AS candidate_pairs
FROM v2_base WHERE ssn IS NOT NULL GROUP BY 1""", "BLK-01, BLK-09")
def q_block_ssn(spark, sf_dir):
    return _bstats(pairwise.base_rows(pairwise.enriched(spark, sf_dir)), ["organization", "ssn"], "ssn")


@register("block_soundex_year", PS.base() + """
SELECT organization || '|' || sdx || '|' || yr AS block_key, count(DISTINCT node) AS records,
       CAST(count(DISTINCT node) * (count(DISTINCT node) - 1) / 2 AS BIGINT) AS candidate_pairs
FROM v2_base WHERE sdx IS NOT NULL AND yr IS NOT NULL GROUP BY 1""", "BLK-02, BLK-09")
def q_block_sy(spark, sf_dir):
    return _bstats(pairwise.base_rows(pairwise.enriched(spark, sf_dir)), ["organization", "sdx", "year"], "sy")


@register("block_postal", V2_SQL + """
SELECT organization || '|' || left(postnummer, 3) AS block_key, count(DISTINCT source_system || '|' || source_key) AS records,
       CAST(count(DISTINCT source_system || '|' || source_key) * (count(DISTINCT source_system || '|' || source_key) - 1) / 2 AS BIGINT) AS candidate_pairs
FROM a2_union WHERE postnummer IS NOT NULL AND length(postnummer) >= 3 GROUP BY 1""", "BLK-06, BLK-09")
def q_block_postal(spark, sf_dir):
    a = pairwise.addresses(spark, sf_dir).where(F.col("postnummer").isNotNull() & (F.length("postnummer") >= 3)) \
        .withColumn("node", F.concat_ws("|", "source_system", "source_key")).withColumn("p3", F.substring("postnummer", 1, 3))
    return _bstats(a, ["organization", "p3"], "postal")


# ------------------------------------------------------------------------------------ checks

CHECK_SQL = V2_SQL + PS.history() + """,
chk AS (
  SELECT 'chk_score_bounds' AS check_name, (SELECT count(*) FROM v2_golden WHERE dq_score < 0 OR dq_score > 100 OR dq_score IS NULL)
       + (SELECT count(*) FROM a2_golden WHERE dq_score < 0 OR dq_score > 100 OR dq_score IS NULL) AS violations
  UNION ALL SELECT 'chk_address_one_to_one',
       (SELECT count(*) FROM v2_golden g WHERE NOT EXISTS (SELECT 1 FROM a2_golden a WHERE a.cluster_id = g.cluster_id AND a.organization = g.organization))
     + (SELECT count(*) FROM (SELECT cluster_id, organization FROM a2_golden GROUP BY 1, 2 HAVING count(*) > 1))
  UNION ALL SELECT 'chk_history_open',
       (SELECT count(*) FROM (SELECT cluster_id, organization FROM v2_history GROUP BY 1, 2 HAVING count(*) FILTER (WHERE is_valid) <> 1))
     + (SELECT count(*) FROM v2_history WHERE NOT is_valid AND valid_to = DATE '9999-12-31')
  UNION ALL SELECT 'chk_golden_keys',
       (SELECT count(*) FROM (SELECT cluster_id, organization FROM v2_golden GROUP BY 1, 2 HAVING count(*) > 1))
     + (SELECT count(*) FROM v2_golden WHERE cluster_id IS NULL OR organization IS NULL OR source_count < 1)
  UNION ALL SELECT 'chk_serving_count', abs((SELECT count(*) FROM v2_golden) - (SELECT count(*) FROM v2_golden g LEFT JOIN a2_golden a
       ON a.cluster_id = g.cluster_id AND a.organization = g.organization))
  UNION ALL SELECT 'chk_raw_formats',
       (SELECT count(*) FROM bs WHERE NOT regexp_matches(ssn, '^[0-9]{11}$') OR NOT regexp_matches(regexp_replace(phone, '[^0-9+]', '', 'g'), '^\\+47[0-9]{8}$'))
  UNION ALL SELECT 'chk_ssn_single_group',
       (SELECT count(*) FROM (SELECT organization, ssn FROM v2_golden WHERE ssn IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT cluster_id) > 1))
  UNION ALL SELECT 'chk_org_broadcast',
       (SELECT count(*) FROM (SELECT source_key FROM v2_clusters WHERE source_system = 'FREG' GROUP BY 1 HAVING count(DISTINCT organization) <> 2))
  UNION ALL SELECT 'chk_xref_total',
       (SELECT count(*) FROM (SELECT DISTINCT source_system, source_key, organization FROM v2_enriched) e
         WHERE NOT EXISTS (SELECT 1 FROM v2_clusters c WHERE c.source_system = e.source_system AND c.source_key = e.source_key AND c.organization = e.organization))
     + (SELECT count(*) FROM (SELECT source_system, source_key, organization FROM v2_clusters GROUP BY 1, 2, 3 HAVING count(*) > 1))
  UNION ALL SELECT 'chk_history_contiguous',
       (SELECT count(*) FROM (SELECT valid_to, lead(valid_from) OVER (PARTITION BY cluster_id, organization ORDER BY valid_from) AS nxt
                              FROM v2_history) WHERE nxt IS NOT NULL AND nxt <> valid_to)
)
SELECT check_name, violations, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS result FROM chk"""


@register("quality_gates", CHECK_SQL, "CK-01..10, JN-10")
def q_checks(spark, sf_dir):
    from aurum.plans import inputs
    enr, cl, gold, addr = v2_chain(spark, sf_dir)
    # several checks read these
    ag = written(address_golden(addr, cl))
    hist = written(pairwise.q_history_v2(spark, sf_dir))
    key = ["cluster_id", "organization"]
    bs = inputs.bs(spark, sf_dir)
    w = Window.partitionBy(*key).orderBy("valid_from")
    parts = [
        C.check("chk_score_bounds", C.out_of_bounds(gold, "dq_score").select(F.lit(1).alias("x"))
                .unionByName(C.out_of_bounds(ag, "dq_score").select(F.lit(1).alias("x")))),
        C.check("chk_address_one_to_one", gold.join(ag, key, "left_anti").select(F.lit(1).alias("x"))
                .unionByName(C.duplicated(ag, key).select(F.lit(1).alias("x")))),
        C.check("chk_history_open", hist.groupBy(*key).agg(F.count_if("is_valid").alias("o")).where(F.col("o") != 1).select(F.lit(1).alias("x"))
                .unionByName(hist.where(~F.col("is_valid") & (F.col("valid_to") == F.lit(rules.OPEN_END).cast("date"))).select(F.lit(1).alias("x")))),
        C.check("chk_golden_keys", C.duplicated(gold, key).select(F.lit(1).alias("x")).unionByName(
            gold.where(F.col("cluster_id").isNull() | F.col("organization").isNull() | (F.col("source_count") < 1)).select(F.lit(1).alias("x")))),
        C.check("chk_serving_count", gold.join(ag, key, "left").groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 1)),
        C.check("chk_raw_formats", bs.where(~F.col("ssn").rlike(r"^[0-9]{11}$") | ~F.regexp_replace("phone", r"[^0-9+]", "").rlike(rules.PHONE_PATTERN_NO))),
        C.check("chk_ssn_single_group", gold.where(F.col("ssn").isNotNull()).groupBy("organization", "ssn")
                .agg(F.countDistinct("cluster_id").alias("n")).where(F.col("n") > 1)),
        C.check("chk_org_broadcast", cl.where(F.col("source_system") == "FREG").groupBy("source_key")
                .agg(F.countDistinct("organization").alias("n")).where(F.col("n") != 2)),
        C.check("chk_xref_total", enr.select("source_system", "source_key", "organization").distinct()
                .join(cl, ["source_system", "source_key", "organization"], "left_anti").select(F.lit(1).alias("x"))
                .unionByName(C.duplicated(cl, ["source_system", "source_key", "organization"]).select(F.lit(1).alias("x")))),
        C.check("chk_history_contiguous", hist.withColumn("nxt", F.lead("valid_from").over(w))
                .where(F.col("nxt").isNotNull() & (F.col("nxt") != F.col("valid_to")))),
    ]
    return C.union_checks(parts)


@register("history_of_customer", V2_SQL + PS.history() + """,
card_id AS (SELECT min(cluster_id) AS cluster_id FROM v2_golden WHERE organization = 'BANK'
            AND source_count = (SELECT max(source_count) FROM v2_golden WHERE organization = 'BANK'))
SELECT h.* FROM v2_history h JOIN card_id USING (cluster_id) WHERE h.organization = 'BANK'""", "HS-08")
def q_hist_customer(spark, sf_dir):
    gold = _gold(spark, sf_dir).where(F.col("organization") == "BANK")
    pick = gold.join(F.broadcast(gold.agg(F.max("source_count").alias("mx"))), F.col("source_count") == F.col("mx")).agg(F.min("cluster_id").alias("cluster_id"))
    h = pairwise.q_history_v2(spark, sf_dir).where(F.col("organization") == "BANK")
    return h.join(F.broadcast(pick), "cluster_id")


# Postcode format per country (DQ-009) and the ISO-2 country shape (DQ-010).
POSTCODE_BY_COUNTRY = [("NO", "^[0-9]{4}$"), ("SE", "^[0-9]{3} ?[0-9]{2}$"), ("DK", "^[0-9]{4}$"), ("PL", "^[0-9]{2}-[0-9]{3}$")]


@register("dq_rules_extended", V2_SQL + """,
pc AS (SELECT * FROM (VALUES """ + ", ".join(f"('{c}', '{p}')" for c, p in POSTCODE_BY_COUNTRY) + """) AS t(land, pattern))
SELECT a.cluster_id, a.organization, a.land, a.postnummer,
  (a.postnummer IS NOT NULL AND pc.pattern IS NOT NULL AND NOT regexp_matches(a.postnummer, pc.pattern)) AS dq_009_postcode_by_country,
  (a.land IS NULL OR NOT regexp_matches(a.land, '^[A-Z]{2}$')) AS dq_010_iso_country
FROM a2_golden a LEFT JOIN pc ON pc.land = a.land""", "DQ-009, DQ-010")
def q_dq_ext(spark, sf_dir):
    enr, cl, gold, addr = v2_chain(spark, sf_dir)
    ag = address_golden(addr, cl)
    pc = F.broadcast(spark.createDataFrame(POSTCODE_BY_COUNTRY, "land string, pattern string"))
    j = ag.join(pc, "land", "left")
    return j.select("cluster_id", "organization", "land", "postnummer",
                    (F.col("postnummer").isNotNull() & F.col("pattern").isNotNull() & ~F.expr("postnummer rlike pattern")).alias("dq_009_postcode_by_country"),
                    (F.col("land").isNull() | ~F.col("land").rlike("^[A-Z]{2}$")).alias("dq_010_iso_country"))


@register("candidate_pairs", PS.base() + """,
cp AS (
  SELECT 'ssn' AS block, organization || '|' || ssn AS k, node FROM v2_base WHERE ssn IS NOT NULL
  UNION ALL SELECT 'soundex_year', organization || '|' || sdx || '|' || yr, node FROM v2_base WHERE sdx IS NOT NULL AND yr IS NOT NULL
  UNION ALL SELECT 'soundex', organization || '|' || sdx, node FROM v2_base WHERE sdx IS NOT NULL
  UNION ALL SELECT 'phone8', organization || '|' || ph8, node FROM v2_base WHERE ph8 IS NOT NULL
)
SELECT block, count(*) AS blocks, CAST(sum(n) AS BIGINT) AS records, CAST(sum(n * (n - 1) / 2) AS BIGINT) AS candidate_pairs, max(n) AS largest_block
FROM (SELECT block, k, count(DISTINCT node) AS n FROM cp GROUP BY 1, 2) GROUP BY block""", "BLK-07, BLK-09, R7")
def q_candidate_pairs(spark, sf_dir):
    """Candidate-pair volume per blocking pass from block sizes alone: the
    skew report that decides which passes stay groups (never a pair list)."""
    r = pairwise.base_rows(pairwise.enriched(spark, sf_dir))
    parts = [("ssn", ["organization", "ssn"]), ("soundex_year", ["organization", "sdx", "year"]),
             ("soundex", ["organization", "sdx"]), ("phone8", ["organization", "ph8"])]
    out = None
    for name, cols in parts:
        ok = F.lit(True)
        for c in cols:
            ok = ok & F.col(c).isNotNull()
        p = r.where(ok).groupBy(*cols).agg(F.countDistinct("node").alias("n")).agg(
            F.lit(name).alias("block"), F.count("*").alias("blocks"), F.sum("n").alias("records"),
            F.sum(F.shiftright(F.col("n") * (F.col("n") - 1), 1)).alias("candidate_pairs"), F.max("n").alias("largest_block"))
        out = p if out is None else out.unionByName(p)
    return out


RACE_FIELDS = ["first_name", "last_name", "phone", "email"]


@register("survivorship_race", GOLD_ONLY + """,
race_latest AS (
  SELECT cluster_id, organization, source_system, """ + ", ".join(
    f"first({f} ORDER BY record_date DESC, source_key, _source_file) AS {f}" for f in RACE_FIELDS) + """
  FROM v2_grouped GROUP BY 1, 2, 3
),
race_long AS (""" + "\nUNION ALL\n".join(
    f"SELECT r.cluster_id, r.organization, '{f}' AS field, r.source_system, r.{f} AS source_value, g.{f} AS golden_value "
    f"FROM race_latest r JOIN v2_golden g ON g.cluster_id = r.cluster_id AND g.organization = r.organization" for f in RACE_FIELDS) + """)
SELECT *, COALESCE(source_value = golden_value, FALSE) AS is_winner FROM race_long""", "GD-08")
def q_race(spark, sf_dir):
    """Per golden field, each source's latest value side by side with the survivor."""
    enr, cl, gold, addr = v2_chain(spark, sf_dir)
    from aurum.operators.survivorship import desc_date
    e = enr.join(cl.select("source_system", "source_key", "organization", "cluster_id"), ["source_system", "source_key", "organization"])
    latest = e.groupBy("cluster_id", "organization", "source_system").agg(
        F.min_by(F.struct(*RACE_FIELDS), F.struct(desc_date("record_date"), F.col("source_key"), F.col("_source_file"))).alias("v"))
    g = gold.select("cluster_id", "organization", *[F.col(f).alias("g_" + f) for f in RACE_FIELDS])
    j = latest.join(g, ["cluster_id", "organization"])
    st = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col("v." + f).alias("source_value"), F.col("g_" + f).alias("golden_value"))
                             for f in RACE_FIELDS])).alias("x")
    return j.select("cluster_id", "organization", "source_system", st).select(
        "cluster_id", "organization", "x.field", "source_system", "x.source_value", "x.golden_value",
        F.coalesce(F.col("x.source_value") == F.col("x.golden_value"), F.lit(False)).alias("is_winner"))


@register("score_rules_extended", PS.clusters("parity", "transitive") + PS.addresses() + """,
addr_latest AS (
  SELECT organization, source_system, source_customer_key, first(gate ORDER BY file_date DESC, source_key) AS gate,
         first(postnummer ORDER BY file_date DESC, source_key) AS postnummer, first("by" ORDER BY file_date DESC, source_key) AS city
  FROM a2_union GROUP BY 1, 2, 3
),
nb AS (
  SELECT b.*, a.gate, a.postnummer, a.city FROM v2_base b LEFT JOIN addr_latest a
    ON a.organization = b.organization AND a.source_system = b.source_system AND a.source_customer_key = b.source_key
)
SELECT h.node, h.best_neighbor,
  bool_or(COALESCE(lower(x.last_name) = lower(y.last_name) AND x.birth_date = y.birth_date, FALSE)) AS d03_name_dob,
  CAST(max(CASE WHEN x.gate IS NOT NULL AND y.gate IS NOT NULL AND jaro_winkler_similarity(x.gate, y.gate) >= 0.80
            AND x.postnummer = y.postnummer THEN 0.25 ELSE 0.0 END) AS DOUBLE) AS score_p02,
  max(CAST(CASE WHEN length(regexp_replace(x.phone, '[^0-9]', '', 'g')) >= 7 AND length(regexp_replace(y.phone, '[^0-9]', '', 'g')) >= 7
            AND right(regexp_replace(x.phone, '[^0-9]', '', 'g'), 7) = right(regexp_replace(y.phone, '[^0-9]', '', 'g'), 7)
            AND x.city = y.city THEN 0.10 ELSE 0.0 END AS DOUBLE)) AS score_p05
FROM v2_onehop h JOIN nb x ON x.node = h.node JOIN nb y ON y.node = h.best_neighbor
GROUP BY 1, 2""", "SC-15")
def q_extended_rules(spark, sf_dir):
    """The specified-but-deferred rules D03 (last name + birth date, no published
    weight: a flag), P02 (street JW >= 0.80 and same postcode: 0.25) and P05
    (last 7 phone digits and same city: 0.10) on each record's best-neighbour edge."""
    from aurum.functions import digits, jaro_winkler
    from aurum.operators.survivorship import desc_date
    from aurum.plans import inputs
    enr = pairwise.enriched(spark, sf_dir)
    g = pairwise.MatchGraph(enr, "parity", inputs.overrides(spark, sf_dir))
    oh = g.one_hop().where(F.col("best_neighbor").isNotNull()).select("node", "best_neighbor")
    a = pairwise.addresses(spark, sf_dir).groupBy("organization", "source_system", "source_customer_key").agg(
        F.min_by(F.struct("gate", "postnummer", F.col("by").alias("city")), F.struct(desc_date("file_date"), F.col("source_key"))).alias("a"))
    rows = g.rows.join(a, (g.rows.organization == a.organization) & (g.rows.source_system == a.source_system)
                       & (g.rows.source_key == a.source_customer_key), "left") \
        .select("node", "last_name", "birth_date", "phone", F.col("a.gate").alias("gate"), F.col("a.postnummer").alias("postnummer"),
                F.col("a.city").alias("city"))
    x = rows.select(*[F.col(c).alias("x_" + c) for c in rows.columns])
    y = rows.select(*[F.col(c).alias("y_" + c) for c in rows.columns])
    p = oh.join(x, oh.node == x.x_node).join(y, oh.best_neighbor == y.y_node)
    dx, dy = digits("x_phone"), digits("y_phone")
    return p.groupBy("node", "best_neighbor").agg(
        F.bool_or(F.coalesce((F.lower("x_last_name") == F.lower("y_last_name")) & (F.col("x_birth_date") == F.col("y_birth_date")), F.lit(False))).alias("d03_name_dob"),
        F.max(F.when(F.col("x_gate").isNotNull() & F.col("y_gate").isNotNull() & (jaro_winkler("x_gate", "y_gate") >= 0.80)
                     & (F.col("x_postnummer") == F.col("y_postnummer")), 0.25).otherwise(0.0)).alias("score_p02"),
        F.max(F.when((F.length(dx) >= 7) & (F.length(dy) >= 7) & (F.substring(dx, -7, 7) == F.substring(dy, -7, 7))
                     & (F.col("x_city") == F.col("y_city")), 0.10).otherwise(0.0)).alias("score_p05"))


ADDR_FIELDS = ["gate", "postnummer", "by", "land"]


@register("address_winners", V2_SQL + ",\nawin AS (\n" + "\nUNION ALL\n".join(
    f"SELECT '{f}' AS field, e.source_system FROM a2_grouped e JOIN a2_golden g ON g.cluster_id = e.cluster_id "
    f"AND g.organization = e.organization WHERE e.\"{f}\" IS NOT NULL AND e.\"{f}\" = g.\"{f}\"" for f in ADDR_FIELDS)
    + ")\nSELECT field, source_system, count(*) AS rows_matching_golden FROM awin GROUP BY 1, 2", "AG-13")
def q_addr_winners(spark, sf_dir):
    enr, cl, gold, addr = v2_chain(spark, sf_dir)
    ag = address_golden(addr, cl).select("cluster_id", "organization", *[F.col(f).alias("g_" + f) for f in ADDR_FIELDS])
    c = cl.select("source_system", F.col("source_key").alias("source_customer_key"), "organization", "cluster_id")
    e = addr.join(c, ["source_system", "source_customer_key", "organization"]).join(ag, ["cluster_id", "organization"])
    st = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), (F.col(f).isNotNull() & (F.col(f) == F.col("g_" + f))).alias("hit"))
                             for f in ADDR_FIELDS]))
    return e.select("source_system", st.alias("x")).where("x.hit").groupBy(F.col("x.field").alias("field"), "source_system") \
        .agg(F.count("*").alias("rows_matching_golden"))


# The pairwise survivorship written as a rule *table* (data), turned into min_by rules (GD-04).
RULE_TABLE = [
    # output, validity, priority column
    ("ssn", "not_null", "source"),
    ("first_name", "len_gt_1", "source"),
    ("last_name", "len_gt_1", "source"),
    ("birth_date", "not_null", "source"),
    ("citizenship", "not_null", "citizenship"),
    ("phone", "digits_ge_8", "source"),
    ("email", "has_at", "source"),
]


def rules_from_table(rows) -> list:
    from aurum.functions import digits
    from aurum.operators.survivorship import Rule, desc_date
    valid = {
        "not_null": lambda c: F.col(c).isNotNull(),
        "len_gt_1": lambda c: F.length(F.trim(F.coalesce(c, F.lit("")))) > 1,
        "digits_ge_8": lambda c: F.col(c).isNotNull() & (F.length(digits(c)) >= 8),
        "has_at": lambda c: F.col(c).like("%@%"),
    }
    prio = {"source": F.col("_prio"), "citizenship": F.col("_cprio")}
    tie = [desc_date("record_date"), F.col("source_system"), F.col("source_key"), F.col("_source_file")]
    return [Rule(r["output"], F.col(r["output"]), [prio[r["priority"]], *tie], valid[r["validity"]](r["output"]), fallback=True)
            for r in rows]


@register("survive_generic", GOLD_ONLY + "\nSELECT cluster_id, organization, ssn, first_name, last_name, birth_date, citizenship, phone, email FROM v2_gold0",
          "GD-04")
def q_survive_generic(spark, sf_dir):
    from aurum.operators.survivorship import survive
    enr, cl = clusters_for(spark, sf_dir)
    table = spark.createDataFrame(RULE_TABLE, "output string, validity string, priority string")
    rows = table.collect()  # the rule table: a handful of rows of metadata, never data
    grouped = enr.join(cl.select("source_system", "source_key", "organization", "cluster_id"), ["source_system", "source_key", "organization"]) \
        .withColumn("_prio", pairwise.source_priority()).withColumn("_cprio", pairwise.citizenship_priority())
    return survive(grouped, ["cluster_id", "organization"], rules_from_table(rows))
