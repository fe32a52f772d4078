"""Stream rule set (NRT) in batch form: events -> mapped records -> latest
state -> match graph -> clusters -> golden -> quality -> CDC.

Match graph. With the stream rules a candidate pair scores >= 0.70 exactly
when the e-mails are equal (1.0), the last 10 phone digits are equal (0.95)
or the canonical first + last names are equal (0.80): the probabilistic rules
sum to at most 0.30 + 0.20 + 0.15 = 0.65. Each of the three implies a shared
blocking key (domain / phone suffix / soundex), so the graph is a union of
cliques on those keys, built as groups and stars (no pair lists). The only
exception is an e-mail without '@' (no domain block): it is a clique only
together with a shared soundex or phone suffix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aurum import rules
from aurum.functions import digits, row_hash
from aurum.functions.similarity import jaro_winkler
from aurum.operators import graph
from aurum.operators.fuzzy import similar_values
from aurum.operators.partners import best_partners
from aurum.operators.quality import customer_rules_stream, score_quality
from aurum.operators.scoring import stream_rules, stream_total
from aurum.operators.survivorship import Rule, survive
from aurum.plans.layers import layer
from aurum.sources.events import map_events, raw_events

CUTOFF = "2024-01-03 00:00:00"  # events before it form the first load, the rest the update batch
BATCH_ENDS = ["2024-01-11 00:00:00", "2024-01-21 00:00:00", "2100-01-01 00:00:00"]

STATE_COLS = ["source_system", "source_key", "first_name", "last_name", "canonical_first_name", "email", "phone",
              "block_soundex", "block_email_domain", "block_phone_suffix", "event_ts", "arrival_seq"]


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layer(spark, ("nrt_raw", sf_dir), lambda: raw_events(spark, sf_dir))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layer(spark, ("nrt_recs", sf_dir), lambda: map_events(_raw(spark, sf_dir))[0])


def mapped(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(records, rejects); a query of records alone takes :func:`records`, which parses the messages once."""
    return records(spark, sf_dir), layer(spark, ("nrt_rejects", sf_dir), lambda: map_events(_raw(spark, sf_dir))[1])


def upsert_latest(records: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Keyed latest state with out-of-order protection (RT-01).

    The newest event time wins; equal times go to the later arrival. One
    aggregation (partially combined map-side), no sort of the whole key.
    """
    r = records.select(*STATE_COLS)
    if state is not None:
        r = state.select(*STATE_COLS).unionByName(r)
    order = F.struct("event_ts", "arrival_seq")
    return r.groupBy("source_system", "source_key").agg(
        F.max_by(F.struct(*[c for c in STATE_COLS if c not in ("source_system", "source_key")]), order).alias("s")) \
        .select("source_system", "source_key", "s.*")


def node_col() -> Column:
    return F.concat_ws("|", "source_system", "source_key")


def memberships(state: DataFrame) -> DataFrame:
    """(gid, node) of the decisive cliques (see module doc)."""
    rules.check_match_graph()
    s = state.withColumn("node", node_col())
    em = F.col("email")
    p10 = F.regexp_replace("phone", r"\+", "")
    parts = [
        s.where(em.isNotNull() & (F.instr(em, "@") > 0)).select(F.concat(F.lit("E|"), em).alias("gid"), "node"),
        s.where(em.isNotNull() & (F.instr(em, "@") == 0) & F.col("block_soundex").isNotNull())
         .select(F.concat_ws("|", F.lit("F"), em, "block_soundex").alias("gid"), "node"),
        s.where(em.isNotNull() & (F.instr(em, "@") == 0) & F.col("block_phone_suffix").isNotNull())
         .select(F.concat_ws("|", F.lit("G"), em, "block_phone_suffix").alias("gid"), "node"),
        s.where(F.col("phone").isNotNull() & (F.length(p10) >= 10))
         .select(F.concat(F.lit("P|"), F.substring(p10, -10, 10)).alias("gid"), "node"),
        s.where(F.col("canonical_first_name").isNotNull() & F.col("last_name").isNotNull())
         .select(F.concat_ws("|", F.lit("C"), F.lower("canonical_first_name"), F.lower("last_name")).alias("gid"), "node"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def resolve(state: DataFrame) -> DataFrame:
    """Full re-resolution: connected components of the match graph (CL-07)."""
    m = memberships(state).checkpoint()
    nodes = state.select(node_col().alias("node"))
    cc = graph.connected_components(nodes, graph.star_edges(m))
    return state.withColumn("node", node_col()).join(cc, "node").withColumnRenamed("component", "cluster_id").drop("node")


def assign_delta(old: DataFrame, changed: DataFrame) -> DataFrame:
    """Incremental assign / merge that never splits (CL-06): the rows whose record or cluster changes.

    ``old``: stored records with their cluster; ``changed``: new versions of
    records. A stored record stands for its cluster, so the graph has one node per
    cluster or new record that shares a key with a changed record, and its
    components follow the batch, not the state. The survivor is the smallest id.
    """
    key = ["source_system", "source_key"]
    node = node_col().alias("node")
    mine = memberships(changed).checkpoint()
    hot = mine.select("gid").distinct()
    others = memberships(old.join(changed.select(*key), key, "left_anti")).join(hot, "gid", "left_semi")
    known = old.select(node, "cluster_id")
    met = mine.unionByName(others).join(known, "node", "left").select("gid", F.coalesce("cluster_id", "node").alias("node"))
    # records without any key are nodes too
    ids = met.select("node").unionByName(changed.select(node).join(known, "node", "left").select(F.coalesce("cluster_id", "node").alias("node"))).distinct().checkpoint()
    found = graph.connected_components(ids, graph.star_edges(met)).checkpoint()
    now = changed.withColumn("node", node_col()).join(known, "node", "left").withColumn("id", F.coalesce("cluster_id", "node")) \
        .drop("cluster_id").join(found.select(F.col("node").alias("id"), F.col("component").alias("cluster_id")), "id").select(*STATE_COLS, "cluster_id")
    merged = found.where(F.col("node") != F.col("component")).select(F.col("node").alias("cluster_id"), "component")
    moved = old.join(changed.select(*key), key, "left_anti").join(merged, "cluster_id").select(*STATE_COLS, F.col("component").alias("cluster_id"))
    return now.unionByName(moved)


def assign_incremental(old: DataFrame, changed: DataFrame) -> DataFrame:
    """All records with their cluster after :func:`assign_delta`."""
    delta = assign_delta(old, changed).checkpoint()
    key = ["source_system", "source_key"]
    return old.select(*STATE_COLS, "cluster_id").join(delta.select(*key), key, "left_anti").unionByName(delta)


def golden(clustered: DataFrame) -> DataFrame:
    """Survivorship per cluster (GD-03): valid first by source priority then
    recency, else any non-empty value by recency; then quality and row hash."""
    prio = F.coalesce(*[F.when(F.col("source_system") == k, F.lit(v)) for k, v in rules.STREAM_PRIORITY.items()], F.lit(99))
    rec = F.coalesce(-F.unix_micros(F.col("event_ts").cast("timestamp")), F.lit(1 << 62))

    def rule(name: str, valid: Column) -> Rule:
        v = F.coalesce(valid, F.lit(False))
        present = F.col(name).isNotNull() & (F.length(F.col(name)) > 0)
        return Rule(name, F.col(name), [F.when(v, 0).otherwise(1), F.when(v, prio).otherwise(0), rec,
                                        F.col("source_system"), F.col("source_key")], present)

    g = survive(clustered, ["cluster_id"], [
        rule("first_name", F.length(F.trim("first_name")) > 1),
        rule("last_name", F.length(F.trim("last_name")) > 1),
        rule("email", F.instr("email", "@") > 0),
        rule("phone", F.length(digits("phone")) >= 7),
    ], [F.size(F.collect_set("source_system")).cast("long").alias("source_count")])
    g = score_quality(g, customer_rules_stream())
    return g.withColumn("row_hash", row_hash("first_name", "last_name", "email", "phone", "dq_score", "source_count", sep="|")) \
        .select("cluster_id", "first_name", "last_name", "email", "phone", "dq_score", "source_count", "row_hash")


def golden_events(old: DataFrame, new: DataFrame, as_of: str) -> DataFrame:
    """CDC between two golden snapshots (RT-03, SNK-01): INSERT / UPDATE when the
    hash changed (with the previous hash), CLOSE for ids absorbed by a merge."""
    o = old.select("cluster_id", F.col("row_hash").alias("previous_hash"))
    j = new.join(o, "cluster_id", "full_outer")
    ev = (j.where(F.col("row_hash").isNull() | F.col("previous_hash").isNull() | (F.col("row_hash") != F.col("previous_hash")))
          .withColumn("event_type", F.when(F.col("row_hash").isNull(), "CLOSE")
                      .when(F.col("previous_hash").isNull(), "INSERT").otherwise("UPDATE")))
    return ev.select(F.col("cluster_id").alias("customer_id"), "event_type", "first_name", "last_name", "email", "phone",
                     "dq_score", "source_count", "row_hash", "previous_hash", F.lit(as_of).cast("timestamp").alias("valid_from"))


def xref_events(old: DataFrame, new: DataFrame) -> DataFrame:
    """XREF changes keyed system|key (SNK-02): ASSIGN for new records, REASSIGN on moves."""
    o = old.select("source_system", "source_key", F.col("cluster_id").alias("previous_customer_id"))
    j = new.select("source_system", "source_key", "cluster_id").join(o, ["source_system", "source_key"], "left")
    return j.where(F.col("previous_customer_id").isNull() | (F.col("previous_customer_id") != F.col("cluster_id"))).select(
        F.concat_ws("|", "source_system", "source_key").alias("event_key"), "source_system", "source_key",
        F.col("cluster_id").alias("customer_id"),
        F.when(F.col("previous_customer_id").isNull(), "ASSIGN").otherwise("REASSIGN").alias("event_type"),
        "previous_customer_id")


def apply_cdc(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fold a golden event log into current and SCD2 history tables (SNK-04)."""
    w = Window.partitionBy("customer_id").orderBy("valid_from")
    hist = events.withColumn("valid_to", F.coalesce(F.lead("valid_from").over(w), F.lit(rules.OPEN_END + " 00:00:00").cast("timestamp"))) \
        .withColumn("is_current", F.lead("valid_from").over(w).isNull() & (F.col("event_type") != "CLOSE"))
    cur = hist.where("is_current").drop("valid_to", "is_current", "previous_hash", "event_type")
    return cur, hist.where(F.col("event_type") != "CLOSE")


def _domain(c: str) -> Column:
    return F.when(F.instr(c, "@") > 0, F.substr(F.col(c), F.instr(c, "@")))


def score_entries(state: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, holders, entries) of :mod:`aurum.operators.partners` for the stream rules.

    A holder is a decisive key with one profile (names, mail domain, soundex).
    Profiles of one key with similar full names are scored as pairs. All others
    gain from an equal soundex and, within a domain, from a similar first name,
    so their cells are the key's records of a soundex, of a domain and first
    name, of both, and all.
    """
    w = rules.STREAM_SCORES
    s = state.withColumn("node", node_col()).select(
        "node", F.col("canonical_first_name").alias("first"), F.col("last_name").alias("last"), F.col("block_soundex").alias("sdx"), _domain("email").alias("domain"))
    s = s.withColumn("full", F.concat("first", F.lit(" "), "last")).withColumn("profile", F.to_json(F.struct("first", "last", "sdx", "domain")))
    rows = memberships(state).join(s, "node").checkpoint()
    det = F.when(F.substring("gid", 1, 1) == "P", w["D02"]).when(F.substring("gid", 1, 1) == "C", w["C01"]).otherwise(w["D01"])
    cell = {"profile": F.concat_ws("|", F.lit("a"), "gid", "profile"), "both": F.concat_ws("|", F.lit("b"), "gid", "sdx", "domain", "given"),
            "given": F.concat_ws("|", F.lit("c"), "gid", "domain", "given"), "sdx": F.concat_ws("|", F.lit("d"), "gid", "sdx"), "gid": F.concat_ws("|", F.lit("e"), "gid")}
    rows = rows.withColumn("given", F.lower("first"))
    near = F.col("given").isNotNull() & F.col("domain").isNotNull()
    use = {"profile": F.lit(True), "both": near & F.col("sdx").isNotNull(), "given": near, "sdx": F.col("sdx").isNotNull(), "gid": F.lit(True)}
    members = None
    for c, key in cell.items():
        one = rows.where(use[c]).select(key.alias("cell"), "node")
        members = one if members is None else members.unionByName(one)
    holders = rows.select(cell["profile"].alias("holder"), "node").distinct()
    profiles = rows.select("gid", "profile", "first", "last", "full", "given", "sdx", "domain").distinct().withColumn("det", det).checkpoint()

    def several(of: DataFrame, keys: list[str], c: str) -> DataFrame:
        """Distinct values by key, of keys with more than one."""
        v = of.where(F.col(c).isNotNull()).select(*keys, F.col(c).alias("value")).distinct()
        many = v.groupBy(*keys).agg(F.min("value").alias("x"), F.max("value").alias("y")).where(F.col("x") != F.col("y")).drop("x", "y")
        return v.join(many, keys, "left_semi")

    def similar(of: DataFrame, keys: list[str], c: str, least: float) -> DataFrame:
        """(keys, a, b, jw), equal values included."""
        v = several(of, keys, c)
        found = similar_values(v, v, least, keys=keys).where(F.col("left_value") != F.col("right_value"))
        own = of.where(F.col(c).isNotNull()).select(*keys, F.col(c).alias("a"), F.col(c).alias("b"), F.lit(1.0).alias("jw")).distinct()
        return found.select(*keys, F.col("left_value").alias("a"), F.col("right_value").alias("b"), "jw").unionByName(own)

    bonus = {"sdx": F.lit(w["P03"]), "given": F.lit(w["P04"])}
    holder = cell["profile"].alias("holder")
    entries = profiles.select(holder, cell["gid"].alias("cell"), F.col("det").alias("total")) \
        .unionByName(profiles.where(use["sdx"]).select(holder, cell["sdx"].alias("cell"), (F.col("det") + bonus["sdx"]).alias("total")))
    firsts = similar(profiles.where(near), ["gid", "domain"], "given", rules.STREAM_FIRST_NAME_LEAST).checkpoint()
    by_first = profiles.where(near).join(firsts.withColumnRenamed("a", "given"), ["gid", "domain", "given"]).drop("given").withColumnRenamed("b", "given")
    mine = F.concat_ws("|", F.lit("a"), "gid", "profile").alias("holder")
    entries = entries.unionByName(by_first.select(mine, cell["given"].alias("cell"), (F.col("det") + bonus["given"]).alias("total"))) \
        .unionByName(by_first.where(F.col("sdx").isNotNull()).select(mine, cell["both"].alias("cell"), (F.col("det") + bonus["sdx"] + bonus["given"]).alias("total")))
    fulls = similar(profiles, ["gid"], "full", rules.FUZZY_NAME_LEAST).checkpoint()
    cols = ["gid", "profile", "first", "last", "sdx", "domain", "det"]
    x = profiles.select(*[F.col(c).alias(c if c == "gid" else c + "_a") for c in cols], F.col("full").alias("a"))
    y = profiles.select(*[F.col(c).alias(c if c == "gid" else c + "_b") for c in cols if c != "det"], F.col("full").alias("b"))
    pairs = x.join(fulls, ["gid", "a"]).join(y, ["gid", "b"])
    same_sdx = F.coalesce(F.col("sdx_a") == F.col("sdx_b"), F.lit(False))
    first_jw = jaro_winkler(F.lower("first_a"), F.lower("first_b"))
    p04 = F.coalesce((F.col("domain_a") == F.col("domain_b")) & (first_jw >= rules.STREAM_FIRST_NAME_LEAST), F.lit(False))
    total = F.col("det_a") + F.col("jw") * w["P01"] + F.when(same_sdx, w["P03"]).otherwise(0.0) + F.when(p04, w["P04"]).otherwise(0.0)
    entries = entries.unionByName(pairs.select(F.concat_ws("|", F.lit("a"), "gid", "profile_a").alias("holder"),
                                               F.concat_ws("|", F.lit("a"), "gid", "profile_b").alias("cell"), total.alias("total")))
    return members.distinct(), holders, entries.withColumn("label", F.lit(""))


def score_best_edges(state: DataFrame) -> DataFrame:
    """Per record its best edge (ties: the smallest partner), scored with every
    stream rule (SC-07..13, SC-16 match audit)."""
    bn = best_partners(*score_entries(state)).select("node", "other")
    s = state.withColumn("node", node_col())
    cols = ["node", "canonical_first_name", "last_name", "email", "phone", "block_soundex"]
    a = s.select(*[F.col(c).alias(c + "_a") for c in cols])
    b = s.select(*[F.col(c).alias(c + "_b") for c in cols])
    p = bn.join(a, bn.node == a.node_a).join(b, bn.other == b.node_b)
    rs = stream_rules()
    p = p.select(F.col("node").alias("node_a"), F.col("other").alias("node_b"), *[v.alias(k) for k, v in rs.items()])
    return p.withColumn("total_score", stream_total()).select(
        "node_a", "node_b", *[F.round(k, 6).alias(k) for k in rs.keys()], F.round("total_score", 6).alias("total_score"))


def block_stats(state: DataFrame, col: str) -> DataFrame:
    """Block sizes and implied candidate pairs per key (BLK-09): n (n-1) / 2."""
    return state.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("block_key")).agg(F.count("*").alias("records")) \
        .withColumn("candidate_pairs", F.shiftright(F.col("records") * (F.col("records") - 1), 1))


# ------------------------------------------------------------------------------------ queries

from aurum.plans import nrt_sql as NS  # noqa: E402
from aurum.plans.catalog import register  # noqa: E402

ALL = "TRUE"
OLD = f"event_ts < TIMESTAMP '{CUTOFF}'"
REC_COLS = ["event_id", "source_system", "source_key", "first_name", "last_name", "email", "phone", "event_ts",
            "canonical_first_name", "block_soundex", "block_email_domain", "block_phone_suffix"]


def state_all(spark, sf_dir):
    recs = records(spark, sf_dir)
    return layer(spark, ("nrt_state", sf_dir, "all"), lambda: upsert_latest(recs))


def state_old(spark, sf_dir):
    recs = records(spark, sf_dir)
    return layer(spark, ("nrt_state", sf_dir, "old"), lambda: upsert_latest(recs.where(F.col("event_ts") < F.lit(CUTOFF).cast("timestamp"))))


def clusters_all(spark, sf_dir):
    return layer(spark, ("nrt_clusters", sf_dir, "all"), lambda: resolve(state_all(spark, sf_dir)))


def clusters_old(spark, sf_dir):
    return layer(spark, ("nrt_clusters", sf_dir, "old"), lambda: resolve(state_old(spark, sf_dir)))


@register("nrt_source", NS.events() + "\nSELECT " + ", ".join(REC_COLS) + " FROM nrt_recs", "SRC-06, PRJ-08, FN-01..06")
def q_nrt_source(spark, sf_dir):
    return records(spark, sf_dir).select(*REC_COLS)


@register("map_split_fields", NS.events() + "\nSELECT source_key, first_name, last_name, email, phone FROM nrt_recs WHERE source_system = 'CRM_A'", "PRJ-06")
def q_map_a(spark, sf_dir):
    return records(spark, sf_dir).where(F.col("source_system") == "CRM_A").select("source_key", "first_name", "last_name", "email", "phone")


@register("map_full_name", NS.events() + "\nSELECT source_system, source_key, first_name, last_name FROM nrt_recs WHERE source_system IN ('CRM_B', 'CRM_C')", "PRJ-07")
def q_map_bc(spark, sf_dir):
    return records(spark, sf_dir).where(F.col("source_system").isin("CRM_B", "CRM_C")) \
        .select("source_system", "source_key", "first_name", "last_name")


@register("map_events_union", NS.events() + "\nSELECT source_system, count(*) AS records, count(DISTINCT source_key) AS keys FROM nrt_recs GROUP BY 1", "PRJ-08")
def q_map_union(spark, sf_dir):
    return records(spark, sf_dir).groupBy("source_system").agg(F.count("*").alias("records"), F.countDistinct("source_key").alias("keys"))


@register("nrt_bad_events", NS.events() + "\nSELECT event_id, topic, reject_reason FROM nrt_rejects", "SRC-07")
def q_bad(spark, sf_dir):
    return mapped(spark, sf_dir)[1].select("event_id", "topic", "reject_reason")


STATE_OUT = ["source_system", "source_key", "first_name", "last_name", "email", "phone", "event_ts"]


@register("upsert_latest", NS.events() + NS.chain("", ALL) + "\nSELECT " + ", ".join(STATE_OUT) + " FROM nrt_state", "RT-01")
def q_upsert(spark, sf_dir):
    return state_all(spark, sf_dir).select(*STATE_OUT)


@register("reresolve_all", NS.events() + NS.chain("", ALL) + "\nSELECT source_system, source_key, cluster_id FROM nrt_cl", "CL-07, CL-02, BLK-03..05, SC-07..13")
def q_reresolve(spark, sf_dir):
    return clusters_all(spark, sf_dir).select("source_system", "source_key", "cluster_id")


@register("golden_nrt", NS.events() + NS.chain("", ALL) + "\nSELECT * FROM nrt_gold", "GD-03, DQ-001..X03 (stream), FN-12")
def q_golden_nrt(spark, sf_dir):
    return golden(clusters_all(spark, sf_dir))


@register("score_pairs_nrt", NS.events() + NS.chain("", ALL) + """,
bn AS (SELECT s AS node_a, first(d ORDER BY total_score DESC, d) AS node_b
       FROM (SELECT node_a AS s, node_b AS d, round(total_score, 9) AS total_score FROM nrt_pairs UNION ALL SELECT node_b, node_a, round(total_score, 9) FROM nrt_pairs) GROUP BY s)
SELECT bn.node_a, bn.node_b, round(CAST(score_d01 AS DOUBLE), 6) AS score_d01, round(CAST(score_d02 AS DOUBLE), 6) AS score_d02,
       round(CAST(score_c01 AS DOUBLE), 6) AS score_c01, round(CAST(score_p01 AS DOUBLE), 6) AS score_p01,
       round(CAST(score_p03 AS DOUBLE), 6) AS score_p03, round(CAST(score_p04 AS DOUBLE), 6) AS score_p04,
       round(CAST(greatest(score_d01, score_d02, score_c01) + score_p01 + score_p03 + score_p04 AS DOUBLE), 6) AS total_score
FROM bn JOIN nrt_state a ON a.node = bn.node_a JOIN nrt_state b ON b.node = bn.node_b,
LATERAL (SELECT """ + NS._pair_scores("a", "b") + ")", "SC-07..13, SC-16")
def q_score_nrt(spark, sf_dir):
    return score_best_edges(state_all(spark, sf_dir))


@register("cdc_golden_events", NS.events() + NS.chain("_o", OLD) + NS.chain("", ALL) + "\n" +
          NS.golden_events_sql("nrt_gold_o", "nrt_gold", CUTOFF), "SNK-01, RT-03")
def q_cdc_golden(spark, sf_dir):
    return golden_events(golden(clusters_old(spark, sf_dir)), golden(clusters_all(spark, sf_dir)), CUTOFF)


@register("cdc_xref_events", NS.events() + NS.chain("_o", OLD) + NS.chain("", ALL) + """
SELECT n.source_system || '|' || n.source_key AS event_key, n.source_system, n.source_key, n.cluster_id AS customer_id,
       CASE WHEN o.cluster_id IS NULL THEN 'ASSIGN' ELSE 'REASSIGN' END AS event_type, o.cluster_id AS previous_customer_id
FROM nrt_cl n LEFT JOIN nrt_cl_o o USING (source_system, source_key)
WHERE o.cluster_id IS NULL OR o.cluster_id <> n.cluster_id""", "SNK-02")
def q_cdc_xref(spark, sf_dir):
    return xref_events(clusters_old(spark, sf_dir), clusters_all(spark, sf_dir))


def _state_batch(spark, sf_dir, i: int) -> DataFrame:
    """State after batch ``i``, written once for all steps of its resolution."""
    end = F.lit(BATCH_ENDS[i]).cast("timestamp")
    return layer(spark, ("nrt_state_batch", sf_dir, i), lambda: upsert_latest(records(spark, sf_dir).where(F.col("event_ts") < end)))


def _batch_events(spark, sf_dir):
    golds = [layer(spark, ("nrt_gold_batch", sf_dir, i), lambda i=i: golden(resolve(_state_batch(spark, sf_dir, i))))
             for i in range(len(BATCH_ENDS))]
    empty = golds[0].limit(0)
    ev = golden_events(empty, golds[0], BATCH_ENDS[0])
    for i in (1, 2):
        ev = ev.unionByName(golden_events(golds[i - 1], golds[i], BATCH_ENDS[i]))
    return ev


def _batch_sql() -> str:
    ch = "".join(NS.chain(f"_{i}", f"event_ts < TIMESTAMP '{end}'") for i, end in enumerate(BATCH_ENDS))
    return NS.events() + ch + f""",
nrt_gold_empty AS (SELECT * FROM nrt_gold_0 WHERE FALSE),
cdc_log AS (
  {NS.golden_events_sql('nrt_gold_empty', 'nrt_gold_0', BATCH_ENDS[0])}
  UNION ALL {NS.golden_events_sql('nrt_gold_0', 'nrt_gold_1', BATCH_ENDS[1])}
  UNION ALL {NS.golden_events_sql('nrt_gold_1', 'nrt_gold_2', BATCH_ENDS[2])}
),
cdc_hist AS (
  SELECT *, COALESCE(lead(valid_from) OVER w, TIMESTAMP '9999-12-31 00:00:00') AS valid_to,
         lead(valid_from) OVER w IS NULL AND event_type <> 'CLOSE' AS is_current
  FROM cdc_log WINDOW w AS (PARTITION BY customer_id ORDER BY valid_from)
)"""


@register("cdc_apply_current", _batch_sql() + """
SELECT customer_id, first_name, last_name, email, phone, dq_score, source_count, row_hash, valid_from FROM cdc_hist WHERE is_current""", "SNK-04")
def q_cdc_current(spark, sf_dir):
    cur, _ = apply_cdc(_batch_events(spark, sf_dir))
    return cur.select("customer_id", "first_name", "last_name", "email", "phone", "dq_score", "source_count", "row_hash", "valid_from")


@register("cdc_apply_history", _batch_sql() + """
SELECT customer_id, event_type, row_hash, previous_hash, valid_from, valid_to, is_current FROM cdc_hist WHERE event_type <> 'CLOSE'""", "SNK-04, HS-06")
def q_cdc_history(spark, sf_dir):
    _, hist = apply_cdc(_batch_events(spark, sf_dir))
    return hist.select("customer_id", "event_type", "row_hash", "previous_hash", "valid_from", "valid_to", "is_current")


def apply_xref(events: DataFrame, order: str = "batch_id") -> DataFrame:
    """Fold the ASSIGN / REASSIGN log into the cross-reference: the last assignment of every key (SNK-04)."""
    return events.groupBy("source_system", "source_key").agg(F.max_by("customer_id", order).alias("customer_id"))


def _xref_log(spark, sf_dir):
    """The cross-reference events of every batch, resolved from scratch after each."""
    before, log = None, None
    for i in range(len(BATCH_ENDS)):
        now = layer(spark, ("nrt_xref_batch", sf_dir, i), lambda i=i: resolve(_state_batch(spark, sf_dir, i)))
        ev = xref_events(now.limit(0) if before is None else before, now).withColumn("batch_id", F.lit(i))
        log, before = ev if log is None else log.unionByName(ev), now
    return log


@register("cdc_apply_xref", _batch_sql() + """,
xref_log AS (
  SELECT source_system, source_key, cluster_id, 0 AS b FROM nrt_cl_0
  UNION ALL SELECT n.source_system, n.source_key, n.cluster_id, 1 FROM nrt_cl_1 n LEFT JOIN nrt_cl_0 o USING (source_system, source_key)
    WHERE o.cluster_id IS DISTINCT FROM n.cluster_id
  UNION ALL SELECT n.source_system, n.source_key, n.cluster_id, 2 FROM nrt_cl_2 n LEFT JOIN nrt_cl_1 o USING (source_system, source_key)
    WHERE o.cluster_id IS DISTINCT FROM n.cluster_id
)
SELECT source_system, source_key, arg_max(cluster_id, b) AS customer_id FROM xref_log GROUP BY 1, 2""", "SNK-04, HS-09")
def q_cdc_xref_apply(spark, sf_dir):
    """The cross-reference mirror, from the events alone."""
    return apply_xref(_xref_log(spark, sf_dir))


def incremental(spark, sf_dir):
    recs = records(spark, sf_dir)
    touched = recs.where(F.col("event_ts") >= F.lit(CUTOFF).cast("timestamp")).select("source_system", "source_key").distinct()
    changed = state_all(spark, sf_dir).join(touched, ["source_system", "source_key"], "left_semi")
    return layer(spark, ("nrt_incr", sf_dir), lambda: assign_incremental(clusters_old(spark, sf_dir), changed.checkpoint()))


_INCR_SQL = NS.events() + NS.chain("_o", OLD) + NS.chain("", ALL) + f""",
touched AS (SELECT DISTINCT source_system || '|' || source_key AS node FROM nrt_recs WHERE event_ts >= TIMESTAMP '{CUTOFF}'),
inc_e AS (
  SELECT node_a AS s, node_b AS d FROM nrt_pairs_o
  UNION SELECT node_a, node_b FROM nrt_pairs WHERE node_a IN (SELECT node FROM touched) OR node_b IN (SELECT node FROM touched)
),
inc_u AS (SELECT s, d FROM inc_e UNION SELECT d, s FROM inc_e),
inc_nodes AS (SELECT node FROM nrt_state UNION SELECT node FROM nrt_state_o),
inc_reach(s, d) AS (SELECT node, node FROM inc_nodes UNION SELECT r.s, u.d FROM inc_reach r JOIN inc_u u ON r.d = u.s),
inc_cl AS (SELECT st.source_system, st.source_key, c.cluster_id FROM nrt_state st
           JOIN (SELECT s AS node, min(d) AS cluster_id FROM inc_reach GROUP BY s) c USING (node))"""


@register("cluster_incremental", _INCR_SQL + "\nSELECT * FROM inc_cl", "CL-06, BLK-08")
def q_incr(spark, sf_dir):
    return incremental(spark, sf_dir).select("source_system", "source_key", "cluster_id")


@register("nrt_equals_batch", _INCR_SQL + """
SELECT b.cluster_id AS batch_cluster, count(DISTINCT i.cluster_id) AS stream_clusters, count(*) AS records
FROM nrt_cl b JOIN inc_cl i USING (source_system, source_key) GROUP BY b.cluster_id""", "RT-07")
def q_equals(spark, sf_dir):
    b = clusters_all(spark, sf_dir).select("source_system", "source_key", F.col("cluster_id").alias("batch_cluster"))
    i = incremental(spark, sf_dir).select("source_system", "source_key", F.col("cluster_id").alias("stream_cluster"))
    return b.join(i, ["source_system", "source_key"]).groupBy("batch_cluster").agg(
        F.countDistinct("stream_cluster").alias("stream_clusters"), F.count("*").alias("records"))


@register("candidates_incremental", NS.events() + NS.chain("_o", OLD) + NS.chain("", ALL) + f""",
newr AS (SELECT * FROM nrt_state WHERE node IN (SELECT DISTINCT source_system || '|' || source_key FROM nrt_recs
                                                  WHERE event_ts >= TIMESTAMP '{CUTOFF}'))
SELECT n.node, 'soundex' AS block, count(o.node) AS candidates FROM newr n JOIN nrt_state_o o ON o.block_soundex = n.block_soundex AND o.node <> n.node GROUP BY 1
UNION ALL SELECT n.node, 'email_domain', count(o.node) FROM newr n JOIN nrt_state_o o ON o.block_email_domain = n.block_email_domain AND o.node <> n.node GROUP BY 1
UNION ALL SELECT n.node, 'phone_suffix', count(o.node) FROM newr n JOIN nrt_state_o o ON o.block_phone_suffix = n.block_phone_suffix AND o.node <> n.node GROUP BY 1""",
          "BLK-08")
def q_cand_incr(spark, sf_dir):
    """Candidate counts of each new record against the stored state, per block
    (sizes of the lookups, computed by joining block sizes - no pair list)."""
    recs = records(spark, sf_dir)
    touched = recs.where(F.col("event_ts") >= F.lit(CUTOFF).cast("timestamp")).select(node_col().alias("node")).distinct()
    new = state_all(spark, sf_dir).withColumn("node", node_col()).join(touched, "node", "left_semi")
    old = state_old(spark, sf_dir).withColumn("node", node_col())
    blocks = [("soundex", "block_soundex"), ("email_domain", "block_email_domain"), ("phone_suffix", "block_phone_suffix")]
    cols = [c for _, c in blocks]
    # a record meets its stored version once for all blocks
    met = new.select("node", *cols).join(old.select("node", *[F.col(c).alias(f"_{c}") for c in cols]), "node", "left").checkpoint()
    out = None
    for name, col in blocks:
        sizes = old.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
        part = (met.where(F.col(col).isNotNull()).select("node", col, f"_{col}").join(sizes, col)
                .select("node", F.lit(name).alias("block"),
                        (F.col("n") - F.when(F.col(f"_{col}") == F.col(col), 1).otherwise(0)).cast("long").alias("candidates"))
                .where(F.col("candidates") > 0))
        out = part if out is None else out.unionByName(part)
    return out


for _name, _col, _ids in [("block_soundex", "block_soundex", "BLK-03, BLK-09"), ("block_email_domain", "block_email_domain", "BLK-04, BLK-09"),
                          ("block_phone_suffix", "block_phone_suffix", "BLK-05, BLK-09")]:
    register(_name, NS.events() + NS.chain("", ALL) + f"""
SELECT {_col} AS block_key, count(*) AS records, CAST(count(*) * (count(*) - 1) / 2 AS BIGINT) AS candidate_pairs
FROM nrt_state WHERE {_col} IS NOT NULL GROUP BY 1""", _ids)(
        lambda spark, sf_dir, _c=_col: block_stats(state_all(spark, sf_dir), _c))


# ------------------------------------------------------------------------------------ address stream (RT-08)

from aurum.operators.quality import address_rules  # noqa: E402
from aurum.sources.derived import CITIES  # noqa: E402
from aurum.sources.events import ADDRESS_COLS, map_addresses, raw_address_events  # noqa: E402


def upsert_addresses(records: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Keyed latest address state; the newest event time wins, then the later arrival."""
    r = records.select(*ADDRESS_COLS)
    if state is not None:
        r = state.select(*ADDRESS_COLS).unionByName(r)
    return r.groupBy("source_system", "source_key").agg(
        F.max_by(F.struct(*ADDRESS_COLS[2:]), F.struct("event_ts", "arrival_seq")).alias("s")).select("source_system", "source_key", "s.*")


def address_golden(addr: DataFrame, clustered: DataFrame) -> DataFrame:
    """Link addresses to stream clusters, survive by validity -> priority -> recency, score."""
    c = clustered.select("source_system", F.col("source_key").alias("source_customer_key"), "cluster_id")
    g = addr.join(c, ["source_system", "source_customer_key"])
    prio = F.coalesce(*[F.when(F.col("source_system") == k, F.lit(v)) for k, v in rules.STREAM_PRIORITY.items()], F.lit(99))
    rec = -F.unix_micros(F.col("event_ts").cast("timestamp"))
    tie = [prio, rec, F.col("source_system"), F.col("source_key")]
    out = survive(g, ["cluster_id"], [
        Rule("gate", F.col("gate"), tie, F.length(F.trim(F.coalesce("gate", F.lit("")))) >= 3, fallback=True),
        Rule("postnummer", F.col("postnummer"), tie, F.col("postnummer").isNotNull(), fallback=True),
        Rule("by", F.col("by"), tie, F.col("by").isNotNull(), fallback=True),
        Rule("land", F.col("land"), tie, F.col("land").isNotNull(), fallback=True),
    ])
    return score_quality(out, address_rules())


@register("nrt_address_pipeline", NS.events() + NS.chain("", ALL) + f""",
addr AS (
  SELECT source_system, 'ADDR-' || source_key AS source_key, source_key AS source_customer_key,
    CASE WHEN source_system = 'CRM_C' AND CAST(substr(source_key, 2) AS BIGINT) % 3 = 0
         THEN 'Storg. ' ELSE 'Storgata ' END || CAST(1 + CAST(substr(source_key, 2) AS BIGINT) % 120 AS VARCHAR) AS gate,
    lpad(CAST((CAST(substr(source_key, 2) AS BIGINT) * 37) % 10000 AS VARCHAR), 4, '0') AS postnummer,
    CASE WHEN CAST(substr(source_key, 2) AS BIGINT) % 30 = 7 THEN NULL
         ELSE {NS.lst(CITIES)}[CAST(substr(source_key, 2) AS BIGINT) % 4 + 1] END AS "by",
    'NO' AS land, event_ts
  FROM nrt_state
),
ag AS (
  SELECT c.cluster_id, a.* FROM addr a JOIN nrt_cl c ON c.source_system = a.source_system AND c.source_key = a.source_customer_key
),
ag0 AS (
  SELECT cluster_id,
    first(gate ORDER BY CASE WHEN length(trim(COALESCE(gate, ''))) >= 3 THEN 0 ELSE 1 END, p, event_ts DESC, source_system, source_key) AS gate,
    first(postnummer ORDER BY CASE WHEN postnummer IS NOT NULL THEN 0 ELSE 1 END, p, event_ts DESC, source_system, source_key) AS postnummer,
    first("by" ORDER BY CASE WHEN "by" IS NOT NULL THEN 0 ELSE 1 END, p, event_ts DESC, source_system, source_key) AS "by",
    first(land ORDER BY CASE WHEN land IS NOT NULL THEN 0 ELSE 1 END, p, event_ts DESC, source_system, source_key) AS land
  FROM (SELECT *, CASE source_system WHEN 'CRM_A' THEN 1 WHEN 'CRM_B' THEN 2 WHEN 'CRM_C' THEN 3 ELSE 99 END AS p FROM ag)
  GROUP BY cluster_id
)
SELECT *, {NS.dq_score(NS.dq_address_terms())} AS dq_score FROM ag0""", "RT-08, GD-05")
def q_nrt_address(spark, sf_dir):
    return address_golden(upsert_addresses(map_addresses(raw_address_events(spark, sf_dir))), clusters_all(spark, sf_dir))
