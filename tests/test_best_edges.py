"""Best edges, override handling and statuses of the match graph against all literal pairs."""

import random

import pytest
from pyspark.sql import functions as F

from aurum import rules
from aurum.functions import digits, soundex_nordic
from aurum.functions.similarity import jaro_winkler
from aurum.operators import graph, partners
from aurum.plans import nrt
from aurum.plans.pairwise import MatchGraph, clusters

COLUMNS = "organization string, source_system string, source_key string, ssn string, first_name string, last_name string, birth_date date, canonical_first_name string, phone string, email string"


def people(seed, n):
    """Rows with few ids, phones and names, so that groups of every kind overlap; some records have several rows."""
    rng = random.Random(seed)
    firsts, lasts = ["Kari", "Karin", "Karl", "Ola", None, "Jo Anne"], ["Hansen", "Hanssen", "Hanson", "Jensen", "Berg", None, "Anne Berg"]
    rows = []
    for i in range(n):
        for _ in range(rng.choice([1, 1, 1, 2])):
            first = rng.choice(firsts)
            rows.append((rng.choice(["BANK", "BANK", "INS"]), rng.choice(["BS", "NICE"]), f"k{rng.randrange(n)}", rng.choice([None, None, "1", "2", f"i{i}"]), first,
                         rng.choice(lasts), None, first, rng.choice([None, "+4711111111", "22222222", f"9{i:07d}", "123"]), None))
    return rows


def as_frame(spark, rows):
    years = spark.createDataFrame(rows, COLUMNS)
    return years.withColumn("birth_date", F.when(F.length("source_key") % 2 == 0, F.lit("1980-02-03")).otherwise(F.lit("1981-01-01")).cast("date"))


def literal_edges(rows, blocks, overrides):
    """All matched row pairs, by a cross product of the rows: (node_a, node_b, total, label, parted)."""
    a, b = (rows.select(*[F.col(c).alias(f"{c}_{s}") for c in rows.columns]) for s in "ab")
    eq = lambda c: F.coalesce(F.col(c + "_a") == F.col(c + "_b"), F.lit(False))
    met = eq("ssn") | (eq("sdx") & eq("year"))
    if blocks == "extended":
        met = met | eq("sdx") | eq("ph8")
    p = a.crossJoin(b).where((F.col("organization_a") == F.col("organization_b")) & (F.col("node_a") != F.col("node_b")) & met)
    same = F.lit(True)
    for c in ("canonical_first_name", "last_name"):
        same = same & (F.lower(F.trim(F.coalesce(F.col(c + "_a"), F.lit("")))) == F.lower(F.trim(F.coalesce(F.col(c + "_b"), F.lit("")))))
    jw = F.when(F.col("full_a").isNotNull() & F.col("full_b").isNotNull(), jaro_winkler("full_a", "full_b"))
    d = dict(rules.PAIR_SCORES)
    det = F.greatest(F.when(eq("ssn"), F.when(same, d["D01"]).otherwise(d["D01b"])).otherwise(0.0), F.when(eq("ph8"), d["D02"]).otherwise(0.0))
    fuzzy = F.when(jw >= rules.FUZZY_NAME_LEAST, jw * rules.FUZZY_NAME_WEIGHT).otherwise(0.0)
    total = det + fuzzy + F.when(eq("sdx"), rules.SOUNDEX_BONUS).otherwise(0.0)
    label = F.when(eq("ssn") & same, "D01").when(eq("ssn"), "D01b").when(eq("ph8"), "D02").when(fuzzy > 0, "FUZZY").otherwise("OTHER")
    found = p.select("node_a", "node_b", "source_key_a", "source_key_b", total.alias("t"), label.alias("l")).where(F.col("t") >= rules.MATCH_THRESHOLD).collect()
    banned = {frozenset(o) for o in overrides}
    return [(r["node_a"], r["node_b"], r["t"], r["l"], frozenset((r["source_key_a"], r["source_key_b"])) in banned) for r in found]


def check(spark, rows, blocks, overrides):
    frame = as_frame(spark, rows)
    ov = spark.createDataFrame(overrides, "source_key_a string, source_key_b string") if overrides else None
    g = MatchGraph(frame, blocks, ov)
    edges = literal_edges(g.rows, blocks, overrides)
    nodes = [r["node"] for r in g.nodes.collect()]
    kept = [e for e in edges if not e[4]]
    best = {}
    for a, b, t, label, _ in kept:
        best[a] = min(best.get(a, (1.0, "", "")), (-round(t, 9), label, b))
    got = {r["node"]: (-round(r["total"], 9), r["label"], r["other"]) for r in g.best_edges().collect()}
    assert got == best
    near = {n: min((b for a, b, *_ in kept if a == n), default=None) for n in nodes}
    assert {r["node"]: r["best_neighbor"] for r in g.one_hop().collect()} == near
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b, *_ in kept:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    assert {r["node"]: r["cluster_id"] for r in g.components().collect()} == {n: find(n) for n in nodes}
    parted = {a for a, _, _, _, p in edges if p}
    status = {"|".join((r["organization"], r["source_system"], r["source_key"])): r["match_status"] for r in clusters(g, "transitive").collect()}
    assert {n for n, s in status.items() if s == "UNMERGE"} == parted
    return len(kept), len(parted)


@pytest.mark.parametrize("blocks", ["parity", "extended"])
def test_best_edges_equal_all_pairs(spark, blocks):
    assert check(spark, people(1, 24), blocks, [])[0] > 20


@pytest.mark.parametrize("blocks,seed", [("parity", 2), ("extended", 3)])
def test_overrides_part_single_pairs(spark, blocks, seed):
    rows = people(seed, 18)
    keys = sorted({r[2] for r in rows})
    rng = random.Random(seed)
    some = [tuple(rng.sample(keys, 2)) for _ in range(14)]
    kept, parted = check(spark, rows, blocks, some)
    assert kept and parted


def test_a_group_of_endpoints_alone(spark):
    # one id, every record named by an override: first and last of six are parted from all others but one
    rows = [("BANK", "BS", f"k{i}", "1", "Kari", "Hansen", None, "Kari", None, None) for i in range(6)]
    some = [("k0", f"k{i}") for i in range(1, 5)] + [(f"k{i}", "k5") for i in range(1, 5)]
    check(spark, rows, "parity", some)
    check(spark, rows, "parity", [*some, ("k5", "k0")])


def test_hot_key_is_split_and_rows_stay_linear(spark):
    n = 6000
    members = spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 1500)).alias("gid"),
                                    F.format_string("n%06d", "id").alias("node"))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                                           "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(keep, ("2k", "2k", "1.2", "-1")):
            spark.conf.set(k, v)
        m = members.checkpoint()
        ends = graph.group_minima(m)
        assert {(r["min1"], r["min2"]) for r in ends.where("gid = 'hot'").collect()} == {("n000000", "n000003")}
        joined = m.join(ends, "gid").groupBy("node").agg(F.min("min1").alias("x"))
        assert joined.count() == n
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        # two rows a key reach the second aggregate, however many members the key has
        limited = partners.k_smallest(m, "gid", 2)
        limited.collect()
        assert limited._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_stream_best_edges_equal_all_pairs(spark):
    rng = random.Random(6)
    rows = []
    for i in range(40):
        first, last = rng.choice(["Kari", "Karin", "kari", "Ola", None]), rng.choice(["Hansen", "Hanssen", "Berg", None])
        mail = rng.choice([None, "a@x.no", "b@x.no", "c@y.no", f"m{i}@x.no", "noat"])
        rows.append(("CRM_A", f"k{i}", first, last, first, mail, rng.choice([None, "+4711111111", "4722222222", "12"])))
    s = spark.createDataFrame(rows, "source_system string, source_key string, first_name string, last_name string, canonical_first_name string, email string, phone string") \
        .withColumn("block_soundex", soundex_nordic("last_name")).withColumn("block_email_domain", F.when(F.instr("email", "@") > 0, F.substr("email", F.instr("email", "@")))) \
        .withColumn("block_phone_suffix", F.when(F.length(digits("phone")) >= 4, F.substring(digits("phone"), -4, 4)))
    got = {r["node_a"]: (round(r["total_score"], 6), r["node_b"]) for r in nrt.score_best_edges(s).collect()}
    from aurum.operators.scoring import stream_rules, stream_total
    n = s.withColumn("node", nrt.node_col())
    a, b = (n.select(*[F.col(c).alias(f"{c}_{k}") for c in n.columns]) for k in "ab")
    met = F.lit(False)
    for c in ("block_soundex", "block_email_domain", "block_phone_suffix"):
        met = met | F.coalesce(F.col(c + "_a") == F.col(c + "_b"), F.lit(False))
    pairs = a.crossJoin(b).where((F.col("node_a") != F.col("node_b")) & met).select("node_a", "node_b", *[v.alias(k) for k, v in stream_rules().items()])
    best = {}
    for r in pairs.withColumn("t", stream_total()).where(F.col("t") >= rules.MATCH_THRESHOLD).collect():
        best[r["node_a"]] = min(best.get(r["node_a"], (1.0, "")), (-round(r["t"], 6), r["node_b"]))
    assert got == {k: (-t, o) for k, (t, o) in best.items()} and len(got) > 20
