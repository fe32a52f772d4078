"""Pairwise rule set (bulk V2): blocked pair scoring, clusters, survivorship,
quality, addresses, history, cross-reference and serving.

Blocking semantics. With the pairwise rules a blocked pair matches (total >=
0.70) exactly when the ids are equal (>= 0.98), the last 8 phone digits are
equal (0.95) or the full-name Jaro-Winkler is >= 0.85 (>= 0.7225); every
other blocked pair scores at most 0.10. So the match graph is

* ``parity`` blocks (id, or soundex(last)+birth year): cliques on (org, id)
  and (org, soundex, year, phone8), plus name similarity inside (org,
  soundex, year);
* ``extended`` blocks (adds soundex-only and phone blocks): cliques on
  (org, id) and (org, phone8), plus name similarity inside (org, soundex).

Cliques stay groups (:mod:`aurum.operators.graph`), name similarity runs on
distinct names per block (:mod:`aurum.operators.fuzzy`). The best edge of a
record is a leave-one-out maximum over the names of its groups
(:mod:`aurum.operators.partners`). Unmerge overrides remove single pairs: a
record they name (an endpoint) meets the smallest record without overrides and
a few endpoints of each of its groups, as many as its overrides call for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aurum import rules
from aurum.functions import digits, soundex_nordic
from aurum.operators import aliases, graph, partners
from aurum.operators.fuzzy import similar_values
from aurum.operators.harmonise import enrich_v2, fake_name_flag, union_addresses, union_customers_v2
from aurum.operators.quality import address_rules, customer_rules_bulk, score_quality
from aurum.operators.scoring import pairwise_rules, pairwise_total
from aurum.operators.survivorship import Rule, desc_date, survive
from aurum.plans import inputs
from aurum.plans.layers import layer
from aurum.session import written

NODE_ATTRS = ["ssn", "first_name", "last_name", "birth_date", "canonical_first_name", "phone", "email"]


def enriched(spark: SparkSession, sf_dir: str, canonical: str = "initcap") -> DataFrame:
    def build():
        u = union_customers_v2(inputs.freg(spark, sf_dir), inputs.bs(spark, sf_dir), inputs.nice(spark, sf_dir))
        e = enrich_v2(u, canonical)
        # the dictionary variant also flags fake names by rule
        return e if canonical == "initcap" else fake_name_flag(e, spark.createDataFrame([(t,) for t in rules.FAKE_TOKENS], "token string"))
    return layer(spark, ("v2_enriched", sf_dir, canonical), build)


def node_id(org="organization", src="source_system", key="source_key") -> Column:
    return F.concat_ws("|", F.col(org), F.col(src), F.col(key))


def base_rows(enr: DataFrame) -> DataFrame:
    """Distinct matching rows per node (a node = org|system|key; updates add rows)."""
    d = digits("phone")
    return (enr.select("organization", "source_system", "source_key", *NODE_ATTRS).distinct()
            .withColumn("node", node_id())
            .withColumn("sdx", soundex_nordic("last_name"))
            .withColumn("year", F.substring(F.col("birth_date").cast("string"), 1, 4))
            .withColumn("ph8", F.when(F.col("phone").isNotNull() & (F.length(d) >= 8), F.substring(d, -8, 8)))
            .withColumn("full", F.when(F.col("canonical_first_name").isNotNull() & F.col("last_name").isNotNull(),
                                       F.concat("canonical_first_name", F.lit(" "), "last_name")))
            # a name as it is (nulls told apart), and as the id rules compare it
            .withColumn("name", F.to_json(F.struct("canonical_first_name", "last_name")))
            .withColumn("norm", F.concat_ws("\u0001", *[F.lower(F.trim(F.coalesce(c, F.lit("")))) for c in ("canonical_first_name", "last_name")])))


def _k(*cols) -> Column:
    return F.concat_ws("|", *[F.col(c) for c in cols])


def memberships(rows: DataFrame, blocks: str) -> tuple[DataFrame, DataFrame]:
    """(clique memberships (gid, node), name nodes (nblock, full, gid, node))."""
    s = rows.where(F.col("ssn").isNotNull()).select(F.concat(F.lit("S|"), _k("organization", "ssn")).alias("gid"), "node")
    if blocks == "parity":
        p = rows.where(F.col("sdx").isNotNull() & F.col("year").isNotNull() & F.col("ph8").isNotNull()) \
            .select(F.concat(F.lit("P|"), _k("organization", "sdx", "year", "ph8")).alias("gid"), "node")
        nb = rows.where(F.col("sdx").isNotNull() & F.col("year").isNotNull()).withColumn("nblock", _k("organization", "sdx", "year"))
    else:
        p = rows.where(F.col("ph8").isNotNull()).select(F.concat(F.lit("P|"), _k("organization", "ph8")).alias("gid"), "node")
        nb = rows.where(F.col("sdx").isNotNull()).withColumn("nblock", _k("organization", "sdx"))
    names = nb.where(F.col("full").isNotNull()).select(
        "nblock", "full", F.concat(F.lit("N|"), _k("nblock", "full")).alias("gid"), "node")
    return s.unionByName(p), names


def name_links(names: DataFrame) -> DataFrame:
    """(nblock, a, b, jw) for distinct full names of one block with JW >= 0.85, both ways round."""
    nv = written(names.select("nblock", F.col("full").alias("value")).distinct())
    sim = similar_values(nv, nv, rules.FUZZY_NAME_LEAST, keys=["nblock"]).where(F.col("left_value") != F.col("right_value"))
    return sim.select("nblock", F.col("left_value").alias("a"), F.col("right_value").alias("b"), "jw")


def _override_keys(ov: DataFrame) -> DataFrame:
    return ov.select(F.least("source_key_a", "source_key_b").alias("k1"), F.greatest("source_key_a", "source_key_b").alias("k2")).distinct()


def _node_key(c: str) -> Column:
    # node = org|system|key ; the key itself may not contain '|' in the fixtures, take the rest
    return F.regexp_extract(F.col(c), r"^[^|]*\|[^|]*\|(.*)$", 1)


class MatchGraph:
    """Compressed match graph of one rule-set configuration.

    A table that several steps read is written once: derived again in each of them, a plan would hold a hundred and more
    exchanges, and its stages, their threads and their plan texts are the driver's memory.
    """

    def __init__(self, enr: DataFrame, blocks: str = "parity", overrides: DataFrame | None = None):
        rules.check_match_graph()
        self.rows = written(base_rows(enr))
        self.nodes = written(self.rows.select("node", "organization", "source_system", "source_key", "ssn").dropDuplicates(["node"]))
        cliques, names = memberships(self.rows, blocks)
        self.blocks = blocks
        self.names = written(name_links(names))
        name_gid = lambda c: F.concat(F.lit("N|"), F.concat_ws("|", "nblock", c))
        self.links = self.names.select(name_gid("a").alias("gid"), name_gid("b").alias("gid2"))
        self.members = written(cliques.unionByName(names.select("gid", "node")).distinct())
        self.overrides = overrides
        self._held = self._banned = self._parted = self._most = self._endpoint = None
        if overrides is not None:
            ok = _override_keys(overrides)
            keys = ok.select(F.col("k1").alias("k")).unionByName(ok.select(F.col("k2").alias("k"))).distinct()
            self.endpoints = written(self.nodes.join(keys, self.nodes.source_key == keys.k, "left_semi").select("node"))
            self.okeys = ok
        else:
            self.endpoints = None

    # -- override endpoints ----------------------------------------------------------------------
    def banned(self) -> DataFrame:
        """(node, other) of all overrides, both ways round."""
        if self._banned is None:
            n = self.nodes.select("node", F.col("source_key").alias("k"))
            one = written(self.okeys.join(n.select("node", F.col("k").alias("k1")), "k1").join(n.select(F.col("node").alias("other"), F.col("k").alias("k2")), "k2")
                          .select("node", "other"))
            self._banned = written(one.unionByName(one.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct())
        return self._banned

    def held(self) -> DataFrame:
        """(gid, node): the groups of the endpoints."""
        if self._held is None:
            self._held = written(self.members.join(self.endpoints, "node", "left_semi").select("gid", "node"))
        return self._held

    def parted(self) -> DataFrame:
        """(node, other) of the overrides between records that meet (in a group or in groups of similar names), both ways round."""
        if self._parted is None:
            to = self.held().select(F.col("gid").alias("gid2"), F.col("node").alias("other"))
            same = written(self.banned().join(self.held(), "node"))
            linked = same.join(self.links, "gid").join(to, ["gid2", "other"])
            equal = same.join(to.withColumnRenamed("gid2", "gid"), ["gid", "other"])
            self._parted = written(equal.select("node", "other").unionByName(linked.select("node", "other")).distinct())
        return self._parted

    def most_banned(self) -> int:
        """The most overrides of a record; one that parts it from a record it never meets takes no partner away."""
        if self._most is None:
            self._most = self.parted().groupBy("node").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        return self._most

    def _endpoint_pairs(self) -> DataFrame:
        """(node, other): for every endpoint enough of its partners to keep its smallest one and all connectivity.

        In a group these are the smallest record without overrides (never
        banned) and the 2 d + 2 smallest endpoints, d being the most overrides of
        a record. The smallest allowed partner is among them. Endpoints of a group
        with a free record are connected through it. In a group of endpoints alone
        any two miss at most 2 d of the 2 d + 2 together, so they share a partner.
        Rows grow with endpoints and overrides, not with the members of a group.
        """
        if self._endpoint is not None:
            return self._endpoint
        k = 2 * self.most_banned() + 2
        held = self.held()
        groups = written(held.select("gid").unionByName(held.select("gid").join(self.links, "gid").select(F.col("gid2").alias("gid"))).distinct())
        near = self.members.join(groups, "gid", "left_semi")
        free = near.join(self.endpoints, "node", "left_anti").groupBy("gid").agg(F.min("node").alias("other"))
        tied = partners.k_smallest(held, "gid", k).select("gid", F.col("node").alias("other"))
        met = written(free.unionByName(tied))
        via = held.join(self.links, "gid").select(F.col("gid2").alias("gid"), "node")
        pairs = held.select("gid", "node").unionByName(via).join(met, "gid").select("node", "other").where(F.col("node") != F.col("other")).distinct()
        # endpoints of a linked name meet its records too
        self._endpoint = written(pairs.join(self.banned(), ["node", "other"], "left_anti"))
        return self._endpoint

    def unmerged(self) -> DataFrame:
        """(node): records that an override parts from a match."""
        return self.parted().select("node").distinct()

    # -- best edges --------------------------------------------------------------------------------
    def _entries(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(members, holders, entries) of :mod:`aurum.operators.partners` for the pairwise rules.

        A holder is a key (equal id, equal phone, name block) with one of its names.
        Its cells: the same name, the same name but for case, a similar name, the
        same soundex, the whole key.
        """
        r = self.rows
        phone_key = ["organization", "sdx", "year", "ph8"] if self.blocks == "parity" else ["organization", "ph8"]
        block_key = ["organization", "sdx", "year"] if self.blocks == "parity" else ["organization", "sdx"]
        parts = []
        for kind, key in (("S", ["organization", "ssn"]), ("P", phone_key), ("N", block_key)):
            has = [F.col(c).isNotNull() for c in key] + ([F.col("full").isNotNull()] if kind == "N" else [])
            ok = has[0]
            for h in has[1:]:
                ok = ok & h
            parts.append(r.where(ok).select(F.lit(kind).alias("kind"), F.concat(F.lit(kind + "|"), _k(*key)).alias("gid"), "name", "norm", "sdx", "full", "node"))
        rows = written(parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct())
        is_s, is_n = F.col("kind") == "S", F.col("kind") == "N"
        cell = {"name": F.concat_ws("|", F.lit("a"), "gid", "name"), "norm": F.concat_ws("|", F.lit("b"), "gid", "norm"),
                "sdx": F.concat_ws("|", F.lit("c"), "gid", "sdx"), "gid": F.concat_ws("|", F.lit("d"), "gid")}
        use = {"name": F.lit(True), "norm": is_s, "sdx": ~is_n & F.col("sdx").isNotNull(), "gid": ~is_n}
        members = None
        for c, key in cell.items():
            one = rows.where(use[c]).select(key.alias("cell"), "node")
            members = one if members is None else members.unionByName(one)
        members = members.distinct()
        holders = rows.select(F.concat_ws("|", F.lit("a"), "gid", "name").alias("holder"), "node")
        names = written(rows.select("kind", "gid", "name", "norm", "sdx", "full").distinct())
        d = dict(rules.PAIR_SCORES)
        bonus = F.when(F.col("sdx").isNotNull(), F.lit(rules.SOUNDEX_BONUS)).otherwise(0.0)
        other = F.when(is_s, F.lit(d["D01b"])).otherwise(F.lit(d["D02"]))
        other_label = F.when(is_s, "D01b").otherwise("D02")
        equal = F.when(is_s, F.lit(d["D01"])).when(is_n, 0.0).otherwise(F.lit(d["D02"]))
        equal_label = F.when(is_s, "D01").when(is_n, "FUZZY").otherwise("D02")
        holder = F.concat_ws("|", F.lit("a"), "gid", "name").alias("holder")

        def entry(of: DataFrame, c: str, total: Column, label: Column) -> DataFrame:
            return of.where(use[c]).select(holder, cell[c].alias("cell"), total.alias("total"), label.alias("label"))

        entries = entry(names, "name", equal + F.when(F.col("full").isNotNull(), F.lit(1.0) * rules.FUZZY_NAME_WEIGHT).otherwise(0.0) + bonus, equal_label) \
            .unionByName(entry(names, "norm", F.lit(d["D01"]) + F.lit(0.0) + bonus, F.lit("D01"))) \
            .unionByName(entry(names, "sdx", other + F.lit(0.0) + F.lit(rules.SOUNDEX_BONUS), other_label)) \
            .unionByName(entry(names, "gid", other, other_label))
        return members, holders, entries.unionByName(self._similar_entries(names, other, d))

    def _similar_entries(self, names: DataFrame, other: Column, d: dict) -> DataFrame:
        """Entries of different names of one key whose full names are similar or equal."""
        named = names.where(F.col("full").isNotNull())
        several = named.where("kind <> 'N'").groupBy("gid").agg(F.min("full").alias("x"), F.max("full").alias("y")).where(F.col("x") != F.col("y")).select("gid")
        values = written(named.join(several, "gid", "left_semi").select("gid", F.col("full").alias("value")))
        found = similar_values(values, values, rules.FUZZY_NAME_LEAST, keys=["gid"]).where(F.col("left_value") != F.col("right_value")) \
            .select("gid", F.col("left_value").alias("a"), F.col("right_value").alias("b"), "jw")
        found = found.unionByName(self.names.select(F.concat(F.lit("N|"), "nblock").alias("gid"), "a", "b", "jw"))
        # equal full names that are split differently into first and last name
        twice = named.groupBy("gid", "full").agg(F.count("*").alias("n")).where("n > 1")
        found = written(found.unionByName(twice.select("gid", F.col("full").alias("a"), F.col("full").alias("b"), F.lit(1.0).alias("jw"))))
        x = named.select("kind", "gid", "name", "norm", "sdx", F.col("full").alias("a"))
        y = named.select("gid", F.col("name").alias("name2"), F.col("norm").alias("norm2"), F.col("sdx").alias("sdx2"), F.col("full").alias("b"))
        pairs = found.join(x, ["gid", "a"]).join(y, ["gid", "b"]).where(F.col("name") != F.col("name2"))
        same = (F.col("kind") == "S") & (F.col("norm") == F.col("norm2"))
        base = F.when(same, F.lit(d["D01"])).when(F.col("kind") == "N", 0.0).otherwise(other)
        label = F.when(same, "D01").when(F.col("kind") == "S", "D01b").when(F.col("kind") == "N", "FUZZY").otherwise("D02")
        bonus = F.when(F.col("sdx") == F.col("sdx2"), F.lit(rules.SOUNDEX_BONUS)).otherwise(0.0)
        return pairs.select(F.concat_ws("|", F.lit("a"), "gid", "name").alias("holder"), F.concat_ws("|", F.lit("a"), "gid", "name2").alias("cell"),
                            (base + F.col("jw") * rules.FUZZY_NAME_WEIGHT + bonus).alias("total"), label.alias("label"))

    def best_edges(self) -> DataFrame:
        """(node, other, total, label): the best edge of every record with a match, overrides applied (CL-04, SC-16)."""
        members, holders, entries = self._entries()
        if self.endpoints is None:
            return partners.best_partners(members, holders, entries)
        members, entries = written(members), written(entries)
        holders = written(holders)
        rest = partners.best_partners(members, holders, entries).join(self.endpoints, "node", "left_anti")
        tied = partners.best_allowed(members, holders.join(self.endpoints, "node", "left_semi"), entries, self.banned(), self.most_banned() + 2)
        return rest.unionByName(tied)

    def one_hop(self) -> DataFrame:
        """(node, cluster_id, best_neighbor): min of the closed neighbourhood, and
        the smallest neighbour other than the node itself (NULL = singleton)."""
        gm = graph.group_minima(self.members)
        own = self.members.join(gm, "gid")
        via = self.members.join(self.links, "gid").join(gm.withColumnRenamed("gid", "gid2"), "gid2")
        cand = own.select("node", "min1", "min2").unionByName(via.select("node", "min1", "min2"))
        other = F.when(F.col("min1") != F.col("node"), F.col("min1")).otherwise(F.col("min2"))
        agg = written(cand.groupBy("node").agg(F.min(other).alias("best_neighbor")))
        if self.endpoints is not None:
            agg = agg.join(self.endpoints, "node", "left_anti")
            ep = self._endpoint_pairs().groupBy("node").agg(F.min("other").alias("best_neighbor"))
            agg = agg.unionByName(ep)
        out = self.nodes.select("node").join(agg, "node", "left")
        return out.withColumn("cluster_id", F.least(F.col("node"), F.coalesce("best_neighbor", "node")))

    def edges(self) -> DataFrame:
        """Edge list with the same connectivity as the full match graph (stars + links)."""
        m = self.members
        if self.endpoints is not None:
            m = written(m.join(self.endpoints, "node", "left_anti"))
        stars = graph.star_edges(m)
        reps = written(m.groupBy("gid").agg(F.min("node").alias("rep")))
        links = self.links.join(reps, "gid").join(reps.select(F.col("gid").alias("gid2"), F.col("rep").alias("rep2")), "gid2") \
            .select(F.col("rep").alias("src"), F.col("rep2").alias("dst"))
        e = stars.unionByName(links)
        if self.endpoints is not None:
            e = e.unionByName(self._endpoint_pairs().select(F.col("node").alias("src"), F.col("other").alias("dst")))
        return e

    def components(self) -> DataFrame:
        return graph.connected_components(self.nodes.select("node"), self.edges()) \
            .withColumnRenamed("component", "cluster_id")

    def edge_scores(self, pairs: DataFrame) -> DataFrame:
        """Score node pairs (node, other) over their blocked rows; best row pair per node pair."""
        r = self.rows.select("node", *NODE_ATTRS, "sdx", "year", "ph8")
        a = r.select(*[F.col(c).alias(c + "_a") for c in r.columns])
        b = r.select(*[F.col(c).alias(c + "_b") for c in r.columns])
        met = {c: F.coalesce(F.col(c + "_a") == F.col(c + "_b"), F.lit(False)) for c in ("ssn", "sdx", "year", "ph8")}
        blocked = met["ssn"] | (met["sdx"] & met["year"]) if self.blocks == "parity" else met["ssn"] | met["sdx"] | met["ph8"]
        p = pairs.join(a, pairs.node == a.node_a).join(b, pairs.other == b.node_b).where(blocked)
        s = pairwise_rules()
        total, mtype = pairwise_total()
        p = p.select("node", "other", *[v.alias(k) for k, v in s.items()]).withColumn("total_score", total).withColumn("match_type", mtype)
        return p.groupBy("node", "other").agg(
            F.min_by(F.struct(*s.keys(), "total_score", "match_type"),
                     F.struct(-F.col("total_score"), F.col("match_type"), *[-F.col(k) for k in s.keys()])).alias("b")) \
            .select("node", "other", "b.*")


def clusters(g: MatchGraph, mode: str = "one_hop") -> DataFrame:
    """Per node: cluster id, label and score of its best edge, status (CL-01..05, CL-08).

    Status: UNMERGE where an override parts the record from a match, else
    STEWARD_QUEUE for a record without id and match, else MATCHED.
    """
    if mode == "transitive":
        found = g.components()
    else:
        found = g.one_hop().select("node", "cluster_id")
    found, best = written(found), written(g.best_edges().select("node", "label", "total"))
    out = g.nodes.join(found, "node").join(best, "node", "left")
    if g.endpoints is not None:
        out = out.join(g.unmerged().withColumn("parted", F.lit(True)).hint("merge"), "node", "left")
    else:
        out = out.withColumn("parted", F.lit(None).cast("boolean"))
    status = F.when(F.col("parted"), "UNMERGE").when(F.col("label").isNull() & F.col("ssn").isNull(), "STEWARD_QUEUE").otherwise("MATCHED")
    return out.select("source_system", "source_key", "organization", "cluster_id", F.coalesce("label", F.lit("SINGLETON")).alias("match_type"),
                      F.round("total", 6).alias("match_score"), status.alias("match_status"))


# ------------------------------------------------------------------------------------ golden

def _priority(col_src: str, org: str, table: dict) -> Column:
    return F.coalesce(*[F.when(F.col(col_src) == k, F.lit(v)) for k, v in table.items()], F.lit(3))


def source_priority() -> Column:
    return F.when(F.col("organization") == "BANK", _priority("source_system", "BANK", rules.PRIORITY_BANK)) \
        .otherwise(_priority("source_system", "INS", rules.PRIORITY_INS))


def citizenship_priority() -> Column:
    return F.when(F.col("organization") == "BANK", _priority("source_system", "BANK", rules.CITIZENSHIP_PRIORITY_BANK)) \
        .otherwise(_priority("source_system", "INS", rules.CITIZENSHIP_PRIORITY_INS))


def golden_rules(prio: Column, cprio: Column) -> list[Rule]:
    tie = [desc_date("record_date"), F.col("source_system"), F.col("source_key"), F.col("_source_file")]

    def r(name, valid, p=prio):
        return Rule(name, F.col(name), [p, *tie], valid, fallback=True)

    return [
        r("ssn", F.col("ssn").isNotNull()),
        r("first_name", F.length(F.trim(F.coalesce("first_name", F.lit("")))) > 1),
        r("last_name", F.length(F.trim(F.coalesce("last_name", F.lit("")))) > 1),
        r("birth_date", F.col("birth_date").isNotNull()),
        r("citizenship", F.col("citizenship").isNotNull(), cprio),
        r("phone", F.col("phone").isNotNull() & (F.length(digits("phone")) >= 8)),
        r("email", F.col("email").like("%@%")),
    ]


def golden(enr: DataFrame, cl: DataFrame) -> DataFrame:
    """Survivorship per (cluster, org), one aggregation (GD-02), then quality (DQ-*)."""
    grouped = enr.join(cl.select("source_system", "source_key", "organization", "cluster_id"),
                       ["source_system", "source_key", "organization"]) \
        .withColumn("_prio", source_priority()).withColumn("_cprio", citizenship_priority())
    tie = [desc_date("record_date"), F.col("source_system"), F.col("source_key"), F.col("_source_file")]
    g = survive(grouped, ["cluster_id", "organization"], golden_rules(F.col("_prio"), F.col("_cprio")), [
        F.min_by("record_date", F.struct(F.col("_prio"), *tie)).alias("record_date"),
        F.size(F.collect_set("source_system")).cast("long").alias("source_count"),
        F.max(F.col("is_fake_name").cast("int")).cast("boolean").alias("is_fake_name"),
        F.max(F.col("ssn_valid").cast("int")).cast("boolean").alias("ssn_valid"),
    ])
    g = score_quality(g, customer_rules_bulk(), fired="dq_fired_rules")
    return g.select("cluster_id", "organization", "ssn", "first_name", "last_name", "birth_date", "citizenship",
                    "phone", "email", "record_date", "source_count", "is_fake_name", "ssn_valid", "dq_score", "dq_fired_rules")


GOLDEN_OUT = ["cluster_id", "organization", "ssn", "first_name", "last_name", "birth_date", "citizenship",
              "phone", "email", "record_date", "source_count", "dq_score"]
TRACKED_V2 = ["ssn", "first_name", "last_name", "birth_date", "citizenship", "phone", "email", "dq_score"]


def history(enr: DataFrame, cl: DataFrame) -> DataFrame:
    """SCD2 of golden versions at every file date (HS-04 semantics on HS-01/02 snapshots, R5)."""
    grouped = enr.join(cl.select("source_system", "source_key", "organization", "cluster_id"),
                       ["source_system", "source_key", "organization"]) \
        .withColumn("_prio", source_priority()).withColumn("_cprio", citizenship_priority())
    key = ["cluster_id", "organization"]
    tie = [desc_date("record_date"), F.col("source_system"), F.col("source_key"), F.col("_source_file")]
    rl = golden_rules(F.col("_prio"), F.col("_cprio"))

    def st(r: Rule) -> Column:
        inv = F.when(r.valid, F.lit(0)).otherwise(F.lit(1))
        return F.min(F.struct(inv.alias("i"), *[k.alias(f"k{i}") for i, k in enumerate(r.order)], r.value.alias("v"))).alias(r.output)

    per_date = grouped.groupBy(*key, "record_date").agg(
        *[st(r) for r in rl],
        F.min(F.struct(F.col("_prio"), *tie)).alias("_q"),
        F.max(F.col("is_fake_name").cast("int")).alias("_fake"), F.max(F.col("ssn_valid").cast("int")).alias("_sv"))
    first_seen = grouped.groupBy(*key, "source_system").agg(F.min("record_date").alias("record_date")) \
        .groupBy(*key, "record_date").agg(F.count("*").alias("new_sources"))
    w = Window.partitionBy(*key).orderBy("record_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    snap = per_date.join(first_seen.hint("merge"), key + ["record_date"], "left").select(
        *key, F.col("record_date").alias("snapshot_date"),
        *[F.min(r.output).over(w)["v"].alias(r.output) for r in rl],
        F.sum(F.coalesce("new_sources", F.lit(0))).over(w).cast("long").alias("source_count"),
        (F.max("_fake").over(w) == 1).alias("is_fake_name"), (F.max("_sv").over(w) == 1).alias("ssn_valid"))
    snap = score_quality(snap, customer_rules_bulk())
    from aurum.plans.ssn_first import scd2
    return scd2(snap, key, "snapshot_date", TRACKED_V2, "|").select(
        *key, "ssn", "first_name", "last_name", "birth_date", "citizenship", "phone", "email", "dq_score",
        "source_count", "valid_from", "valid_to", "is_valid", "row_hash")


# ------------------------------------------------------------------------------------ addresses

def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_addresses(inputs.addresses(spark, sf_dir, "FREG"), inputs.addresses(spark, sf_dir, "BS"),
                           inputs.addresses(spark, sf_dir, "NICE"))


def alias_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alias classes of the surrogate keys (records without a national id)."""
    surrogates = enriched(spark, sf_dir).where(F.col("ssn").isNull())
    return layer(spark, ("v2_aliases", sf_dir), lambda: aliases.alias_classes(surrogates))


def address_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layer(spark, ("v2_address_links", sf_dir),
                 lambda: aliases.address_links(addresses(spark, sf_dir), alias_classes(spark, sf_dir)))


def linked_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The addresses of all feeds, also under surrogate keys that only aliases of them have addresses for."""
    return aliases.link_addresses(addresses(spark, sf_dir), address_links(spark, sf_dir))


def address_groups(addr: DataFrame, cl: DataFrame) -> DataFrame:
    """Address -> customer cluster on (system, customer key, org) (JN-09)."""
    c = cl.select("source_system", F.col("source_key").alias("source_customer_key"), "organization", "cluster_id")
    return addr.join(c, ["source_system", "source_customer_key", "organization"]) \
        .select("cluster_id", "organization", "source_system", "source_key", "source_customer_key") \
        .distinct().withColumn("address_id", node_id())


def address_golden(addr: DataFrame, cl: DataFrame) -> DataFrame:
    """Golden address per (cluster, org) with address quality (GD-05, DQ-011..N02)."""
    c = cl.select("source_system", F.col("source_key").alias("source_customer_key"), "organization", "cluster_id")
    g = addr.join(c, ["source_system", "source_customer_key", "organization"]) \
        .withColumn("_prio", F.coalesce(*[F.when(F.col("source_system") == k, F.lit(v)) for k, v in rules.ADDRESS_PRIORITY.items()], F.lit(3)))
    tie = [desc_date("file_date"), F.col("source_system"), F.col("source_key"), F.col("_source_file")]
    pr = F.col("_prio")
    out = survive(g, ["cluster_id", "organization"], [
        Rule("gate", F.col("gate"), [pr, *tie], F.length(F.trim(F.coalesce("gate", F.lit("")))) >= 3, fallback=True),
        Rule("postnummer", F.col("postnummer"), [pr, *tie], F.col("postnummer").isNotNull(), fallback=True),
        Rule("by", F.col("by"), [pr, *tie], F.col("by").isNotNull(), fallback=True),
        Rule("land", F.col("land"), [F.when(F.col("land").isNotNull(), pr).otherwise(F.lit(99)), *tie], None, fallback=True),
    ], [F.max("file_date").alias("last_updated"), F.count("*").cast("long").alias("source_rows")])
    out = score_quality(out, address_rules(), fired="dq_fired_rules")
    return out.select("cluster_id", "organization", F.lit("PRIMARY").alias("address_type"), "gate", "postnummer", "by",
                      "land", F.lit(True).alias("is_primary"), "last_updated", "dq_score", "dq_fired_rules")


def address_history(addr: DataFrame, cl: DataFrame) -> DataFrame:
    """Address SCD2 from snapshots at every file date (HS-05)."""
    c = cl.select("source_system", F.col("source_key").alias("source_customer_key"), "organization", "cluster_id")
    g = addr.join(c, ["source_system", "source_customer_key", "organization"]) \
        .withColumn("_prio", F.coalesce(*[F.when(F.col("source_system") == k, F.lit(v)) for k, v in rules.ADDRESS_PRIORITY.items()], F.lit(3)))
    key = ["cluster_id", "organization"]
    tie = [desc_date("file_date"), F.col("source_system"), F.col("source_key"), F.col("_source_file")]

    def st(name, valid, first):
        inv = F.when(valid, F.lit(0)).otherwise(F.lit(1)) if valid is not None else F.lit(0)
        return F.min(F.struct(inv.alias("i"), first.alias("p"), *[k.alias(f"k{i}") for i, k in enumerate(tie)], F.col(name).alias("v"))).alias(name)

    per_date = g.groupBy(*key, "file_date").agg(
        st("gate", F.length(F.trim(F.coalesce("gate", F.lit("")))) >= 3, F.col("_prio")),
        st("postnummer", F.col("postnummer").isNotNull(), F.col("_prio")),
        st("by", F.col("by").isNotNull(), F.col("_prio")),
        st("land", None, F.when(F.col("land").isNotNull(), F.col("_prio")).otherwise(F.lit(99))))
    w = Window.partitionBy(*key).orderBy("file_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    snap = per_date.select(*key, F.col("file_date").alias("snapshot_date"),
                           *[F.min(c).over(w)["v"].alias(c) for c in ["gate", "postnummer", "by", "land"]])
    snap = score_quality(snap, address_rules()).withColumn("address_type", F.lit("PRIMARY")).withColumn("is_primary", F.lit(True))
    from aurum.plans.ssn_first import scd2
    tracked = ["address_type", "gate", "postnummer", "by", "land", "is_primary", "dq_score"]
    return scd2(snap, key, "snapshot_date", tracked, "|").select(
        *key, "address_type", "gate", "postnummer", "by", "land", "is_primary", "dq_score",
        "valid_from", "valid_to", "is_valid", "row_hash")


__all__ = ["enriched", "MatchGraph", "clusters", "golden", "history", "addresses", "address_groups",
           "address_golden", "address_history"]


# ------------------------------------------------------------------------------------ queries

from aurum.plans import pairwise_sql as PS  # noqa: E402
from aurum.plans.catalog import register  # noqa: E402
from aurum.plans.sqlfrag import tier  # noqa: E402


def clusters_for(spark, sf_dir, blocks="parity", mode="transitive", canonical="initcap"):
    enr = enriched(spark, sf_dir, canonical)
    cl = layer(spark, ("v2_clusters", sf_dir, blocks, mode, canonical),
               lambda: clusters(MatchGraph(enr, blocks, inputs.overrides(spark, sf_dir)), mode))
    return enr, cl


CL_COLS = ["source_system", "source_key", "organization", "cluster_id", "match_type", "match_score", "match_status"]
SQL_CL_ONEHOP = PS.clusters("parity", "one_hop") + "\nSELECT * FROM v2_clusters"
SQL_CL_TRANS = PS.clusters("extended", "transitive") + "\nSELECT * FROM v2_clusters"


@register("cluster_one_hop", SQL_CL_ONEHOP, "CL-01, CL-04, CL-05, BLK-01, BLK-02, BLK-07, SC-01..06, JN-04")
def q_cluster_one_hop(spark, sf_dir):
    return clusters_for(spark, sf_dir, "parity", "one_hop")[1].select(*CL_COLS)


@register("cluster_transitive", SQL_CL_TRANS, "CL-02, CL-08, BLK-03, BLK-05, R6")
def q_cluster_transitive(spark, sf_dir):
    return clusters_for(spark, sf_dir, "extended", "transitive")[1].select(*CL_COLS)


# the golden chain: reference blocking, transitive clusters (spec), overrides applied
GOLD_SQL = PS.clusters("parity", "transitive") + PS.golden()


@register("golden_v2", GOLD_SQL + "\nSELECT cluster_id, organization, ssn, first_name, last_name, birth_date, citizenship, "
          "phone, email, record_date, source_count, dq_score FROM v2_golden", "GD-02, WN-02, WN-03, AG-01, AG-02, JN-05, DQ-001, DQ-002, DQ-003, DQ-004, DQ-005, DQ-006, DQ-007, DQ-008, DQ-N03, DQ-AI01, DQ-X03")
def q_golden_v2(spark, sf_dir):
    enr, cl = clusters_for(spark, sf_dir)
    return golden(enr, cl).select(*GOLDEN_OUT)


@register("dq_fired_rules", GOLD_SQL + "\nSELECT cluster_id, organization, dq_score, dq_fired_rules FROM v2_golden", "DQ-ENG")
def q_dq_fired(spark, sf_dir):
    enr, cl = clusters_for(spark, sf_dir)
    return golden(enr, cl).select("cluster_id", "organization", "dq_score", "dq_fired_rules")


ADDR_SQL = PS.clusters("parity", "transitive") + PS.address_golden()


@register("address_golden", ADDR_SQL + "\nSELECT * FROM a2_golden", "GD-05, GD-07, PRJ-03, JN-09, DQ-011..N02")
def q_address_golden(spark, sf_dir):
    enr, cl = clusters_for(spark, sf_dir)
    return address_golden(linked_addresses(spark, sf_dir), cl)


# ------------------------------------------------------------------------------------ serving

from aurum.operators import serving  # noqa: E402

V2_SQL = PS.clusters("parity", "transitive") + PS.golden() + PS.address_golden()


def v2_chain(spark, sf_dir):
    enr, cl = clusters_for(spark, sf_dir)
    gold = layer(spark, ("v2_golden", sf_dir), lambda: golden(enr, cl))
    addr = linked_addresses(spark, sf_dir)
    return enr, cl, gold, addr


@register("steward_queue_v2", PS.clusters("parity", "transitive") + """
SELECT e.source_key, e.source_system, e.organization, e.first_name, e.last_name, e.phone, e.email, e.record_date
FROM v2_clusters c JOIN v2_enriched e USING (source_system, source_key, organization)
WHERE c.match_status = 'STEWARD_QUEUE'""", "CL-05, HS-11")
def q_steward_queue_v2(spark, sf_dir):
    enr, cl = clusters_for(spark, sf_dir)
    return cl.where(F.col("match_status") == "STEWARD_QUEUE").join(enr, ["source_system", "source_key", "organization"]) \
        .select("source_key", "source_system", "organization", "first_name", "last_name", "phone", "email", "record_date")


@register("steward_queue_by_org", PS.clusters("parity", "transitive") + """
SELECT e.organization, count(*) OVER org AS queued, max(e.record_date) OVER org AS newest, min(e.record_date) OVER org AS oldest,
       e.record_date, e.source_system, e.source_key, e.first_name, e.last_name, e.phone, e.email
FROM v2_clusters c JOIN v2_enriched e USING (source_system, source_key, organization)
WHERE c.match_status = 'STEWARD_QUEUE' WINDOW org AS (PARTITION BY e.organization)
ORDER BY 1, 5 DESC, 6, 7, 8, 9, 10, 11""", "SV-06")
def q_steward_by_org(spark, sf_dir):
    """The steward's queue by organisation, newest record first, beside the length of the organisation's queue and its newest and oldest date."""
    # a written queue is sorted and counted without joining it again, and AQE can split its join where one organisation holds most of it
    queue = written(q_steward_queue_v2(spark, sf_dir))
    totals = written(queue.groupBy("organization").agg(
        F.count("*").alias("queued"), F.max("record_date").alias("newest"), F.min("record_date").alias("oldest")))
    return queue.join(totals, "organization") \
        .select("organization", "queued", "newest", "oldest", "record_date", "source_system", "source_key", "first_name", "last_name", "phone", "email") \
        .orderBy("organization", F.desc("record_date"), "source_system", "source_key", "first_name", "last_name", "phone", "email")


@register("steward_list_by_org", PS.clusters("parity", "transitive") + """
SELECT e.organization, e.record_date, e.source_system, e.source_key, e.first_name, e.last_name, e.phone, e.email
FROM v2_clusters c JOIN v2_enriched e USING (source_system, source_key, organization)
WHERE c.match_status = 'STEWARD_QUEUE' ORDER BY 1, 2 DESC, 3, 4""", "SV-06")
def q_steward_list(spark, sf_dir):
    """The steward's list by organisation, newest record first."""
    return q_steward_queue_v2(spark, sf_dir).select("organization", "record_date", "source_system", "source_key", "first_name", "last_name", "phone", "email") \
        .orderBy("organization", F.desc("record_date"), "source_system", "source_key")


@register("cluster_numbering", PS.clusters("parity", "transitive") + """
SELECT organization, cluster_id, dense_rank() OVER (PARTITION BY organization ORDER BY cluster_id) AS customer_group_id
FROM (SELECT DISTINCT organization, cluster_id FROM v2_clusters)""", "CL-03, WN-07")
def q_cluster_numbering(spark, sf_dir):
    cl = clusters_for(spark, sf_dir)[1].select("organization", "cluster_id").distinct()
    return graph.dense_number(cl, ["cluster_id"], ["organization"], out="customer_group_id")


@register("cluster_stats", PS.clusters("parity", "transitive") + """
SELECT organization, cluster_size, count(*) AS clusters FROM (
  SELECT organization, cluster_id, count(*) AS cluster_size FROM v2_clusters GROUP BY 1, 2) GROUP BY 1, 2""", "CL-09")
def q_cluster_stats(spark, sf_dir):
    cl = clusters_for(spark, sf_dir)[1]
    return cl.groupBy("organization", "cluster_id").agg(F.count("*").alias("cluster_size")) \
        .groupBy("organization", "cluster_size").agg(F.count("*").alias("clusters"))


@register("xref_customer", PS.clusters("parity", "transitive") + """
SELECT row_number() OVER (ORDER BY cluster_id, organization, source_system, source_key) AS xref_id,
       cluster_id, organization, source_system, source_key FROM v2_clusters""", "HS-09, WN-08")
def q_xref_customer(spark, sf_dir):
    cl = clusters_for(spark, sf_dir)[1].select("cluster_id", "organization", "source_system", "source_key")
    return graph.dense_number(cl, ["cluster_id", "organization", "source_system", "source_key"], out="xref_id")


@register("address_groups", V2_SQL + """
SELECT DISTINCT cluster_id, organization, source_system, source_key, source_customer_key,
       concat_ws('|', organization, source_system, source_key) AS address_id FROM a2_grouped""", "JN-09, ST-02")
def q_address_groups(spark, sf_dir):
    _, cl, _, addr = v2_chain(spark, sf_dir)
    return address_groups(addr, cl)


@register("surrogate_aliases", PS.clusters("parity", "transitive") + PS.addresses() + """
SELECT source_system, source_key, owner_key FROM a2_link""", "CK-02")
def q_surrogate_aliases(spark, sf_dir):
    """Surrogate keys without an address of their own, and the alias whose addresses they take."""
    return address_links(spark, sf_dir)


@register("xref_address", V2_SQL + """
SELECT row_number() OVER (ORDER BY address_id, organization, source_system, source_key, cluster_id) AS xref_id,
       address_id, cluster_id, organization, source_system, source_key
FROM (SELECT DISTINCT cluster_id, organization, source_system, source_key,
             concat_ws('|', organization, source_system, source_key) AS address_id FROM a2_grouped)""", "HS-09, WN-08")
def q_xref_address(spark, sf_dir):
    _, cl, _, addr = v2_chain(spark, sf_dir)
    ag = address_groups(addr, cl).select("address_id", "cluster_id", "organization", "source_system", "source_key").distinct()
    return graph.dense_number(ag, ["address_id", "organization", "source_system", "source_key", "cluster_id"], out="xref_id")


@register("history_v2", V2_SQL + PS.history() + "\nSELECT * FROM v2_history", "HS-04, HS-01, HS-02, WN-05, WN-06")
def q_history_v2(spark, sf_dir):
    enr, cl = clusters_for(spark, sf_dir)
    return history(enr, cl)


@register("address_history", V2_SQL + PS.address_history() + "\nSELECT * FROM a2_history", "HS-05")
def q_address_history(spark, sf_dir):
    _, cl, _, addr = v2_chain(spark, sf_dir)
    return address_history(addr, cl)


PIT_DATE = "2024-01-01"


@register("history_point_in_time", V2_SQL + PS.history() + f"""
SELECT cluster_id, organization, first_name, last_name, phone, email, dq_score, valid_from
FROM v2_history WHERE valid_from <= DATE '{PIT_DATE}' AND DATE '{PIT_DATE}' < valid_to""", "HS-07")
def q_pit(spark, sf_dir):
    h = q_history_v2(spark, sf_dir)
    return serving.point_in_time(h, PIT_DATE).select("cluster_id", "organization", "first_name", "last_name", "phone",
                                                      "email", "dq_score", "valid_from")


@register("golden_diff", V2_SQL + PS.history() + """,
gd_pairs AS (
  SELECT cluster_id, organization, valid_from AS changed_at,
         lag(first_name) OVER w AS o_first_name, first_name AS n_first_name,
         lag(last_name) OVER w AS o_last_name, last_name AS n_last_name,
         lag(phone) OVER w AS o_phone, phone AS n_phone, lag(email) OVER w AS o_email, email AS n_email,
         CAST(lag(dq_score) OVER w AS VARCHAR) AS o_dq_score, CAST(dq_score AS VARCHAR) AS n_dq_score,
         row_number() OVER w AS rn
  FROM v2_history WINDOW w AS (PARTITION BY cluster_id, organization ORDER BY valid_from)
)
SELECT * FROM (
  SELECT cluster_id, organization, changed_at, 'first_name' AS field, o_first_name AS old_value, n_first_name AS new_value FROM gd_pairs WHERE rn > 1
  UNION ALL SELECT cluster_id, organization, changed_at, 'last_name', o_last_name, n_last_name FROM gd_pairs WHERE rn > 1
  UNION ALL SELECT cluster_id, organization, changed_at, 'phone', o_phone, n_phone FROM gd_pairs WHERE rn > 1
  UNION ALL SELECT cluster_id, organization, changed_at, 'email', o_email, n_email FROM gd_pairs WHERE rn > 1
  UNION ALL SELECT cluster_id, organization, changed_at, 'dq_score', o_dq_score, n_dq_score FROM gd_pairs WHERE rn > 1
) WHERE old_value IS DISTINCT FROM new_value""", "HS-12")
def q_golden_diff(spark, sf_dir):
    return serving.golden_diff(q_history_v2(spark, sf_dir), ["cluster_id", "organization"], "valid_from",
                               ["first_name", "last_name", "phone", "email", "dq_score"])


@register("customer_360", V2_SQL + """,
c360_addr AS (
  SELECT cluster_id, organization, count(*) AS address_count,
         max(CASE WHEN is_primary THEN gate END) AS primary_gate, max(CASE WHEN is_primary THEN "by" END) AS primary_by,
         max(CASE WHEN is_primary THEN postnummer END) AS primary_postnummer, max(CASE WHEN is_primary THEN land END) AS primary_land,
         max(CASE WHEN is_primary THEN dq_score END) AS primary_address_dq_score,
         CAST(to_json(list({'address_id': cluster_id || '|' || organization || '|' || address_type, 'type': address_type, 'gate': gate,
                       'by': "by", 'postnummer': postnummer, 'land': land, 'is_primary': is_primary, 'dq_score': dq_score}
                      ORDER BY address_type, gate)) AS VARCHAR) AS all_addresses
  FROM a2_golden GROUP BY cluster_id, organization
)
SELECT g.cluster_id, g.first_name, g.last_name, g.first_name || ' ' || g.last_name AS full_name, g.email, g.phone,
       g.dq_score, """ + tier("g.dq_score") + """ AS dq_tier, g.source_count, g.record_date AS last_updated, g.ssn, g.birth_date,
       g.citizenship, g.organization, COALESCE(a.address_count, 0) AS address_count, a.primary_gate, a.primary_by,
       a.primary_postnummer, a.primary_land,
       concat_ws(', ', a.primary_gate, a.primary_by, a.primary_postnummer, a.primary_land) AS primary_address_full,
       a.all_addresses, a.primary_address_dq_score
FROM v2_golden g LEFT JOIN c360_addr a ON a.cluster_id = g.cluster_id AND a.organization = g.organization""", "SV-01, AG-04, JN-07, FN-14, FN-15")
def q_customer_360(spark, sf_dir):
    enr, cl, gold, addr = v2_chain(spark, sf_dir)
    return serving.customer_360(gold, address_golden(addr, cl))


@register("customer_360_flat", V2_SQL + """
SELECT g.cluster_id, g.first_name, g.last_name, g.email, g.phone, g.dq_score, """ + tier("g.dq_score") + """ AS dq_tier,
       g.source_count, g.record_date AS last_updated, g.ssn, g.birth_date, g.citizenship, g.organization,
       g.cluster_id || '|' || g.organization || '|' || a.address_type AS address_id, a.address_type, a.gate, a."by" AS city,
       a.postnummer, a.land, a.is_primary, a.dq_score AS address_dq_score
FROM v2_golden g LEFT JOIN a2_golden a ON a.cluster_id = g.cluster_id AND a.organization = g.organization""", "SV-02, JN-07")
def q_customer_360_flat(spark, sf_dir):
    enr, cl, gold, addr = v2_chain(spark, sf_dir)
    return serving.customer_360_flat(gold, address_golden(addr, cl))


@register("cross_org", V2_SQL + """
SELECT b.ssn, b.first_name AS bank_first_name, b.last_name AS bank_last_name, b.email AS bank_email, b.phone AS bank_phone,
       i.first_name AS ins_first_name, i.last_name AS ins_last_name, i.email AS ins_email, i.phone AS ins_phone,
       b.citizenship, b.birth_date
FROM v2_golden b JOIN v2_golden i ON b.ssn = i.ssn AND b.organization = 'BANK' AND i.organization = 'INS'""", "SV-03, JN-08")
def q_cross_org(spark, sf_dir):
    return serving.cross_org(v2_chain(spark, sf_dir)[2])


SEARCH_TERM = "hansen"


@register("search_golden", V2_SQL + f"""
SELECT cluster_id, organization, first_name, last_name, email, dq_score FROM v2_golden
WHERE cluster_id ILIKE '%{SEARCH_TERM}%' OR first_name ILIKE '%{SEARCH_TERM}%' OR last_name ILIKE '%{SEARCH_TERM}%'
   OR email ILIKE '%{SEARCH_TERM}%'
ORDER BY cluster_id, organization LIMIT 20""", "SV-04, FN-17")
def q_search(spark, sf_dir):
    return serving.search(v2_chain(spark, sf_dir)[2], SEARCH_TERM, 20)


@register("search_with_address", V2_SQL + """
SELECT g.cluster_id, g.organization, g.first_name, g.last_name, g.dq_score, a.gate, a."by"
FROM v2_golden g JOIN a2_golden a ON a.cluster_id = g.cluster_id AND a.organization = g.organization
WHERE (a."by" ILIKE '%bergen%' OR a.gate ILIKE '%bergen%' OR g.last_name ILIKE '%bergen%') AND g.dq_score >= 90
ORDER BY g.cluster_id, g.organization LIMIT 50""", "SV-05")
def q_search_addr(spark, sf_dir):
    enr, cl, gold, addr = v2_chain(spark, sf_dir)
    return serving.search_with_address(gold, address_golden(addr, cl), "bergen", 90, 50)


@register("top_golden", V2_SQL + """
SELECT t.cluster_id, t.organization, t.first_name, t.last_name, t.dq_score, t.source_count, a.gate, a."by", a.postnummer
FROM (SELECT * FROM v2_golden ORDER BY dq_score DESC, source_count DESC, cluster_id, organization LIMIT 10) t
LEFT JOIN a2_golden a ON a.cluster_id = t.cluster_id AND a.organization = t.organization""", "SV-07")
def q_top_golden(spark, sf_dir):
    enr, cl, gold, addr = v2_chain(spark, sf_dir)
    return serving.top_golden(gold, address_golden(addr, cl), 10)


@register("lineage", V2_SQL + """
SELECT e.source_system, e.source_key, e.organization, e.record_date, e._source_file, g.cluster_id,
       e.first_name AS source_first_name, g.first_name AS golden_first_name, e.email AS source_email, g.email AS golden_email
FROM v2_enriched e JOIN v2_clusters c USING (source_system, source_key, organization)
JOIN v2_golden g ON g.cluster_id = c.cluster_id AND g.organization = c.organization""", "HS-10")
def q_lineage(spark, sf_dir):
    enr, cl, gold, addr = v2_chain(spark, sf_dir)
    return serving.lineage(enr, cl, gold)


@register("customer_card", V2_SQL + """,
card_id AS (SELECT min(cluster_id) AS cluster_id FROM v2_golden WHERE organization = 'BANK'
            AND source_count = (SELECT max(source_count) FROM v2_golden WHERE organization = 'BANK'))
SELECT c.cluster_id, c.organization, c.source_system, c.source_key, e.first_name, e.last_name, e.email, e.record_date,
       g.first_name AS golden_first_name, g.last_name AS golden_last_name, g.dq_score
FROM v2_clusters c JOIN card_id USING (cluster_id) JOIN v2_enriched e USING (source_system, source_key, organization)
JOIN v2_golden g ON g.cluster_id = c.cluster_id AND g.organization = c.organization
WHERE c.organization = 'BANK'""", "SV-08, HS-08")
def q_customer_card(spark, sf_dir):
    enr, cl, gold, addr = v2_chain(spark, sf_dir)
    return serving.customer_card(enr, cl, gold, "BANK")
